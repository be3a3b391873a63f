"""Registered queries of the pipeline operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_bucket, table
from . import (chat_format, conversation_repair, decontaminate, exact_dedup, line_dedup, lm_scoring, mixing, near_dedup,
               pii, quality_rules, token_counts, toxicity, vector_codes)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """The model learned from labels of rows whose crc32 modulo 3 is not 1."""
    labels = table(spark, sf_dir, "labels").filter(crc_bucket("doc_id", 3) != 1)
    return toxicity.fit(docs, labels)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.with_scores(docs.select("doc_id", "text"), toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"), "n_hits")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        decontaminate.is_contaminated().alias("contaminated"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the boilerplate lines of their hosts."""
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents."""
    near = near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model and base scores of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_scoring.score_documents(docs, crc_bucket("doc_id", 10) != 0)
    return scored.select("doc_id", (crc_bucket("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents``, dropped rows included."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), carry=[digest]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: A conversation whose texts are control strings of the template.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the formatted conversations, read back from the formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    made = chat_format.format_conversations(turns.unionByName(planted))
    back = chat_format.read_back(F.col("formatted"))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat_format.unescape(s["text"]))
    rows = made.select("conv_id", "valid", "bad_turn", back.alias("turns"), F.array_join(loss, "").alias("loss"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars", "valid")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents taken into the mixture, one row per epoch."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("mix_domain").alias("domain"), "lang", "source", F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_epoch").alias("epoch"))


def edits_of(text) -> list:
    """Two edits of every document, taken from its own text: its first word over seven characters
    at a third, and its last 40 characters again at two thirds."""
    n = F.length(text)
    kind = "struct<pos:int,del:int,ins:string>"
    one = F.struct(F.floor(n / 3).alias("pos"), F.lit(7).alias("del"), F.substring_index(text, " ", 1).alias("ins"))
    two = F.struct(F.floor(n * 2 / 3).alias("pos"), F.lit(0).alias("del"), F.right(text, F.lit(40)).alias("ins"))
    return F.array(one.cast(kind), two.cast(kind))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after two edits, and the characters encoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = token_counts.token_trees(docs).withColumn("n_before", F.col("n_tokens"))
    body = F.coalesce("text", F.lit(""))
    edited = token_counts.apply_edits(trees.withColumn("edits", edits_of(body)).withColumn("n_chars", F.length(body)))
    return edited.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "n_before",
                         F.col("n_tokens").alias("n_after"), F.length("text").cast("long").alias("n_chars_after"),
                         F.col("n_again").alias("n_encoded_again"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(pii.BASE))
    return found.select("doc_id", *[count(k) for k in pii.BASE],
                        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
                        pii.span_list(F.col("spans")).alias("spans"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code of every vector, with the errors of its label."""
    coded, codebook = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(vector_codes.codebook_digest(codebook)).alias("codebooks_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns as the contract damages them; a dropped turn stays as a row that only names its conversation."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"),
                        (F.crc32(name.cast("binary")) % 20).alias("harm"))
    copies = (F.when(F.col("harm") == 0, F.array(F.lit(True))).when(F.col("harm") == 3, F.array(F.lit(False), F.lit(False)))
              .otherwise(F.array(F.lit(False))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), F.explode(copies).alias("gone"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    turns = damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    made = conversation_repair.repair_digests(turns, gone=F.col("gone"))
    return made.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                       "audit", "repaired_sha256")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and certified rules on every document."""
    rows = quality_rules.counted(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    settings = quality_rules.fit(rows, table(spark, sf_dir, "labels"))
    return quality_rules.judge(rows, settings).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("rejected_by", ",").alias("rejected_by"))


Q = {f.__name__: f for f in (
    op1_toxicity, op2_decontaminate, op3_line_dedup, op4_near_dedup, op5_lm_scoring, op6_exact_dedup,
    op7_chat_format, op8_mixing, op9_token_counts, op10_pii, op11_vector_codes,
    op12_conversation_repair, op13_quality_rules)}
