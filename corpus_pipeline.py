"""The corpus pipeline: toxicity, exact dedup, near dedup, benchmark decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result as Parquet into the shared folder and reads it back as the next one's documents.
All stages but the last return the columns of ``documents``.

Rows are told apart by ``doc_id`` and a hash of the text, so NULL and repeated ids are handled:
decisions about a text hold for the rows with that id and text.  An empty table stays empty.  Extra
columns are kept, maps too; names that begin with two underscores belong to the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertsieve.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from alertsieve.llm.common import crc_bucket, least_row, stored, table


ROW = "__row_key"


def _row_key():
    return F.xxhash64("doc_id", "text").alias(ROW)


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in ``rows`` (written, so that Spark knows its size)."""
    return (docs.withColumn(ROW, _row_key())
            .join(stored(rows.select(ROW), "drop"), ROW, "left_anti").drop(ROW))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.  It learns from labelled documents whose
    crc32 modulo 3 is not 1; without labels of both kinds nothing is rejected."""
    labels = table(spark, sf_dir, "labels").filter(crc_bucket("doc_id", 3) != 1)
    model = toxicity.fit(docs, labels)
    return toxicity.with_scores(docs, model, score="__score", hits="__hits").filter(
        F.col("__score") < toxicity.REJECT).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays (NULL counts as the empty text)."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every near-duplicate component one row stays: the smallest doc_id, of its rows the one
    with the smallest text hash; of rows equal in both, one."""
    near = stored(near_dedup.near_duplicates(docs.select("doc_id", "text"), carry=[_row_key()])
                  .select(ROW, "component", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id")), "near-decisions")
    inside = near.filter("component IS NOT NULL")
    stays = stored(inside.groupBy("component").agg(F.min(F.struct("id", ROW)).alias("s"))
                   .select("component", F.col(f"s.{ROW}").alias("stays")), "near-stays")
    goes = inside.join(stays, "component").filter(F.col(ROW) != F.col("stays")).select(ROW)
    keyed = _without(docs, goes).withColumn(ROW, _row_key())
    # rows equal in id and text share a key: one of them stays (texts without words are linked with nothing)
    again = stored(inside.groupBy(ROW).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(ROW), "near-again")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = keyed.join(again, ROW, "left_anti").select(*columns)
    many = (keyed.join(again, ROW, "left_semi").groupBy(ROW)
            .agg(least_row(F.struct(*columns), docs.schema).alias("r")).select("r.*"))
    return once.unionByName(many)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words inside benchmark windows go."""
    found = decontaminate.contamination(docs.select("text", _row_key()), table(spark, sf_dir, "benchmark"))
    return _without(docs, found.filter(decontaminate.is_contaminated()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, at the target weights: the columns of documents, mix_domain,
    mix_tokens and mix_epoch, one row per epoch that takes the document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The toxicity stage learns a model, which SQL can't express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the result is read from the last stage's files."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
