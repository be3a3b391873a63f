"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step reads the texts once and hands the next one a fixed-size bitmap of the keys that
more than one row shares, so the full content is hashed only for rows that survived the
length and the prefix step.  Only slim key rows are shuffled, and counted map-side first, so
a key that holds a third of all rows costs no more than any other.

Defined results: NULL text counts as the empty text; the empty texts are one group.  Of equal
texts the row with the largest key stays; a NULL key loses to any other.  Rows that repeat
both key and text get the same answer, and ``drop_exact_duplicates`` keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_bitmap, key_bitmap, least_row, stored

PREFIX_CHARS = 256
BITMAP_BITS = 20


def _split(docs: DataFrame, key: str, text: str, carry: list[Column], prefix_chars: int,
           bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows known to be single, rows whose text may repeat, the groups of the latter)."""
    body = F.coalesce(F.col(text), F.lit(""))
    length = F.octet_length(body)

    lengths = (docs.select(length.alias("len")).groupBy("len").count().filter("count > 1"))
    by_length = in_bitmap(key_bitmap(lengths, ["len"], bits), bits, "_len")

    keyed = docs.select(F.col(key).alias("_key"), length.alias("_len"), body.alias("_body"), *carry)
    prefixed = keyed.withColumn("_prefix", F.when(
        by_length, F.xxhash64(F.substring("_body", 1, prefix_chars))))
    shared = (prefixed.filter("_prefix IS NOT NULL").groupBy("_len", "_prefix").count()
              .filter("count > 1"))
    by_prefix = in_bitmap(key_bitmap(shared, ["_len", "_prefix"], bits), bits, "_len", "_prefix")

    survivor = F.coalesce(F.col("_prefix").isNotNull() & by_prefix, F.lit(False))
    singles = prefixed.filter(~survivor).drop("_body")
    rest = prefixed.filter(survivor).withColumn("_hash", F.sha2("_body", 256)).drop("_body")
    # written first: the join to a stored table is two plain shuffles, which Spark can split
    # where one text holds a large share of the rows
    groups = stored(rest.groupBy("_hash").agg(F.max("_key").alias("_keep"), F.count(F.lit(1)).alias("_n")),
                    "exact-groups")
    return singles, rest, groups


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     carry: list[Column] | None = None, prefix_chars: int = PREFIX_CHARS,
                     bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, full_hash (NULL where the
    refinement ended before the full hash), and the columns ``carry``."""
    carry = carry or []
    singles, rest, groups = _split(docs, key, text, carry, prefix_chars, bitmap_bits)
    extra = [c for c in singles.columns if c not in ("_key", "_len", "_prefix")]
    one = singles.select(F.col("_key").alias(key), F.col("_key").alias("keep_id"),
                         F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
                         F.lit(None).cast("string").alias("full_hash"), *extra)
    many = rest.join(groups, "_hash").select(
        F.col("_key").alias(key), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
        F.col("_key").eqNullSafe(F.col("_keep")).alias("kept"), F.col("_hash").alias("full_hash"), *extra)
    return one.unionByName(many)


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                          prefix_chars: int = PREFIX_CHARS, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.  Texts are shuffled only for rows
    that survived the prefix step."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    singles, rest, groups = _split(docs, key, text, [row], prefix_chars, bitmap_bits)
    kept = (rest.join(groups, (rest["_hash"] == groups["_hash"]) & rest["_key"].eqNullSafe(groups["_keep"]))
            .select(rest["_hash"], "_row"))
    repeats = kept.groupBy("_hash").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    once = kept.join(repeats, "_hash", "left_anti").select("_row")
    many = (kept.join(repeats, "_hash", "left_semi").groupBy("_hash")
            .agg(least_row(F.col("_row"), docs.schema).alias("_row"))
            .select("_row"))
    return singles.select("_row").unionByName(once).unionByName(many).select("_row.*")
