"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertsieve.session import run_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data folder through Spark (any store it can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(col: str, modulus: int) -> Column:
    """``crc32`` of the value written as text, modulo ``modulus`` (NULL: 0)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % modulus, F.lit(0))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: the lineage ends
    there, and every later reader sees the same rows whichever executor is lost."""
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _has_map(kind: T.DataType) -> bool:
    inner = [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else \
        [kind.elementType] if isinstance(kind, T.ArrayType) else []
    return isinstance(kind, T.MapType) or any(_has_map(x) for x in inner)


def least_row(row: Column, schema: T.StructType) -> Column:
    """The least of some rows (structs of ``schema``); where a column holds a map, which has no order, the one whose
    JSON comes first."""
    return F.min_by(row, F.to_json(row)) if _has_map(schema) else F.min(row)


def bitmap_slot(bits: int, *cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << bits))


def key_bitmap(keys: DataFrame, cols: list[str], bits: int) -> Column:
    """Bitmap of ``2 ** bits`` bits over the key columns, as a scalar-subquery column
    (array of longs).  Its size is fixed whatever the number of keys: more keys only
    let more rows through ``in_bitmap``, never fewer."""
    slot = bitmap_slot(bits, *cols)
    words = (keys.select(slot.alias("slot"))
             .groupBy(F.shiftright("slot", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("v")))
    grid = keys.sparkSession.range(0, 1 << (bits - 6), 1, 1).withColumnRenamed("id", "w")
    return (grid.join(words, "w", "left")
            .agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("v", F.lit(0).cast("long")).alias("v"))))
                 .alias("a"))
            .select(F.col("a.v").alias("v")).scalar())


def in_bitmap(bitmap: Column, bits: int, *cols) -> Column:
    """True for every row whose key is in the bitmap (and, rarely, for another)."""
    slot = bitmap_slot(bits, *cols)
    word = F.element_at(bitmap, (F.shiftright(slot, 6) + 1).cast("int"))
    return F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1


class Sent:
    """A value broadcast as bytes that hold the classes it is made of, so that Python workers need not
    have this package.  ``value`` unpacks it: ask once per task."""

    def __init__(self, sc, value):
        self._bytes = sc.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._bytes.value)


class KeyFilter:
    """A bitmap of fixed size over long keys, for use inside tasks: ``passes`` is true for every
    key of ``keys`` and, rarely, for another.  At most ``2 ** (bits - 6)`` words reach the
    driver and are broadcast, whatever the number of keys."""

    def __init__(self, keys: DataFrame, col: str, bits: int):
        spark, self.bits = keys.sparkSession, bits
        slots = keys.select(F.explode(F.array(*[F.shiftrightunsigned(col, at).bitwiseAND(F.lit((1 << bits) - 1))
                                                for at in (0, 64 - bits)])).alias("s"))
        words = (slots.groupBy(F.shiftright("s", 6).alias("w"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("v")).toArrow())
        bitmap = np.zeros(1 << (bits - 6), dtype=np.int64)
        bitmap[words["w"].to_numpy()] = words["v"].to_numpy()
        self._bitmap = spark.sparkContext.broadcast(bitmap)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        bitmap, u = self._bitmap.value, keys.view(np.uint64)
        mask, out = np.uint64((1 << self.bits) - 1), np.ones(len(keys), bool)
        for at in (0, 64 - self.bits):
            s = ((u >> np.uint64(at)) & mask).astype(np.int64)
            out &= ((bitmap[s >> 6] >> (s & 63)) & 1) == 1
        return out
