"""Galaxy catalogue preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import d
from ..functions.sky import ang_dist
from ..functions.text import strip_bytes_repr
from ..schema import GALAXY
from ..session import names_in, touch

CATALOGUE_COLUMNS = ["HyperLEDA_name", "2MASS_name", "RA", "dec", "dist", "dist_err", "z",
                     "stellarmass"]


def build_galaxy_catalogue(raw: DataFrame, range_mpc: float = 230.0, keep_index: bool = True,
                           strip_names: bool = True, sort: bool = True) -> DataFrame:
    """S3: project, keep ``dist < range_mpc``, add ``ang_dist = dist/(1+z)^2``,
    drop ``z``, rename RA->ra and dist->lum_dist, order by ``lum_dist`` (A7).

    ``strip_names`` turns byte-string reprs (``b'..'``) into plain names once,
    here, instead of at every notification.  The sort is only for writing the
    table in distance order; matching never relies on row order.
    """
    cols = (["galaxy_idx"] if keep_index and "galaxy_idx" in raw.columns else []) + CATALOGUE_COLUMNS
    out = (raw.select(*[F.col(f"`{c}`") for c in cols])
           .filter(F.col("dist") < d(range_mpc))
           .withColumn("ang_dist", ang_dist(F.col("dist"), F.col("z")))
           .drop("z")
           .withColumnRenamed("RA", "ra")
           .withColumnRenamed("dist", "lum_dist"))
    if strip_names:
        out = (out.withColumn("HyperLEDA_name", strip_bytes_repr(F.col("HyperLEDA_name")))
               .withColumn("2MASS_name", strip_bytes_repr(F.col("`2MASS_name`"))))
    if sort:
        out = out.orderBy("lum_dist", *(["galaxy_idx"] if "galaxy_idx" in out.columns else []))
    return out


def write_catalogue(cat: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the prepared catalogue (parquet preferred; CSV with header)."""
    w = cat.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_catalogue(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a prepared galaxy catalogue with its declared types.

    CSV columns are taken by their header names, in any order; a catalogue without
    ``galaxy_idx`` has none in the result either (ties between hosts are then broken by
    name and position, see ``kilonova.host_first``)."""
    if fmt != "csv":
        return spark.read.schema(GALAXY).parquet(path)
    raw = spark.read.option("header", True).csv(path)
    there = {c.lower(): c for c in raw.columns}
    missing = [f.name for f in GALAXY.fields if f.name.lower() not in there and f.name != "galaxy_idx"]
    if missing:
        raise ValueError(f"catalogue {path} has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")
    return raw.select(*[F.col(f"`{there[f.name.lower()]}`").cast(f.dataType).alias(f.name)
                        for f in GALAXY.fields if f.name.lower() in there])


# --- versions: a catalogue that is replaced while streams run ---------------------

PUBLISHED = "_published"


def publish_catalogue(cat: DataFrame, path: str) -> str:
    """Write ``cat`` as the next version below ``path`` and make it the current one; its name.

    Versions are never changed.  A version counts from the moment its record, an empty file, is there, so a
    write that breaks off is never read."""
    spark = cat.sparkSession
    there = [x for x in names_in(spark, path) if x.startswith("v")]
    version = f"v{1 + max((int(x[1:]) for x in there), default=0):08d}"
    cat.write.parquet(f"{path}/{version}")
    touch(spark, f"{path}/{PUBLISHED}/{version}")
    return version


def current_version(spark: SparkSession, path: str) -> str:
    """The last published version."""
    versions = names_in(spark, f"{path}/{PUBLISHED}")
    if not versions:
        raise ValueError(f"no catalogue is published at {path}")
    return versions[-1]


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    return spark.read.parquet(f"{path}/{version or current_version(spark, path)}")
