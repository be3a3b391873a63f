"""Alert table clustered by a space-filling curve over sky position and night.

Rows are ordered along a Morton curve over (right ascension, sine of declination, night), each scaled to
``BITS`` bits, and range-partitioned on it, so a file holds a compact piece of sky and time.  A list of
the files with the least and greatest position and date of each is written last; a table without one is
not complete.  Reads of a cone, a time range or one object's place list only the files whose ranges
meet it, before any file is opened; inside a file, row groups are skipped by the same statistics.

Rows without a position or date stand at the begin of the curve; their files are read whenever asked for
such rows, never for a cone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sky import ang_sep_sql
from ..schema import ALERT
from ..session import path_exists

BITS = 10
_TOP = (1 << BITS) - 1
#: Alerts of a file where the caller names no number of files.
ROWS_PER_FILE = 100_000


def _spread(x: str) -> str:
    """The low ten bits of ``x``, two empty bits between neighbours."""
    for shift, mask in ((16, 0x030000FF), (8, 0x0300F00F), (4, 0x030C30C3), (2, 0x09249249)):
        x = f"(({x} | shiftleft({x}, {shift})) & {mask}L)"
    return x


def curve_sql(ra: str, dec: str, jd: str, first: float, last: float) -> str:
    """Place on the curve: the bits of the three scaled coordinates in turn.  Each is staged by a lambda, so
    the expression stays small."""
    span = max(float(last) - float(first), 1.0)
    scaled = [f"pmod({ra}, 360.0D) / 360.0D", f"(SIN(RADIANS({dec})) + 1) / 2",
              f"({jd} - {float(first)!r}D) / {span!r}D"]
    whole = ", ".join(f"CAST(least(greatest({x}, 0), 1) * {_TOP} AS BIGINT)" for x in scaled)
    return (f"aggregate(transform(array({whole}), x -> {_spread('x')}), CAST(0 AS BIGINT), "
            f"(a, x) -> shiftleft(a, 1) | coalesce(x, 0L))")


def write_clustered(alerts: DataFrame, path: str, files: int | None = None) -> None:
    """Write ``alerts`` below ``path`` (``data`` and ``files``), about ``files`` files of equal size.

    Ties of the curve are ordered by date and id, so a crowded place is cut like any other."""
    spark = alerts.sparkSession
    if path_exists(spark, f"{path}/files"):
        raise ValueError(f"{path} already holds a clustered table")
    n, first, last = alerts.agg(F.count(F.lit(1)), F.min("candidate.jd"), F.max("candidate.jd")).first()
    files = files or max(1, -(-n // ROWS_PER_FILE))
    curve = curve_sql("candidate.ra", "candidate.dec", "candidate.jd", first or 0.0, last or 0.0)
    (alerts.withColumn("_curve", F.expr(curve))
     .repartitionByRange(files, "_curve", "candidate.jd", "candid").sortWithinPartitions("_curve", "candidate.jd")
     .drop("_curve").write.mode("overwrite").parquet(f"{path}/data"))
    c = "candidate"
    spans = [f(F.col(f"{c}.{x}")).alias(f"{name}_{x}") for x in ("ra", "dec", "jd") for name, f in (("min", F.min), ("max", F.max))]
    (spark.read.schema(ALERT).parquet(f"{path}/data").groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.count(F.lit(1)).alias("n"), *spans).coalesce(1).write.parquet(f"{path}/files"))


def files_meeting(spark: SparkSession, path: str, ra: float | None = None, dec: float | None = None,
                  radius_deg: float = 0.0, first_jd: float | None = None, last_jd: float | None = None) -> list[str]:
    """The files of a clustered table that can hold alerts of a cone and of a time range."""
    files = spark.read.parquet(f"{path}/files")
    if first_jd is not None:
        files = files.filter(F.col("max_jd") >= first_jd)
    if last_jd is not None:
        files = files.filter(F.col("min_jd") <= last_jd)
    if ra is not None:
        r = radius_deg * (1 + 1e-9) + 1e-9
        files = files.filter((F.col("max_dec") >= dec - r) & (F.col("min_dec") <= dec + r))
        ratio = math.sin(math.radians(min(r, 90.0))) / max(math.cos(math.radians(dec)), 1e-300)
        if abs(dec) + r < 90 and ratio < 1:
            half, at = math.degrees(math.asin(ratio)) + 1e-9, ra % 360
            # the interval, and its copies one turn to either side
            meets = [(F.col("max_ra") >= at - half + turn) & (F.col("min_ra") <= at + half + turn) for turn in (-360, 0, 360)]
            files = files.filter(meets[0] | meets[1] | meets[2])
    return sorted(r[0] for r in files.select("file").collect())


def read_clustered(spark: SparkSession, path: str, ra: float | None = None, dec: float | None = None,
                   radius_deg: float = 0.0, first_jd: float | None = None, last_jd: float | None = None) -> DataFrame:
    """Alerts of a clustered table: all, or those of a cone and a time range (bounds included)."""
    files = files_meeting(spark, path, ra, dec, radius_deg, first_jd, last_jd)
    out = spark.read.schema(ALERT).parquet(*files) if files else spark.createDataFrame([], ALERT)
    if first_jd is not None:
        out = out.filter(F.col("candidate.jd") >= first_jd)
    if last_jd is not None:
        out = out.filter(F.col("candidate.jd") <= last_jd)
    if ra is not None:
        r = radius_deg * (1 + 1e-9) + 1e-9
        within = f"{ang_sep_sql('candidate.ra', 'candidate.dec', f'{float(ra)!r}D', f'{float(dec)!r}D')} <= {math.radians(radius_deg)!r}D"
        # the plain bounds reach the row groups' statistics
        out = out.filter(F.col("candidate.dec").between(dec - r, dec + r)).filter(within)
    return out


def read_object(spark: SparkSession, path: str, object_id: str, ra: float, dec: float,
                radius_deg: float = 0.01) -> DataFrame:
    """The alerts of an object whose place is known."""
    return read_clustered(spark, path, ra, dec, radius_deg).filter(F.col("objectId") == object_id)
