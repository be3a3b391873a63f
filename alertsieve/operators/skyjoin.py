"""Cone (spherical range) joins by sky cells.

A non-equi distance predicate alone plans as a nested-loop join.  Following
the zones idea, the sky is cut into cells of ``cell_deg``:

* catalogue side: each source is exploded into every cell its search disc
  touches (``disc_cells``: RA half-width ``asin(sin r / cos dec)``, whole zones
  at the poles, RA wrapped);
* alert side: exactly one cell per alert (``point_cell``) -- no explosion, so
  the left side keeps its partitioning and a stream can use the same join;
* equi-join on the cell id, with the exact separation test (and any other
  residual predicate) inside the join condition, so only true matches leave the
  join.  Every (alert, source) pair meets at most once because the alert sits
  in one cell.

Planning: the catalogue side is broadcast only after its exploded size
has been measured below ``broadcast_max_bytes``; otherwise both sides are
shuffled on the cell id and AQE's skew-join handling splits hot cells (many
alerts of one object share a cell); ``salt_buckets`` adds explicit salting.
For flags as columns (no row multiplication) see ``kilonova.catalogue_flags``,
which runs the same cell test as broadcast existence joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sky import ang_sep_sql, disc_cells_sql, point_cell_sql
from ..session import file_marks

CELL = "_cell"
DEFAULT_CELL_DEG = 0.5
#: Most bytes of a broadcast catalogue side.
DEFAULT_BROADCAST_MAX_BYTES = 128 << 20


def explode_catalogue(cat: DataFrame, ra: str, dec: str, radius_rad: Column | str,
                      cell_deg: float = DEFAULT_CELL_DEG, radius_name: str = "_radius") -> DataFrame:
    """Catalogue rows with their search radius, one row per touched cell."""
    r = F.expr(radius_rad) if isinstance(radius_rad, str) else radius_rad
    with_r = cat.withColumn(radius_name, r)
    return with_r.withColumn(CELL, F.explode(F.expr(disc_cells_sql(f"`{ra}`", f"`{dec}`", f"`{radius_name}`",
                                                                   cell_deg))))


_CHECKED: dict = {}


def plan_key(df: DataFrame) -> tuple:
    """What a measured figure of ``df`` holds for: the plan and the files it reads, with their length and
    time of change."""
    spark = df.sparkSession
    folders = sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})
    return spark.sparkContext.applicationId, df.semanticHash(), tuple(file_marks(spark, f) for f in folders)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` in memory: eight per fixed-width value plus the text, and a row header."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text = F.sum(sum(wide, F.lit(0)).cast("long"))
    rows, chars = df.agg(F.count(F.lit(1)), F.coalesce(text, F.lit(0))).first()
    return rows * (16 + 8 * len(df.columns)) + chars


def broadcast_limit(spark, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> int:
    """Most bytes of a broadcast side: the session's ``alertsieve.broadcast.maxBytes``, else ``max_bytes``."""
    return int(spark.conf.get("alertsieve.broadcast.maxBytes", str(max_bytes)))


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, size=None) -> DataFrame:
    """``broadcast(df)`` when its measured size is at most ``max_bytes`` (or the session's
    ``alertsieve.broadcast.maxBytes``); otherwise ``df`` itself (shuffle join on the cell id;
    AQE splits skewed cells).  The size is one small job, remembered for the plan and the files
    it reads, so a catalogue that has grown is measured again.  ``size`` measures ``df`` where its columns
    are more than numbers and text."""
    max_bytes = broadcast_limit(df.sparkSession, max_bytes)
    key = plan_key(df)
    if key not in _CHECKED:
        _CHECKED[key] = size() if size else measured_bytes(df)
    return F.broadcast(df) if _CHECKED[key] <= max_bytes else df


def cone_join(left: DataFrame, cat_cells: DataFrame, left_ra: str, left_dec: str,
              cat_ra: str, cat_dec: str, how: str = "inner",
              radius_name: str = "_radius", cell_deg: float = DEFAULT_CELL_DEG,
              extra: Column | str | None = None, sep_name: str | None = "sep_rad",
              broadcast_max_bytes: int | None = DEFAULT_BROADCAST_MAX_BYTES,
              salt_buckets: int = 1) -> DataFrame:
    """Join ``left`` rows to catalogue rows within the catalogue row's radius.

    ``cat_cells`` comes from ``explode_catalogue`` with the same ``cell_deg``;
    its column names must not clash with ``left``'s.  ``how`` is ``inner``
    (pairs, with the separation in ``sep_name``), ``left_semi`` (J2s: rows with
    at least one match) or ``left_anti`` (J3: rows with none).  ``extra`` is a
    residual predicate (Column or SQL text) evaluated inside the join.

    ``salt_buckets > 1`` (shuffle path only) spreads each cell over that many
    join keys: every left row gets a salt from a hash of its columns, every
    catalogue row is replicated once per salt.  Use it when AQE skew splitting
    is off or insufficient; the result is identical.
    """
    lc = left.withColumn(CELL + "_l", F.expr(point_cell_sql(f"`{left_ra}`", f"`{left_dec}`", cell_deg)))
    right = cat_cells
    broadcast = False
    if broadcast_max_bytes is not None:
        right = checked_broadcast(cat_cells, broadcast_max_bytes)
        broadcast = right is not cat_cells
    salted = salt_buckets > 1 and not broadcast
    if salted:
        lc = lc.withColumn("_salt_l", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]),
                                             F.lit(salt_buckets)))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                               F.lit(salt_buckets - 1).cast("long"))))
    sep = ang_sep_sql(f"`{left_ra}`", f"`{left_dec}`", f"`{cat_ra}`", f"`{cat_dec}`")
    cond_sql = f"{CELL}_l = {CELL} AND {sep} <= `{radius_name}`"
    if salted:
        cond_sql = f"_salt_l = _salt AND {cond_sql}"
    if isinstance(extra, str):
        cond_sql += f" AND ({extra})"
    cond = F.expr(cond_sql)
    if extra is not None and not isinstance(extra, str):
        cond = cond & extra
    out = lc.join(right, cond, how)
    if how == "inner":
        if sep_name:
            out = out.withColumn(sep_name, F.expr(sep))
        out = out.drop(CELL, radius_name, "_salt")
    return out.drop(CELL + "_l", "_salt_l")
