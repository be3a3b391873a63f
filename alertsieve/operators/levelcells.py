"""A sky index of several cell sizes, for catalogues whose search radii differ.

Level k cuts declination into zones of ``TOP_DEG / STEP**k`` degrees and every zone into as many
right-ascension cells of at least that width as fit its narrower edge.  A catalogue row is indexed at the
finest level whose cells are twice its radius or wider, so away from the poles its disc touches
at most ``MOST_CELLS`` cells whatever the radius (at a pole a zone has few cells).  A point lies in one cell
per level and looks up the levels that the catalogue uses.

Two forms of the lookup:

* ``level_join``: (point, source) pairs; a point is written once per level in use, a pair meets once.
* ``with_lists`` / ``nearest``: the catalogue is folded to one row per cell holding its sources as a sorted array;
  a point gets the array of its cell by one equi-join per level in use, and its sources are filtered and
  chosen inside the row.  Nothing is grouped behind the join, so this runs on a stream in append mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sky import ang_sep_sql
from .skyjoin import checked_broadcast, measured_bytes, plan_key

KEY, LEVEL = "_key", "_level"
TOP_DEG, STEP, LEVELS = 4.0, 4, 9
#: Zones (2) times cells of a zone (3) that a disc of half a cell's width touches, with one more of
#: either where it begins in the narrower neighbour of a zone.
MOST_CELLS = 12
_ZONES = 1 << 25        # more than the zones, and than the cells of a zone, of the finest level


def level_sql(radius_rad: str) -> str:
    """Finest level whose cells are twice the radius or wider (the coarsest for wider radii)."""
    fit = f"FLOOR(LN({TOP_DEG!r}D / greatest(2 * DEGREES({radius_rad}) * 1.000001D, 1e-12D)) / LN({STEP}.0D))"
    return f"CAST(least(greatest({fit}, 0), {LEVELS - 1}) AS INT)"


def _cells_of_zone(zone: str, size: str) -> str:
    """Cells in a zone: as many as its edge nearest a pole has room for."""
    edge = f"greatest(abs({zone} * {size} - 90.0D), abs(({zone} + 1) * {size} - 90.0D))"
    return f"CAST(greatest(FLOOR(360.0D / {size} * COS(RADIANS(least({edge}, 90.0D)))), 1) AS BIGINT)"


def _key(level: str, zone: str, cell: str) -> str:
    return f"(({level} * {_ZONES}L + {zone}) * {_ZONES}L + {cell})"


def point_key_sql(ra: str, dec: str, level: int) -> str:
    """The cell of a point at one level; NULL where a coordinate is missing (NULL or NaN)."""
    size = f"{TOP_DEG / STEP ** level!r}D"
    zone = f"CAST(FLOOR((least(greatest({dec}, -90.0D), 90.0D) + 90.0D) / {size}) AS BIGINT)"
    n = _cells_of_zone(zone, size)
    cell = f"least(CAST(FLOOR(pmod({ra}, 360.0D) / 360.0D * {n}) AS BIGINT), {n} - 1)"
    return f"CASE WHEN NOT isnan({ra}) AND NOT isnan({dec}) THEN {_key(f'{level}L', zone, cell)} END"


def disc_keys_sql(ra: str, dec: str, radius_rad: str, level: str) -> str:
    """Every cell of a level (a column) that a disc touches."""
    size = f"({TOP_DEG!r}D / POWER({STEP}.0D, {level}))"
    r = f"(DEGREES({radius_rad}) * 1.000000001D + 1e-11D)"
    lo, hi = f"({dec} - {r})", f"({dec} + {r})"
    ratio = f"(SIN(RADIANS({r})) / COS(RADIANS({dec})))"
    whole = f"({hi} >= 90.0D OR {lo} <= -90.0D OR {ratio} >= 1.0D)"
    half = f"(DEGREES(ASIN(least({ratio}, 1.0D))) + 1e-11D)"
    zones = (f"sequence(CAST(FLOOR((greatest({lo}, -90.0D) + 90.0D) / {size}) AS BIGINT), "
             f"CAST(FLOOR((least({hi}, 90.0D) + 90.0D) / {size}) AS BIGINT))")
    at = f"pmod({ra}, 360.0D)"
    first = f"CAST(FLOOR(({at} - {half}) / 360.0D * z.n) AS BIGINT)"
    last = f"CAST(FLOOR(({at} + {half}) / 360.0D * z.n) AS BIGINT)"
    cells = (f"CASE WHEN {whole} OR {last} - {first} >= z.n - 1 THEN sequence(0L, z.n - 1) "
             f"ELSE transform(sequence({first}, {last}), c -> pmod(c, z.n)) END")
    numbered = f"transform({zones}, z -> named_struct('z', z, 'n', {_cells_of_zone('z', size)}))"
    return f"flatten(transform({numbered}, z -> transform({cells}, c -> {_key(f'CAST({level} AS BIGINT)', 'z.z', 'c')})))"


def index_catalogue(cat: DataFrame, ra: str, dec: str, radius_rad: str, radius_name: str = "_radius") -> DataFrame:
    """Catalogue rows with their radius and level, one row per touched cell.  Rows without a
    position or radius match nothing and are left out."""
    known = " AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in (ra, dec, radius_name))
    with_r = cat.withColumn(radius_name, F.expr(radius_rad)).filter(known)
    return (with_r.withColumn(LEVEL, F.expr(level_sql(f"`{radius_name}`")))
            .withColumn(KEY, F.explode(F.expr(disc_keys_sql(f"`{ra}`", f"`{dec}`", f"`{radius_name}`", LEVEL)))))


_USED: dict = {}


def levels_used(indexed: DataFrame) -> list[int]:
    """Levels of an indexed catalogue (at most ``LEVELS``): a small job, remembered for the plan and its files."""
    key = plan_key(indexed)
    if key not in _USED:
        _USED[key] = sorted(r[0] for r in indexed.select(LEVEL).distinct().collect())
    return _USED[key]


def level_join(points: DataFrame, indexed: DataFrame, point_ra: str, point_dec: str, cat_ra: str, cat_dec: str,
               radius_name: str = "_radius", extra: str = "true", sep_name: str = "sep_rad") -> DataFrame:
    """(point, source) pairs within the source's radius, with their separation.  ``extra`` is a residual
    condition (SQL text) inside the join."""
    keys = ", ".join(point_key_sql(f"`{point_ra}`", f"`{point_dec}`", k) for k in levels_used(indexed))
    if not keys:
        keys = "CAST(NULL AS BIGINT)"
    probes = points.withColumn("_probe", F.explode(F.expr(f"array({keys})")))
    sep = ang_sep_sql(f"`{point_ra}`", f"`{point_dec}`", f"`{cat_ra}`", f"`{cat_dec}`")
    side = checked_broadcast(indexed)
    pairs = probes.join(side, F.expr(f"_probe = {KEY} AND {sep} <= `{radius_name}` AND ({extra})"))
    return pairs.withColumn(sep_name, F.expr(sep)).drop("_probe", KEY, LEVEL, radius_name)


def fold_cells(indexed: DataFrame, order: list[str]) -> DataFrame:
    """One row per cell: ``_sources``, its catalogue rows as structs of the columns ``order``, sorted.  Rows equal in all of them
    are one."""
    one = F.struct(*[F.col(f"`{c}`") for c in order])
    return indexed.groupBy(KEY, LEVEL).agg(F.sort_array(F.collect_set(one)).alias("_sources"))


def with_lists(points: DataFrame, indexed: DataFrame, order: list[str], ra: str, dec: str) -> DataFrame:
    """``points`` and ``_sources``: the catalogue rows of its cells, of all levels."""
    folded = fold_cells(indexed, order)
    small = checked_broadcast(folded, size=lambda: measured_bytes(indexed)) is not folded
    used = levels_used(indexed)
    out, kept = points, [F.col(f"`{c}`") for c in points.columns]
    for k in used:
        side = folded.filter(F.col(LEVEL) == k).select(F.col(KEY).alias(f"_key{k}"), F.col("_sources").alias(f"_sources{k}"))
        out = out.withColumn(f"_probe{k}", F.expr(point_key_sql(f"`{ra}`", f"`{dec}`", k)))
        out = out.join(F.broadcast(side) if small else side, F.expr(f"_probe{k} = _key{k}"), "left")
    lists = ", ".join(f"coalesce(_sources{k}, array())" for k in used)
    if not used:
        return points.withColumn("_sources", F.lit(None).cast(folded.schema["_sources"].dataType))
    return out.select(*kept, F.expr(f"concat({lists})").alias("_sources"))


def nearest(points: DataFrame, indexed: DataFrame, order: list[str], ra: str, dec: str, condition: str) -> DataFrame:
    """Points with their first source by ``order`` of those that meet ``condition``, SQL text over the struct ``s`` and
    the point's columns; points without one are left out.  The chosen source is the struct ``_source``."""
    met = with_lists(points, indexed, order, ra, dec)
    # a generator of at most one row: the choice is worked out once
    return (met.withColumn("_source", F.explode(F.expr(
        f"filter(array(array_min(filter(_sources, s -> {condition}))), x -> x IS NOT NULL)"))).drop("_sources"))
