"""Sky joins of tables stored by cell (J1, J3), for catalogues too big to broadcast.

Alerts and the exploded catalogue are written once as tables bucketed and sorted by cell, with the same number
of buckets; their join then needs no exchange, however often it is run.  Cells with more than ``HOT_ROWS``
alerts would make one bucket's task long: their alerts are written apart and meet the catalogue by the salted
join, which spreads a cell over as many tasks as it has salts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sky import ang_sep_sql, point_cell_sql
from ..session import run_folder
from .skyjoin import CELL, DEFAULT_CELL_DEG, cone_join

BUCKETS, HOT_ROWS, SALTS = 64, 1_000_000, 16


@dataclass
class CellTable:
    """A table stored by cell; ``hot`` has the rows of crowded cells (of alerts), ``cells`` the rows as they were given."""
    stored: DataFrame
    hot: DataFrame | None = None
    cells: DataFrame | None = None


def _store(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    spark, name = df.sparkSession, f"alertsieve_{label}_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, column).sortBy(column).option("path", run_folder(spark, label)).format("parquet")
     .saveAsTable(name))
    return spark.table(name)


def store_points(points: DataFrame, ra: str, dec: str, cell_deg: float = DEFAULT_CELL_DEG, buckets: int = BUCKETS,
                 hot_rows: int = HOT_ROWS) -> CellTable:
    """Points (alerts) by their cell.  Rows without a position have none; they match nothing and are kept."""
    rows = points.withColumn(CELL + "_l", F.expr(point_cell_sql(f"`{ra}`", f"`{dec}`", cell_deg)))
    spark, path = points.sparkSession, run_folder(points.sparkSession, "hot-points")
    crowded = rows.groupBy(CELL + "_l").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows).select(CELL + "_l")
    crowded.write.parquet(f"{path}/cells")  # at most rows / hot_rows cells
    hot = F.broadcast(spark.read.parquet(f"{path}/cells"))
    rows.join(hot, CELL + "_l", "left_semi").write.parquet(f"{path}/rows")
    return CellTable(_store(rows.join(hot, CELL + "_l", "left_anti"), "points", CELL + "_l", buckets),
                     spark.read.parquet(f"{path}/rows"))


def store_catalogue(cells: DataFrame, buckets: int = BUCKETS) -> CellTable:
    """An exploded catalogue (``explode_catalogue``) by cell."""
    return CellTable(_store(cells, "catalogue", CELL, buckets), cells=cells)


def bucket_join(points: CellTable, catalogue: CellTable, ra: str, dec: str, cat_ra: str, cat_dec: str, how: str,
                radius_name: str = "_radius", cell_deg: float = DEFAULT_CELL_DEG, extra: str = "true",
                salts: int = SALTS) -> DataFrame:
    """``cone_join`` (inner without the separation, left_semi or left_anti) of stored tables: no exchange but for crowded
    cells."""
    sep = ang_sep_sql(f"`{ra}`", f"`{dec}`", f"`{cat_ra}`", f"`{cat_dec}`")
    met = points.stored.join(catalogue.stored.hint("merge"),
                             F.expr(f"{CELL}_l = {CELL} AND {sep} <= `{radius_name}` AND ({extra})"), how)
    met = met.drop(CELL, CELL + "_l", radius_name)
    if points.hot is None or points.hot.isEmpty():
        return met
    few = cone_join(points.hot.drop(CELL + "_l"), catalogue.cells, ra, dec, cat_ra, cat_dec, how=how, radius_name=radius_name,
                    cell_deg=cell_deg, extra=extra, sep_name=None, broadcast_max_bytes=None, salt_buckets=salts)
    return met.unionByName(few)
