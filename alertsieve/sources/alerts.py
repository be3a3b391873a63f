"""Alert tables (S1) and topic tables (S5 sink).

Alerts are stored as parquet partitioned by observing night, so a query over
a date range reads only those folders (partition pruning), and nested column
pruning / predicate pushdown reach into ``candidate.*`` inside each file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ALERT

NIGHT = "night"


def night_of(jd_col: str = "candidate.jd"):
    """Observing night as an integer JD (nights start at noon UTC)."""
    return F.floor(F.col(jd_col)).cast("long")


def write_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Write alerts partitioned by night.

    Rows are rebalanced on the night first: a night's rows meet in few tasks, so
    the file count stays near the number of nights, and AQE splits a night that
    is larger than its partition size over several tasks and joins small ones.
    Unlike a range partition this samples nothing, so the input runs once."""
    (alerts.withColumn(NIGHT, night_of()).hint("rebalance", NIGHT)
     .write.mode(mode).partitionBy(NIGHT).parquet(path))


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Read an alert table with its declared schema (no inference pass)."""
    schema = T.StructType(ALERT.fields + [T.StructField(NIGHT, T.LongType())])  # ALERT stays untouched
    return spark.read.schema(schema).parquet(path)


def write_topics(topics: DataFrame, path: str, mode: str = "append") -> None:
    """Route output (topic, candid, ...) -> one folder per topic."""
    topics.hint("rebalance", "topic").write.mode(mode).partitionBy("topic").parquet(path)
