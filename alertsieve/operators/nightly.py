"""Counts kept by night (A1, A2, A3, A8): partial aggregates per night partition that add up.

``refresh`` works out only the nights whose files changed since the last time, told by the files' names,
lengths and times of change, and takes away nights that are gone.  A night's partial rows are (kind, key, part, n):
classes, catalogue labels, filters, and classes of objects.  The totals are sums over the partial rows, equal to the
queries over all alerts; the alert table isn't read for them.

Defined results: a missing class, label or object is a key of its own; a night is replaced whole, so a
refresh that breaks off is done again by the next one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, file_marks, names_in, path_exists
from ..sources.alerts import NIGHT, read_alerts
from . import classify as K
from . import filters as FL
from . import kilonova as KN

SCHEMA = f"kind string, key string, part string, n long, mark string, {NIGHT} long"


def _marks(spark: SparkSession, alert_path: str) -> dict[int, str]:
    nights = [x for x in names_in(spark, alert_path) if x.startswith(f"{NIGHT}=")]
    return {int(x.split("=")[1]): hashlib.md5(file_marks(spark, f"{alert_path}/{x}").encode()).hexdigest() for x in nights
            if x.split("=")[1].lstrip("-").isdigit()}


def partial_rows(alerts: DataFrame, galaxies: DataFrame, sky_objects: DataFrame) -> DataFrame:
    """(night, kind, key, part, n) of alerts with their night: one scan, two groupings of it.

    An alert counts once for its object and class and once for its label and the set of its filters (a bit each); labels
    and filters are taken apart after the alerts that share them have been counted."""
    names = FL.ROW_FILTERS + FL.CATALOGUE_FILTERS
    simbad = f"coalesce({FL.filter_sql('simbad_candidates', alerts)}, false)"
    flags = [F.expr(f"coalesce({FL.filter_sql(n, alerts)}, false)").alias(f"f_{n}") for n in FL.ROW_FILTERS]
    rows = KN.catalogue_flags(alerts, galaxies, sky_objects, keep=[NIGHT, "objectId", "cdsxmatch"],
                              extra=[*flags, K.classify(alerts).alias("class"), F.expr(simbad).alias("simbad")])
    passed = " + ".join(f"CASE WHEN f_{n} THEN {1 << i}L ELSE 0L END" for i, n in enumerate(names))
    some = rows.selectExpr(NIGHT, "objectId", "class", "CASE WHEN simbad THEN cdsxmatch END AS label", f"{passed} AS passed")
    counts = (some.groupingSets([[NIGHT, "objectId", "class"], [NIGHT, "label", "passed"]],
                                NIGHT, "objectId", "class", "label", "passed")
              .agg(F.count(F.lit(1)).alias("n"), (F.grouping("objectId") == 0).alias("of_object")))
    entry = "named_struct('kind', '{}', 'key', {}, 'part', {})"
    null = "CAST(NULL AS STRING)"
    entries = [f"CASE WHEN label IS NOT NULL THEN {entry.format('label', 'label', null)} END"]
    entries += [f"CASE WHEN passed & {1 << i}L != 0 THEN {entry.format('filter', repr(n), null)} END" for i, n in enumerate(names)]
    apart = (f"CASE WHEN of_object THEN array({entry.format('object', 'objectId', 'class')}) "
             f"ELSE filter(array({', '.join(entries)}), x -> x IS NOT NULL) END")
    return (counts.select(NIGHT, F.explode(F.expr(apart)).alias("e"), "n")
            .groupBy(NIGHT, "e.kind", "e.key", "e.part").agg(F.sum("n").alias("n")))


def refresh(spark: SparkSession, alert_path: str, path: str, galaxies: DataFrame, sky_objects: DataFrame) -> list[int]:
    """Bring the partial rows below ``path`` up to date with an alert table; the nights worked out anew."""
    now, then = _marks(spark, alert_path), {}
    if path_exists(spark, path):
        then = {r[NIGHT]: r.mark for r in spark.read.schema(SCHEMA).parquet(path).select(NIGHT, "mark").distinct().collect()}
    for gone in then.keys() - now.keys():
        delete_folder(spark, f"{path}/{NIGHT}={gone}")
    changed = sorted(n for n, mark in now.items() if then.get(n) != mark)
    if changed:
        some = read_alerts(spark, alert_path).filter(F.col(NIGHT).isin(changed))  # partition pruning
        mark = F.create_map(*[x for n in changed for x in (F.lit(n).cast("long"), F.lit(now[n]))])
        (partial_rows(some, galaxies, sky_objects).withColumn("mark", mark[F.col(NIGHT)]).hint("rebalance", NIGHT)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(NIGHT).parquet(path))
    return changed


def _kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).filter(F.col("kind") == kind)


def class_counts(spark: SparkSession, path: str) -> DataFrame:
    """A1: alerts of every class, the ten largest."""
    return (_kind(spark, path, "object").groupBy(F.col("part").alias("class")).agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_first("class")).limit(10))


def label_counts(spark: SparkSession, path: str) -> DataFrame:
    """A2: alerts of every catalogue label among the catalogue candidates, the five largest."""
    return (_kind(spark, path, "label").groupBy(F.col("key").alias("cdsxmatch")).agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), F.asc("cdsxmatch")).limit(5))


def filter_counts(spark: SparkSession, path: str) -> DataFrame:
    """A3: alerts that pass each filter, also filters that none passes."""
    names = spark.createDataFrame([(n,) for n in FL.ROW_FILTERS + FL.CATALOGUE_FILTERS], "filter string")
    found = _kind(spark, path, "filter").groupBy(F.col("key").alias("filter")).agg(F.sum("n").alias("n"))
    return names.join(found, "filter", "left").select("filter", F.coalesce("n", F.lit(0)).alias("n"))


def object_classes(spark: SparkSession, path: str) -> DataFrame:
    """Classes and number of alerts of every object."""
    return _kind(spark, path, "object").groupBy(F.col("key").alias("objectId")).agg(
        F.array_join(F.sort_array(F.collect_set("part")), "|").alias("classes"), F.sum("n").alias("n_alerts"))
