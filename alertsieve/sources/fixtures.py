"""Derive alert and catalogue tables from the driver's generic test tables.

The test data holds no alerts, so one ``events`` row becomes one alert (see
FIXTURES.md for the rules).  Everything except the per-object history is a
row-local projection.  ``jdstarthist``, ``ndethist`` and ``prv_candidates``
come from a range-partitioned prefix scan (``object_history``), the same for
objects of any size.
Only the slim columns (event id, object id, time and the history point)
travel through the shuffle; the remaining ~25 alert columns are recomputed
from the event id afterwards.  Predicates that only depend on the object id
(e.g. the catalogue label) are pushed by Catalyst below the window.

On a production cluster alerts arrive with their history already packaged by
the survey, so this adapter is a fixture, not a step of the filtering plan.

Expressions are Spark SQL text (``selectExpr``): one JVM call per column
instead of one per expression node.  ``D`` suffixes keep literals double (a
bare ``100.0`` is a decimal in Spark SQL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def epoch_micros_sql(df: DataFrame, name: str) -> str:
    """Microseconds since the epoch, independent of the session time zone."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)"
    return f"unix_micros(CAST(`{name}` AS TIMESTAMP))"


def epoch_micros(df: DataFrame, name: str) -> Column:
    return F.expr(epoch_micros_sql(df, name))


def _history_fields_sql(e: str = "event_id") -> dict[str, str]:
    """Measurement columns of event ``e`` (identical for the current point and
    for the same point seen later as history, except ``magpsf``)."""
    return {
        "jd": "jd",
        "fid": f"CAST(1 + (({e} * 13) % 101) % 2 AS BIGINT)",
        "magpsf": f"16 + (({e} * 7919) % 499) / 100.0D",
        "sigmapsf": f"0.02D + (({e} * 17) % 89) / 1000.0D",
        "magnr": f"20 + ({e} % 31) / 10.0D",
        "sigmagnr": f"0.02D + ({e} % 13) / 1000.0D",
        "magzpsci": f"26 + ({e} % 5) / 10.0D",
        "isdiffpos": f"CASE WHEN {e} % 7 = 0 THEN 'f' ELSE 't' END",
        "ssnamenr": (f"CASE WHEN {e} % 50 = 0 THEN 'Ceres' WHEN {e} % 50 = 1 THEN CAST(NULL AS STRING) "
                     f"ELSE 'null' END"),
    }


def _slim_events(events: DataFrame) -> DataFrame:
    us = epoch_micros_sql(events, "ts")
    return events.selectExpr(
        "event_id", "ts", "user_id * 8 + CAST(get_json_object(props, '$.k') AS BIGINT) % 8 AS obj",
        f"{us} / 86400000000.0D + 2440587.5D AS jd")


def _history_point_sql() -> str:
    h = _history_fields_sql()
    # a point seen as history is a non-detection when event_id % 5 == 0
    h["magpsf"] = f"CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE {h['magpsf']} END"
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in h.items()) + ")"


def object_history(slim: DataFrame, n_parts: int) -> DataFrame:
    """(event_id, obj, jd, jdstarthist, ndethist, prv_candidates), ranks and dates with no task owning an object.

    Events are range-partitioned on (obj, ts, event_id): the sampler splits a
    large object's time range over many partitions, and partition i precedes
    partition i+1 in that order.  Inside a partition rank, first date and
    history are local.  An object that lies in several partitions is cut into pieces, one
    per partition; at most one such object crosses each border, so there are fewer of them than partitions.
    Every piece is sent to the object's later partitions, where its points are put in front of the
    alerts' own: grouped by (object, partition), so a task holds the points of one partition and
    one history, never an object's pieces for all its partitions.  Windows by object see the counts and first dates of pieces
    alone.  The partitioned slim events are checkpointed (shared folder of
    ``spark.checkpoint.dir``) so all uses see the same partition ids even if
    a stage is recomputed after an executor loss.  Every alert carries all
    earlier points of its object, so the history itself is quadratic in an
    object's events by definition; Catalyst drops it when it is not read.
    """
    ensure_checkpoint_dir(slim.sparkSession)
    r = (slim.repartitionByRange(n_parts, "obj", "ts", "event_id")
         .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    by = "PARTITION BY obj, _pid ORDER BY ts, event_id"
    point = _history_point_sql()
    local = r.selectExpr(
        "event_id", "obj", "jd", "_pid", f"row_number() OVER ({by}) AS _rank",
        f"min(jd) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _first",
        f"collect_list({point}) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _points")
    crossing = (r.groupBy("obj").agg(F.min("_pid").alias("_low"), F.max("_pid").alias("_last"))
                .filter("_last > _low").select("obj", "_last"))
    pieces = r.join(F.broadcast(crossing), "obj")  # fewer rows than partitions
    before = "OVER (PARTITION BY obj ORDER BY _pid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    counts = (pieces.groupBy("obj", "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("jd").alias("_m"))
              .selectExpr("obj", "_pid", f"sum(_n) {before} AS _count", f"min(_m) {before} AS _start"))
    held = (pieces.selectExpr("obj", "_pid", "_last", f"named_struct('ts', ts, 'e', event_id, 'p', {point}) AS q")
            .groupBy("obj", "_pid", "_last").agg(F.array_sort(F.collect_list("q")).alias("_q")))
    sent = held.selectExpr("obj", "_pid AS _from", "transform(_q, x -> x.p) AS _piece",
                           "explode(filter(sequence(_pid, _last), x -> x > _pid)) AS _to")
    earlier = (sent.groupBy("obj", F.col("_to").alias("_pid"))
               .agg(F.array_sort(F.collect_list(F.struct("_from", "_piece"))).alias("_e"))
               .selectExpr("obj", "_pid", "flatten(transform(_e, x -> x._piece)) AS _earlier"))
    return (local.join(counts, ["obj", "_pid"], "left").join(earlier, ["obj", "_pid"], "left").selectExpr(
        "event_id", "obj", "jd",
        "CASE WHEN _start IS NULL THEN _first ELSE least(_start, _first) END AS jdstarthist",
        "CAST(coalesce(_count, 0) + _rank AS BIGINT) AS ndethist",
        "concat(coalesce(_earlier, array()), coalesce(_points, array())) AS prv_candidates"))


def events_to_alerts(events: DataFrame, n_parts: int | None = None) -> DataFrame:
    """events(event_id, ts, user_id, props, ...) -> alerts with schema ALERT."""
    n_parts = n_parts or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _project_alert(object_history(_slim_events(events), n_parts))


# Catalogue label of an object by obj % 20 (FIXTURES.md).
_CDS = ["Unknown"] * 9 + ["Galaxy", "Seyfert_1", "QSO", "RRLyr", "Candidate_YSO", "Candidate_TTau*",
                          "SN", "Candidate_SN*", "Transient", "Fail"]


def _project_alert(hist: DataFrame) -> DataFrame:
    e = "event_id"
    g = "(1 + obj % 150)"
    cur = _history_fields_sql(e)
    cds = "element_at(array(" + ", ".join(f"'{n}'" for n in _CDS) + "), CAST(obj % 20 + 1 AS INT))"
    cand = {
        "jd": "jd",
        "jdstarthist": "jdstarthist",
        "ndethist": "ndethist",
        "drb": f"CASE WHEN {e} % 101 = 0 THEN CAST(NULL AS DOUBLE) ELSE (({e} * 7919 + 11) % 997) / 997.0D END",
        "classtar": f"(({e} * 6151 + 5) % 991) / 991.0D",
        "fid": cur["fid"], "magpsf": cur["magpsf"], "sigmapsf": cur["sigmapsf"], "magnr": cur["magnr"],
        "sigmagnr": cur["sigmagnr"], "magzpsci": cur["magzpsci"], "isdiffpos": cur["isdiffpos"],
        "ra": f"(({g} * 7919) % 36000) / 100.0D + (({e} % 7) - 3) * 0.002D",
        "dec": f"-30 + (({g} * 4051) % 12000) / 100.0D",
        "ssdistnr": (f"CASE WHEN {e} % 11 = 0 THEN 5.0D WHEN {e} % 11 = 1 THEN CAST(NULL AS DOUBLE) "
                     f"WHEN {e} % 11 = 2 THEN 30.0D ELSE -999.0D END"),
        "ssnamenr": cur["ssnamenr"],
        "field": f"CAST(CASE WHEN {e} % 8 = 0 THEN 1525 WHEN {e} % 8 = 1 THEN 530 ELSE 600 + {e} % 8 END AS BIGINT)",
        "neargaia": f"({e} % 53) / 4.0D",
        "distpsnr1": f"({e} % 47) / 4.0D",
    }
    rf_snia = f"(({e} * 3571 + 1) % 971) / 971.0D"
    return hist.selectExpr(
        f"{e} AS candid",
        "concat('OBJ', lpad(CAST(obj AS STRING), 8, '0')) AS objectId",
        f"CASE WHEN obj % 20 = 19 THEN CAST(NULL AS STRING) ELSE {cds} END AS cdsxmatch",
        f"CAST(CASE WHEN ({e} * 17) % 25 = 0 THEN 3 WHEN ({e} * 17) % 25 = 1 THEN 2 ELSE 0 END AS BIGINT) AS roid",
        f"CASE WHEN {e} % 30 = 0 THEN (({e} * 37) % 89) / 89.0D ELSE 0.0D END AS mulens",
        f"(({e} * 5407 + 3) % 983) / 983.0D AS snn_snia_vs_nonia",
        f"(({e} * 4799 + 7) % 977) / 977.0D AS snn_sn_vs_all",
        f"{rf_snia} AS rf_snia_vs_nonia",
        f"(({e} * 2749 + 9) % 967) / 967.0D AS rf_kn_vs_nonkn",
        f"{rf_snia} AS rfscore",
        f"CASE WHEN ({e} * 29) % 40 = 0 THEN concat('TRCK_', CAST({e} AS STRING)) "
        f"WHEN ({e} * 29) % 40 = 1 THEN CAST(NULL AS STRING) ELSE '' END AS tracklet",
        "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in cand.items()) + ") AS candidate",
        "prv_candidates",
    )


def load_alerts(spark, sf_dir: str) -> DataFrame:
    return events_to_alerts(spark.read.parquet(f"{sf_dir}/events.parquet"))


def customer_to_raw_galaxies(customer: DataFrame) -> DataFrame:
    """Raw galaxy table (input of ``build_galaxy_catalogue``) from ``customer``.

    Names are written as byte-string reprs (b'...') like a table exported from
    HDF5, so the catalogue builder has to strip them.
    """
    dist = "CAST(20 + (c_custkey * 31) % 240 AS DOUBLE)"
    quote = "'\\''"   # SQL string literal holding one single quote
    return customer.selectExpr(
        "c_custkey AS galaxy_idx",
        f"concat('b', {quote}, 'PGC', CAST(c_custkey AS STRING), {quote}) AS HyperLEDA_name",
        f"concat('b', {quote}, 'J', lpad(CAST(c_custkey AS STRING), 8, '0'), {quote}) AS `2MASS_name`",
        "((c_custkey * 7919) % 36000) / 100.0D AS RA",
        "-30 + ((c_custkey * 4051) % 12000) / 100.0D AS dec",
        f"{dist} AS dist",
        f"{dist} / 10.0D AS dist_err",
        "CAST(c_acctbal AS DOUBLE) AS stellarmass",
        f"{dist} * 70 / 299792.458D AS z",
    )


def part_to_sky_objects(part: DataFrame) -> DataFrame:
    """Nearby-object catalogue (src_id, ra, dec, type) from ``part``."""
    return part.selectExpr(
        "p_partkey AS src_id",
        "((p_partkey * 7919) % 36000) / 100.0D + ((p_partkey % 5) - 2) * 0.0005D AS ra",
        "-30 + ((p_partkey * 4051) % 12000) / 100.0D AS dec",
        "CAST(p_size % 8 AS BIGINT) AS type",
    )


def load_raw_galaxies(spark, sf_dir: str) -> DataFrame:
    return customer_to_raw_galaxies(spark.read.parquet(f"{sf_dir}/customer.parquet"))


def load_sky_objects(spark, sf_dir: str) -> DataFrame:
    return part_to_sky_objects(spark.read.parquet(f"{sf_dir}/part.parquet"))


def part_to_rules(part: DataFrame) -> DataFrame:
    """User rules (``rule_index.RULES``), one per row of ``part``: a label and a magnitude, two labels and a score, or two
    scores (FIXTURES.md)."""
    p = "p_partkey"
    names = "array(" + ", ".join(f"'{n}'" for n in _CDS) + ")"

    def label(k: int) -> str:
        return f"element_at({names}, CAST({p} * {k} % 19 + 1 AS INT))"

    def span(column: str, low: str, width: float) -> str:
        return f"named_struct('column', '{column}', 'low', {low}, 'high', {low} + {width!r}D)"
    return part.selectExpr(
        f"concat('rule_', CAST({p} AS STRING)) AS topic",
        f"CASE {p} % 3 WHEN 0 THEN map('cdsxmatch', array({label(1)})) WHEN 1 THEN map('cdsxmatch', array({label(7)}, {label(11)})) "
        "ELSE CAST(map() AS MAP<STRING, ARRAY<STRING>>) END AS labels",
        f"CASE {p} % 3 WHEN 0 THEN array({span('magpsf', f'16 + ({p} * 37 % 450) / 100.0D', 0.05)}) "
        f"WHEN 1 THEN array({span('rf_snia_vs_nonia', f'({p} * 13 % 90) / 100.0D', 0.01)}) "
        f"ELSE array({span('classtar', f'({p} * 17 % 95) / 100.0D', 0.005)}, {span('drb', f'({p} * 29 % 80) / 100.0D', 0.1)}) "
        "END AS ranges")


def load_rules(spark, sf_dir: str) -> DataFrame:
    return part_to_rules(spark.read.parquet(f"{sf_dir}/part.parquet"))
