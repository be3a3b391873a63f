"""Alert stream in, flagged / classified / routed stream out.

Every filter and the classifier are functions of one row, so the streaming
plan is stateless: ``readStream -> flags -> class -> topics -> writeStream``
in append mode, no watermark needed.  The catalogue filters join the stream
to a static, cell-exploded catalogue (a stream-static join keeps no state).
Notification rows are appended with ``foreachBatch``, keyed on (topic, candid,
channel) within an observation date, so a replayed micro-batch does not
duplicate them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import classify as K
from ..operators import routing as R
from ..session import names_in, run_folder, touch


def read_alert_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def classify_stream(stream: DataFrame) -> DataFrame:
    return stream.select("candid", "objectId", K.classify(stream).alias("class"))


def topic_stream(stream: DataFrame, galaxies: DataFrame | None = None,
                 sky_objects: DataFrame | None = None) -> DataFrame:
    """(topic, candid, objectId) rows of a stream.  With the catalogues, all
    topics -- the two catalogue filters as stream-static broadcast existence
    joins -- in one pass; without, the per-row topics."""
    if sky_objects is None:
        return R.route_topics(stream)
    from ..operators import filters as FL
    from ..operators import kilonova as KN
    from ..functions.columns import flag
    topics = FL.row_topics()
    extra = []
    for n in topics:
        sql = FL.filter_sql(n, stream)
        extra.append((F.expr(f"coalesce({sql}, false)") if sql is not None
                      else flag(FL.get_filter(n).builder(stream))).alias("f_" + n))
    label = {t: FL.REGISTRY[t].topic for t in topics} | {t: t for t in FL.CATALOGUE_FILTERS}
    topics = topics + FL.CATALOGUE_FILTERS
    flags = KN.catalogue_flags(stream, galaxies, sky_objects, keep=["candid", "objectId"], extra=extra)
    names = F.array(*[F.when(F.col("f_" + t), F.lit(label[t])) for t in topics])
    return flags.select(F.explode(F.filter(names, lambda x: x.isNotNull())).alias("topic"), "candid", "objectId")


def write_append(df: DataFrame, out_path: str, ckpt: str, partition_by: list[str] | None = None,
                 available_now: bool = True):
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", ckpt))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_classification_stream(spark: SparkSession, alerts: DataFrame | None = None, run_dir: str | None = None,
                              source_path: str | None = None, source_schema=None,
                              max_files_per_trigger: int | None = 4) -> DataFrame:
    """Run the stateless classification stream to completion (availableNow)
    and return the sink table.  The source is an alert folder (``source_path``,
    e.g. the night-partitioned alert table), or ``alerts`` written as the
    stream's input files."""
    base = run_dir or run_folder(spark, "stream")
    if source_path is None:
        alerts.write.mode("overwrite").parquet(f"{base}/in")
        source_path, source_schema = f"{base}/in", alerts.schema
    stream = read_alert_stream(spark, source_path, source_schema, max_files_per_trigger=max_files_per_trigger)
    q = write_append(classify_stream(stream), f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def run_topic_stream(spark: SparkSession, alerts: DataFrame, run_dir: str | None = None,
                     galaxies: DataFrame | None = None, sky_objects: DataFrame | None = None) -> DataFrame:
    """Same, writing one folder per topic (``partitionBy('topic')``)."""
    base = run_dir or run_folder(spark, "topics")
    alerts.write.mode("overwrite").parquet(f"{base}/in")
    stream = read_alert_stream(spark, f"{base}/in", alerts.schema, max_files_per_trigger=4)
    q = write_append(topic_stream(stream, galaxies, sky_objects), f"{base}/out", f"{base}/ckpt",
                     partition_by=["topic"])
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


#: Key of a notification row; rows are stored by observation date and attempt to write them.
NOTE_KEY = ["topic", "candid", "channel"]
OBS_DATE, ATTEMPT = "obs_date", "attempt"
#: Folder of the commit records inside a notification table (Spark's readers pass it by).
COMMITS = "_commits"


def _committed(spark: SparkSession, table_path: str, schema, dates: list | None = None) -> DataFrame | None:
    """Rows of committed attempts, of all dates or of ``dates``; None where there are none."""
    done = set(names_in(spark, f"{table_path}/{COMMITS}"))
    folders = []
    for date in names_in(spark, table_path) if dates is None else [f"{OBS_DATE}={d}" for d in dates]:
        if not date.startswith(f"{OBS_DATE}="):
            continue
        for name in names_in(spark, f"{table_path}/{date}"):
            if not name.startswith((f"{ATTEMPT}=", "_", ".")):
                raise ValueError(f"{table_path}/{date}/{name} is no part of a notification table")
            if name.removeprefix(f"{ATTEMPT}=") in done:
                folders.append(f"{table_path}/{date}/{name}")
    if not folders:
        return None
    return spark.read.schema(schema).option("basePath", table_path).parquet(*folders)


def read_notifications(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of a notification table whose write was committed; files of an attempt that broke off stay unseen."""
    schema = T.StructType([T.StructField("topic", T.StringType()), T.StructField("candid", T.LongType()),
                           T.StructField("channel", T.StringType()), T.StructField("epoch_id", T.LongType()),
                           T.StructField(OBS_DATE, T.StringType()), T.StructField(ATTEMPT, T.StringType())])
    rows = _committed(spark, table_path, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def notification_sink(table_path: str):
    """``foreachBatch`` function appending notification rows once: rows of a batch that repeat
    (topic, candid, channel) are written once, and rows already committed are skipped.

    The batch is worked out once and held while it is written.  Every attempt writes folders of its own, by
    observation date; its commit record, an empty file, is created last, and readers list only the
    folders of attempts that have one.  A batch that breaks off between two files leaves nothing to be
    seen, and its replay writes all of it.  Only the dates of the batch are looked at, so a batch costs the same
    however long the history is."""
    def sink(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = (batch.withColumn(OBS_DATE, F.coalesce(OBS_DATE, F.lit("unknown"))).dropDuplicates(NOTE_KEY)
                .withColumn("epoch_id", F.lit(epoch_id).cast("long"))
                .withColumn(ATTEMPT, F.lit(f"{epoch_id}-{uuid.uuid4().hex}"))).persist()
        try:
            dates = sorted(r[0] for r in rows.select(OBS_DATE).distinct().collect())
            if not dates:
                return
            done, new = _committed(spark, table_path, rows.schema, dates), rows
            if done is not None:
                new = rows.join(done.select(*NOTE_KEY), NOTE_KEY, "left_anti")
            new.write.mode("append").partitionBy(OBS_DATE, ATTEMPT).parquet(table_path)
            _commit(spark, table_path, rows.select(ATTEMPT).first()[0])
        finally:
            rows.unpersist()
    return sink


def _commit(spark: SparkSession, table_path: str, attempt: str) -> None:
    touch(spark, f"{table_path}/{COMMITS}/{attempt}")


def kilonova_stream(stream: DataFrame, galaxies: DataFrame, sky_objects: DataFrame) -> DataFrame:
    """Catalogue filters on a stream: (topic, candid, objectId) rows.

    Stream-static joins only (semi join to the host-galaxy cells, anti join to
    the star cells, both broadcast after the size check); no aggregation and no
    state, so append mode works without a watermark.
    """
    from ..operators import kilonova as KN
    ekn = KN.early_kn_candidates(stream, galaxies, sky_objects, with_host=False)
    rkn = KN.rate_based_kn_candidates(stream, sky_objects)
    return (ekn.select(F.lit("early_kn_candidates").alias("topic"), "candid", "objectId")
            .unionByName(rkn.select(F.lit("rate_based_kn_candidates").alias("topic"), "candid", "objectId")))


def run_kilonova_stream(spark: SparkSession, alerts: DataFrame, galaxies: DataFrame, sky_objects: DataFrame,
                        run_dir: str | None = None) -> DataFrame:
    base = run_dir or run_folder(spark, "kilonova")
    alerts.write.mode("overwrite").parquet(f"{base}/in")
    stream = read_alert_stream(spark, f"{base}/in", alerts.schema, max_files_per_trigger=4)
    q = write_append(kilonova_stream(stream, galaxies, sky_objects), f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def run_early_kn_stream(spark: SparkSession, source_path: str, galaxies: DataFrame, sky_objects: DataFrame,
                        run_dir: str | None = None, max_files_per_trigger: int | None = 16) -> DataFrame:
    """Early kilonova candidates with their hosts from a stored alert table read as a stream: stream-static joins,
    the host chosen inside the row, append mode, no state."""
    from ..operators import kilonova as KN
    from ..schema import ALERT
    from ..sources.alerts import NIGHT
    base = run_dir or run_folder(spark, "early-kn")
    schema = T.StructType(ALERT.fields + [T.StructField(NIGHT, T.LongType())])
    stream = read_alert_stream(spark, source_path, schema, max_files_per_trigger=max_files_per_trigger)
    q = write_append(KN.early_kn_candidates(stream, galaxies, sky_objects), f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def channel_rows(batch: DataFrame, galaxies: DataFrame, sky_objects: DataFrame) -> DataFrame:
    """(topic, candid, obs_date, channel) rows of one (micro-)batch of alerts, all three kilonova topics from one scan."""
    from ..operators import kilonova as KN
    return R.channels_one_pass(KN.kilonova_topic_rows(batch, galaxies, sky_objects), obs_date=OBS_DATE)


def run_notification_stream(spark: SparkSession, alerts: DataFrame, galaxies: DataFrame,
                            sky_objects: DataFrame, run_dir: str | None = None) -> tuple[str, object]:
    """Alerts stream -> channel rows appended idempotently by ``foreachBatch``.
    Returns (table path, sink function) so callers can replay a batch."""
    base = run_dir or run_folder(spark, "notify")
    alerts.write.mode("overwrite").parquet(f"{base}/in")
    stream = read_alert_stream(spark, f"{base}/in", alerts.schema, max_files_per_trigger=4)
    table = f"{base}/channels"
    write_rows = notification_sink(table)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        write_rows(channel_rows(batch, galaxies, sky_objects), epoch_id)

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table, sink


def batch_versions(spark: SparkSession, run_dir: str, epoch_id: int, paths: list[str]) -> list[str]:
    """The catalogue versions of a micro-batch: the current ones when it is first run, and the same again when it is
    replayed.  The choice is recorded as the name of an empty file."""
    from ..operators.catalogue import current_version
    made = [x for x in names_in(spark, f"{run_dir}/versions") if x.split(".")[0] == str(epoch_id)]
    if not made:
        made = [".".join([str(epoch_id), *[current_version(spark, p) for p in paths]])]
        touch(spark, f"{run_dir}/versions/{made[0]}")
    return made[0].split(".")[1:]


def run_versioned_stream(spark: SparkSession, source_path: str, schema, galaxy_path: str, sky_path: str,
                         run_dir: str | None = None, max_files_per_trigger: int | None = 4) -> str:
    """Alert stream -> notification rows, with the catalogue versions that are current as each micro-batch begins.
    Catalogues are published with ``catalogue.publish_catalogue``; one that is replaced while the stream runs
    holds from the next micro-batch on.  Returns the path of the notification table."""
    from ..operators.catalogue import read_version
    base = run_dir or run_folder(spark, "notify")
    table = f"{base}/channels"
    write_rows = notification_sink(table)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        chosen = batch_versions(batch.sparkSession, base, epoch_id, [galaxy_path, sky_path])
        galaxies, sky = [read_version(batch.sparkSession, p, v) for p, v in zip((galaxy_path, sky_path), chosen)]
        write_rows(channel_rows(batch, galaxies, sky), epoch_id)
    stream = read_alert_stream(spark, source_path, schema, max_files_per_trigger=max_files_per_trigger)
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table
