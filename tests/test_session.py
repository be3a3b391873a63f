"""Sessions and folders: nothing of a foreign session is changed, no silent local folder."""

import pytest

from alertsieve import session as S
from alertsieve.operators.skyjoin import checked_broadcast


class _Remote:
    """What ``ensure_checkpoint_dir`` asks of a session on a cluster without the setting."""

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_existing_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert S.get_spark(shuffle_partitions=99) is not None
        assert spark.conf.get("spark.sql.shuffle.partitions") == "13"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(ValueError):
        S.ensure_checkpoint_dir(_Remote)
    assert S.is_local(_Remote) is False


def test_run_folders_are_deleted(spark):
    kept = S._FOLDERS.pop(spark.sparkContext.applicationId, [])
    try:
        path = S.run_folder(spark, "probe")
        spark.range(3).write.parquet(path)
        assert S.path_exists(spark, path)
        assert S.clear_run_folders(spark) == 1 and not S.path_exists(spark, path)
    finally:
        S._FOLDERS[spark.sparkContext.applicationId] = kept


def test_grown_catalogue_is_measured_again(spark):
    path = S.run_folder(spark, "catalogue")
    spark.range(100).selectExpr("id", "repeat('x', 20) AS name").write.parquet(path)
    small = spark.read.parquet(path)
    assert checked_broadcast(small, 10_000) is not small
    spark.range(1000).selectExpr("id", "repeat('x', 20) AS name").write.mode("append").parquet(path)
    grown = spark.read.parquet(path)
    assert checked_broadcast(grown, 10_000) is grown
