import os
import pytest
from pyspark.sql import functions as F

from lexiflow.plans.splits import assign_split
from lexiflow.session import work_path
from lexiflow.sources.parquet import read_feature_set, write_feature_set
from lexiflow.sources.tables import read_table
from tests.conftest import SF001


def test_write_refuses_existing_path_by_default(spark):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 8, "train").otherwise("val"))
    path = work_path(spark, "exists")
    write_feature_set(df, path)
    with pytest.raises(Exception):
        write_feature_set(df, path)
    write_feature_set(df, path, mode="overwrite")
    assert read_feature_set(spark, path, "val").count() == 2


def test_every_row_in_one_split(spark):
    df = assign_split(spark.range(-25, 75).withColumnRenamed("id", "doc_id"))
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {"train": 80, "test": 10, "val": 10}


def test_reader_deals_out_only_when_asked(spark):
    path = os.path.join(SF001, "documents.parquet")
    stored = spark.read.parquet(path).rdd.getNumPartitions()
    assert read_table(spark, path).rdd.getNumPartitions() == stored
    assert read_table(spark, path, 5).rdd.getNumPartitions() == 5


def test_checkpoint_folder_is_asked_for_on_a_cluster(monkeypatch):
    from lexiflow import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
