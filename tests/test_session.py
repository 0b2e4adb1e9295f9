"""Written tables: what stands for them goes, settings stay, slices are folders."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusmill import session


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in (lambda all_files: [all_files.apply(i) for i in range(all_files.length())])(manager.getAllFiles()) if f.getName().startswith("shuffle_")}


def counted(spark, n=5000):
    return spark.range(n).select((F.col("id") % 7).alias("k"), "id").repartition(4, "k").groupBy("k").agg(F.sum("id").alias("total"))


@pytest.mark.parametrize("value", [None, "false", "true"])
def test_shuffle_files_of_a_written_table_go(spark, value):
    key = session._DROP_SHUFFLES
    earlier = spark.conf.get(key, None)
    spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    try:
        before = shuffle_files(spark)
        table = session.materialize(counted(spark), "counted")
        assert shuffle_files(spark) <= before
        assert spark.conf.get(key, None) == value
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, counted(spark).collect()))
    finally:
        spark.conf.unset(key) if earlier is None else spark.conf.set(key, earlier)


def test_a_sliced_table_is_read_by_slice_and_can_be_emptied(spark):
    rows = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("slice"))
    table = session.materialize(rows, "sliced", "slice")
    one = table.where("slice = 1")
    assert "PartitionFilters: [isnotnull(slice" in one._jdf.queryExecution().toString()
    assert sorted(r.id for r in one.collect()) == list(range(1, 100, 3)) and table.columns == ["id", "slice"]
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    session.discard(table)
    assert len(folders) == 3 and all(spark.read.schema("id bigint").parquet(f).count() == 0 for f in folders)


def test_queries_are_named_before_there_is_a_session():
    root = Path(__file__).resolve().parents[1]
    made = "import __spark_entry__ as e; from pyspark.sql import SparkSession as S; print(len(e.queries()), len(e.oracle_sql()), S.getActiveSession())"
    said = subprocess.run([sys.executable, "-c", made], cwd=root, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr[-2000:]
    found, checked, session_made = said.stdout.split()
    assert int(found) > int(checked) > 0 and session_made == "None"
