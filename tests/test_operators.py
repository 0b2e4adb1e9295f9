import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.labels import any_flag, any_flag_strict, not_category
from corpusmill.operators import relational as R
from corpusmill.operators import splits as S
from corpusmill.operators.hotkeys import lookup_join
from corpusmill.operators.sizing import partition_count, repartition_by_size, target_partitions


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_labels_with_nulls(spark):
    flags = spark.createDataFrame([(1, None, 0), (None, 1, 0), (0, 0, 0), (None, None, None)], "a int, b int, c int").coalesce(1)
    assert values(flags, any_flag_strict("a", "b", "c")) == [0, 0, 0, 0]
    assert values(flags, any_flag("a", "b", "c")) == [1, 1, 0, 0]
    category = spark.createDataFrame([("not_cyberbullying",), ("age",), (None,)], "c string").coalesce(1)
    assert values(category, not_category(F.col("c"), "not_cyberbullying")) == [0, 1, 1]


def test_sentinel_keeps_nulls_and_is_pushed_down(spark, tmp_path):
    df = spark.createDataFrame([(-1,), (0,), (1,), (None,)], "toxic int").coalesce(1)
    assert values(R.drop_sentinel(df, "toxic"), "toxic") == [0, 1, None]
    df.write.parquet(str(tmp_path / "t"))
    plan = R.drop_sentinel(spark.read.parquet(str(tmp_path / "t")), "toxic")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Not(EqualNullSafe(toxic,-1))]" in plan


def test_word_filters(spark):
    df = spark.createDataFrame([("",), ("  ",), ("a",), ("a b",), ("a \x1cb",), (None,)], "cleaned_text string").coalesce(1)
    assert values(R.filter_min_words(df), "cleaned_text") == ["a b", "a \x1cb"]
    assert values(R.short_texts(df), "cleaned_text") == ["", "  ", "a"]
    texts = df.withColumnRenamed("cleaned_text", "text")
    both = R.filter_min_words(R.add_cleaned_text(texts, ["lowercase"]))
    assert sorted(R.clean_and_filter(texts, ["lowercase"]).collect()) == sorted(both.collect())


def test_join_multiplies_and_suffixes(spark):
    left = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "id string, v string")
    right = spark.createDataFrame([("1", 7), ("1", 8)], "id string, v int")
    joined = R.join_labels(left, right)
    assert joined.columns == ["id", "v_x", "v_y"] and joined.count() == 4


def test_validation(spark):
    with pytest.raises(ValueError):
        R.require_columns(spark.range(1), ["text"])
    with pytest.raises(ValueError):
        R.union_sources([])
    df = spark.createDataFrame([("train",), ("dev",), ("eval",), (None,)], "split string")
    assert {r.split for r in R.validate_split_domain(df).collect()} == {"eval", None}
    with pytest.raises(Exception, match="invalid split name"):
        R.require_split_domain(df).collect()
    assert R.require_split_domain(df.where("split in ('train', 'dev')")).count() == 2


def test_splits_cover_and_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("label", (F.col("id") % 3).cast("int"))
    first, second = S.stratified_split(df, 0.3, "label", "x", "id")
    a, b = set(values(first, "id")), set(values(second, "id"))
    assert not a & b and len(a | b) == 5000 and abs(len(b) - 1500) < 150
    again = S.stratified_split(df.repartition(7), 0.3, "label", "x", "id")[1]
    assert set(values(again.coalesce(1), "id")) == b
    nested = S.stratified_split(second, 0.5, "label", "y", "id")[1]
    assert 600 < nested.count() < 900
    assert set(values(S.random_split(df, 0.2, "x", "id")[1], "id")).isdisjoint(values(S.random_split(df, 0.2, "x", "id")[0], "id"))


def test_quota_is_exact_and_keeps_copies_together(spark):
    df = spark.range(3001).withColumn("label", F.when(F.col("id") < 1000, "a").when(F.col("id") < 3000, "b").otherwise("c"))
    first, second = S.quota_split(df, 0.3, "label", "q", "id")
    counts = {r["label"]: r["count"] for r in second.groupBy("label").count().collect()}
    assert counts == {"a": 300, "b": 600}
    assert first.count() + second.count() == 3001
    # A third of all rows are copies of one key.
    copies = df.withColumn("key", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    first, second = S.quota_split(copies, 0.5, "label", "q", "key")
    assert not set(values(first, "key")) & set(values(second, "key"))
    sizes = {r["label"]: r["count"] for r in second.groupBy("label").count().collect()}
    assert sizes["a"] <= 500 and sizes["b"] <= 1000
    with pytest.raises(ValueError):
        S.quota_split(df, 1.0, "label", "q", "id")


def test_no_plan_with_a_shuffle_depends_on_row_order(spark):
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 3).cast("string").alias("key"))
    table = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    plan = lookup_join(rows, table, "key", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically" not in plan and "rand(" not in plan


def test_row_bytes_of_nested_values(spark):
    rows = spark.sql("SELECT array('ab', null, 'é') AS a, map('k', 1L) AS m, struct(1 AS x, 'yz' AS y) AS s, cast(1 AS decimal(30, 2)) AS d, cast(null AS array<int>) AS n")
    assert R.table_bytes(rows).first().n_bytes == (2 + 2) + (1 + 8) + (4 + 2) + 16


def test_lookup_join_with_hot_keys(spark):
    rng = random.Random(1)
    keys = ["hot"] * 4000 + [f"k{rng.randint(0, 3000)}" for _ in range(6000)] + [None] * 5 + ["missing"] * 5
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, key string").repartition(5)
    table = rows.where("key <> 'missing'").groupBy("key").agg(F.count("*").alias("n"), F.max("i").alias("m"))
    for weight in ("n", None):
        got = {r.i: r.m for r in lookup_join(rows, table, "key", weight).collect()}
        wanted = {r.key: r.m for r in table.collect()}
        assert got == {i: wanted.get(k) for i, k in enumerate(keys)}


def brute_partitions(n_bytes, workers, memory, least, aimed):
    if n_bytes <= least:
        return 1
    if n_bytes / workers <= least:
        return round(n_bytes / least)
    p = 1
    while n_bytes / p > memory * workers:
        p += 1
    n = p * workers
    while n_bytes / (n + 1) > least and n // workers < aimed:
        n += 1
    return n


def test_partition_count(spark):
    rng = random.Random(2)
    for _ in range(2000):
        args = (rng.randint(1, 10**6), rng.randint(1, 9), rng.randint(100, 10**5), rng.randint(1, 10**5), rng.randint(1, 12))
        assert partition_count(*args) == brute_partitions(*args), args
    df = spark.createDataFrame([("x" * 100,)] * 300, "t string")
    for least in (100, 3000, 10_000, 12_000, 10**6):
        row = target_partitions(df, 3, 2500.0, least, 4).first()
        assert row.n_bytes == 30_000 and row.n_partitions == partition_count(30_000, 3, 2500.0, least, 4)
    spread = repartition_by_size(df, 3, 2500.0, 1000, 4)
    assert spread.rdd.getNumPartitions() == partition_count(30_000, 3, 2500.0, 1000, 4)
    assert sorted(spread.collect()) == sorted(df.collect())


def test_word_minimum_equals_python(spark, string_frame, strings):
    for n in (0, 1, 2, 5, 2000, 20_000):
        kept = {r.i for r in R.filter_min_words(string_frame, "t", n).collect()}
        assert kept == {i for i, t in enumerate(strings) if len(t.split()) >= n}
