import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpusmill.llm import queries

from .conftest import FOLDER


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    rows = found.collect()
    assert rows and name in entry.queries()
    if name in queries.ORACLES:
        con = duckdb.connect()
        for table in ("documents", "embeddings", "pages", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        result = con.execute(queries.ORACLES[name])
        names = [d[0] for d in result.description]
        key = lambda row: [(v is None, v) for v in row]
        assert sorted(names) == sorted(found.columns)
        assert sorted((tuple(r[c] for c in names) for r in rows), key=key) == sorted(result.fetchall(), key=key)


def test_each_stage_works_on_what_is_left(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {0: docs.count()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        docs = stage(spark, docs, FOLDER).persist()
        kept[number] = docs.count()
        assert number == 5 or docs.columns == columns
    assert kept[0] > kept[1] > kept[2] >= kept[3] > 0 and kept[5] == kept[4]
    assert corpus_pipeline.run(spark, FOLDER).count() == kept[5]


def test_odd_and_empty_tables(spark, odd_docs, no_docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs, least in ((odd_docs, 5), (no_docs, 0)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == columns
        rows = corpus_pipeline.encode_texts(spark, docs, str(tmp_path)).collect()
        assert len(rows) >= least


def test_stages_mind_no_column_names(spark, tmp_path):
    """Extra columns called as the stages call their own for a while, in whatever case, stay as they are."""
    names = ["_text", "_toxic", "_copy", "_cut", "_CUT_id", "_size", "_taken", "_time", "_mix_pattern", "_mix_draw", "_mix_size", "_mix_all", "_mix_last", "class_id", "seed", "label", "ids"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    for k, name in enumerate(names):
        docs = docs.withColumn(name, corpus_pipeline.F.lit(k))
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    rows = docs.collect()
    assert rows and all([r[n] for n in names] == list(range(len(names))) for r in rows)
    assert corpus_pipeline.encode_texts(spark, docs, str(tmp_path)).count() == len(rows)
