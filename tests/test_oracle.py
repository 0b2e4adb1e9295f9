"""Every registered query beside its SQL, over whole tables."""

import os
import time

import pytest

from corpusmill.catalog import catalog

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = catalog()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def normal(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    began = time.time()
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    took = time.time() - began
    if took > 10:
        print(f"SLOW {name}: {took:.1f} s")
    if name not in ORACLES:
        assert columns
        return
    result = engine.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = [tuple(r[i] for i in order) for r in result.fetchall()]
    assert len(got) == len(wanted), f"{len(got)} rows for {len(wanted)}"
    got, wanted = normal(got), normal(wanted)
    wrong = [(g, w) for g, w in zip(got, wanted) if g != w]
    assert not wrong, f"{len(wrong)} of {len(got)} rows differ, first: {str(wrong[0])[:2000]}"
