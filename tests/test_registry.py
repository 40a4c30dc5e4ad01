"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from cinderfield.plans.oracle_sql import statements
from cinderfield.plans.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = REGISTRY, statements()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def tidy(pdf):
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if str(pdf[c].dtype).startswith("datetime"):
            pdf[c] = pdf[c].astype("datetime64[us]").astype(str)
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def test_entry_module_offers_these_queries():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"spatial_cv", "holdout_eval", "batch_scores", "feature_attribution"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf, name):
    got, want = tidy(QUERIES[name](spark, sf).toPandas()), tidy(duck.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    for c in got.columns:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        assert same.all(), (c, got[c][~same].head().tolist(), want[c][~same].head().tolist())


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
