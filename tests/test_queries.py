"""Registered queries against DuckDB over the smallest tables."""

from __future__ import annotations

import decimal
import math
import os
import re
import unicodedata

import duckdb
import pytest

from eventweave.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return (None if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    at = [want.columns.index(c) for c in cols]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).limit(1).count() == 1


def test_normalize_turns(spark, tmp_path):
    def plain_text(text):
        low = unicodedata.normalize("NFD", text.lower())
        low = "".join(c for c in low if not unicodedata.combining(c)).replace("№", " nr ")
        return " ".join(re.findall("[a-z0-9]+", low)) or None

    texts = ["plain, ASCII 1", "Zażółć Gęślą", "№5", "x№ 7", "ế Ǎ ǧ Ṡ ơ Việt Nam", "e\u0301te\u0301", "日本 ß", "", None]
    rows = [(1, k, "user", t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {x["turn"]: x["normalized"] for x in registry.queries()["normalize_turns"](spark, str(tmp_path)).collect()}
    assert got == {k: None if t is None else plain_text(t) for _, k, _, t in rows}
    assert registry.queries()["normalize_turns"](spark, SF).count() == spark.read.parquet(f"{SF}/conversations.parquet").count()


def test_no_cartesian_product(spark):
    for name, q in registry.queries().items():
        if name != "multiclass_metrics":  # joins two single rows
            plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
