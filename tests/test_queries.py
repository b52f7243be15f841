"""Every registered query over the smallest tables, against its DuckDB SQL where it has one."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tidemill.plans.registry import QUERIES
from tidemill.session import settings_for

DATA = "/root/testdata/sf0.001"
NO_SQL = {"boosted_classifier", "model_metrics", "tree_classifier"}

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _sorted(rows):
    return sorted(tuple(map(_plain, row)) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    rows = _sorted(frame.select(*[f"`{c}`" for c in columns]).collect())
    if name in NO_SQL:
        assert rows
        return
    result = tables.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == _sorted([row[i] for i in order] for row in result.fetchall())


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) - set(driver.oracle_sql()) == NO_SQL


def test_entry(spark):
    assert driver.entry(spark).columns == ["stt", "edt", "cur_date", "keyword", "keyword_count"]


def test_models_learn_something(spark):
    scored = driver.queries()["tree_classifier"](spark, DATA).toPandas()
    found = scored[scored.response == 1].prediction.mean()
    assert found > scored[scored.response == 0].prediction.mean() + 0.2


def test_scores_of_fitted_models(spark):
    test = driver.queries()["model_columns"](spark, DATA)
    rows, positives = test.count(), test.where("response = 1").count()
    scores = driver.queries()["model_metrics"](spark, DATA).collect()
    assert {r.classifier for r in scores} == {"boosted", "tree"}
    for r in scores:
        assert (r.rows, r.positives) == (rows, positives)
        assert 1 - positives / rows - 0.05 < r.accuracy <= 1


@pytest.mark.parametrize("name", ["keyword_window_count", "visitor_repair", "date_helpers", "cdc_upsert_latest", "event_time"])
def test_results_do_not_depend_on_the_session_zone(spark, tables, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_query(spark, tables, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_settings_grow_with_the_input():
    small, large = settings_for(10**9), settings_for(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) > 700_000
