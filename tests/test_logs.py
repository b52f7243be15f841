from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import logs as L
from tidemill.operators.visitors import MODES, repair_visitors
from tidemill.plans import inputs as I

DAY = 86_400_000


def _lines(spark, records):
    return spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def _values(frame):
    return [json.loads(r.value) for r in frame.collect()]


PAGE_RECORD = {
    "common": {"mid": "m1", "is_new": "1", "ch": None, "vc": 3},
    "page": {"item": "5", "during": 20, "note": None},
    "displays": [{"pos": 1, "x": None}, {"pos": 2}],
    "actions": [{"id": "cart"}],
    "err": {"error_code": 7},
    "extra": {"k": [1, None]},
    "gone": None,
    "ts": 1000,
}


def test_dirty_reasons(spark):
    lines = [None, "", "null", "[1]", '{"a":', '"x"', '{"ts":1}', '{"common":3,"ts":1}', '{"common":{"is_new":"1"},"ts":1}',
             '{"common":{"mid":"a"}}', '{"common":{"mid":"a"},"ts":"x"}', '{"common":{"mid":"a"},"ts":"12"}']
    parsed = L.read_logs(_lines(spark, lines))
    reasons = [r.reason for r in L.dirty_logs(parsed).collect()]
    assert reasons == ["not a JSON object"] * 6 + ["no common block"] * 2 + ["no device"] + ["no time"] * 2
    assert [(r.mid, r.ts) for r in L.valid_logs(parsed).collect()] == [("a", 12)]


def test_page_record_split(spark):
    good = L.valid_logs(L.read_logs(_lines(spark, [PAGE_RECORD])))
    common, page = {"mid": "m1", "is_new": "1", "vc": 3}, {"item": "5", "during": 20}
    whole = {"common": common, "page": page, "displays": PAGE_RECORD["displays"], "actions": [{"id": "cart"}],
             "err": {"error_code": 7}, "extra": {"k": [1, None]}, "ts": 1000}
    assert _values(L.log_err(good)) == [whole]
    assert _values(L.log_start(good)) == []
    assert _values(L.log_display(good)) == [
        {"common": common, "page": page, "display": {"pos": 1}, "ts": 1000},
        {"common": common, "page": page, "display": {"pos": 2}, "ts": 1000}]
    assert _values(L.log_action(good)) == [{"common": common, "page": page, "action": {"id": "cart"}}]
    rest = {k: v for k, v in whole.items() if k not in ("displays", "actions")}
    assert _values(L.log_page(good)) == [rest]


def test_start_record_and_empty_arrays(spark):
    start = {"common": {"mid": "a"}, "start": {"entry": "icon"}, "displays": [{"pos": 1}], "ts": 1}
    empty = {"common": {"mid": "a"}, "page": {"item": "x"}, "displays": [], "actions": [], "start": None, "ts": 2}
    good = L.valid_logs(L.read_logs(_lines(spark, [start, empty])))
    assert _values(L.log_start(good)) == [start]
    assert _values(L.log_display(good)) == []
    assert _values(L.log_page(good)) == [{k: v for k, v in empty.items() if k != "start"}]


def test_repaired_flag_reaches_every_output(spark):
    good = L.valid_logs(L.read_logs(_lines(spark, [PAGE_RECORD]))).withColumn("is_new", F.lit("0"))
    for row in L.log_split(good).collect():
        assert json.loads(row.value)["common"]["is_new"] == "0", row.tag


def test_split_reconciles_with_input(spark):
    rng = random.Random(1)
    records, broken = [], 0
    for i in range(400):
        record = {"common": {"mid": str(i % 9)}, "ts": i, "page": {"item": "x"}}
        if rng.random() < 0.3:
            record["start"] = {"entry": "e"}
        record["displays"] = [{"pos": p} for p in range(rng.randrange(4))]
        text = json.dumps(record)
        if rng.random() < 0.1:
            text, broken = text[:-3], broken + 1
        records.append(text)
    parsed = L.read_logs(_lines(spark, records))
    counts = {r.tag: r.n for r in L.log_split(parsed).groupBy("tag").agg(F.count("*").alias("n")).collect()}
    assert counts["dirty"] == broken
    assert counts["page"] + counts["start"] + counts["dirty"] == 400
    expected = sum(len(json.loads(r)["displays"]) for r in records if _is_json(r) and "start" not in json.loads(r))
    assert counts["display"] == expected


def _is_json(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def _walk(records, mode):
    """One record after the other, one remembered day per device."""
    remembered, out = {}, {}
    for mid, ts, seq, flag in sorted(records, key=lambda r: (r[1], r[2])):
        day = (ts + 8 * 3_600_000) // DAY
        held = remembered.get(mid)
        if flag == "1":
            if held is None:
                remembered[mid] = day
            elif held != day:
                flag = "0"
        elif (held is not None) if mode == "as_written" else (held is None):
            remembered[mid] = day - 1
        out[seq] = flag
    return out


def visits(seed, n=600, devices=12):
    rng = random.Random(seed)
    return [(f"m{int(rng.random() ** 2 * devices)}", rng.randrange(0, 6 * DAY, 3_600_000), i, rng.choice(["1", "1", "0", None]))
            for i in range(n)]


@pytest.mark.parametrize("hot_rows", [10**9, 40])
@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_record_by_record_walk(spark, seed, mode, hot_rows):
    records = visits(seed)
    logs = spark.createDataFrame(records, "mid string, ts long, seq long, is_new string")
    fixed = repair_visitors(logs, ("ts", "seq"), mode, hot_rows=hot_rows)
    assert fixed.columns == logs.columns
    assert {r.seq: r.is_new for r in fixed.collect()} == _walk(records, mode)


def test_repair_arguments(spark):
    logs = spark.createDataFrame([("a", 1, "1")], "mid string, ts long, is_new string")
    with pytest.raises(ValueError):
        repair_visitors(logs, mode="other")
    with pytest.raises(ValueError):
        repair_visitors(logs, order=("mid", "ts"))


def test_events_of_a_task_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "EVENTS_A_TASK", 50)
    spark.range(2000).selectExpr("id AS event_id", "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value",
                                 "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(300).selectExpr("id AS p_partkey", "concat('p', id) AS p_name").write.parquet(f"{tmp_path}/part.parquet")
    for feed in (I.app_log, I.search_log, I.change_log):
        sizes = feed(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert sum(n for _, n in sizes) == 2000 and max(n for _, n in sizes) <= 60
