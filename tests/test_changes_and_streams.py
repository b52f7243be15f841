from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from test_logs import _walk, visits
from tidemill.operators import changes as C
from tidemill.operators.visitors import MODES
from tidemill.sinks import writers as W
from tidemill.sinks.dimensions import DimensionFiles
from tidemill.sources import catalog, readers
from tidemill.streaming import jobs
from tidemill.streaming.visitors import repair_visitor_stream


def _log(spark, changes):
    rows = []
    for i, (op, ts, key, name) in enumerate(changes):
        image = {"id": key, "name": name, "secret": 1}
        rows.append((json.dumps({"before": image if op == "d" else None, "after": None if op == "d" else image, "op": op,
                                 "ts_ms": ts, "source": {"db": "shop", "table": "user" if key < 10 else "item", "pos": i},
                                 "transaction": None}),))
    return spark.createDataFrame(rows, "value string")


CHANGES = [("r", 0, 1, "a"), ("c", 1, 2, "b"), ("u", 2, 1, "c"), ("d", 2, 2, "b"), ("c", 3, 11, "i"), ("u", 3, 1, "z"), ("u", 3, 1, "y")]


def test_strict_parse_fails_on_a_bad_line(spark):
    bad = spark.createDataFrame([("{oops",)], "value string")
    with pytest.raises(Exception):
        C.read_changes(bad).collect()
    assert C.read_changes(bad, strict=False).first()["op"] is None


def test_clean_keeps_one_image(spark):
    rows = C.clean_changes(C.read_changes(_log(spark, CHANGES))).collect()
    assert rows[0].__fields__ == ["before", "after", "op"]
    assert all((r.before is not None) == (r.op == "d") and (r.after is None) == (r.op == "d") for r in rows)


def test_latest_images_break_ties_by_position(spark):
    changes = C.read_changes(_log(spark, CHANGES)).withColumn("position", C.source_position()).withColumn("image", C.image())
    rows = changes.select("op", "ts_ms", "position", F.get_json_object("image", "$.id").alias("id"),
                          F.get_json_object("image", "$.name").alias("name"))
    last = C.latest_images(rows, "id", ["ts_ms", "position"], ["name"])
    assert {r.id: r.name for r in last.collect()} == {"1": "y", "11": "i"}
    lost = rows.withColumn("id", F.lit(None).cast("string"))
    assert C.latest_images(lost, "id", ["ts_ms", "position"], ["name"]).count() == 0
    assert C.unkeyed_changes(lost, "id").count() == rows.count()


def _config(spark, rows):
    out = []
    for i, (op, source, sink, columns) in enumerate(rows):
        image = {"source_table": source, "sink_table": sink, "sink_columns": columns, "row_key": "id"}
        out.append((json.dumps({"before": image if op == "d" else None, "after": None if op == "d" else image, "op": op,
                                "ts_ms": 5, "source": {"table": "conf", "pos": i}}),))
    return spark.createDataFrame(out, "value string")


def test_routing_and_configuration(spark):
    log = _config(spark, [("r", "user", "dim_u", "id"), ("u", "user", "dim_user", "id, name"), ("c", "item", "dim_item", "id"),
                          ("d", "item", "dim_item", "id")])
    state = C.config_state(log)
    assert [(r.source_table, r.sink_table) for r in state.collect()] == [("user", "dim_user")]
    routed = C.route_changes(C.read_changes(_log(spark, CHANGES)), state).collect()
    assert len(routed) == 6 and {r.sink_table for r in routed} == {"dim_user"}
    assert json.loads(routed[0].payload) == {"id": 1, "name": "a"} and routed[0].row_key == "1"
    spark.sql("CREATE DATABASE IF NOT EXISTS tide_conf")
    try:
        C.apply_table_config(spark, C.config_images(log.limit(3)), "tide_conf")
        assert {r.tableName for r in catalog.show_tables(spark, "tide_conf").collect()} == {"dim_user", "dim_item"}
        C.apply_table_config(spark, C.config_images(log), "tide_conf")
        assert {r.tableName for r in catalog.show_tables(spark, "tide_conf").collect()} == {"dim_user"}
    finally:
        spark.sql("DROP DATABASE tide_conf CASCADE")


def test_change_source_selects(spark):
    changes = C.read_changes(_log(spark, CHANGES))
    snapshot = readers.snapshot_changes(spark.createDataFrame([(7, "s")], "id int, name string"), "shop", "user")
    assert readers.change_source(changes, snapshot).count() == 8
    assert readers.change_source(changes, snapshot, tables=["shop.item"]).count() == 1
    assert readers.change_source(changes, snapshot, databases=["other"]).count() == 0
    assert readers.change_source(changes, snapshot).where("op = 'r' AND ts_ms = 0 AND after LIKE '%7%'").count() == 1


def test_dimension_files_repeat_and_fold(spark, tmp_path):
    files = DimensionFiles(spark, str(tmp_path / "dim"), "id", ["ts"], ["name"])
    with pytest.raises(FileNotFoundError):
        files.current()
    schema = "op string, id int, name string, ts long"
    batches = [[("c", 1, "a", 1), ("c", 2, "b", 2)], [("u", 1, "c", 3), ("d", 2, "b", 4)], [("c", 2, "again", 5), ("u", 1, "late", 0)]]
    def rows():
        return {r.id: r.name for r in files.current().collect()}
    files.upsert(spark.createDataFrame(batches[0], schema), 0)
    files.upsert(spark.createDataFrame(batches[1], schema), 1)
    files.upsert(spark.createDataFrame(batches[1], schema), 1)
    assert rows() == {1: "c"}
    assert files.compact() == 1 and files.compact() == 1
    assert rows() == {1: "c"}
    files.upsert(spark.createDataFrame(batches[2], schema), 2)
    assert rows() == {1: "c", 2: "again"}
    assert files.compact() == 2 and rows() == {1: "c", 2: "again"}


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "tag string, value string")
    assert sorted(map(tuple, W.routed_records(frame, "tag", topics={"a": "ta", "b": "tb"}).collect())) == [
        ("ta", "1"), ("ta", "3"), ("tb", "2")]
    assert W.as_lines(frame.limit(1)).first()["value"] == '{"tag":"a","value":"1"}'
    W.tagged_batches(str(tmp_path / "t"))(frame, 0)
    W.tagged_batches(str(tmp_path / "t"))(frame, 0)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    got = {}
    W.fan_out({t: lambda part, n, t=t: got.update({t: sorted(r.value for r in part.collect())}) for t in "ab"})(frame, 0)
    assert got == {"a": ["1", "3"], "b": ["2"]}
    with pytest.raises(Exception, match="(?i)kafka"):
        W.kafka_sink(frame.select("value"), "localhost:1", "topic")


def test_failing_json_write_is_retried_then_raised(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception):
        W.json_batches(str(tmp_path / "file"), retries=1)(spark.range(1), 0)


def _write_in_order(spark, folder, batches):
    """One text file per batch, written one after the other so that the stream reads them in this order."""
    folder.mkdir()
    for i, lines in enumerate(batches):
        (folder / f"{i:03d}.txt").write_text("\n".join(lines) + "\n")
        stamp = 1_700_000_000 + i
        os.utime(folder / f"{i:03d}.txt", (stamp, stamp))
    return readers.file_lines(spark, str(folder), streaming=True, files_per_trigger=1)


@pytest.mark.parametrize("mode", MODES)
def test_visitor_stream_equals_walk_and_restarts(spark, tmp_path, mode):
    jobs.use_rocksdb(spark)
    records = sorted(visits(8, n=240, devices=5), key=lambda r: (r[1], r[2]))
    lines = [json.dumps({"mid": m, "ts": t, "seq": s, "is_new": n}) for m, t, s, n in records]
    batches = [lines[:100], lines[100:130], lines[130:]]
    parse = F.from_json("value", "mid string, ts long, seq long, is_new string").alias("r")

    def run(upto):
        source = readers.file_lines(spark, str(tmp_path / "in"), streaming=True, files_per_trigger=1)
        fixed = repair_visitor_stream(source.select(parse).select("r.*"), ("ts", "seq"), mode)
        query = (fixed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start())
        query.awaitTermination()

    _write_in_order(spark, tmp_path / "in", batches[:2])
    run(2)
    (tmp_path / "in" / "900.txt").write_text("\n".join(batches[2]) + "\n")
    run(3)
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(out) == 240
    assert {r.seq: r.is_new for r in out} == _walk(records, mode)


def test_keyword_stream_windows_and_late_rows(spark, tmp_path):
    def line(minute, item="red ring"):
        page = {"item": item, "item_type": "keyword", "last_page_id": "search"}
        return json.dumps({"common": {"mid": "a"}, "page": page, "ts": minute * 60_000})
    source = _write_in_order(spark, tmp_path / "in", [[line(1), line(2)], [line(12, "red")], [line(25)], [line(26), line(3, "late")]])
    jobs.keyword_job(source, str(tmp_path / "out"), str(tmp_path / "check"), until_done=True).start().awaitTermination()
    rows = {(r.stt[-8:], r.keyword): r.keyword_count for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # The window that is still open at the end stays inside, and a row two batches behind the watermark is dropped.
    # (One batch behind it would still count: Spark moves the watermark between batches only.)
    assert rows == {("08:00:00", "red"): 2, ("08:00:00", "ring"): 2, ("08:10:00", "red"): 1}


def test_log_and_route_jobs(spark, tmp_path):
    jobs.use_rocksdb(spark)
    record = {"common": {"mid": "a", "is_new": "1"}, "page": {"item": "x"}, "displays": [{"pos": 1}], "ts": 5}
    source = _write_in_order(spark, tmp_path / "logs", [[json.dumps(record), "{bad"], [json.dumps(record | {"ts": 90_000_000})]])
    jobs.log_split_job(source, str(tmp_path / "c1"), str(tmp_path / "split"), until_done=True).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "split"))
    assert {(r.tag, json.loads(r.value)["common"]["is_new"]) for r in rows.collect()} == {
        ("page", "1"), ("display", "1"), ("page", "0"), ("display", "0")}
    again = readers.file_lines(spark, str(tmp_path / "logs"), streaming=True)
    jobs.dirty_log_job(again, str(tmp_path / "dirty"), str(tmp_path / "c2"), until_done=True).start().awaitTermination()
    assert [r.value for r in spark.read.parquet(str(tmp_path / "dirty")).collect()] == ["{bad"]

    changes = _write_in_order(spark, tmp_path / "changes", [[r.value for r in _log(spark, CHANGES).collect()]])
    config = _config(spark, [("c", "user", "dim_user", "id,name")])
    jobs.route_job(changes, lambda: config, str(tmp_path / "c3"), W.tagged_batches(str(tmp_path / "routed"), "sink_table"),
                   until_done=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "routed")).groupBy("sink_table").count().collect()[0]["count"] == 6
