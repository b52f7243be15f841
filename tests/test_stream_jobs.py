"""Jobs over several micro-batches: routing with early changes, snapshot hand-over, visitor days, late rows, open windows."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from test_logs import _walk, visits
from tidemill.operators import changes as C
from tidemill.operators.visitors import MODES
from tidemill.sinks import writers as W
from tidemill.sinks.dimensions import DimensionFiles
from tidemill.sources.handover import SnapshotFiles, chunk_of, snapshot_then_changes
from tidemill.streaming.lateness import LateStore, earlier_maximum, mark_late
from tidemill.streaming.routing import RouteStore, routed_feed
from tidemill.streaming.visitor_days import VisitorDays
from tidemill.streaming.visitors import STATE_TTL_MS


def _lines(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")


def _setting(table, op="c", columns="id,name", moved_from=None, pos=0):
    row = {"source_table": table, "sink_table": f"dwd_{table}", "sink_columns": columns, "row_key": "id"}
    before = row if op == "d" else row | {"source_table": moved_from} if moved_from else None
    return {"before": before, "after": None if op == "d" else row, "op": op, "ts_ms": pos, "source": {"table": "conf", "pos": pos}}


def _change(number, table, name="x"):
    return {"before": None, "after": {"id": number, "name": name, "more": 1}, "op": "u", "ts_ms": number,
            "source": {"table": table, "pos": number}}


class _Batches:
    """Keeps what a batch writer gets, by batch; a repeated batch replaces itself."""

    def __init__(self):
        self.got = {}

    def __call__(self, frame, number):
        self.got[number] = sorted((r.asDict() for r in frame.collect()), key=str)


def _feed(spark, settings, changes):
    empty = spark.createDataFrame([], "value string")
    return routed_feed(_lines(spark, settings) if settings else empty, _lines(spark, changes) if changes else empty)


ROUTE_STEPS = [
    ([], [_change(1, "a"), _change(2, "b"), _change(3, None)]),
    ([_setting("a")], [_change(4, "a"), _change(5, "b")]),
    ([_setting("a", "d", pos=1)], [_change(6, "a"), _change(7, "a")]),
    ([_setting("b", columns="name")], [_change(8, "b"), _change(9, "a")]),
    ([_setting("a", columns="id", pos=2)], []),
    ([_setting("a", "d", pos=3), _setting("a", pos=4)], [_change(10, "a")]),
    ([_setting("c", "u", moved_from="b", pos=5)], [_change(11, "b"), _change(12, "c")]),
]


def test_every_change_is_routed_once_or_waits(spark, tmp_path):
    sink = _Batches()
    store = RouteStore(spark, str(tmp_path / "routes"), sink, compact_every=2)
    assert store.waiting().count() == store.nameless().count() == store.configuration().count() == 0
    for number, (settings, changes) in enumerate(ROUTE_STEPS):
        for _ in range(2 if number in (1, 4) else 1):  # a repeated batch
            store(_feed(spark, settings, changes), number)
    assert {n: [r["ts_ms"] for r in rows] for n, rows in sink.got.items()} == {
        0: [], 1: [1, 4], 2: [], 3: [2, 5, 8], 4: [6, 7, 9], 5: [10], 6: [12]}
    assert json.loads(sink.got[3][0]["payload"]) == {"name": "x"}
    assert json.loads(sink.got[4][0]["payload"]) == {"id": 6}
    assert {r.ts_ms for r in store.waiting().collect()} == {11}
    assert [r.ts_ms for r in store.nameless().collect()] == [3]
    assert {r.source_table for r in store.configuration().where("live").collect()} == {"a", "c"}
    store.compact(6)
    store.compact(6)
    assert {r.ts_ms for r in store.waiting().collect()} == {11}
    store(_feed(spark, [_setting("b", pos=6)], []), 7)
    assert [r["ts_ms"] for r in sink.got[7]] == [11]
    assert store.waiting().count() == 0


def test_tables_follow_the_configuration(spark, tmp_path):
    spark.sql(f"CREATE DATABASE tide_routes LOCATION '{tmp_path / 'tables'}'")
    try:
        store = RouteStore(spark, str(tmp_path / "routes"), _Batches(), "tide_routes")
        for number, (settings, changes) in enumerate(ROUTE_STEPS):
            store(_feed(spark, settings, changes), number)
            if number == 3:
                assert {r.tableName for r in spark.sql("SHOW TABLES IN tide_routes").collect()} == {"dwd_b"}
        # b's row became c's: the same sink table has another source now.
        assert {r.tableName for r in spark.sql("SHOW TABLES IN tide_routes").collect()} >= {"dwd_a", "dwd_c"}
    finally:
        spark.sql("DROP DATABASE tide_routes CASCADE")


def _user_log(seed, n=400, users=30):
    draw = random.Random(seed)
    return [{"before": {"id": (i := draw.randrange(users)), "name": "gone"}, "after": None, "op": "d", "ts_ms": p // 3, "source": {"pos": p}}
            if draw.random() < 0.3 else
            {"before": None, "after": {"id": (i := draw.randrange(users)), "name": f"n{p}"}, "op": "u", "ts_ms": p // 3, "source": {"pos": p}}
            for p in range(n)]


def _images(frame):
    fields = frame.select("op", "ts_ms", C.source_position().alias("position"), F.get_json_object(C.image(), "$.id").alias("id"),
                          F.get_json_object(C.image(), "$.name").alias("name"))
    return {(r.id, r.name) for r in C.latest_images(fields, "id", ["ts_ms", "position"], ["name"]).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_snapshot_and_log_give_the_logs_images(spark, tmp_path, seed):
    log, draw = _user_log(seed), random.Random(seed)
    changes = C.read_changes(_lines(spark, log))
    key = F.get_json_object(C.image(), "$.id")
    placed = changes.select("op", "ts_ms", C.source_position().alias("position"), key.alias("id"),
                            F.get_json_object(C.image(), "$.name").alias("name"), chunk_of(key, 4).alias("chunk"))
    files = SnapshotFiles(spark, str(tmp_path / "snapshot"), 4)
    positions = {c: draw.randrange(100, 300) for c in range(4)}
    for chunks in ([0, 2], [1], [3]):
        assert set(files.missing()) >= set(chunks)
        with pytest.raises(ValueError, match="have not been read"):
            snapshot_then_changes(files, changes, chunk_of(key, 4))
        here = spark.createDataFrame([(c, positions[c]) for c in chunks], "chunk int, position long")
        seen = placed.join(here.withColumnRenamed("position", "upto"), "chunk").where("position <= upto")
        rows = C.latest_images(seen, "id", ["ts_ms", "position"], ["name", "chunk"])
        files.store(rows.select("id", "name", "chunk"), here, "shop", "user")
    whole = snapshot_then_changes(files, changes.where(C.source_position() >= 90), chunk_of(key, 4))
    assert _images(whole) == _images(changes)
    kept = {(r.chunk, r.position) for r in whole.where("op <> 'r'").collect()}
    assert all(p > positions[c] for c, p in kept)
    assert len(kept) == placed.collect().__len__() - sum(r.position <= positions[r.chunk] for r in placed.collect())


@pytest.mark.parametrize("mode", MODES)
def test_visitor_days_equal_the_walk(spark, tmp_path, mode):
    records = sorted(visits(8, n=300, devices=5), key=lambda r: (r[1], r[2]))
    got = _Batches()
    days = VisitorDays(spark, str(tmp_path / "days"), got, ("ts", "seq"), mode, compact_every=3, hot_rows=20)
    cuts = sorted(random.Random(2).sample(range(1, 299), 4))
    for number, (a, b) in enumerate(zip([0, *cuts], [*cuts, 300], strict=True)):
        batch = spark.createDataFrame([(m, t, s, n, "x") for m, t, s, n in records[a:b]], "mid string, ts long, seq long, is_new string, day string")
        for _ in range(2 if number in (1, 3) else 1):  # a repeated batch
            days(batch, number)
    assert {r["seq"]: r["is_new"] for rows in got.got.values() for r in rows} == _walk(records, mode)


def test_a_forgotten_day(spark, tmp_path):
    day = 86_400_000
    def run(path, ttl, pause):
        got, now = _Batches(), [1000]
        days = VisitorDays(spark, str(tmp_path / path), got, ("ts",), ttl_ms=ttl, clock=lambda: now[0], compact_every=2)
        for number in range(3):
            days(spark.createDataFrame([("a", number * day, "1")], "mid string, ts long, is_new string"), number)
            now[0] += pause
        return [got.got[n][0]["is_new"] for n in range(3)]
    assert run("kept", None, 60_000) == ["1", "0", "0"]
    assert run("short", 10_000, 60_000) == ["1", "1", "1"]
    # A refuted claim writes nothing, so the day is ten seconds old after the second batch already.
    assert run("between", 10_000, 5_000) == ["1", "0", "1"]


def test_a_stream_with_a_time_to_live(spark, tmp_path):
    from tidemill.sources import readers
    from tidemill.streaming import jobs

    def record(ts):
        return json.dumps({"common": {"mid": "a", "is_new": "1"}, "page": {"item": "x"}, "ts": ts})
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.txt").write_text(record(0) + "\n")
    got, now = _Batches(), [1000]
    days = VisitorDays(spark, str(tmp_path / "days"), got, ttl_ms=STATE_TTL_MS, clock=lambda: now[0])
    query = jobs.visitor_days_job(readers.file_lines(spark, str(tmp_path / "in"), streaming=True), days, str(tmp_path / "check")).start()
    try:
        for number, wait in enumerate((5_000, 60_000)):
            query.processAllAvailable()
            now[0] += wait
            (tmp_path / "in" / f"{number + 1}.txt").write_text(record((number + 1) * 86_400_000) + "\n")
        query.processAllAvailable()
    finally:
        query.stop()
    assert [r["is_new"] for n in sorted(got.got) for r in got.got[n]] == ["1", "0", "1"]


@pytest.mark.parametrize("stretch", [3, 50, 1000])
def test_running_maximum(spark, stretch):
    draw = random.Random(stretch)
    rows = [(k * 2, draw.randrange(1000) if draw.random() < 0.9 else None) for k in range(300)]
    frame = spark.createDataFrame(rows, "offset long, ts long").repartition(3)
    seen, expected = 17, {}
    for offset, ts in rows:
        expected[offset] = seen
        seen = max(seen, ts if ts is not None else seen)
    assert {r.offset: r.newest for r in earlier_maximum(frame, "ts", "offset", 17, stretch).collect()} == expected
    first = earlier_maximum(frame, "ts", "offset", None, stretch).where("offset = 0").first()
    assert first.newest is None


def test_late_rows_go_aside(spark, tmp_path):
    minutes = [1, 2, 12, 3, 9, 25, 11, 19, 20, 29, None]
    rows = [(k, None if m is None else m * 60_000) for k, m in enumerate(minutes)]
    frame = spark.createDataFrame(rows, "offset long, ts long")
    assert {r.offset for r in mark_late(frame).where("late").collect()} == {3, 4, 6, 7}
    kept, late = _Batches(), _Batches()
    store = LateStore(spark, str(tmp_path / "late"), kept, late)
    for number, (a, b) in enumerate([(0, 3), (3, 4), (4, 8), (8, 11)]):
        for _ in range(2 if number == 2 else 1):
            store(frame.where(F.col("offset").between(a, b - 1)), number)
    assert {r["offset"] for rows in late.got.values() for r in rows} == {3, 4, 6, 7}
    assert sum(map(len, kept.got.values())) + sum(map(len, late.got.values())) == len(rows)


def test_dimension_files_compact_themselves(spark, tmp_path):
    files = DimensionFiles(spark, str(tmp_path / "dim"), "id", ["ts"], ["name"], compact_every=2)
    for number in range(7):
        batch = spark.createDataFrame([("u", number % 3, f"n{number}", number), ("d" if number == 4 else "u", 9, "x", number)],
                                      "op string, id int, name string, ts long")
        for _ in range(2 if number in (2, 5) else 1):
            files.upsert(batch, number)
    assert {r.id: r.name for r in files.current().collect()} == {0: "n6", 1: "n4", 2: "n5", 9: "x"}
    assert W.complete_batches(spark, str(tmp_path / "dim/base")) == [3, 5]
    assert W.complete_batches(spark, str(tmp_path / "dim/delta")) == [4, 5, 6]


def test_batch_folders(spark, tmp_path):
    for number in (0, 3, 11):
        spark.range(1).write.parquet(W.batch_folder(str(tmp_path), number))
    (tmp_path / "batch=4").mkdir()
    assert W.complete_batches(spark, str(tmp_path)) == [0, 3, 11]
    W.remove_batches(spark, str(tmp_path), 3)
    assert W.complete_batches(spark, str(tmp_path)) == [11]
    assert W.complete_batches(spark, str(tmp_path / "none")) == []
