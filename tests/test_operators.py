from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import gram
from tidemill.operators import metrics as M
from tidemill.operators import models
from tidemill.operators import premiums as R
from tidemill.operators import profile as P
from tidemill.operators import quantiles as Q
from tidemill.operators import resample as S
from tidemill.operators import stats as A
from tidemill.operators.neighbors import nearest_positions, positions
from tidemill.operators.quantiles import exact_quantiles
from tidemill.operators.skew import fits_broadcast, join_lookup, join_state
from tidemill.sinks.writers import routed_files


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_join_state_with_hot_keys(spark, hot_rows):
    facts = spark.range(600).select((F.pow(F.col("id") % 30, F.lit(2)) % 7).cast("int").alias("k"), "id")
    state = facts.where("k <> 4").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    joined = {(r.id, r.k, r.top) for r in join_state(facts, state, "k", "n", hot_rows).collect()}
    tops = {r.k: r.top for r in state.collect()}
    assert joined == {(r.id, r.k, tops.get(r.k)) for r in facts.collect()}


def test_join_state_spreads_a_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), "id")
        state = facts.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
        joined = join_state(facts, state, "k", "n", hot_rows=500).withColumn("task", F.spark_partition_id())
        sizes = joined.where("k = 0").groupBy("task").agg(F.count("*").alias("n")).collect()
        assert len(sizes) > 2 and max(r.n for r in sizes) < 500
        assert joined.where("k = 0 AND top = 899").count() == 900
        copies = facts.select("k").repartition(8)
        spread = join_state(copies, state, "k", "n", hot_rows=500).withColumn("task", F.spark_partition_id())
        assert spread.where("k = 0 AND top = 899").select("task").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("rows", [1, 1000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_lookup_small_and_big(spark, rows, how):
    facts = spark.range(200).select((F.col("id") % 5).alias("k"), "id")
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (9, "z")], "k long, name string")
    joined = join_lookup(facts, lookup, "k", how, rows=rows, hot_rows=30)
    names = {0: "a", 1: "b", 2: "c"}
    expected = {(i, names.get(i % 5)) for i in range(200) if how == "left" or i % 5 in names}
    assert {(r.id, r.name) for r in joined.collect()} == expected
    assert fits_broadcast(lookup, rows) == (rows >= 4)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_lookup_spreads_absent_and_null_hot_keys(spark, how):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        key = F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 5)
        facts = spark.range(1200).select(key.cast("long").alias("k"), "id")
        lookup = spark.createDataFrame([(0, "a"), (1, "b"), (9, "z")], "k long, name string")
        joined = join_lookup(facts, lookup, "k", how, rows=1, hot_rows=300)
        names = {0: "a", 1: "b"}
        known = {r.id: names.get(r.k) for r in facts.collect() if how == "left" or r.k in names}
        assert {r.id: r.name for r in joined.collect()} == known
        if how == "left":
            tasks = joined.groupBy("k", F.spark_partition_id().alias("task")).count()
            hot = tasks.where("k is null or k = 77").groupBy("k").agg(F.max("count").alias("most")).collect()
            assert len(hot) == 2 and all(r.most < 200 for r in hot)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_predict_keeps_rows_with_missing_features(spark):
    train = spark.createDataFrame([(float(i), int(i > 20)) for i in range(40)], "x double, y int")
    model = models.fit_tree(train, ["x"], "y")
    asked = spark.createDataFrame([(1, 3.0), (2, None), (3, float("nan")), (4, 30.0)], "id int, x double")
    assert {r.id: r.prediction for r in models.predict(model, asked).collect()} == {1: 0, 2: None, 3: None, 4: 1}
    with pytest.raises(Exception):
        models.fit_tree(train.union(spark.createDataFrame([(None, 1)], "x double, y int")), ["x"], "y")


def test_balancing_refuses_one_row_and_chunks_many_copies(spark):
    frame = spark.createDataFrame([(i, float(i), int(i == 0)) for i in range(9)], "id long, x double, y int")
    with pytest.raises(ValueError):
        S.oversample(frame, "id", ["x"], "y")
    many = spark.range(3000).select("id", F.col("id").cast("double").alias("x"), (F.col("id") < 2).cast("int").alias("y"))
    whole, cut = (S.synthetic_rows(many, "id", ["x"], "y", chunk=c) for c in (10_000, 100))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))
    assert whole.count() == 2996 and whole.select("base", "copy").distinct().count() == 2996


def test_rules_of_fitted_trees(spark, tmp_path):
    draw = random.Random(11)
    rows = []
    for k in range(600):
        x, y, z = draw.random(), draw.choice([0.25, 0.5, 1.0]), draw.randrange(5)
        rows.append((k, x, y, z, int(x * y > 0.2 or (z == 3 and draw.random() < 0.7))))
    rows += [(900, None, 0.5, 1, 0), (901, float("nan"), 0.5, 1, 0), (902, 0.5, 0.5, None, 1)]
    frame = spark.createDataFrame(rows, "id int, x double, `y` double, z int, label int")
    train = frame.where("id < 400")
    frame.write.parquet(str(tmp_path / "rows"))
    for model in (models.fit_boosted(train, ["x", "y", "z"], "label", rounds=4, depth=3), models.fit_tree(train, ["x", "y", "z"], "label", depth=5)):
        rules = models.tree_rules(model)
        expected = {r.id: r.prediction for r in models.predict(model, frame).collect()}
        assert {r.id: r.p for r in frame.select("id", rules.column().alias("p")).collect()} == expected
        found = duckdb.sql(f"SELECT id, {rules.sql()} FROM read_parquet('{tmp_path}/rows/*.parquet')").fetchall()
        assert dict(found) == expected
        assert sum(p is None for p in expected.values()) == 3
        assert set(expected.values()) == {0, 1, None}


def _plain_bootstrap(rows, draws):
    import hashlib
    cuts, groups = A.POISSON_CUTS, {}
    for group, value, key in rows:
        if value is None:
            continue
        for d in range(draws):
            digest = hashlib.md5(f"42:{key}:{d // 8}".encode()).hexdigest()
            weight = sum(int(digest[4 * (d % 8):4 * (d % 8) + 4], 16) >= c for c in cuts)
            sums = groups.setdefault(group, {}).setdefault(d, [0, 0.0])
            sums[0] += weight
            sums[1] += weight * value
    return {g: np.percentile([s / n for n, s in by.values() if n], [2.5, 97.5]) for g, by in groups.items()}


def test_bootstrap_interval(spark):
    draw = random.Random(12)
    rows = [(draw.choice(["a", "b", None]), draw.choice([0.0, 1.0, 2.5, None]), k) for k in range(300)]
    frame = spark.createDataFrame(rows, "g string, v double, id int").repartition(3)
    found = A.group_mean_bootstrap(frame, ["g"], "v", ["id"], draws=20).collect()
    expected = _plain_bootstrap(rows, 20)
    assert {r.g for r in found} == set(expected)
    for r in found:
        assert (r.low, r.high) == pytest.approx(tuple(expected[r.g]), rel=1e-12)
        assert r.low < r["mean"] < r.high and r.n == sum(g == r.g and v is not None for g, v, _ in rows)
    assert A.group_mean_bootstrap(frame.limit(0), ["g"], "v", ["id"]).collect() == []


@pytest.mark.parametrize("block", [2, 64])
def test_wide_correlations(spark, block):
    rng = np.random.default_rng(13)
    values = rng.normal(1e6, 1, (500, 5)) + np.outer(rng.normal(size=500), [1, -1, 0, 2, 0])
    values[rng.random((500, 5)) < 0.1] = np.nan
    values[:, 4] = 3.0
    rows = [tuple(None if np.isnan(x) and i % 2 else float(x) for x in row) for i, row in enumerate(values)]
    frame = spark.createDataFrame(rows, "a double, b double, `c c` double, d double, e double").repartition(70)
    found = {(r.a, r.b): (r.n, r["corr"]) for r in gram.corr_matrix_wide(frame, frame.columns, block).collect()}
    assert len(found) == 25
    for i, a in enumerate(frame.columns):
        for j, b in enumerate(frame.columns):
            both = ~np.isnan(values[:, i]) & ~np.isnan(values[:, j])
            n, corr = found[a, b]
            assert n == both.sum()
            if "e" in (a, b):
                assert corr is None
            else:
                assert corr == pytest.approx(np.corrcoef(values[both, i], values[both, j])[0, 1], abs=1e-9)


@pytest.mark.parametrize("accuracy", [50, 400, 50_000])
@pytest.mark.parametrize("shape", ["uniform", "heavy", "tail"])
def test_exact_quantiles(spark, accuracy, shape):
    rng = np.random.default_rng(5)
    values = {"uniform": rng.random(9000), "heavy": np.where(rng.random(9000) < 0.4, 7.0, rng.integers(0, 50, 9000)),
              "tail": np.exp(rng.normal(0, 4, 9000))}[shape]
    frame = spark.createDataFrame([(float(v), i % 3) for i, v in enumerate(values)] + [(None, 0), (float("nan"), 1)],
                                  "v double, g int").repartition(7)
    points = [0.0, 0.013, 0.25, 0.5, 0.75, 1.0]
    got = {r.probability: r.value for r in exact_quantiles(frame, ["v"], points, accuracy=accuracy).collect()}
    for p in points:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)
    grouped = exact_quantiles(frame, ["v"], [0.5], ["g"], accuracy)
    for r in grouped.collect():
        assert r.value == pytest.approx(float(np.median(values[r.g::3])), rel=1e-12)


def test_quantiles_of_groups_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(Q, "fits_broadcast", lambda state: False)
    values = np.random.default_rng(6).integers(0, 40, 3000).astype(float)
    frame = spark.createDataFrame([(float(v), i % 7) for i, v in enumerate(values)], "v double, g int")
    for r in exact_quantiles(frame, ["v"], [0.5], ["g"], accuracy=50).collect():
        assert r.value == float(np.median(values[r.g::7]))


def test_quantiles_of_tiny_groups(spark):
    frame = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (4.0, "b")], "v double, g string")
    assert {r.g: r.value for r in exact_quantiles(frame, ["v"], [0.25], ["g"]).collect()} == {"a": 1.0, "b": 3.25}
    assert exact_quantiles(frame.limit(0), ["v"], [0.5]).collect() == []


def test_quantile_window_sees_only_the_bracket(spark, monkeypatch):
    seen = []
    ranges = Q._only_ranges
    monkeypatch.setattr(Q, "RANGE_ROWS", 100)
    monkeypatch.setattr(Q, "RANGES", 16)
    monkeypatch.setattr(Q, "_only_ranges", lambda counted, groups: seen.append((counted.count(), (kept := ranges(counted, groups)).count())) or kept)
    frame = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    got = exact_quantiles(frame, ["v"], [0.5], accuracy=1000).first()
    assert got.value == pytest.approx(float(np.median([r.v for r in frame.collect()])), rel=1e-12)
    (bracket, left), = seen
    assert bracket < 0.01 * 200_000 and left < 0.2 * bracket


@pytest.mark.parametrize("shape", ["uniform", "heavy", "tail"])
def test_ranges_of_brackets(spark, monkeypatch, shape):
    monkeypatch.setattr(Q, "RANGE_ROWS", 20)
    monkeypatch.setattr(Q, "RANGES", 8)
    rng = np.random.default_rng(7)
    values = {"uniform": rng.random(4000), "heavy": np.where(rng.random(4000) < 0.4, 7.0, rng.integers(0, 60, 4000)),
              "tail": np.exp(rng.normal(0, 4, 4000))}[shape]
    frame = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)], "v double, g int").repartition(3)
    points = [0.0, 0.013, 0.5, 0.75, 1.0]
    for r in exact_quantiles(frame, ["v"], points, ["g"], 50).collect():
        assert r.value == pytest.approx(float(np.quantile(values[r.g::2], r.probability)), rel=1e-12)


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    monkeypatch.setattr(Q, "MARGIN", 1e-3)
    turns, brackets = [], Q._brackets
    monkeypatch.setattr(Q, "_brackets", lambda *a: turns.append(a[4]) or brackets(*a))
    values = np.random.default_rng(8).random(3000)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    points = [0.1, 0.5, 0.9]
    got = exact_quantiles(frame, ["v"], points, accuracy=20).collect()
    assert {r.probability: r.value for r in got} == {p: pytest.approx(float(np.quantile(values, p)), rel=1e-12) for p in points}
    assert len(turns) > 1


def _near(points, k):
    def d2(p, q):  # plain additions; sum() would compensate rounding
        total = 0.0
        for a, b in zip(p, q):
            total += (a - b) * (a - b)
        return total

    out = {}
    for i, p in points.items():
        others = sorted((d2(p, q), j) for j, q in points.items() if j != i)
        out[i] = others[:k]
    return out


@pytest.mark.parametrize("box_points", [15, 1000])
def test_nearest_positions_equal_brute_force(spark, box_points):
    rng = random.Random(11)
    points = {i: (rng.gauss(0, 1) ** 3, float(rng.randrange(8)), rng.random()) for i in range(400)}
    points = {min(j for j, q in points.items() if q == p): p for p in points.values()}
    points |= {1000 + i: (50.0 + i, 500.0, 0.0) for i in range(3)}
    rows = spark.createDataFrame([(i, *p) for i, p in points.items()], "id long, a double, b double, c double")
    found = nearest_positions(positions(rows, "id", ["a", "b", "c"], 5), 5, box_points).collect()
    got = {}
    for r in found:
        got.setdefault(r.pos, []).append((r.d2, r.near))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in _near(points, 5).items()}


def _balanced(spark, box_points, copies):
    rng = random.Random(4)
    rows = [(i, rng.random() * 9, float(rng.randrange(5)), 0) for i in range(500)]
    rows += [(500 + i, 3.0, 2.0, 1) for i in range(copies)] + [(800 + i, rng.random() * 9, rng.random(), 1) for i in range(60)]
    frame = spark.createDataFrame(rows, "id long, a double, b double, y int")
    return rows, S.synthetic_rows(frame, "id", ["a", "b"], "y", box_points=box_points)


@pytest.mark.parametrize("copies", [0, 40])
def test_synthetic_rows_lie_between_neighbours(spark, copies):
    rows, made = _balanced(spark, 10, copies)
    rare = {r[0]: r[1:3] for r in rows if r[3] == 1}
    near = _near(rare, 5)
    out = made.collect()
    assert len(out) == 500 - len(rare)
    for r in out:
        x = rare[r.base]
        assert any(all(min(p, q) - 1e-9 <= v <= max(p, q) + 1e-9 for p, q, v in zip(x, rare[j], (r.a, r.b)))
                   for _, j in near[r.base]), r
    turns = [sum(o.base == i for o in out) for i in rare]
    assert max(turns) - min(turns) <= 1


def test_synthetic_rows_do_not_depend_on_the_boxes(spark):
    few, many = (sorted(map(tuple, _balanced(spark, n, 40)[1].collect())) for n in (10, 10_000))
    assert few == many


def test_oversample_balances(spark):
    rows = [(i, float(i), i % 4 == 0) for i in range(40)]
    frame = spark.createDataFrame([(i, x, int(y)) for i, x, y in rows], "id long, x double, y int")
    assert {r.y: r.n for r in S.class_counts(S.oversample(frame, "id", ["x"], "y"), "y").collect()} == {0: 30, 1: 30}
    with pytest.raises(ValueError):
        S.synthetic_rows(frame.where("y = 1"), "id", ["x"], "y")


def test_split_is_stable_and_a_fifth(spark):
    frame = spark.range(5000)
    first = {r.id for r in S.train_test_split(frame, "id")[1].collect()}
    train, test = S.train_test_split(frame.repartition(7), "id")
    assert {r.id for r in test.collect()} == first and train.count() + len(first) == 5000
    assert 850 < len(first) < 1150


def test_metrics_without_positives(spark):
    frame = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    assert M.classification_metrics(frame, "y", "p").first().asDict() == {
        "accuracy": 1.0, "recall": 0.0, "precision": 0.0, "f1": 0.0}
    assert [(r.actual, r.predicted, r.n) for r in M.confusion_matrix(frame, "y", "p").collect()] == [
        (1, 1, 0), (1, 0, 0), (0, 1, 0), (0, 0, 2)]


def test_premium_ratio(spark):
    frame = spark.createDataFrame([(100.0, 40.0, 200.0, 100.0), (10.0, 0.0, 0.0, 0.0)],
                                  "gross double, ceded double, closing double, opening double")
    rows = R.retained_premium_ratio(frame, "gross", "ceded", "closing").collect()
    assert [tuple(r) for r in rows] == [(60.0, 200.0, 30.0), (10.0, 0.0, None)]
    assert R.retained_premium_ratio(frame, "gross", "ceded", "closing", "opening").first()["average_equity"] == 150.0


def test_positions_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGE_ROWS", 20)
    values = random.Random(2).sample(range(10_000), 501)
    frame = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)
    assert [(r.v, r.position) for r in R.with_position(frame, "v").orderBy("v").collect()] == [
        (v, i) for i, v in enumerate(sorted(values))]
    bound = R.bind_by_position([frame, frame.limit(3).select(F.col("v").alias("w"))], ["v", "w"])
    assert bound.count() == 501 and bound.where("w IS NOT NULL").count() == 3


def test_encoding_and_profiles(spark):
    frame = spark.createDataFrame([("Male", 1.0, "b"), ("Female", None, "a"), ("?", 3.0, None)], "g string, v double, t string")
    assert [r.g for r in P.encode_categories(frame, "g", P.GENDER_CODES).collect()] == [0, 1, None]
    assert {r.column: r.nulls for r in P.null_counts(frame).collect()} == {"g": 0, "v": 1, "t": 1}
    assert {(r.column, r.dtype, r.non_null) for r in P.frame_info(frame).collect()} == {
        ("g", "string", 3), ("v", "double", 2), ("t", "string", 2)}
    assert [tuple(r) for r in P.describe_object(frame, ["t"]).collect()] == [("t", 2, 2, "a", 1)]
    assert P.numeric_columns(frame) == ["v"] and P.text_columns(frame) == ["g", "t"]
    assert sorted((r.column, r.value or "-") for r in P.distinct_values(frame, ["t"]).collect()) == [
        ("t", "-"), ("t", "a"), ("t", "b")]


def test_outliers(spark):
    values = [1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 100.0, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    assert [r.id for r in P.iqr_remove(frame, ["v"]).orderBy("id").collect()] == [0, 1, 2, 3, 4, 5]
    assert [(r.id, r.value) for r in P.iqr_outliers(frame, ["v"], ["id"]).collect()] == [(6, 100.0)]
    box = P.box_stats(frame, ["v"]).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.fliers) == (2.0, 3.0, 3.5, 1.0, 4.0, 1)


def test_routed_files_replace_a_repeated_batch(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "tag string, v int")
    for batch in (0, 1, 1):
        routed_files(frame, str(tmp_path / "out"), "tag", batch)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.tag, r.v, r.batch) for r in rows.collect()) == [("a", 1, 0), ("a", 1, 1), ("b", 2, 0), ("b", 2, 1)]


def test_crosstab_forms(spark):
    frame = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("b", 0), (None, 1)], "k string, y int")
    def table(**how):
        return {r.k: (r["0"], r["1"]) for r in A.crosstab(frame, "k", "y", [0, 1], **how).collect()}
    assert table() == {"a": (1, 2), "b": (1, 0)}
    assert table(normalize="index") == {"a": (1 / 3, 2 / 3), "b": (1.0, 0.0)}
    assert table(normalize="columns") == {"a": (0.5, 1.0), "b": (0.5, 0.0)}
    with pytest.raises(ValueError):
        table(normalize="all")
    more = frame.union(spark.createDataFrame([("b", 2), ("c", 2), ("c", None)], "k string, y int"))
    cells = {(r.k, r.value): r.n for r in A.crosstab(more, "k", "y").collect()}
    assert cells == {("a", 0): 1, ("a", 1): 2, ("b", 0): 1, ("b", 2): 1, ("c", 2): 1}
    shares = {(r.k, r.value): r.share for r in A.crosstab(more, "k", "y", normalize="columns").collect()}
    assert shares == {("a", 0): 0.5, ("a", 1): 1.0, ("b", 0): 0.5, ("b", 2): 0.5, ("c", 2): 0.5}
    listed = {r.k: (r["0"], r["1"]) for r in A.crosstab(more, "k", "y", [0, 1], "index").collect()}
    assert listed == {"a": (1 / 3, 2 / 3), "b": (0.5, 0.0), "c": (0.0, 0.0)}  # value 2 counts in the rows' totals
    assert [r.value for r in A.value_counts(frame, "k").collect()] == ["a", "b"]
    assert [(r.value, r.share) for r in A.value_shares(frame, "k").collect()] == [("a", 0.75), ("b", 0.25)]


def test_bootstrap_makes_no_row_for_each_draw(spark):
    frame = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2)], "g string, v double, id int")
    plan = A.group_mean_bootstrap(frame, ["g"], "v", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    # Draws are opened behind the sums of a batch, and the frame is read once.
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("MapInArrow") and "Join" not in plan


def test_bootstrap_of_several_columns(spark):
    rows = [("a", 1, 1.0, 1), ("a", None, 2.0, 2), (None, 1, 4.0, 3), (None, None, 8.0, 4), ("a", 1, float("inf"), 5), ("a", 1, 3.0, 1)] * 400
    frame = spark.createDataFrame(rows, "g string, h int, v double, id int")
    found = {(r.g, r.h): r for r in A.group_mean_bootstrap(frame, ["g", "h"], "v", ["id"], draws=20).collect()}
    expected = _plain_bootstrap([((g, h), v, k) for g, h, v, k in rows], 20)
    assert set(found) == set(expected)
    for by, r in found.items():
        assert r.n == sum((g, h) == by for g, h, _, _ in rows)
        if by != ("a", 1):
            assert (r.low, r.high) == pytest.approx(tuple(expected[by]), rel=1e-12) and r.low == r.high == r["mean"]
    assert found["a", 1].high == float("inf") and found["a", 1].low < 4
