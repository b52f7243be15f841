from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.functions import dates as D
from tidemill.functions import text as X


def _one(spark, text, expression):
    return spark.createDataFrame([(text,)], "s string").select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize("text, expected", [("abbc", 2), ("abbcaaad", 3), ("pwke", 0), ("", 0), ("a", 0), (None, None),
                                            ("a\n\n\nb", 3), ("x😀😀", 2)])
def test_longest_run(spark, text, expected):
    assert _one(spark, text, X.longest_run("s")) == expected


@pytest.mark.parametrize("text, expected", [("abbc", 2), ("abbcaaad", 3), ("pwke", 1), ("", 0), ("a", 1), (None, None)])
def test_longest_run_min1(spark, text, expected):
    assert _one(spark, text, X.longest_run("s", zero_without_repeat=False)) == expected


@pytest.mark.parametrize("text, expected", [("abcabcbb", 3), ("bbbbb", 1), ("pwwkew", 3), ("", 0), (None, None),
                                            ("😀a😀b", 3)])
def test_longest_distinct_span(spark, text, expected):
    assert _one(spark, text, X.longest_distinct_span("s")) == expected


def test_longest_distinct_span_of_many_texts(spark, monkeypatch):
    monkeypatch.setattr(X, "_CHARS_PER_STEP", 50)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh é\n") for _ in range(rng.randrange(0, 60))) for _ in range(300)]

    def slow(s):
        return max((e - b for b in range(len(s)) for e in range(b + 1, len(s) + 1) if len(set(s[b:e])) == e - b), default=0)

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", X.longest_distinct_span("s").alias("r"))
    assert {r.i: r.r for r in rows.collect()} == {i: slow(t) for i, t in enumerate(texts)}


def test_tokens(spark):
    assert _one(spark, "Red-Ring 5G,red", X.tokens("s")) == ["red", "ring", "5g", "red"]
    assert _one(spark, "--", X.tokens("s")) == []


def test_dictionary_tokens(spark):
    cut = X.dictionary_tokens(["小米", "手机", "京东", "自营", "移动", "联通", "电信"])
    assert _one(spark, "小米手机京东自营5G移动联通电信", cut("s")) == ["小米", "手机", "京东", "自营", "5g", "移动", "联通", "电信"]
    assert _one(spark, "été 买", cut("s")) == ["été", "买"]


def test_token_function_in_sql(spark):
    X.register_tokenizer(spark)
    spark.createDataFrame([(1, "Red ring"), (2, "--")], "id int, t string").createOrReplaceTempView("said")
    rows = spark.sql("SELECT id, keyword FROM said, LATERAL ik_analyze(t) x(keyword)")
    assert sorted((r.id, r.keyword) for r in rows.collect()) == [(1, "red"), (1, "ring")]
    assert "BatchEvalPython" not in rows._jdf.queryExecution().toString()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_dates_do_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.123956' t, 1710037800123 ms, -1 early").select(
            D.millis_of_utc("t").alias("millis"), D.ts_to_date("ms").alias("date"), D.ts_to_datetime("ms").alias("clock"),
            D.ts_to_datetime("ms", "UTC").alias("utc"), D.ts_to_partition("ms").alias("part"),
            D.datetime_to_ts(D.ts_to_datetime("ms")).alias("back"), D.date_to_ts(D.ts_to_date("ms")).alias("midnight"),
            D.ts_to_datetime("early", "UTC").alias("before_epoch")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.millis == 1710037800123
    assert (row.date, row.clock, row.utc, row.part) == (
        "2024-03-10", "2024-03-10 10:30:00", "2024-03-10 02:30:00", "20240310")
    assert (row.back, row.midnight) == (1710037800000, 1710000000000)
    assert row.before_epoch == "1969-12-31 23:59:59"


def test_bad_datetime_fails(spark):
    with pytest.raises(Exception):
        spark.sql("SELECT 'soon' s").select(D.datetime_to_ts("s")).collect()


def test_literal_pattern(spark):
    assert spark.sql("SELECT TIMESTAMP'2024-01-05 00:00:00' t").select(D.window_format(F.col("t"), "2024-12-11")).first()[0] == "2024-12-11"


def _best_by_trying_all(run, words):
    """All ways to choose words; most characters, fewest words, then earlier and longer words first."""
    best, stack = None, [(0, ())]
    while stack:
        at, chosen = stack.pop()
        if at >= len(run):
            key = (sum(n for _, n in chosen), -len(chosen), tuple((-s, n) for s, n in chosen))
            best = max(best, (key, chosen)) if best else (key, chosen)
            continue
        stack.append((at + 1, chosen))
        stack += [(at + n, (*chosen, (at, n))) for n in range(1, len(run) - at + 1) if run[at:at + n] in words]
    out, at = [], 0
    for start, n in (*best[1], (len(run), 0)):
        if start > at:
            out.append(run[at:start])
        if n:
            out.append(run[start:start + n])
        at = start + n
    return out


def test_best_path_among_overlapping_words():
    draw = random.Random(4)
    for _ in range(300):
        words = {"".join(draw.choice("abc") for _ in range(draw.randrange(1, 5))) for _ in range(6)}
        run = "".join(draw.choice("abcx") for _ in range(draw.randrange(9)))
        assert X.best_words(run, X.word_trie(words)) == _best_by_trying_all(run, words)
    trie = X.word_trie(["研究", "研究生", "生命", "起源", "", None])
    assert X.best_words("研究生命起源", trie) == ["研究", "生命", "起源"]
    assert X.best_words("他研究生命ab", trie) == ["他", "研究", "生命", "ab"]
    assert len(X.best_words("ab" * 50_000, X.word_trie(["ab", "ba"]))) == 50_000


def test_dictionary_in_sql(spark):
    X.register_tokenizer(spark, "cut_words", ["red", "Dress"])
    spark.createDataFrame([(1, "RedDress, 7up"), (2, None), (3, "")], "id int, text string").createOrReplaceTempView("dictionary_texts")
    rows = spark.sql("SELECT id, s.word FROM dictionary_texts, LATERAL cut_words(text) s(word)").collect()
    assert [(r.id, r.word) for r in rows] == [(1, "red"), (1, "dress"), (1, "7up")]


def test_runs_are_cut_in_arrow_arrays(monkeypatch):
    monkeypatch.setattr(X, "_CHARS_PER_STEP", 40)
    draw = random.Random(9)
    trie = X.word_trie(["ab", "ba", "c", "acb"])
    rows = [None if draw.random() < 0.2 else ["".join(draw.choice("abcx") for _ in range(draw.randrange(1, 60))) for _ in range(draw.randrange(5))]
            for _ in range(200)]
    expected = [None if r is None else [w for run in r for w in X.best_words(run, trie)] for r in rows]
    runs = pa.array(rows, pa.list_(pa.string()))
    assert X.cut_runs(runs, trie).to_pylist() == expected
    assert X.cut_runs(runs.slice(7, 90), trie).to_pylist() == expected[7:97]
    for few in ([], [None], [[]]):
        assert X.cut_runs(pa.array(few, pa.list_(pa.string())), trie).to_pylist() == few


def test_words_of_a_large_batch_need_little_memory():
    trie = X.word_trie(["ab", "ba"])
    runs = pa.array([["abba", "xabx", "b"] * 100] * 4000, pa.list_(pa.string()))
    tracemalloc.start()
    try:
        assert len(X.cut_runs(runs, trie).flatten()) == 4000 * 100 * 6
        assert tracemalloc.get_traced_memory()[1] < 80e6
    finally:
        tracemalloc.stop()
