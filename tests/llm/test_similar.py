"""Near-duplicates and neighbours, against brute force; the pipeline, stage by stage."""

from __future__ import annotations

import random
import re
import string
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tidemill.llm import minhash, stable_ann
from tidemill.llm.components import connected_components

DATA = "/root/testdata/sf0.001"
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def _components(rows, width, percent):
    """Least id of each id's component, by all pairs."""
    sets = [(i, _set(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in parent}


def _copies(seed, n=120):
    draw = random.Random(seed)
    words = ["".join(draw.choice(string.ascii_lowercase) for _ in range(4)) for _ in range(2000)]
    base = [draw.choice(words) for _ in range(80)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            text = [draw.choice(words) for _ in range(draw.randrange(1, 60))]
        else:
            text = list(base)
            for _ in range(draw.randrange(0, 7)):
                text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((1000 + i, " ".join(text)))
    return [*rows, (2000, rows[1][1].upper()), (2001, rows[1][1]), (2001, rows[1][1]), (2002, "A b"), (2003, "a  B")]


@pytest.mark.parametrize(("seed", "small"), [(1, 16), (2, 2)])
def test_near_duplicates(make, odd_rows, seed, small):
    rows = [*_copies(seed), *odd_rows]
    expected = _components(rows, 3, 85)
    found = minhash.near_duplicates(make(rows), 3, 0.85, small).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.component_id == (None if r.doc_id is None else expected[r.doc_id])
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    sizes = {i: len(_set(t, 3)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in found)
    assert minhash.near_duplicates(make([]), 3, 0.85).collect() == []


def test_one_of_each_group_stays(make):
    rows = _copies(3, 60)
    expected = _components(rows, 5, 80)
    left = minhash.keep_one(make([*rows, (None, rows[0][1])]))
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted({i for i, r in expected.items() if i == r})
    assert left.where("doc_id is null").count() == 1
    assert left.columns == make([]).columns


def test_signatures_agree_as_often_as_sets_do():
    texts = ["a b c d e f g h i j " * 3 + f"x{k} y{k}" for k in range(2)] + ["one", ""]
    sets, sizes = minhash.shingle_sets(pa.array(texts), 3)
    found = minhash.signatures(sets, sizes, 6000)
    a, b = (_set(t, 3) for t in texts[:2])
    assert abs((found[0] == found[1]).mean() - len(a & b) / len(a | b)) < 0.05
    assert sizes.tolist() == [len(_set(t, 3)) for t in texts]
    assert not found[3].any()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)} | {200 + i: 200 for i in range(50)}


@pytest.mark.parametrize("cell", [20_000, 64])
def test_neighbours(spark, monkeypatch, cell):
    monkeypatch.setattr(stable_ann, "CELL", cell)
    draw = np.random.default_rng(9)
    centres = draw.normal(size=(12, 16))
    vectors = centres[draw.integers(0, 12, 900)] + 0.4 * draw.normal(size=(900, 16))
    vectors[600:800] = vectors[600]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(5000, None, "x"), (5020, [0.0] * 16, "x"), (5040, [float("nan")] * 16, "x"), (5060, [None] * 16, "x"), (5080, [1.0], "x"), (None, [1.0] * 16, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    found = {}
    for r in stable_ann.nearest(frame, frame.where("vec_id % 20 = 0"), 20).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(range(0, 900, 20))
    hit = 0
    for q, near in found.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, 21))
        assert [(-n[2], n[1]) for n in near] == sorted((-n[2], n[1]) for n in near)
        assert all(abs(n[2] - vectors[q] @ vectors[n[1]]) < 1e-9 and n[1] != q for n in near)
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        least = np.sort(scores)[-20]
        hit += sum(n[2] >= least - 1e-9 for n in near)
    assert hit / (20 * len(found)) >= 0.9


def test_equal_vectors_go_by_id(spark):
    draw = np.random.default_rng(10)
    ids = draw.permutation(3000).tolist()
    other = draw.normal(size=(500, 8))
    rows = [(i, [1.0] * 8) for i in ids] + [(5000 + i, v.tolist()) for i, v in enumerate(other)]
    rows += [(9000, [2.0] * 8)] * 30 + [(9100, [2.0] * 8)] * 3
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = {}
    for r in stable_ann.nearest(frame, frame.where("vec_id IN (0, 7, 2500, 9000, 9100)"), 20).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found[0] == found[7] == found[2500] == found[9100] == [9000] * 20
    same = [i for i in found[9000][3:] if i < 5000]
    assert found[9000][:3] == [9100] * 3 and same == list(range(len(same))) and len(same) > 10
    alone = frame.where("vec_id < 9000")
    found = {}
    for r in stable_ann.nearest(alone, alone.where("vec_id IN (0, 7, 2500)"), 20).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    near = {i for i, v in enumerate(other) if v.sum() > 8}
    for q, ids in found.items():
        same = [i for i in ids if i < 5000]
        assert same == [i for i in range(40) if i != q][:len(same)] and {i - 5000 for i in ids if i >= 5000} == near


def test_few_neighbours(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (20, [2.0, 1.0]), (7, [2.0, 1.0])], "vec_id long, embedding array<float>")
    rows = stable_ann.nearest(frame, frame.where("vec_id % 20 = 0"), 20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows) == [(0, 1, 7, 4.0), (0, 2, 20, 4.0), (20, 1, 7, 5.0), (20, 2, 0, 4.0)]
    assert stable_ann.nearest(frame.limit(0), frame.limit(0), 20).collect() == []


def test_chi_square():
    draw = np.random.default_rng(1).chisquare(8, 100_000)
    for x in (3.0, 8.0, 15.0):
        assert abs(float(stable_ann.chi_square(np.array([x]), 8)[0]) - (draw <= x).mean()) < 0.01


@pytest.mark.skipif(not Path(DATA).exists(), reason="the driver's tables are not here")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, DATA)
    rows = [(r.doc_id, r.text) for r in clean.select("doc_id", "text").collect()]
    once = stages["near_duplicates"](spark, clean, DATA)
    expected = {i for i, root in _components(rows, 5, 80).items() if i == root}
    assert {r.doc_id for r in once.select("doc_id").collect()} == expected
    hidden = stages["secrets"](spark, once, DATA)
    assert hidden.columns == once.columns == clean.columns == docs.columns
    assert not any(re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r.text or "") for r in hidden.collect())
    pieces = corpus_pipeline.run(spark, DATA).collect()
    assert {p.doc_id for p in pieces} == expected


@pytest.mark.skipif(not Path(DATA).exists(), reason="the driver's tables are not here")
def test_registered_queries(spark):
    names = driver.queries()
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 14)}
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    rows = names["op10_host_reputation"](spark, DATA)
    result = connection.execute(driver.oracle_sql()["op10_host_reputation"])
    order = [rows.columns.index(d[0]) for d in result.description]
    assert sorted(repr(tuple(r[i] for i in order)) for r in rows.collect()) == sorted(map(repr, result.fetchall()))
