"""Winnowing, the Merkle log and the alignment of two vocabularies, against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemill.llm import bpe_units, merkle_log, token_alignment, winnowing

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# Winnowing ----------------------------------------------------------------------------------------------------


def _words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _contaminated(docs, items):
    windows = {}
    for i, text in items:
        words = _words(text)
        size = min(10, len(words))
        for s in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[s:s + size]), set()).add(i)
    rows = []
    for i, text in docs:
        words, held = _words(text), set()
        hit = [False] * len(words)
        for size in {len(w) for w in windows}:
            for s in range(len(words) - size + 1):
                if (owners := windows.get(tuple(words[s:s + size]))) is not None:
                    held |= owners
                    hit[s:s + size] = [True] * size
        names = sorted(str(h) for h in held if h is not None)
        rows.append((i, len(words), sum(hit), len(names), ",".join(names), any(hit)))
    return sorted(rows, key=repr)


def _few_words(draw, count, sizes, letters="aBcd"):
    return [(i, " ".join(draw.choice(letters) for _ in range(draw.choice(sizes)))) for i in range(count)]


DRAW = random.Random(5)
PASSAGE = " ".join(f"w{DRAW.randrange(400)}" for _ in range(60))
DOCS = [*_few_words(DRAW, 60, range(70)), (70, "x, " + PASSAGE.upper() + " y"), (71, " ".join(PASSAGE.split()[7:17])),
        (72, " ".join(PASSAGE.split()[7:16])), (73, "a " * 3000), (74, "Éa éa ÉA-B")]
ITEMS = [*_few_words(DRAW, 30, [0, 1, 2, 3, 5, 9, 10, 11, 12, 30]), (90, "a " * 40), (91, "a " * 12), (None, "c c d d a a b"),
         (92, None), (93, "x Y"), (93, "éa"), (94, PASSAGE), (95, PASSAGE)]
LONG = [item for item in ITEMS if len(_words(item[1])) >= 10]


@pytest.mark.parametrize(("items", "block"), [(ITEMS, None), (LONG, None), ([], None), (LONG, 40)])
def test_windows_of_items_in_documents(spark, make, odd_rows, monkeypatch, items, block):
    if block:
        monkeypatch.setattr(winnowing, "BLOCK_ROWS", block)
    docs = [*DOCS, *odd_rows]
    benchmark = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, `key` string, row int")
    assert _sorted(winnowing.contaminated(make(docs), benchmark).collect()) == _contaminated(docs, items)
    assert winnowing.contaminated(make([]), benchmark).collect() == []


def test_every_stretch_of_ten_words_keeps_its_fingerprint(spark):
    draw = random.Random(7)
    core = [f"w{draw.randrange(50)}" for _ in range(10)]
    texts = [[f"u{draw.randrange(50)}" for _ in range(draw.randrange(30))] + core + [f"u{draw.randrange(50)}" for _ in range(20)]
             for _ in range(50)]
    rows = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate([*texts, core])], "k int, words array<string>, n int")
    marks = winnowing.window_runs(rows).select("k", F.inline(F.concat("runs"))).select("k", "mark").distinct().collect()
    own = {r.mark for r in marks if r.k == len(texts)}
    assert len(own) == 1
    assert {r.k for r in marks if r.mark in own} == set(range(len(texts) + 1))


# Merkle log ---------------------------------------------------------------------------------------------------


def _digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def _levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([_digest(row[i:i + 3]) for i in range(0, len(row), 3)])
    return levels


def _way(levels, i):
    steps = []
    for row in levels[:-1]:
        first = i - i % 3
        steps.append((row[first:i], row[i + 1:first + 3]))
        i //= 3
    return steps


def _fold(node, steps):
    for left, right in steps:
        node = _digest([*left, node, *right])
    return node


def _proofs(rows):
    def leaf(row, text):
        fields = [None if v is None else str(v) for v in (*row[:4], text)]
        return _digest(["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])

    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), row))
    trees = {s: sorted(v, key=lambda x: x[:3]) for s, v in by_source.items()}
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: _levels([x[2] for x in trees[s]]) for s in names}
    above = _levels([levels[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, row) in enumerate(trees[s]):
            steps = [*_way(levels[s], i), *_way(above, k)]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            folded = _fold(leaf(row, row[4].replace("\n", "")) if tampered else own, steps)
            proof = _digest([h for step in steps for side in step for h in side])
            out.append((row[0], own, levels[s][-1][0], above[-1][0], proof, folded, folded == above[-1][0]))
    return sorted(out, key=repr)


def _document_rows(odd_rows):
    rows = [(i, "s", "en", None if t is None else len(t), t) for i, t in odd_rows]
    rows += [(i, None, None, 1, "a\nb") for i in range(4)] + [(i, "", "x", None, "\n") for i in range(3)] + [(1, "é", "", 0, "")]
    return rows + [(i, "hot", "en", 1, f"text {i % 7}\n") for i in range(2300)] + [(9, "hot", "en", 1, "again")] * 5


def test_proofs(spark, odd_rows):
    rows = _document_rows(odd_rows)
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, name string, idx int")
    logs = merkle_log.manifest(docs.repartition(3))
    assert _sorted(merkle_log.prove(logs).collect()) == _proofs(rows)
    nodes = merkle_log.log_rows(logs).where("name = '=hot'").orderBy("position").collect()
    levels = _levels([x[1] for x in sorted((r["index"], r.digest) for r in nodes if r.level == 0)])
    assert [r.position for r in nodes] == list(range(sum(map(len, levels))))
    assert all(levels[r.level][r["index"]] == r.digest for r in nodes)
    assert [r.position for r in nodes if r.level == 1][:2] == [3, 7]
    empty = spark.createDataFrame([], docs.schema)
    assert merkle_log.prove(merkle_log.manifest(empty)).collect() == []
    one = merkle_log.prove(merkle_log.manifest(docs.limit(1))).first()
    assert one.leaf == one.subroot == one.root
    assert one.proof_sha256 == _digest([])


@pytest.mark.parametrize("total", [1, 2, 3, 4, 9, 10, 28, 243, 250])
def test_positions_are_the_order_of_completion(total):
    levels = merkle_log.levels_above(total)
    order = [level for level, _ in merkle_log.completed([str(i).encode() for i in range(total)], levels)]
    seen = Counter()
    for place, level in enumerate(order):
        assert merkle_log.position(level, seen[level], total, levels) == place
        seen[level] += 1
    assert seen == Counter({k: -(-total // 3**k) for k in range(levels + 1)})


# Alignment ----------------------------------------------------------------------------------------------------


def _aligned(docs):
    a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    values = {c: v for v, c in enumerate(bpe_units.byte_letters())}
    of_a = {i: bytes(values[c] for c in t) for t, i in a.get_vocab().items() if all(c in values for c in t)}
    of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(b.vocab_size())]

    def spans(ids, table):
        ends = np.cumsum([len(table[i]) for i in ids]).tolist()
        return list(zip([0, *ends], ends, ids))

    done, counts = [], Counter()
    for name, text in docs:
        ids_a, ids_b, links, groups = [], [], [], []
        if text:
            ids_a, ids_b, raw = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
            if b"".join(of_a[i] for i in ids_a) != raw or b"".join(of_b[i] for i in ids_b) != raw:
                ids_a, ids_b = [], []
            left, right, low = spans(ids_a, of_a), spans(ids_b, of_b), 0
            for s, e, i in left:
                while right[low][1] <= s:
                    low += 1
                k = low
                while k < len(right) and right[k][0] < e:
                    links.append((i, right[k][2]))
                    k += 1
            both = {e for _, e, _ in left} & {e for _, e, _ in right}
            for side, out in ((left, one := []), (right, two := [])):
                row = []
                for _, e, i in side:
                    row.append(str(i))
                    if e in both:
                        out.append(",".join(row))
                        row = []
            groups = [f"{x}|{y}" for x, y in zip(one, two, strict=True)]
        counts.update(links)
        done.append((name, len(ids_a), len(ids_b), links, groups))
    best = Counter()
    for (_, i), n in counts.items():
        best[i] = max(best[i], n)
    return sorted(((name, n, m, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    sha256(";".join(groups).encode()).hexdigest() if groups else "") for name, n, m, links, groups in done), key=repr)


def _odd_texts():
    draw = random.Random(3)
    letters = "aB's  \n\n\t<|endoftext|><s></s>éÉßİΣ \x1c.,12 中文́x |here\r▁;:!(\"0"
    rows = [(1000 + k, "".join(draw.choice(letters) for _ in range(draw.randrange(60)))) for k in range(600)]
    rows += [(3000 + k, "".join(draw.choice("ab ,.\n") for _ in range(draw.randrange(40)))) for k in range(600)]
    return rows + list(enumerate([" ", "  a", "a  ", "\n\n\na", "a\n\n\n", "a \n b", "a.b ,c", "it's foo's. 3.5", "<s>hi</s> <unk> <0x0A>"], 5000))


@pytest.mark.parametrize(("block", "fan"), [(None, None), (500, 2)])
def test_alignment(make, odd_rows, monkeypatch, block, fan):
    if block:
        monkeypatch.setattr(token_alignment, "BLOCK_PAIRS", block)
        monkeypatch.setattr(token_alignment, "FAN", fan)
    rows = [*_odd_texts(), *odd_rows]
    found = token_alignment.align_documents(make(rows).repartition(5), BYTE, PIECE).collect()
    assert _sorted(found) == _aligned(rows)
    assert token_alignment.align_documents(make([]), BYTE, PIECE).collect() == []


def test_forgotten_units_are_learnt_again(monkeypatch):
    own, texts = token_alignment.Aligner(BYTE, PIECE), [t for _, t in _odd_texts()]
    first = own.numbers(texts)
    counted = own.sums(own.stats[:, 3], *first).tolist()
    monkeypatch.setattr(token_alignment, "CACHE_UNITS", 10)
    assert own.full()
    own.clear()
    again = own.numbers(texts)
    assert own.sums(own.stats[:, 3], *again).tolist() == counted


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 50_000])
def test_minimal_perfect_hash(size):
    pairs = np.unique(np.random.default_rng(size).integers(0, 2**32, size, dtype=np.uint32))
    sizes, taken, order = token_alignment.build_hash(pairs)
    assert sorted(order.tolist()) == pairs.tolist()
    assert taken.sum() == len(pairs)
    rows = []
    for bucket in np.unique(token_alignment.bucket_of(pairs)):
        s, t, o = token_alignment.build_hash(pairs[token_alignment.bucket_of(pairs) == bucket])
        rows.append({"bucket": int(bucket), "sizes": s, "taken": np.packbits(t).tobytes(), "pairs": o.astype("<u4").tobytes()})
    table = token_alignment.PairTable(rows)
    assert sorted(table.index(pairs).tolist()) == list(range(len(pairs)))
    others = np.setdiff1d(np.arange(1, 5000, dtype=np.uint32), pairs)
    assert (table.index(others) == -1).all()
