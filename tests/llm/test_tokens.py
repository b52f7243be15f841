"""Ids: encoding, decoding, shards and packing, against the tokenizers library and exact round trips."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemill.llm import bpe_ranks, bpe_units, packing, token_files

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "aB's  \n\n\t<|endoftext|>éÉßİΣ \x1c.,12 中文\u0301x\u00a0|hereing"


def _texts():
    draw = random.Random(1)
    made = ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(50))) for _ in range(1500)]
    return [*made, "", "the" * 60, "ab" * 300 + "é" * 100, "".join(draw.choice("abcdefinghthere") for _ in range(700))]


def _ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("path", "spaced"), [(WORD, False), (BYTE, True)])
def test_units_give_the_librarys_ids(path, spaced):
    own, library = bpe_units.UnitEncoder(path, spaced), Tokenizer.from_file(path)
    for text in _texts():
        assert np.frombuffer(own.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_rank_arrays_give_the_librarys_ids_and_text():
    own, library, texts = bpe_ranks.RankEncoder(WORD), Tokenizer.from_file(WORD), _texts()
    for text, (ids, decoded) in zip(texts, own.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert decoded == library.decode(expected, skip_special_tokens=False) == own.decode(np.array(expected, int))


def test_bpe_digests(make, odd_rows):
    library = Tokenizer.from_file(WORD)
    expected = []
    for i, t in odd_rows:
        ids = _ids(WORD, t)
        expected.append((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    rows = [tuple(r) for r in bpe_ranks.digest_documents(make(odd_rows), WORD).collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert bpe_ranks.digest_documents(make([]), WORD).collect() == []
    assert [len(r.ids) for r in bpe_ranks.encode_documents(make([(1, "a b"), (2, None)]), WORD).orderBy("doc_id").collect()] == [2, 0]


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip(seed):
    draw = np.random.default_rng(seed)
    ids = draw.integers(0, 4 + 20 * seed, 5000)
    if seed == 5:
        ids[:] = 7
    ends = np.append(np.sort(draw.integers(0, 5000, 30)), 5000)
    grammar = token_files.compress(ids, ends, rounds=6, least=4)
    back, stops = token_files.expand(grammar.symbols, grammar.rules, grammar.ends)
    assert back.tolist() == ids.tolist()
    assert stops.tolist() == ends.tolist()
    assert len(grammar.symbols) < len(ids)
    row = {"symbols": grammar.symbols.astype("<u4").tobytes(), "rules": grammar.rules.astype("<u4").tobytes(),
           "doc_ends": grammar.ends.astype("<u8").tobytes(), "expansions": grammar.expansions().astype("<u8").tobytes()}
    for k in (0, 7, 30):
        assert token_files.read_one(row, k).tolist() == ids[(ends[k - 1] if k else 0):ends[k]].tolist()
    for a, b in ((0, 1), (17, 2300), (4990, 5000)):
        assert token_files.read_range(row, a, b).tolist() == ids[a:b].tolist()


def test_grammar_ends_when_no_pair_repeats():
    draw = np.random.default_rng(3)
    words = [draw.integers(0, 500, 6) for _ in range(4000)]
    ids = np.concatenate([*(words[i] for i in draw.zipf(1.2, 6000) % 4000), [7] * 1000, [8, 9] * 30])
    ends = np.append(np.arange(40, len(ids), 977), len(ids))
    grammar = token_files.compress(ids, ends)
    back, stops = token_files.expand(grammar.symbols, grammar.rules, grammar.ends)
    assert back.tolist() == ids.tolist() and stops.tolist() == ends.tolist()
    last, seen, at = {}, {}, 0
    for end in grammar.ends.tolist():
        for i in range(at, end - 1):
            pair = tuple(grammar.symbols[i:i + 2].tolist())
            if last.get(pair) != i - 1:
                seen[pair], last[pair] = seen.get(pair, 0) + 1, i
        at = end
    assert max(seen.values()) == 1


def test_token_files(make, odd_rows):
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    expected, start = [], 0
    for i, t in order:
        ids = [*_ids(BYTE, t), 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    rows = [tuple(r) for r in token_files.digest_documents(make(odd_rows), BYTE).orderBy("start").collect()]
    assert rows == expected
    assert token_files.digest_documents(make([]), BYTE).collect() == []


def _check(pieces, documents, window):
    by_document, by_sequence = {}, {}
    for p in pieces:
        by_document.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert np.frombuffer(p.ids, "<u4").tolist() == documents[p.doc_id][p.start:p.start + p.length]
        assert p.doc_tokens == len(documents[p.doc_id])
    for i, ids in documents.items():
        at = 0
        for start, length in sorted(by_document[i]):
            assert start == at
            at += length
        assert at == len(ids)
    for cuts in by_sequence.values():
        at = 0
        for offset, length in sorted(cuts):
            assert offset == at
            at += length
        assert at <= window
    return len(by_sequence)


@pytest.mark.parametrize("window", [256, 4096])
def test_packing(make, odd_rows, window):
    rows = [r for k, r in enumerate(odd_rows) if k != 5] + [(100 + i, "word " * (i * 37 % 300)) for i in range(60)]
    documents = {i: [*_ids(WORD, t), 2] for i, t in rows}
    pieces = packing.pack(make(rows), WORD, window).collect()
    assert _check(pieces, documents, window) <= sum(map(len, documents.values())) / window + 3
    assert packing.pack(make([]), WORD).collect() == []
    twice = packing.pack(make([(1, "a b"), (1, "a b")]), WORD).collect()
    assert sorted((p.doc_id, p.length) for p in twice) == [(1, 3), (1, 3)]


@pytest.mark.parametrize("seed", range(5))
def test_plan_fills_windows(seed):
    draw = np.random.default_rng(seed)
    lengths = np.minimum(draw.geometric(0.002 * (seed + 1), 20_000), 4095)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    plan = packing.plan_windows(histogram)
    used = {}
    for length, count in histogram.items():
        for rank in range(count):
            at = 0
            for begin, n, sequence, offset in plan.pieces(length, rank):
                assert begin == at
                at += n
                used.setdefault(sequence, []).append((offset, n))
            assert at == length
    for cuts in used.values():
        at = 0
        for offset, n in sorted(cuts):
            assert offset == at
            at += n
        assert at <= 4096
    assert lengths.sum() / (4096 * len(used)) > 0.995


def test_least_squares():
    matrix = np.array([[1.0, 0, 1], [0, 2, 1]])
    x = packing.nonnegative_least_squares(matrix, np.array([3.0, 4.0]))
    assert (x >= 0).all()
    assert np.abs(matrix @ x - [3, 4]).max() < 1e-6
    assert packing.nonnegative_least_squares(matrix, np.array([-1.0, -1.0])).tolist() == [0, 0, 0]
