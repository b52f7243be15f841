"""Text helpers: search-term tokens and character runs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The table function's name and output column as shop queries spell them.
TOKEN_FUNCTION = "ik_analyze"
TOKEN_COLUMN = "word"

TOKEN_PATTERN = r"([\p{L}\p{N}]+)"

# Characters handled by one numpy step; longer texts are still taken whole.
_CHARS_PER_STEP = 4_000_000
_ROWS_PER_STEP = 1000


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def tokens(column: Column | str) -> Column:
    """Lower-cased runs of letters and digits, in order, duplicates kept."""
    return F.regexp_extract_all(F.lower(_col(column)), F.lit(TOKEN_PATTERN), F.lit(1))


def _unspaced(char: str) -> bool:
    """Thai, Lao, Burmese, kana and Han; Hangul is written with spaces."""
    code = ord(char)
    return 0x0E00 <= code <= 0x0EFF or 0x1000 <= code <= 0x109F or (code >= 0x2E80 and not 0xAC00 <= code <= 0xD7AF)


def dictionary_tokens(words: Iterable[str]):
    """A column function that cuts text by longest dictionary match, for scripts written without spaces.

    Unknown characters of such scripts become single tokens; unknown runs of other letters and digits stay whole.
    """
    vocabulary = frozenset(w.lower() for w in words if w)
    longest = max((len(w) for w in vocabulary), default=1)

    def cut(run: str) -> Iterator[str]:
        at = 0
        while at < len(run):
            word = next(
                (run[at:at + n] for n in range(min(longest, len(run) - at), 1, -1) if run[at:at + n] in vocabulary),
                None,
            )
            if word is None:
                end = at + 1
                while not _unspaced(run[at]) and end < len(run) and not _unspaced(run[end]):
                    end += 1
                word = run[at:end]
            yield word
            at += len(word)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut_all(runs: pd.Series) -> pd.Series:
        return runs.map(lambda found: None if found is None else [w for run in found for w in cut(run)])

    return lambda column: cut_all(tokens(column))


def word_trie(words: Iterable[str]) -> dict:
    """The words, lower-cased, as nested dictionaries by character; the empty string marks the end of a word."""
    trie: dict = {}
    for word in words:
        node = trie
        for char in (word or "").lower():
            node = node.setdefault(char, {})
        if node is not trie:
            node[""] = True
    return trie


def best_words(run: str, trie: dict) -> list[str]:
    """Cut a run of letters into the words of a trie.

    Where words overlap, the choice covers most characters, then takes fewest words, then the word that begins earlier,
    then the longer one. What no chosen word covers stays whole between them; characters of scripts without spaces
    become tokens one by one. One step per character and word that begins there, from the end of the run.
    """
    size = len(run)
    covered, words, taken = [0] * (size + 1), [0] * (size + 1), [0] * (size + 1)
    for at in range(size - 1, -1, -1):
        best, node = (covered[at + 1], -words[at + 1], 0), trie
        for end in range(at, size):
            node = node.get(run[end])
            if node is None:
                break
            if "" in node:
                best = max(best, (covered[end + 1] + end + 1 - at, -words[end + 1] - 1, end + 1 - at))
        covered[at], words[at], taken[at] = best[0], -best[1], best[2]
    found, at = [], 0
    while at < size:
        end = at + max(1, taken[at])
        if not taken[at] and not _unspaced(run[at]):
            while end < size and not taken[end] and not _unspaced(run[end]):
                end += 1
        found.append(run[at:end])
        at = end
    return found


def best_path_tokens(spark: SparkSession, words: Iterable[str]):
    """A column function that cuts text by the best path through a dictionary; the dictionary reaches the workers once,
    as a broadcast, and a run that occurs again in a step of a batch is cut once."""
    shared = spark.sparkContext.broadcast(word_trie(words))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut_all(runs: pa.Array) -> pa.Array:
        parts = [cut_runs(runs.slice(at, _ROWS_PER_STEP), shared.value) for at in range(0, len(runs), _ROWS_PER_STEP)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return cut_all


def cut_runs(runs: pa.Array, trie: dict) -> pa.Array:
    """Lists of runs as lists of their words. Only different runs become Python texts, about `_CHARS_PER_STEP` bytes of
    runs at a time; lists and words stay Arrow arrays, in which a word takes its letters and four bytes."""
    if not len(runs):
        return pa.array([], pa.list_(pa.string()))
    sizes = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    stops = np.cumsum(sizes)
    flat = runs.flatten()
    letters = np.cumsum(pc.fill_null(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    pieces, counts = [pa.array([], pa.string())], np.zeros(len(flat), np.int64)
    steps = np.arange(_CHARS_PER_STEP, letters[-1], _CHARS_PER_STEP) if len(flat) else []
    edges = np.unique(np.r_[0, np.searchsorted(letters, steps), len(flat)]).astype(np.int64)
    for begin, end in zip(edges[:-1], edges[1:]):
        coded = flat.slice(begin, end - begin).dictionary_encode()
        found = [best_words(run, trie) for run in coded.dictionary.to_pylist()]
        words = np.array([len(f) for f in found], dtype=np.int64)
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        width = words[place]
        counts[begin:end] = width
        # The words of a run stand one behind the other: its first one, and as many after it as it has.
        first = np.repeat((np.cumsum(words) - words)[place] - (np.cumsum(width) - width), width)
        pieces.append(pa.array([w for f in found for w in f], pa.string()).take(pa.array(first + np.arange(len(first)))))
    ends = np.r_[0, np.cumsum(counts)][np.r_[0, stops]]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.concat_arrays(pieces),
                                    mask=pc.is_null(runs))


def register_tokenizer(spark: SparkSession, name: str = TOKEN_FUNCTION, words: Iterable[str] | None = None) -> None:
    """Register the tokeniser as a SQL table function for `FROM t, LATERAL name(text) s(keyword)`, with `words` the one
    that cuts by their best path.

    It is a SQL function, so Catalyst inlines it: the lateral call becomes a plain Generate node over whole batches.
    """
    pattern = TOKEN_PATTERN.replace("\\", "\\\\")
    found = f"regexp_extract_all(lower(text), '{pattern}', 1)"
    if words is not None:
        spark.udf.register(f"{name}_cut", best_path_tokens(spark, words))
        found = f"{name}_cut({found})"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE({TOKEN_COLUMN} STRING) "
        f"RETURN SELECT explode({found}) AS {TOKEN_COLUMN}"
    )


def longest_run(column: Column | str, zero_without_repeat: bool = True) -> Column:
    """Length of the longest run of one repeated character; 0 for empty text.

    Text in which nothing repeats gives 0, or 1 with `zero_without_repeat=False`. Only runs of two and more are
    extracted, so the array stays short on ordinary prose.
    """
    text = _col(column)
    runs = F.regexp_extract_all(text, F.lit(r"(?s)((.)\2+)"), F.lit(1))
    single = F.lit(0) if zero_without_repeat else F.least(F.length(text), F.lit(1))
    return F.when(text.isNotNull(), F.coalesce(F.array_max(F.transform(runs, F.length)), single))


def _distinct_spans(texts: list[str]) -> np.ndarray:
    """Longest stretch without a repeated character for each text, all texts in one vectorised pass."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    best = np.zeros(len(texts), dtype=np.int32)
    if not lengths.any():
        return best
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    owner = np.repeat(np.arange(len(texts)), lengths)
    keys = (owner << 21) | codes
    order = np.argsort(keys, kind="stable")
    after_previous = np.zeros(len(codes), dtype=np.int64)
    same = keys[order[1:]] == keys[order[:-1]]
    after_previous[order[1:][same]] = order[:-1][same] + 1
    start = np.maximum.accumulate(np.maximum(after_previous, first[owner]))
    spans = np.arange(len(codes)) - start + 1
    filled = lengths > 0
    best[filled] = np.maximum.reduceat(spans, first[filled])
    return best


@F.pandas_udf(T.IntegerType())
def longest_distinct_span(texts: pd.Series) -> pd.Series:
    """Length of the longest substring without a repeated character (Arrow batches, numpy inside)."""
    result = pd.Series([None] * len(texts), dtype="Int32", index=texts.index)
    chunk: list[int] = []
    chars = 0
    present = [i for i, t in enumerate(texts) if t is not None]
    for i in present:
        chunk.append(i)
        chars += len(texts.iat[i])
        if chars >= _CHARS_PER_STEP or i == present[-1]:
            result.iloc[chunk] = _distinct_spans([texts.iat[j] for j in chunk])
            chunk, chars = [], 0
    return result
