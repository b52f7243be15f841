"""Secrets in texts: three fixed patterns, and a battery of randomness tests for what no pattern names.

Base kinds (`assign`, `access`, `hex`) are matched as they stand. Any other run of at least 16 letters, digits, `+ / _ -`
that holds a digit or changes case inside is a candidate. Its encoding is inferred from the characters it uses, and
three tests ask how far it is from random symbols of that encoding's alphabet: chi-squared of the symbol counts
against uniform, the Wald-Wolfowitz runs of symbols in the upper and lower half of the alphabet, and the serial
correlation of neighbouring symbols. Their standard scores are summed; ordinary words score high, random strings low.

What is ordinary is learnt from the corpus: runs of letters alone (as written in prose) are scored with the same
tests, by length, and give the mean and deviation of the score under the hypothesis "text". The p-value of a candidate
is the normal tail below its score. Within each class of length, Benjamini-Hochberg keeps the expected share of false
finds below `RATE`; a class of length with fewer than `LEAST` reference runs takes the next shorter class that has them
(longer text is easier to tell apart, so this errs on the side of keeping text), and without any, nothing is added.

The driver sees sums and histograms of bounded size only. Each text is searched whole, in its own partition; a
candidate that touches a base span is left out. Spans count code points, the end is exclusive.

Cases: a null text reads as empty and has no spans; repeated rows give repeated results; an empty table gives an empty
result. Only `doc_id` and `text` are read (`redacted` reads `text`), so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, kept_table

# The base kinds, in their order, with the least number of characters of each.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_INNER = re.compile(r"[a-z][A-Z]")
#: Alphabets in order of size: a run takes the first that holds all its characters. Digits, capitals and small letters
#: stand together, so that the halves of the runs test differ in kind and prose (small letters) makes a single run.
ALPHABETS = {
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/",
    "base64url": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_",
}
_PLACES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}
_SETS = {name: frozenset(letters) for name, letters in ALPHABETS.items()}
#: First length of each class.
CLASSES = (16, 18, 21, 25, 33, 49)
LEAST = 30
RATE = 0.01
BINS, BIN = 800, 0.05

SCANNED = ("doc_id long, base array<struct<start: int, kind: int, stop: int>>, found array<struct<start: int, stop: int, "
           "class: int, score: double>>, reference array<struct<class: int, n: long, total: double, squares: double>>")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start and kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def encoding_of(run: str) -> str | None:
    used = set(run)
    return next((name for name, letters in _SETS.items() if used <= letters), None)


def score(run: str, encoding: str) -> float:
    """Sum of the standard scores of the three tests: about 0 for random symbols, high for anything else."""
    places, size, n = _PLACES[encoding], len(ALPHABETS[encoding]), len(run)
    symbols = [places[c] for c in run]
    counts = Counter(symbols)
    expected = n / size
    square = sum(c * c for c in counts.values()) / expected - n
    # Exact mean and variance of the statistic for n uniform draws; the usual k - 1 and 2 (k - 1) need a larger n.
    uniform = (square - (size - 1)) / math.sqrt(2 * (size - 1) * (1 - 1 / n))
    high = [s >= size / 2 for s in symbols]
    above = sum(high)
    changes = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 1 + 2 * above * (n - above) / n
    spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    runs = abs(changes - mean) / spread if 0 < above < n else math.sqrt(n)
    middle = sum(symbols) / n
    deviations = [s - middle for s in symbols]
    power = sum(d * d for d in deviations)
    serial = sum(a * b for a, b in zip(deviations, deviations[1:])) / power if power else 1.0
    return max(0.0, uniform) + runs + abs(serial + 1 / n) * math.sqrt(n)


def length_class(n: int) -> int:
    return sum(n >= c for c in CLASSES) - 1


@lru_cache(maxsize=65_536)
def _judged(run: str) -> tuple[int, int, float] | None:
    """(candidate, class, score): candidate 1, reference text 0; None for runs that are neither."""
    letters = run.isalpha()
    if letters and not _INNER.search(run):
        return 0, length_class(len(run)), score(run, "base64")
    if run.isdigit() or (encoding := encoding_of(run)) is None:
        return None
    if not letters and not any(c.isdigit() for c in run):
        return None
    return 1, length_class(len(run)), score(run, "base64" if letters else encoding)


def scan_text(text: str) -> tuple[list, list, list]:
    """Base spans, candidates (start, end, class, score), and sums over reference runs by class."""
    base, found, sums = base_spans(text), [], {}
    for match in _RUN.finditer(text):
        judged = _judged(match[0])
        if judged is None:
            continue
        candidate, group, value = judged
        if not candidate:
            n, total, squares = sums.get(group, (0, 0.0, 0.0))
            sums[group] = n + 1, total + value, squares + value * value
        elif not any(start < match.end() and match.start() < stop for start, _, stop in base):
            found.append((match.start(), match.end(), group, value))
    return base, found, [(group, *row) for group, row in sorted(sums.items())]


def scanned(docs: DataFrame) -> DataFrame:
    """Base spans, candidates and reference sums of every document; no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())])),
                 pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("class", pa.int32()),
                                     ("score", pa.float64())])),
                 pa.list_(pa.struct([("class", pa.int32()), ("n", pa.int64()), ("total", pa.float64()),
                                     ("squares", pa.float64())]))]
        names = [[f.name for f in kind.value_type] for kind in kinds]
        for batch in batches:
            for at in range(0, len(batch), 1000):
                few = batch.slice(at, 1000)
                rows = [scan_text(t) for t in few.column("text").to_pylist()]
                columns = [pa.array([[dict(zip(name, item)) for item in row[i]] for row in rows], kind)
                           for i, (kind, name) in enumerate(zip(kinds, names))]
                yield pa.RecordBatch.from_arrays([few.column("doc_id"), *columns],
                                                 names=["doc_id", "base", "found", "reference"])

    return documents_of(docs).mapInArrow(run, SCANNED)


def limits(scan: DataFrame) -> list[float]:
    """Score below which a candidate of each class of length counts as random (minus infinity: none does)."""
    own = scan.select(F.explode("reference").alias("r")).select("r.*")
    sums = {r["class"]: r for r in own.groupBy("class").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")).collect()}
    binned = scan.select(F.explode("found").alias("f")).select(
        F.col("f.class").alias("class"), F.least(F.floor(F.col("f.score") / BIN), F.lit(BINS)).cast("int").alias("bin"))
    counts: dict[int, dict[int, int]] = {}
    for r in binned.groupBy("class", "bin").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["class"], {})[r["bin"]] = r["n"]
    found, text = [], None
    for group in range(len(CLASSES)):
        if group in sums and sums[group]["n"] >= LEAST:
            n, mean = sums[group]["n"], sums[group]["total"] / sums[group]["n"]
            text = mean, math.sqrt(max(1e-6, sums[group]["squares"] / n - mean * mean))
        found.append(_cut(counts.get(group, {}), text))
    return found


def _cut(counts: dict[int, int], text: tuple[float, float] | None) -> float:
    """Benjamini-Hochberg over a histogram: a bin counts with the p-value of its upper edge."""
    total, below, limit = sum(counts.values()), 0, -math.inf
    for place in sorted(counts):
        below += counts[place]
        if text is not None and place < BINS:
            edge = (place + 1) * BIN
            p = 0.5 * math.erfc((text[0] - edge) / (text[1] * math.sqrt(2)))
            if p <= RATE * below / total:
                limit = edge
    return limit


def _chosen(found: Column, cuts: list[float]) -> Column:
    bound = F.array(*[F.lit(c) for c in cuts])
    return F.filter(found, lambda f: f["score"] < F.get(bound, f["class"]))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """`doc_id`, `base`, `spans` (arrays of start, kind, stop; kind is a place in `KINDS`) of every document."""
    scan = kept_table(scanned(docs), "secret-scan")
    cuts = limits(scan)
    random = F.transform(_chosen(F.col("found"), cuts), lambda f: F.struct(
        f["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), f["stop"].alias("stop")))
    return scan.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, digest of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def masked(text: str, cuts: list[float], mark: str = "[SECRET]") -> str:
    """The text with every secret replaced by `mark`; spans that overlap are replaced as one."""
    base, found, _ = scan_text(text)
    spans = sorted([(a, b) for a, _, b in base] + [(a, b) for a, b, group, value in found if value < cuts[group]])
    parts, at, end = [], 0, -1
    for begin, stop in spans:
        if begin >= end:
            parts += [text[at:begin], mark]
        end = max(end, stop)
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with secrets masked in `text` (null stays null) and `n_chars` brought up to date where it is a column."""
    cuts = limits(scanned(docs))

    @F.arrow_udf("string")
    def clean(text: pa.Array) -> pa.Array:
        return pa.array([None if t is None else masked(t, cuts) for t in text.to_pylist()], pa.string())

    out = docs.withColumn("text", clean("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
