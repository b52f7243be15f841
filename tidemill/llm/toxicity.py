"""Toxicity of texts: a small convolutional network over hashed word embeddings, trained here in numpy.

A word (A-Z in lower case, outer ASCII punctuation left off) is the sum of one row from each of `TABLES` embedding
tables: two chosen by independent hashes of the word, so that words that share one row rarely share the other, and one
by a hash of its first four bytes, so that an inflected form met for the first time is not a stranger. Filters of several widths slide
over the words of the whole text; the strongest answer of each filter is kept (max pooling), and a logistic layer turns
the answers into a probability. The first embedding dimension starts as the shrunken log-odds of the row's words, the
rest near zero, so that a word never met in training stays neutral.

Training: all labelled rows, held-out rows never among them. The counts behind the log-odds are a grouped sum. In each of
`EPOCHS` rounds every task takes one pass over its rows, `TRAIN_WORDS` words in memory at a time, from the round's common
weights, and the changes of the tasks are averaged (an embedding row over the tasks that met it); the driver only gets
sums of the size of the network. A fifth of the rows is kept from the weights; on it the logit is calibrated to the share
of toxic rows among all labels (Platt), and a threshold is chosen for each language with at least `LEAST_LANGUAGE` rows
there, one for all others, both from sums over all those rows. Scores depend on the text alone; the language only picks
the threshold of the `toxic` decision.

Cases: a null or empty text has the score of no answers; repeated rows have repeated results; rows with a null doc_id
are scored and count as not held out; labels that are null or neither 0 nor 1 are not used, of several for one id the
highest counts. Without both labels in the training rows every text has the share of toxic rows as its score (0 without
labels). Columns other than `doc_id`, `text` and `lang` are not read, so they may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import fresh, hash_spans, kept_table, mix, remainder, slices, text_bytes, word_spans

TABLES, ROWS, SIZE = 3, 1 << 17, 8
WIDTHS, FILTERS = (1, 2, 3), 8
SHARD_ROWS, TRAIN_WORDS = 9000, 5_000_000
#: Bytes of text whose words are in memory at a time, some fifty bytes each for their places, hashes and vectors.
SLICE = 1_000_000
SCORE_BINS = 1 << 20
LEAST_LANGUAGE = 50
EPOCHS, BATCH, RATE = 4, 32, 0.05
HELD_DIVISOR, HELD_REMAINDER = 4, 2

_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def word_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row of every word of the texts in each table (words x TABLES), and the number of words of each text."""
    data, offsets = text_bytes(texts)
    begin, end, owner = word_spans(data, offsets)
    last = max(len(data) - 1, 0)
    for edge, step in ((end, -1), (begin, 1)):
        for _ in range(8):
            at = np.minimum(edge - (step < 0), last)
            loose = np.flatnonzero((end - begin > 1) & _MARK[data[at]]) if len(data) else at
            if not len(loose):
                break
            edge[loose] += step
    whole, head = hash_spans(data, begin, end), hash_spans(data, begin, np.minimum(end, begin + 4))
    rows = [(mix(h) % np.uint64(ROWS)).astype(np.int32) for h in (whole, ~whole, head)]
    return np.stack(rows, axis=1), np.bincount(owner, minlength=len(texts))


@dataclass
class Network:
    """embed: TABLES x ROWS x SIZE; filters[w]: w x SIZE x FILTERS; bias[w]; output: one weight per filter."""

    embed: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    output: np.ndarray
    intercept: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    by_language: dict[str, float] = field(default_factory=dict)

    def _padded(self, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of all words, two zero vectors behind each text, and where each text begins."""
        gap = max(WIDTHS) - 1
        starts = np.concatenate([[0], np.cumsum(counts + gap)])[:-1]
        place = np.arange(len(rows)) + np.repeat(starts - np.concatenate([[0], np.cumsum(counts)])[:-1], counts)
        vectors = np.zeros((len(rows) + gap * len(counts) + gap, SIZE), dtype=np.float32)
        total = self.embed[0][rows[:, 0]]
        for k in range(1, TABLES):
            total = total + self.embed[k][rows[:, k]]
        vectors[place] = total
        return vectors, starts

    def answers(self, width: int, vectors: np.ndarray) -> np.ndarray:
        """Filter answers at every place; at the last places the window runs into the padding."""
        size = len(vectors) - max(WIDTHS) + 1
        total = vectors[:size] @ self.filters[width][0]
        for o in range(1, width):
            total += vectors[o:o + size] @ self.filters[width][o]
        return np.maximum(total + self.bias[width], 0)

    def logits(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(counts):
            return np.zeros(0)
        vectors, starts = self._padded(rows, counts)
        pooled = [np.maximum.reduceat(self.answers(w, vectors), starts, axis=0) for w in WIDTHS]
        return np.concatenate(pooled, axis=1).astype(np.float64) @ self.output + self.intercept

    def scores(self, texts: pa.Array) -> np.ndarray:
        logits = self.slope * self.logits(*word_rows(texts)) + self.shift
        return 1 / (1 + np.exp(-np.clip(logits, -50, 50)))


def _start(yes: np.ndarray, no: np.ndarray, share: float) -> Network:
    """Log-odds of each row (texts with a word of it, toxic against other) in dimension 0, small noise elsewhere.
    `share`: other texts for each toxic one."""
    draw = np.random.default_rng(7)
    embed = draw.normal(0, 0.01, (TABLES, ROWS, SIZE)).astype(np.float32)
    embed[:, :, 0] += np.log((yes + 2) / (no + 2 * share) * share) / (2 * TABLES)
    filters = {w: draw.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, 0] += 0.5 / w
    return Network(embed, filters, {w: np.full(FILTERS, -0.1, np.float32) for w in WIDTHS},
                   draw.normal(0.3, 0.05, len(WIDTHS) * FILTERS), 0.0)


def _no_sums(net: Network) -> dict:
    """Squared gradients so far, of each weight (of an embedding row: one number)."""
    return {"embed": np.full((TABLES, ROWS), 1e-3, np.float32), "output": np.full(len(net.output), 1e-3), "cut": 1e-3,
            **{w: np.full(net.filters[w].shape, 1e-3, np.float32) for w in WIDTHS},
            **{-w: np.full(FILTERS, 1e-3, np.float32) for w in WIDTHS}}


def _pack(net: Network, sums: dict) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows, each with its sum behind it, and all other weights and sums in one row."""
    rows = np.concatenate([net.embed.reshape(-1, SIZE), sums["embed"].reshape(-1, 1)], axis=1).astype(np.float64)
    return rows, _rest(net, sums)


def _rest(net: Network, sums: dict) -> np.ndarray:
    rest = [*(x.ravel() for w in WIDTHS for x in (net.filters[w], net.bias[w], sums[w], sums[-w])),
            net.output, sums["output"], [net.intercept, sums["cut"]]]
    return np.concatenate(rest).astype(np.float64)


def _unpack(rows: np.ndarray, rest: np.ndarray) -> tuple[Network, dict]:
    at, sums = 0, {"embed": rows[:, SIZE].astype(np.float32).reshape(TABLES, ROWS)}

    def take(*shape: int) -> np.ndarray:
        nonlocal at
        at += int(np.prod(shape))
        return rest[at - int(np.prod(shape)):at].reshape(shape)

    filters, bias = {}, {}
    for w in WIDTHS:
        filters[w], bias[w] = take(w, SIZE, FILTERS).astype(np.float32), take(FILTERS).astype(np.float32)
        sums[w], sums[-w] = take(w, SIZE, FILTERS).astype(np.float32), take(FILTERS).astype(np.float32)
    output, sums["output"] = take(len(WIDTHS) * FILTERS).copy(), take(len(WIDTHS) * FILTERS).copy()
    intercept, sums["cut"] = (float(x) for x in take(2))
    return Network(rows[:, :SIZE].astype(np.float32).reshape(TABLES, ROWS, SIZE), filters, bias, output, intercept), sums


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Table rows of the words, words of each text and labels, about `TRAIN_WORDS` words at a time."""
    held: list[tuple] = []
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            held.append((*word_rows(part.column("text")), np.asarray(part.column("toxic")) == 1))
            if sum(len(rows) for rows, _, _ in held) >= TRAIN_WORDS:
                yield _taken(held)
    if held:
        yield _taken(held)


def _taken(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts joined; the list is empty behind it, so that they are not in memory twice while the block is used."""
    block = tuple(np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    return block


def _row_counts(learn: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Toxic and other texts with a word of each table row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yes, no = np.zeros(TABLES * ROWS, np.int64), np.zeros(TABLES * ROWS, np.int64)
        for rows, counts, toxic in _blocks(batches):
            ends, some = np.cumsum(counts), 256
            for at in range(0, len(counts), some):
                few = slice(at, at + some)
                begin, end = ends[at] - counts[at], ends[few][-1]
                owner = np.repeat(np.arange(len(counts[few])), counts[few])
                for k in range(TABLES):
                    seen = np.unique(owner * ROWS + rows[begin:end, k])
                    bad = toxic[few][seen // ROWS]
                    yes[k * ROWS:(k + 1) * ROWS] += np.bincount(seen[bad] % ROWS, minlength=ROWS)
                    no[k * ROWS:(k + 1) * ROWS] += np.bincount(seen[~bad] % ROWS, minlength=ROWS)
        slot = np.flatnonzero(yes + no)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(yes[slot]), pa.array(no[slot])], names=["slot", "yes", "no"])

    found = learn.select("text", "toxic").mapInArrow(run, "slot long, yes long, no long").groupBy("slot").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).toArrow()
    counts = np.zeros((2, TABLES * ROWS))
    counts[:, np.asarray(found["slot"])] = np.stack([np.asarray(found["yes"]), np.asarray(found["no"])])
    return counts[0].reshape(TABLES, ROWS), counts[1].reshape(TABLES, ROWS)


def train(learn: DataFrame, clean: int, bad: int) -> Network:
    """Gradient descent with one step size per weight (Adagrad) on the log loss, the tasks' changes averaged in each round.
    learn: `text` and `toxic` of all rows to learn from, of which `bad` are toxic and `clean` are not."""
    net = _start(*_row_counts(learn), clean / bad)
    rows, rest = _pack(net, _no_sums(net))
    for turn in range(EPOCHS):
        shared = learn.sparkSession.sparkContext.broadcast((rows.astype(np.float32), rest))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            rows, rest = shared.value
            net, sums = _unpack(rows, rest)
            draw, met = np.random.default_rng(11 + turn), False
            for few, counts, toxic in _blocks(batches):
                met, ends = True, np.cumsum(counts)
                order = draw.permutation(len(counts))
                for at in range(0, len(order), BATCH):
                    batch = order[at:at + BATCH]
                    _step(net, sums, np.concatenate([few[ends[i] - counts[i]:ends[i]] for i in batch]), counts[batch], toxic[batch])
            if not met:
                return
            # Column by column, in double precision only what has changed: no second copy of the network.
            new = [*net.embed.reshape(-1, SIZE).T, sums["embed"].ravel()]
            moved = np.zeros(len(rows), dtype=bool)
            for i, column in enumerate(new):
                moved |= column != rows[:, i]
            slot = np.flatnonzero(moved)
            values = [pa.array(np.append(c[slot].astype(np.float64) - rows[slot, i], 0.0)) for i, c in enumerate(new)]
            tail = pa.array([None] * len(slot) + [(_rest(net, sums) - rest).tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(slot, -1)), *values, tail], names=["slot", *(f"c{i}" for i in range(SIZE + 1)), "tail"])

        columns = [f"c{i}" for i in range(SIZE + 1)]
        moved = kept_table(learn.select("text", "toxic").mapInArrow(run, f"slot long, {', '.join(f'{c} double' for c in columns)}, tail array<double>"), "toxicity-round")
        means = moved.where("slot >= 0").groupBy("slot").agg(*[F.avg(c).alias(c) for c in columns]).toArrow()
        tail = moved.where("slot < 0").select(F.posexplode("tail")).groupBy("pos").agg(F.avg("col").alias("col")).toArrow()
        rows[np.asarray(means["slot"])] += np.stack([np.asarray(means[c]) for c in columns], axis=1)
        rest[np.asarray(tail["pos"])] += np.asarray(tail["col"])
        shared.unpersist()
    return _unpack(rows, rest)[0]


def _step(net: Network, sums: dict, rows: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> None:
    vectors, starts = net._padded(rows, counts)
    texts, gap = len(counts), max(WIDTHS) - 1
    owner = np.repeat(np.arange(texts), counts + gap)
    row_of = np.full(len(vectors), -1, dtype=np.int64)
    row_of[np.arange(len(rows)) + np.repeat(starts - np.concatenate([[0], np.cumsum(counts)])[:-1], counts)] = np.arange(len(rows))
    pooled, places = {}, {}
    for w in WIDTHS:
        answer = net.answers(w, vectors)
        best = np.maximum.reduceat(answer, starts, axis=0)
        t, f = np.nonzero(answer == best[owner[:len(answer)]])
        first = np.full((texts, FILTERS), -1, dtype=np.int64)
        first[owner[t[::-1]], f[::-1]] = t[::-1]
        pooled[w], places[w] = best, first
    hidden = np.concatenate([pooled[w] for w in WIDTHS], axis=1).astype(np.float64)
    logit = np.clip(hidden @ net.output + net.intercept, -30, 30)
    error = (1 / (1 + np.exp(-logit)) - toxic) / texts
    back = error[:, None] * net.output
    slope = error @ hidden
    touched, moves = [], []
    for i, w in enumerate(WIDTHS):
        delta = (back[:, i * FILTERS:(i + 1) * FILTERS] * (pooled[w] > 0)).astype(np.float32)
        change = np.zeros_like(net.filters[w])
        for o in range(w):
            at = places[w] + o
            change[o] = np.einsum("bfs,bf->sf", vectors[at], delta)
            inside = (row_of[at] >= 0) & (delta != 0)
            touched.append(row_of[at][inside])
            moves.append((delta[:, :, None] * net.filters[w][o].T[None])[inside])
        _move(net.filters[w], sums[w], change)
        _move(net.bias[w], sums[-w], delta.sum(axis=0))
    _move(net.output, sums["output"], slope)
    cut = error.sum()
    sums["cut"] += cut * cut
    net.intercept -= RATE * cut / np.sqrt(sums["cut"])
    touched, moves = np.concatenate(touched), np.concatenate(moves)
    for k in range(TABLES):
        which, back_to = np.unique(rows[touched, k], return_inverse=True)
        grown = np.zeros((len(which), SIZE), np.float32)
        np.add.at(grown, back_to, moves)
        sums["embed"][k, which] += (grown ** 2).mean(axis=1)
        net.embed[k, which] -= RATE * grown / np.sqrt(sums["embed"][k, which])[:, None]


def _move(weights: np.ndarray, sums: np.ndarray, gradient: np.ndarray) -> None:
    sums += gradient ** 2
    weights -= RATE * gradient / np.sqrt(sums)


def calibrate(held: DataFrame) -> tuple[float, float]:
    """slope and shift of the weighted logistic fit of `truth` on `logit` (Newton, lightly held to slope 1); a step is one
    sum over all rows."""
    a, b = 1.0, 0.0
    for _ in range(50):
        at = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") * a + b))
        off = held.select("logit", "weight", "truth", (1 / (1 + F.exp(-at))).alias("p")).select(
            "logit", (F.col("weight") * (F.col("p") - F.col("truth"))).alias("e"), (F.col("weight") * F.col("p") * (1 - F.col("p"))).alias("c"))
        r = off.agg(F.sum(F.col("e") * F.col("logit")), F.sum("e"), F.sum(F.col("c") * F.col("logit") ** 2), F.sum(F.col("c") * F.col("logit")), F.sum("c")).first()
        gradient = np.array([r[0] + 0.1 * (a - 1), r[1] + 0.01 * b])
        move = np.linalg.solve(np.array([[r[2] + 0.1, r[3]], [r[3], r[4] + 0.01]]), gradient)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-6:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def best_thresholds(held: DataFrame) -> dict[str, float]:
    """For each `name`, the middle of the gap between scores at which the weighted F1 of the toxic class is highest; names
    with fewer than `LEAST_LANGUAGE` rows or one class only have none, '' has one anyway. Scores are summed in
    `SCORE_BINS` bins, so that the rows that are put in order do not grow with the input."""
    hit = F.col("weight") * F.col("truth")
    bins = held.groupBy("name", F.floor(F.col("score") * SCORE_BINS).alias("bin")).agg(
        F.sum(hit).alias("hit"), F.sum("weight").alias("all"), F.sum("truth").alias("toxic"), F.count("*").alias("n"),
        F.min("score").alias("least"), F.max("score").alias("most"))
    whole, down = Window.partitionBy("name"), Window.partitionBy("name").orderBy(F.desc("bin"))
    f1 = 2 * F.sum("hit").over(down) / (F.sum("all").over(down) + F.sum("hit").over(whole))
    cut = (F.col("least") + F.coalesce(F.lead("most").over(down), F.lit(0.0))) / 2
    best = bins.select("name", "bin", "toxic", "n", f1.alias("f1"), cut.alias("cut")).groupBy("name").agg(
        F.max_by("cut", F.struct("f1", "bin")).alias("cut"), F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    kept = (F.col("name") == "") | ((F.col("n") >= LEAST_LANGUAGE) & (F.col("toxic") > 0) & (F.col("toxic") < F.col("n")))
    return {r["name"]: r["cut"] for r in best.where(kept).collect()}


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """`doc_id`, `lang`, `text`, `toxic` of all training rows, equal ones once, with `check` for the rows that are kept from
    the weights, in files of about `SHARD_ROWS` rows; and the number of clean and toxic labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & (remainder("doc_id", HELD_DIVISOR) != HELD_REMAINDER))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        F.coalesce(F.col("lang").cast("string") if "lang" in docs.columns else F.lit(""), F.lit("")).alias("lang"))
    order = F.xxhash64("doc_id")
    rows = texts.join(known, "doc_id").select("*", order.alias("order"), F.xxhash64("text").alias("tie"),
                                              (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 4).alias("check"))
    files = max(1, -(-sum(count.values()) // SHARD_ROWS))
    rows = rows.dropDuplicates(["doc_id", "lang", "tie"]).repartition(files, "order").sortWithinPartitions("order", "doc_id", "tie", "lang")
    return kept_table(rows.drop("order", "tie"), "toxicity-rows"), count.get(0, 0), count.get(1, 0)


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    rows, clean, bad = _labelled(docs, labels)
    found = {(r["check"], r["toxic"]): r["n"] for r in rows.groupBy("check", "toxic").agg(F.count("*").alias("n")).collect()}
    every = [sum(found.get((c, kind), 0) for c in (True, False)) for kind in (0, 1)]
    if sum(every) < 10 or not all(every):
        share = bad / (clean + bad) if clean + bad else 0.0
        net = Network(np.zeros((TABLES, 1, SIZE), np.float32), {}, {}, np.zeros(0))
        net.threshold, net.shift = 1.1, float(share)
        return net
    learn, check = rows.where(~F.col("check")), rows.where("check")
    learnt, held = ([found.get((c, kind), 0) for kind in (0, 1)] for c in (False, True))
    if not all(learnt) or not all(held):
        learn, check, learnt, held = rows, rows, every, every
    net = train(learn, *learnt)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def logit(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        parts = [shared.value.logits(*word_rows(part.column("text"))) for part in slices(batch, limit=SLICE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    each = [clean / held[0], bad / held[1]]
    scale = sum(held) / (clean + bad)
    judged = kept_table(check.select("lang", F.col("toxic").alias("truth"), logit("text").alias("logit")).withColumn(
        "weight", F.when(F.col("truth") == 1, each[1] * scale).otherwise(each[0] * scale)), "toxicity-held")
    net.slope, net.shift = calibrate(judged)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col("logit") * net.slope + net.shift))))
    scored = judged.select("weight", "truth", score.alias("score"), F.explode(F.array_distinct(F.array(F.lit(""), "lang"))).alias("name"))
    net.by_language = best_thresholds(scored)
    net.threshold = net.by_language.pop("")
    return net


def score_texts(net: Network, texts: pa.Array) -> np.ndarray:
    if not net.filters:
        return np.full(len(texts), net.shift)
    return net.scores(texts)


def scorer(spark, net: Network):
    """A column function: text to score."""
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        parts = [score_texts(shared.value, part.column(0)) for part in slices(batch, limit=SLICE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score


def threshold_of(net: Network, language: Column) -> Column:
    found = F.lit(net.threshold)
    for name, value in sorted(net.by_language.items()):
        found = F.when(language == name, F.lit(value)).otherwise(found)
    return found


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score`, and `toxic`: whether the score reaches the threshold of the row's language."""
    net = fit(docs, labels)
    score, spoken = scorer(docs.sparkSession, net), F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), spoken.cast("string").alias("lang"),
                       score(F.coalesce("text", F.lit(""))).alias("score"))
    held = F.coalesce(remainder("doc_id", HELD_DIVISOR) == HELD_REMAINDER, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold_of(net, F.col("lang"))).alias("toxic"))


def clean_documents(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, whose score stays below the threshold of their language. The network is fitted
    on `labelled` documents."""
    net, name = fit(labelled, labels), fresh("score")
    spoken = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    scored = docs.withColumn(name, scorer(docs.sparkSession, net)(F.coalesce("text", F.lit(""))))
    return scored.where(F.col(name) < threshold_of(net, spoken)).drop(name)
