"""Log-likelihood of whole documents under a gated recurrent language model, trained here in numpy.

Words are folded to lower case (A-Z); every document ends in an end token. The most frequent `VOCABULARY` words are dealt
into classes of `CLASS` words by frequency; every other word belongs to one of eight open classes (by its last
character, and whether it leaves ASCII). A gated recurrent unit reads the document; at each token it gives the
probability of the token's class and, inside a class of the vocabulary, of the word. Inside an open class a word has its
share of the class's training tokens (one more for each, one for all unknown words). So the probabilities of all words
and one unknown word of each open class add up to 1.

Counts cover all training documents. The recurrent weights are learnt by truncated backpropagation, starting from output
biases that reproduce the counts of the whole corpus: first on `TRAIN_TOKENS` tokens (documents in the order of a hash of
their id), so that all tasks begin near one another, then in one pass over all training documents, in which every task
goes on with its own ones and the weights of the tasks are averaged by their tokens. Scoring carries the state through all windows of a document, in many documents at once;
each task packs its documents into parallel lanes.

The counts of the `COMMON` most frequent words travel to the tasks (a fixed number of them); tokens that are rarer leave
their document as (document, word) pairs, meet their counts in a join, and return as sums.

Cases: a null text reads as empty and holds the end token only; repeated rows have repeated results (and count twice in
training); a null doc_id counts as not held out; without training documents N and V are 0 and the score is the base
score. Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, hash_spans, kept_table, remainder, slices, text_bytes, word_spans

HELD_DIVISOR, HELD_REMAINDER = 7, 2
VOCABULARY, CLASS, OPEN = 2048, 64, 8
COMMON = 131_072
HIDDEN, EMBED = 24, 16
LANES, STEPS = 384, 32
TRAIN_TOKENS, TRAIN_LANES, EPOCHS, RATE = 1_200_000, 48, 2, 0.006
END = np.uint64(0)
LOG10 = math.log(10)


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A key for each word of the texts (a hash whose lowest three bits are the open class), and words of each text."""
    data, offsets = text_bytes(texts)
    begin, end, owner = word_spans(data, offsets)
    keys = hash_spans(data, begin, end) & ~np.uint64(OPEN - 1)
    if len(keys):
        last = data[end - 1]
        kind = np.select([last == ord("."), last == ord(","), (last | 32 >= 97) & (last | 32 <= 122) | (last >= 128)], [1, 2, 0], 3)
        wide = np.concatenate([[0], np.cumsum(data >= 128)])
        keys |= (kind + 4 * (wide[end] > wide[begin])).astype(np.uint64)
        keys[keys == END] += np.uint64(OPEN)
    return keys, np.bincount(owner, minlength=len(texts))


@dataclass
class Words:
    """Common words ascending by key, with their counts and vocabulary ids (-1: none); sums over the open classes."""

    keys: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    total: int
    distinct: int
    open_tokens: np.ndarray
    open_words: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is not common."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def symbols(self, keys: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Vocabulary id, or VOCABULARY + open class."""
        own = self.ids[np.maximum(place, 0)] if len(self.ids) else np.full(len(keys), -1)
        return np.where((place >= 0) & (own >= 0), own, VOCABULARY + (keys & np.uint64(OPEN - 1)).astype(np.int64))


@dataclass
class Model:
    """embed: symbols x EMBED; wx, wh, b: the three gates side by side; wc, bc: classes; ww, bw: words of classes."""

    embed: np.ndarray
    wx: np.ndarray
    wh: np.ndarray
    b: np.ndarray
    wc: np.ndarray
    bc: np.ndarray
    ww: np.ndarray
    bw: np.ndarray

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.wx, self.wh, self.b, self.wc, self.bc, self.ww, self.bw]


def start_model(words: Words) -> Model:
    draw = np.random.default_rng(5)
    normal = lambda *shape: draw.normal(0, 0.1, shape).astype(np.float32)
    inside = words.ids >= 0
    counts = np.zeros(VOCABULARY)
    counts[words.ids[inside]] = words.counts[inside]
    held = np.concatenate([counts.reshape(-1, CLASS).sum(axis=1), words.open_tokens + words.open_words])
    bc = np.log((held + 1) / (held + 1).sum()).astype(np.float32)
    # Places of the vocabulary that no word fills get next to no probability.
    bw = np.log(np.maximum(counts, 1e-9)).astype(np.float32)
    bw -= np.repeat(bw.reshape(-1, CLASS).max(axis=1), CLASS)
    return Model(normal(VOCABULARY + OPEN, EMBED), normal(EMBED, 3 * HIDDEN), normal(HIDDEN, 3 * HIDDEN),
                 np.zeros(3 * HIDDEN, np.float32), normal(HIDDEN, len(bc)) * 0.1, bc, normal(VOCABULARY, HIDDEN) * 0.1, bw)


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt into lanes, longest first into the emptiest; lanes by falling load."""
    heap = [(0, i) for i in range(min(lanes, len(lengths)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable").tolist():
        load, lane = heapq.heappop(heap)
        dealt[lane].append(d)
        heapq.heappush(heap, (load + int(lengths[d]), lane))
    return [dealt[lane] for _, lane in sorted(heap, reverse=True)]


def _laid(lanes: list[list[np.ndarray]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of each lane, one behind the other, as a row that ends in -1; and the length of each lane."""
    loads = np.array([sum(map(len, lane)) for lane in lanes])
    rows = np.full((len(lanes), int(loads.max())), -1, dtype=kind)
    for row, lane, load in zip(rows, lanes, loads.tolist()):
        np.concatenate(lane, out=row[:load], casting="unsafe")
    return rows, loads


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Room:
    """Arrays by name that one window after the other uses: memory new from the system costs more than the sums in it."""

    def __init__(self, kind: np.dtype) -> None:
        self.kind, self.held = kind, {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, self.kind)
        return self.held[name][:size].reshape(shape)


def _softmax(x: np.ndarray) -> np.ndarray:
    """In the place of x."""
    x = np.exp(_shifted(x)[0], out=x)
    x *= np.reciprocal(x @ np.ones(x.shape[1], np.float32))[:, None]
    return x


def _shifted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray | np.float32]:
    """x without its rows' maxima, and these; as it is, and 0, where no value is far enough from 0 for exp to need that."""
    if not x.size or max(x.max(), -x.min()) < 60:
        return x, np.float32(0)
    top = x.max(axis=1)
    return x - top[:, None], top


def score_symbols(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each document's symbols (open classes: of the class alone). symbols: all
    documents, each ended by symbol 0, one behind the other."""
    result = np.zeros(len(lengths))
    if not len(lengths):
        return result
    ends = np.cumsum(lengths)
    lanes = lanes_of(lengths, LANES)
    every, loads = _laid([[symbols[ends[d] - lengths[d]:ends[d]] for d in lane] for lane in lanes], np.int16)
    owners, _ = _laid([[np.repeat(lane, lengths[lane])] for lane in lanes], np.int32)
    width, steps = every.shape
    table = (model.embed @ model.wx + model.b).astype(np.float32)
    h = np.zeros((width, HIDDEN), np.float32)
    before = np.zeros(width, dtype=np.int64)
    for at in range(0, steps, STEPS):
        active = int((loads > at).sum())
        target = every[:active, at:at + STEPS].astype(np.int64)
        owner = owners[:active, at:at + STEPS]
        most = target.shape[1]
        given = np.concatenate([before[None, :active], target[:, :-1].T])
        gates, fresh = table[np.maximum(given, 0)], (given != 0).astype(np.float32)[:, :, None]
        states = np.empty((most, active, HIDDEN), np.float32)
        now = h[:active]
        for t in range(most):
            # Symbol 0 ends a document: the next one starts from an empty state.
            now = now * fresh[t]
            back = now @ model.wh
            zr = _sigmoid(gates[t, :, :2 * HIDDEN] + back[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(gates[t, :, 2 * HIDDEN:] + r * back[:, 2 * HIDDEN:])
            now = new + z * (now - new)
            states[t] = now
        h[:active], before[:active] = now, target[:, -1]
        real = target.T.ravel() >= 0
        goal, doc = target.T.ravel()[real], owner.T.ravel()[real]
        found = _outputs(model, states.reshape(-1, HIDDEN)[real], goal)
        result += np.bincount(doc, weights=found, minlength=len(lengths))
    return result


def _outputs(model: Model, states: np.ndarray, goal: np.ndarray) -> np.ndarray:
    group = np.where(goal < VOCABULARY, goal // CLASS, VOCABULARY // CLASS + goal - VOCABULARY)
    logits = states @ model.wc + model.bc
    total = logits[np.arange(len(goal)), group] - _log_sum(logits)
    own, edges = _by_class(group)
    inner = _inside(model, states[own], edges, np.empty((len(own), CLASS), states.dtype))
    total[own] += inner[np.arange(len(own)), goal[own] % CLASS] - _log_sum(inner)
    return total


def _by_class(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose word lies in a class of the vocabulary, by class, and where each class begins and ends."""
    order = np.argsort(group.astype(np.int16), kind="stable")
    edges = np.searchsorted(group[order], np.arange(VOCABULARY // CLASS + 1))
    return order[:edges[-1]], edges


def _inside(model: Model, states: np.ndarray, edges: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Logits of the words of each row's class, in `inner`. states: rows by class."""
    for c in np.flatnonzero(np.diff(edges)).tolist():
        rows, words = slice(edges[c], edges[c + 1]), slice(c * CLASS, (c + 1) * CLASS)
        np.matmul(states[rows], model.ww[words].T, out=inner[rows])
        inner[rows] += model.bw[words]
    return inner


def _log_sum(x: np.ndarray) -> np.ndarray:
    x, top = _shifted(x)
    return top + np.log(np.exp(x) @ np.ones(x.shape[1], np.float32))


def train(words: Words, documents: list[np.ndarray]) -> Model:
    """Truncated backpropagation: windows of `STEPS` symbols in `TRAIN_LANES` lanes, states carried, Adam."""
    model = start_model(words)
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    if not len(lengths):
        return model
    moments, turn = _moments(model), 0
    for epoch in range(EPOCHS):
        turn = _epoch(model, moments, turn, documents, 0.3 if epoch else 1.0, TRAIN_LANES)
    return model


def _moments(model: Model) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.zeros_like(p), np.zeros_like(p)) for p in model.parts]


def _epoch(model: Model, moments: list, turn: int, documents: list[np.ndarray], pace: float, width: int) -> int:
    lanes = lanes_of(np.array([len(d) for d in documents], dtype=np.int64), width)
    symbols, loads = _laid([[documents[d] for d in lane] for lane in lanes], np.int16)
    h, before, room = np.zeros((len(lanes), HIDDEN), np.float32), np.zeros(len(lanes), dtype=np.int64), Room(model.b.dtype)
    for at in range(0, symbols.shape[1], STEPS):
        active = int((loads > at).sum())
        target = np.full((active, STEPS), -1, dtype=np.int64)
        piece = symbols[:active, at:at + STEPS]
        target[:, :piece.shape[1]] = piece
        given = np.concatenate([before[:active, None], target[:, :-1]], axis=1)
        gradients, h[:active] = _window(model, given, target, h[:active], room)
        before[:active] = target[:, -1]
        turn += 1
        rate = RATE * pace * math.sqrt(1 - 0.999 ** turn) / (1 - 0.9 ** turn)
        for p, g, (m, v) in zip(model.parts, gradients, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * m / (np.sqrt(v) + 1e-7)
    return turn


def refine(docs: DataFrame, words: Words, model: Model) -> Model:
    """The model after one pass over all training documents, `TRAIN_TOKENS` of a task in memory at a time."""
    shared = docs.sparkSession.sparkContext.broadcast((words, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = shared.value
        model = Model(*(p.copy() for p in start.parts))
        moments, turn, held, size, seen = _moments(model), 0, [], 0, 0
        for batch in batches:
            for part in slices(batch):
                keys, counts = word_keys(part.column("text"))
                symbols, ends = words.symbols(keys, words.find(keys)), np.cumsum(counts)
                held += [np.append(symbols[e - c:e], 0) for c, e in zip(counts, ends)]
                size += len(symbols) + len(counts)
                if size >= TRAIN_TOKENS:
                    turn, held, size, seen = _epoch(model, moments, turn, held, 0.6, LANES), [], 0, seen + size
        if held:
            turn, seen = _epoch(model, moments, turn, held, 0.6, LANES), seen + size
        if seen:
            flat = np.concatenate([p.ravel() for p in model.parts]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["n", "weights"])

    learnt = documents_of(docs).where(F.coalesce(remainder("doc_id", HELD_DIVISOR) != HELD_REMAINDER, F.lit(True)))
    each = kept_table(learnt.select("text").mapInArrow(run, "n long, weights array<double>"), "lm-weights")
    means = each.select("n", F.posexplode("weights")).groupBy("pos").agg((F.sum(F.col("n") * F.col("col")) / F.sum("n")).alias("mean")).toArrow()
    shared.unpersist()
    if not len(means):
        return model
    flat, at, parts = np.zeros(len(means)), 0, []
    flat[np.asarray(means["pos"])] = np.asarray(means["mean"])
    for p in model.parts:
        parts.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return Model(*parts)


def _window(model: Model, given: np.ndarray, target: np.ndarray, h: np.ndarray, room: Room | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Gradients of the mean log loss over one window, and the state after it."""
    width, steps = given.shape
    n, size, room = HIDDEN, width * steps, room or Room(model.b.dtype)
    # All that does not depend on the step before it is done for the whole window at once, step by step in memory.
    given = given.T
    seen, fresh = np.maximum(given, 0).ravel(), (given != 0).astype(np.float32)[:, :, None]
    x = np.take(model.embed, seen, axis=0, out=room("x", size, EMBED), mode="clip")
    gates = np.matmul(x, model.wx, out=room("gates", size, 3 * n))
    gates += model.b
    gates = gates.reshape(steps, width, 3 * n)
    old, zr, inner, new, states = (room(name, steps, width, k) for name, k in (("old", n), ("zr", 2 * n), ("inner", n), ("new", n), ("states", n)))
    z, r = zr[:, :, :n], zr[:, :, n:]
    for t in range(steps):
        np.multiply(h, fresh[t], out=old[t])
        back = old[t] @ model.wh
        both = np.add(gates[t, :, :2 * n], back[:, :2 * n], out=zr[t])
        both *= 0.5
        np.tanh(both, out=both)
        both *= 0.5
        both += 0.5
        inner[t] = back[:, 2 * n:]
        now = np.multiply(r[t], inner[t], out=new[t])
        now += gates[t, :, 2 * n:]
        np.tanh(now, out=now)
        h = np.subtract(old[t], now, out=states[t])
        h *= z[t]
        h += now
    end = h.copy()
    goal = target.T.ravel()
    rows = np.flatnonzero(goal >= 0)
    flat, goal = np.take(states.reshape(-1, n), rows, axis=0, out=room("flat", len(rows), n), mode="clip"), goal[rows]
    scale = np.float32(1 / max(1, len(rows)))
    group = np.where(goal < VOCABULARY, goal // CLASS, VOCABULARY // CLASS + goal - VOCABULARY)
    wrong = np.matmul(flat, model.wc, out=room("wrong", len(rows), len(model.bc)))
    wrong += model.bc
    wrong = _softmax(wrong)
    wrong[np.arange(len(goal)), group] -= 1
    wrong *= scale
    g_wc, g_bc, g_flat = flat.T @ wrong, wrong.sum(axis=0), np.matmul(wrong, model.wc.T, out=room("g_flat", len(rows), n))
    g_ww, g_bw = np.zeros_like(model.ww), np.zeros_like(model.bw)
    own, edges = _by_class(group)
    mine = np.take(flat, own, axis=0, out=room("mine", len(own), n), mode="clip")
    off = _softmax(_inside(model, mine, edges, room("off", len(own), CLASS)))
    off[np.arange(len(own)), goal[own] % CLASS] -= 1
    off *= scale
    g_mine = room("g_mine", len(own), n)
    for c in np.flatnonzero(np.diff(edges)).tolist():
        part, words = slice(edges[c], edges[c + 1]), slice(c * CLASS, (c + 1) * CLASS)
        g_ww[words], g_bw[words] = off[part].T @ mine[part], off[part].sum(axis=0)
        np.matmul(off[part], model.ww[words], out=g_mine[part])
    g_flat[own] += g_mine
    g_states = room("g_states", size, n)
    g_states[:] = 0
    g_states[rows] = g_flat
    g_states = g_states.reshape(steps, width, n)
    # What a step's gradient is multiplied by on its way to each gate, in the places of values used up by it.
    to_z = np.subtract(old, new, out=room("to_z", steps, width, n))
    to_z *= z
    rest = np.subtract(1, z, out=room("rest", steps, width, n))
    to_z *= rest
    to_new = np.multiply(new, new, out=new)
    np.subtract(1, to_new, out=to_new)
    to_new *= rest
    to_r = np.multiply(inner, r, out=inner)
    to_r *= np.subtract(1, r, out=rest)
    d_gates, d_back = (room(name, steps, width, 3 * n) for name in ("gates", "d_back"))
    g_h = np.zeros((width, n), np.float32)
    for t in range(steps - 1, -1, -1):
        g_h += g_states[t]
        d_new = np.multiply(g_h, to_new[t], out=d_gates[t, :, 2 * n:])
        np.multiply(g_h, to_z[t], out=d_gates[t, :, :n])
        np.multiply(d_new, to_r[t], out=d_gates[t, :, n:2 * n])
        d_back[t, :, :2 * n] = d_gates[t, :, :2 * n]
        np.multiply(d_new, r[t], out=d_back[t, :, 2 * n:])
        g_h *= z[t]
        g_h += d_back[t] @ model.wh.T
        g_h *= fresh[t]
    g_wx = np.matmul(x.reshape(steps, width, -1).transpose(0, 2, 1), d_gates).sum(axis=0)
    g_wh = np.matmul(old.transpose(0, 2, 1), d_back).sum(axis=0)
    d_gates = d_gates.reshape(-1, 3 * n)
    g_b = np.ones(size, np.float32) @ d_gates
    g_embed = np.zeros_like(model.embed)
    order = np.argsort(seen.astype(np.int16), kind="stable")
    first = np.flatnonzero(np.diff(seen[order], prepend=-1))
    d_x = np.matmul(d_gates, model.wx.T, out=x)
    g_embed[seen[order[first]]] = np.add.reduceat(np.take(d_x, order, axis=0, out=room("sorted", size, EMBED), mode="clip"), first, axis=0)
    gradients = [g_embed, g_wx, g_wh, g_b, g_wc, g_bc, g_ww, g_bw]
    norm = math.sqrt(sum(float((g * g).sum()) for g in gradients))
    if norm > 1:
        gradients = [g / np.float32(norm) for g in gradients]
    return gradients, end


def count_words(docs: DataFrame) -> DataFrame:
    """`key`, `n`: tokens of each word (and of the end token) in all training documents."""
    learnt = documents_of(docs).where(F.coalesce(remainder("doc_id", HELD_DIVISOR) != HELD_REMAINDER, F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [word_keys(part.column("text"))[0] for part in slices(batch)]
            distinct, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(distinct, END).view(np.int64)), pa.array(np.append(counts, len(batch)))], names=["key", "n"])

    partial = learnt.mapInArrow(run, "key long, n long")
    return partial.groupBy("key").agg(F.sum("n").alias("n"))


def common_words(counts: DataFrame) -> Words:
    """The words that travel to the tasks; everything the driver gets is of fixed size."""
    top = counts.orderBy(F.desc("n"), "key").limit(COMMON).toPandas()
    keys, n = top["key"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    ids = np.full(len(keys), -1, dtype=np.int64)
    order = [*np.flatnonzero(keys == END), *np.flatnonzero(keys != END)][:VOCABULARY]
    ids[order] = np.arange(len(order))
    by_key = np.argsort(keys)
    keys, n, ids = keys[by_key], n[by_key], ids[by_key]
    sums = counts.groupBy(F.col("key").bitwiseAND(OPEN - 1).alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tokens, distinct = np.zeros(OPEN), np.zeros(OPEN)
    for r in sums:
        tokens[r["kind"]], distinct[r["kind"]] = r["n"], r["v"]
    total, different = int(tokens.sum()), int(distinct.sum())
    kind = (keys & np.uint64(OPEN - 1)).astype(np.int64)
    inside = ids >= 0
    return Words(keys, n, ids, total, different, tokens - np.bincount(kind[inside], weights=n[inside], minlength=OPEN),
                 distinct - np.bincount(kind[inside], minlength=OPEN))


def sample_symbols(docs: DataFrame, words: Words) -> list[np.ndarray]:
    """Symbols of training documents in the order of a hash of their id, `TRAIN_TOKENS` of them at most, to begin with."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    rows = documents_of(docs).where(F.coalesce(remainder("doc_id", HELD_DIVISOR) != HELD_REMAINDER, F.lit(True)))
    rows = rows.select("text", F.xxhash64("doc_id", "text").alias("place"))
    # As many documents as surely hold enough tokens are not known; a quarter of the bound is at hand for short ones.
    few = rows.orderBy("place").limit(TRAIN_TOKENS // 300)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, counts = word_keys(part.column("text"))
                symbols = shared.value.symbols(keys, shared.value.find(keys)).astype(np.int16)
                ends = np.cumsum(counts)
                rows = [symbols[e - c:e].tobytes() for c, e in zip(counts, ends)]
                yield pa.RecordBatch.from_arrays([part.column("place"), pa.array(rows, pa.binary())], names=["place", "symbols"])

    taken, held = [], 0
    for r in sorted(few.mapInArrow(run, "place long, symbols binary").collect()):
        document = np.append(np.frombuffer(r["symbols"], dtype=np.int16).astype(np.int64), 0)
        document = document[:max(1, TRAIN_TOKENS - held)]
        held += len(document)
        taken.append(document)
        if held >= TRAIN_TOKENS:
            break
    return taken


SCORED = ("row long, doc_id long, n_tokens long, n_known long, base double, model double, rare array<long>")


def _scored(docs: DataFrame, words: Words, model: Model) -> DataFrame:
    """What a document's own task can tell: sums over its common tokens, and the keys of the others."""
    shared = docs.sparkSession.sparkContext.broadcast((words, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shared.value
        row = TaskContext.get().partitionId() << 40
        unit = math.log10(words.total + words.distinct + 1)
        inner = np.log10(words.open_tokens + words.open_words + 1)
        end = words.find(np.array([END]))[0]
        base_of = np.log10(words.counts + 1.0) - unit
        open_of = np.log10(words.counts + 1.0) - inner[(words.keys & np.uint64(OPEN - 1)).astype(np.int64)]
        open_of[words.ids >= 0] = 0
        for batch in batches:
            symbols, lengths, known, base, more, rare = [], [], [], [], [], []
            for part in slices(batch):
                keys, counts = word_keys(part.column("text"))
                place = words.find(keys)
                owner = np.repeat(np.arange(len(counts)), counts)
                here = place >= 0
                sums = lambda values: np.bincount(owner[here], weights=values[place[here]], minlength=len(counts))
                known.append(np.bincount(owner[here], minlength=len(counts)) + (end >= 0))
                base.append(sums(base_of) + (base_of[end] if end >= 0 else -unit))
                more.append(sums(open_of))
                ends = np.cumsum(counts)
                symbols.append(np.insert(words.symbols(keys, place), ends, 0).astype(np.int16))
                lengths.append(counts + 1)
                left = np.bincount(owner[~here], minlength=len(counts))
                rare.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(left)].astype(np.int32)),
                                                     pa.array(keys[~here].view(np.int64))))
            if not lengths:
                continue
            lengths = np.concatenate(lengths)
            learnt = score_symbols(model, np.concatenate(symbols).astype(np.int64), lengths) / LOG10 + np.concatenate(more)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(lengths))), batch.column("doc_id"), pa.array(lengths), pa.array(np.concatenate(known)),
                 pa.array(np.concatenate(base)), pa.array(learnt), pa.concat_arrays(rare)],
                names=["row", "doc_id", "n_tokens", "n_known", "base", "model", "rare"])
            row += len(lengths)

    return documents_of(docs).mapInArrow(run, SCORED)


def score_documents(docs: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` of every document."""
    counts = kept_table(count_words(docs), "lm-counts")
    words = common_words(counts)
    model = refine(docs, words, train(words, sample_symbols(docs, words)))
    rows = kept_table(_scored(docs, words, model), "lm-rows")
    unit = math.log10(words.total + words.distinct + 1)
    inner = F.array(*[F.lit(float(x)) for x in np.log10(words.open_tokens + words.open_words + 1)])
    pairs = rows.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("k"))
    found = pairs.join(counts, "key", "left")
    ten = F.log10(F.coalesce("n", F.lit(0)) + 1)
    kind = F.col("key").bitwiseAND(OPEN - 1).cast("int")
    back = found.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * (ten - unit)).alias("more_base"), F.sum(F.col("k") * (ten - F.get(inner, kind))).alias("more_model"))
    joined = rows.drop("rare").join(back, "row", "left")
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0))
    full = F.col("model") + F.coalesce("more_model", F.lit(0.0))
    held = F.coalesce(remainder("doc_id", HELD_DIVISOR) == HELD_REMAINDER, F.lit(False))
    return joined.select("doc_id", held.alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                         F.lit(words.total).cast("long").alias("train_tokens"), base.alias("base_score"),
                         (full if words.total else base).alias("score"))
