"""Near-duplicate documents: one-permutation hashing with optimal densification, bands, star-shaped candidates.

A document is its set of distinct word shingles. Documents with equal sets form a class, and classes are compared: a
one-permutation signature is cut into bands, and classes that share a band's values share a bucket. There are as many
bands as let a pair at the similarity slip with a chance of 10^-7.

Each bucket first proposes a star: its least member against all others, as many pairs as it has members. Pairs are
confirmed on full shingle sets, and confirmed links give connected components. A bucket whose members all lie in one
component is settled. The others may hide links between members that the star's centre does not resemble, so their
members of different components are compared as well: directly in small buckets, after a second signature of longer
bands in crowded ones (documents that merely resemble each other part there), always leaving out what is connected
already. No pair is dropped by a cap; the filters before confirmation (sizes, agreeing bins) leave a margin of eight
standard deviations.

Every step is a join or a grouped aggregate on bucket, node or (centre, salt), and no task holds a bucket or a group
of copies; a centre's partners are dealt into groups. Tables that several steps read are written to the shared folder.

Cases: documents without words (or null) have no shingles, are linked with nothing and are kept; a document with fewer
words than a shingle is one shingle of all its words. Rows that share a doc_id count as one node: what one of them is
linked to, all are. A row without doc_id takes no part: its component is null and it is kept. Only `doc_id` and `text`
are read, so other columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, fresh, kept_table, mix, shuffle_partitions, slices, text_bytes, words_of
from tidemill.llm.components import connected_components

WIDTH, SIMILARITY = 5, 0.8
ROWS, FINE_ROWS = 6, 16
SMALL = 16
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending within the text, and how many each text has."""
    hashes, owner = words_of(*text_bytes(texts))
    count = np.bincount(owner, minlength=len(texts))
    if not len(hashes):
        return hashes, count
    # A text of fewer words than a shingle is one shingle of all its words: the places it lacks stay zero.
    value = np.zeros(len(hashes), dtype=np.uint64)
    for o in range(width):
        follows = np.zeros(len(hashes), dtype=bool)
        follows[:len(hashes) - o] = owner[o:] == owner[:len(hashes) - o]
        ahead = np.where(follows, np.concatenate([hashes[o:], np.zeros(o, np.uint64)]), np.uint64(0))
        value = mix(value * _GOLD + ahead + np.uint64(o))
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(count) - count, count)
    whole = np.repeat(count, count)
    kept = (place == 0) | (place <= whole - width)
    value, owner = value[kept], owner[kept]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    first = np.ones(len(value), dtype=bool)
    first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[first], np.bincount(owner[first], minlength=len(texts))


def signatures(sets: np.ndarray, sizes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation signature of each set (rows x bins): a value falls into one bin, a bin keeps its least value.

    An empty bin borrows from a bin that a hash of (bin, attempt) names, trying on until that one holds a value: equal
    for all sets, so two sets agree in a borrowed bin with the probability of their similarity, independently of the
    other bins. Sets without values have a row of zeros.
    """
    rows = len(sizes)
    least = np.full((rows, bins), np.iinfo(np.uint64).max, dtype=np.uint64)
    owner = np.repeat(np.arange(rows), sizes)
    place = (mix(sets) % np.uint64(bins)).astype(np.int64)
    value = mix(sets ^ _GOLD) >> np.uint64(1)
    cell = owner * bins + place
    order = np.lexsort((value, cell))
    first = np.ones(len(order), dtype=bool)
    first[1:] = cell[order][1:] != cell[order][:-1]
    least.ravel()[cell[order][first]] = value[order][first]
    empty = least == np.iinfo(np.uint64).max
    own, open_row, open_bin = least.copy(), *np.nonzero(empty & (sizes > 0)[:, None])
    attempt = 1
    while len(open_row):
        source = (mix(open_bin.astype(np.uint64) * _GOLD + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        found = ~empty[open_row, source]
        least[open_row[found], open_bin[found]] = mix(own[open_row[found], source[found]] + np.uint64(attempt)) >> np.uint64(1)
        open_row, open_bin, attempt = open_row[~found], open_bin[~found], attempt + 1
    least[sizes == 0] = 0
    return least


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of a signature (rows x bands), different between bands."""
    rows, bins = signature.shape
    parts = signature.reshape(rows, bands, bins // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (rows, bands)).copy()
    for i in range(parts.shape[2]):
        key = mix(key * _GOLD + parts[:, :, i])
    return key


def bands_needed(similarity: float, rows: int, miss: float = 1e-7) -> int:
    """Bands of `rows` values of which two sets of this similarity share at least one but for a chance of `miss`."""
    return math.ceil(math.log(miss) / math.log1p(-similarity ** rows))


SIGNED = "doc_id long, n_shingles long, k1 long, k2 long, keys array<long>, marks binary"


def signed(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """`doc_id`, `n_shingles`, a 128-bit digest of the set, band keys, and one byte of every bin; no text."""
    bands = bands_needed(similarity, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, sizes = shingle_sets(part.column("text"), width)
                least = signatures(sets, sizes, bands * ROWS)
                keys = band_keys(least, bands).view(np.int64)
                marks = (least & np.uint64(0xFF)).astype(np.uint8)
                one = _sums(mix(sets + _GOLD), sizes) + sizes.astype(np.uint64)
                two = _sums(mix(~sets), sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(one.view(np.int64)),
                     pa.array(two.view(np.int64)), pa.FixedSizeListArray.from_arrays(keys.ravel(), bands).cast(pa.list_(pa.int64())),
                     pa.array([m.tobytes() for m in marks], pa.binary())],
                    names=["doc_id", "n_shingles", "k1", "k2", "keys", "marks"])

    return documents_of(docs).mapInArrow(run, SIGNED)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _shared(members: DataFrame) -> DataFrame:
    """members: `key`, `node`. Those whose key more than one node has, with the key's least node `rep` and size `m`."""
    groups = members.groupBy("key").agg(F.min("node").alias("rep"), F.max("node").alias("last"), F.count("*").alias("m"))
    return members.join(groups.where("rep <> last").drop("last"), "key")


def _with_components(members: DataFrame, components: DataFrame) -> DataFrame:
    return members.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))


def cross_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs `a` < `b` that share a key and lie in different components.

    Members of a key's largest component meet only those outside it, so a key whose members are nearly all connected
    costs its few outsiders times its size, and one that is all connected costs nothing.
    """
    parts = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    open_keys = main.where("parts > 1").select("key", F.col("main.component").alias("main"))
    rows = members.join(open_keys, "key").select("key", "node", "component", "main")
    out = rows.where("component <> main").select("key", F.col("node").alias("x"), F.col("component").alias("cx"))
    other = rows.select("key", F.col("node").alias("y"), F.col("component").alias("cy"), (F.col("component") == F.col("main")).alias("inside"))
    # Two outsiders meet once, the lesser first; an outsider meets every member of the largest component.
    met = out.join(other, "key").where("cx <> cy and (inside or x < y)")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _likely(pairs: DataFrame, signs: DataFrame, similarity: float, bins: int) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose signatures agree in about as many bins: eight standard
    deviations are granted, so that no true link goes."""
    least = int(bins * (similarity - 8 * math.sqrt(similarity * (1 - similarity) / bins)))

    @F.arrow_udf("boolean")
    def close(left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.bool_())
        a, b = (np.frombuffer(b"".join(x.to_pylist()), dtype=np.uint8).reshape(len(x), -1) for x in (left, right))
        return pa.array((a == b).sum(axis=1) >= least)

    side = lambda end: signs.select(F.col("node").alias(end), F.col("n_shingles").alias("n" + end), F.col("marks").alias("m" + end))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = joined.where(F.least("na", "nb") >= similarity * 0.999999 * F.greatest("na", "nb"))
    return sized.where(close("ma", "mb")).select("a", "b").distinct()


def verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float, group: int = 256) -> DataFrame:
    """The pairs (`a`, `b`) whose full shingle sets reach the similarity. texts: `node`, `text`.

    Each node `a` meets its partners in groups of about `group`: a node with very many partners is sent to several
    tasks. A task holds one set at a time and streams the partners past it.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / group).alias("groups"))
    dealt = pairs.join(degree, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("groups")))
    asked = dealt.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("role")).union(
        dealt.select(F.col("a"), "a", "salt", F.lit(0)).distinct())
    sent = asked.join(texts, "node").repartition(shuffle_partitions(pairs.sparkSession), "a", "salt")
    percent = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hubs = None, []
        for batch in batches:
            for part in slices(batch):
                sets, sizes = shingle_sets(part.column("text"), width)
                ends, found = np.cumsum(sizes), []
                rows = zip(*(part.column(c).to_pylist() for c in ("a", "salt", "role", "node")), ends.tolist(),
                           sizes.tolist(), strict=True)
                for a, salt, role, node, end, size in rows:
                    own = sets[end - size:end]
                    if role == 0:
                        hubs = [*hubs, own.copy()] if key == (a, salt) else [own.copy()]
                        key = a, salt
                    elif key == (a, salt) and any(_linked(own, hub, percent) for hub in hubs):
                        found.append((a, node))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                        names=["a", "b"])

    return sent.sortWithinPartitions("a", "salt", "role").mapInArrow(run, "a long, b long")


def _linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    few, many = (left, right) if len(left) <= len(right) else (right, left)
    if not len(few):
        return False
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    both = int((many[at] == few).sum())
    return 100 * both >= percent * (len(left) + len(right) - both)


def near_duplicates(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, small: int = SMALL) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept` of every document."""
    rows = kept_table(signed(docs, width, similarity), "minhash-rows")
    bins = bands_needed(similarity, ROWS) * ROWS
    some = rows.where("n_shingles > 0 and doc_id is not null")
    labels = kept_table(some.groupBy("k1", "k2").agg(F.min("doc_id").alias("label"), F.count("*").alias("n")).where("n > 1").drop("n"),
                        "minhash-labels")
    named = some.join(labels, ["k1", "k2"], "left").withColumn("node", F.coalesce("label", "doc_id"))
    one_each = named.where("node = doc_id")
    members = kept_table(_shared(one_each.select("node", F.explode("keys").alias("key"))), "minhash-members")
    nodes = members.select("node").distinct()
    held = documents_of(docs).withColumnRenamed("doc_id", "node").join(nodes, "node", "left_semi")
    texts = kept_table(held, "minhash-texts")
    # Narrow tables between the steps: a plan that holds several of them would be planned once for each use of a pair.
    star = kept_table(members.where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b")).distinct(), "minhash-stars")
    first = kept_table(verified(star, texts, width, similarity), "minhash-star")
    components = connected_components(first)
    # Candidates that a star does not show: members of one bucket that its least member does not connect.
    placed = kept_table(_with_components(members, components), "minhash-placed")
    signs = kept_table(one_each.join(nodes, "node", "left_semi").select("node", "n_shingles", "marks"), "minhash-signs")
    pairs = kept_table(cross_pairs(placed.where(F.col("m") <= small)), "minhash-pairs")
    wide = placed.where(F.col("m") > small)
    opened = wide.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    asked = wide.join(opened.select("key"), "key", "left_semi").select("node").distinct()
    fine = kept_table(refined(texts.join(asked, "node", "left_semi"), width, similarity), "minhash-fine")
    fine_members = kept_table(_with_components(_shared(fine).select("key", "node"), components), "minhash-fine-members")
    more = pairs.union(kept_table(cross_pairs(fine_members), "minhash-fine-pairs")).distinct()
    likely = kept_table(_likely(more, signs, similarity, bins), "minhash-likely")
    second = kept_table(verified(likely, texts, width, similarity), "minhash-rest")
    whole = kept_table(connected_components(first.union(second)), "minhash-components")
    found = rows.select("doc_id", "n_shingles", "k1", "k2").join(labels, ["k1", "k2"], "left")
    node = F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    placed = found.withColumn("node", node).join(whole, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def refined(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """`key`, `node`: longer bands, and as many of them as the similarity needs, for the nodes of crowded buckets."""
    bands = bands_needed(similarity, FINE_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                sets, sizes = shingle_sets(part.column("text"), width)
                keys = band_keys(signatures(sets, sizes, bands * FINE_ROWS), bands).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(np.asarray(part.column("node")), bands))],
                    names=["key", "node"])

    return texts.mapInArrow(run, "key long, node long")


def keep_one(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns, without those that are connected to a row of smaller doc_id, and of rows with
    one doc_id the one of least text. Rows without doc_id all stay."""
    gone = near_duplicates(docs, width, similarity).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    place = fresh("place")
    # The join has brought the rows of an id together already; counting them off moves nothing.
    left = docs.where("doc_id is not null").join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    first = Window.partitionBy("doc_id").orderBy("text")
    once = left.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    return once.unionByName(docs.where("doc_id is null"))
