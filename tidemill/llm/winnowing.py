"""Benchmark passages in documents, found by winnowed fingerprints.

The grams of `GRAM` words of a text are hashed, and of every `SPAN` consecutive grams the least hash is a fingerprint. A
stretch of `WINDOW` = `GRAM` + `SPAN` - 1 words holds exactly `SPAN` grams, so wherever it stands it has the same least
hash: each shared stretch of that length, and so each longer one, is met by joining the fingerprints of documents and of
items, of which there are far fewer than grams. A fingerprint is written once for the run of windows whose least hash it
is. Where one is found among the items', its hit is extended to the left and to the right: the windows of its run, by
the hashes of the grams that cover them, are held against the items' windows, and only equal ones count.

An item of fewer than `WINDOW` words is one window. Its span is its whole length, so every stretch of as many words of a
document is held against it; that pass over the documents is made once for each such length that occurs, at most nine.

All of this is columns: no Python runs on the rows. The items' windows are broadcast in blocks of at most `BLOCK_ROWS`
windows (two hashes and a class of eight bytes each, 24 bytes), split by a hash of the window, so a larger set of items
repeats the pass over the documents and never shuffles their words. A document's hits are counted where it was read.

Items that hold the same window make up that window's class. The items of a document are those of its classes;
documents with the same set of classes, as copies of one passage are, have theirs listed once.

Cases: null and empty texts have no words and no hits; the list of no items is the hash of the empty string. An item
without words has no window. Items that share an item_id count as one; an item without id marks its words as hit and is
not listed. Repeated documents and null doc_ids are rows like any other. A text of any length is one row; a stretch of
one repeated word has one fingerprint for all its windows. An empty table of items leaves every document clean, an empty
table of documents gives no rows. Only `doc_id`, `text` and `item_id` are read, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, fold, kept_table
from tidemill.operators.skew import join_lookup

WINDOW, GRAM = 10, 4
SPAN = WINDOW - GRAM + 1
BLOCK_ROWS = 400_000
_NONE = -2**63
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case."""
    return F.array_remove(F.split(fold(text), _SEPARATORS), "")


def _two(*parts: Column) -> list[Column]:
    """128 bits of hash, as columns `key` and `key2`."""
    return [F.xxhash64(*parts).alias("key"), F.xxhash64(F.lit(1), *parts).alias("key2")]


def window_runs(rows: DataFrame) -> DataFrame:
    """`n_words` and `runs` in place of `words`. A run is the windows `first` to `last` with one least hash (`mark`);
    `near` has the hashes of the grams inside them.

    Each step is a column of its own: inside the next one's lambda it would be worked out again for every element.
    """
    head = lambda c, less: F.slice(c, F.lit(1), F.greatest(F.size(c) - less, F.lit(0)))
    at = lambda c, i: F.get(F.col(c), i)
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("grams", F.transform(head("words", GRAM - 1), lambda word, i: F.xxhash64(
        word, *[at("words", i + k) for k in range(1, GRAM)])))
    rows = rows.withColumn("least", F.transform(head("grams", SPAN - 1), lambda gram, i: F.least(
        gram, *[at("grams", i + k) for k in range(1, SPAN)])))
    begins = F.filter(F.sequence(F.lit(0), F.size("least") - 1), lambda i: (i == 0) | (at("least", i) != at("least", i - 1)))
    rows = rows.withColumn("begins", F.when(F.size("least") > 0, begins).otherwise(F.array().cast("array<int>")))
    last = lambda j: F.coalesce(at("begins", j + 1), F.size("least")) - 1
    return rows.withColumn("runs", F.transform("begins", lambda first, j: F.struct(
        first.alias("first"), last(j).alias("last"), at("least", first).alias("mark"),
        F.slice("grams", first + 1, last(j) - first + SPAN).alias("near")))).drop("words", "grams", "least", "begins")


def windows_of_run() -> Column:
    """Array of (`at`, `key`, `key2`) of the windows of a run: grams that overlap by a word cover a window."""
    inside = lambda s: [F.get(F.col("near"), s + k) for k in range(0, SPAN, GRAM - 1)]
    return F.transform(F.sequence(F.lit(0), F.col("last") - F.col("first")), lambda s: F.struct(
        (F.col("first") + s).alias("at"), *_two(*inside(s))))


def stretches(length: int) -> Column:
    """Array of (`at`, `key`, `key2`) of all stretches of so many words, fewer than a window has."""
    starts = F.slice("words", F.lit(1), F.greatest(F.size("words") - (length - 1), F.lit(0)))
    return F.transform(starts, lambda word, i: F.struct(i.alias("at"), *_two(
        F.lit(length), word, *[F.get(F.col("words"), i + k) for k in range(1, length)])))


def item_windows(items: DataFrame) -> DataFrame:
    """`item_id`, `length`, `key`, `key2`, `mark` of every distinct window of the items; a short item's `mark` is null."""
    rows = items.select("item_id", words_of(F.coalesce("text", F.lit(""))).alias("words"))
    runs = window_runs(rows.where(F.size("words") >= WINDOW)).select("item_id", F.inline(F.concat("runs")))
    found = runs.select("item_id", "mark", F.inline(windows_of_run())).select(
        "item_id", F.lit(WINDOW).alias("length"), "key", "key2", "mark")
    # A short item is a stretch of as many words as it has.
    whole = F.coalesce(*[F.when(F.size("words") == n, F.struct(*_two(F.lit(n), *[F.get("words", F.lit(k)) for k in range(n)])))
                         for n in range(1, WINDOW)])
    short = rows.select("item_id", F.size("words").alias("length"), whole.alias("whole")).where("whole IS NOT NULL")
    found = found.union(short.select("item_id", "length", "whole.key", "whole.key2", F.lit(None).cast("long")))
    return found.distinct()


def classes_of(windows: DataFrame) -> DataFrame:
    """`key`, `key2`, `length`, `mark`, `class`: a window with a hash of the set of items that hold it."""
    name = F.col("item_id").cast("string")
    spread = [F.bit_xor(F.xxhash64(F.lit(k), name)) for k in (2, 3)]
    return windows.groupBy("key", "key2", "length", "mark").agg(F.xxhash64(*spread, F.count("item_id")).alias("class"))


def _hits_of_block(rows: DataFrame, windows: DataFrame, lengths: list[int], with_rows: bool) -> DataFrame:
    """`row`, `doc_id`, `n_words`, `at`, `length`, `class` of the documents' stretches that are windows of the block;
    with `with_rows` also a row without hit for every document.

    What a document's row is opened into never carries the whole text along, only the grams of the run.
    """
    marks = windows.where("mark IS NOT NULL").select(F.col("mark").alias("known"), F.lit(False).alias("none")).distinct()
    if with_rows:
        marks = marks.union(marks.sparkSession.range(1).select(F.lit(_NONE), F.lit(True)))
    split = rows.select("row", "doc_id", words_of(F.col("text")).alias("words"))
    nothing = F.struct(F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(_NONE).alias("mark"), F.array().cast("array<long>").alias("near"))
    opened = window_runs(split).select("row", "doc_id", "n_words", F.inline(F.array_prepend("runs", nothing)))
    met = opened.join(F.broadcast(marks), F.col("mark") == F.col("known"))
    keyed = met.select("row", "doc_id", "n_words", "none", F.inline(windows_of_run()))
    known = F.broadcast(windows.where(F.col("length") == WINDOW).select("key", "key2", "length", "class"))
    hit = lambda c: F.when(~F.col("none"), F.col(c)).alias(c)
    found = keyed.join(known, ["key", "key2"], "left").where(F.col("none") | F.col("class").isNotNull()).select(
        "row", "doc_id", "n_words", "at", hit("length"), hit("class"))
    for length in lengths:
        short = F.broadcast(windows.where(F.col("length") == length).select("key", "key2", "length", "class"))
        keyed = split.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.inline(F.concat(stretches(length))))
        found = found.union(keyed.join(short, ["key", "key2"]).select("row", "doc_id", "n_words", "at", "length", "class"))
    return found


def document_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """`row`, `doc_id`, `n_words`, `n_hit`, `classes` (sorted) of every document; `windows` is `classes_of`, written."""
    shape = windows.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("length") < WINDOW, F.col("length"))).alias("short")).first()
    blocks = max(1, -(-shape["n"] // BLOCK_ROWS))
    rows = documents_of(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    if blocks > 1 or shape["short"]:
        rows = kept_table(rows, "winnowed-documents")
    pieces = []
    for k in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("key2", "key"), F.lit(blocks)) == k)
        pieces.append(_hits_of_block(rows, part, sorted(shape["short"]), k == 0))
    hits = reduce(DataFrame.union, pieces)
    # All rows of a document come from one task, which puts them together before anything is sent.
    spans = F.array_sort(F.collect_list(F.when(F.col("length").isNotNull(), F.struct("at", "length"))))
    held = hits.groupBy("row", "doc_id", "n_words").agg(spans.alias("spans"), F.array_sort(F.collect_set("class")).alias("classes"))
    start = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto"))
    covered = F.aggregate("spans", start, lambda done, s: F.struct(
        (done["hit"] + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(done["upto"], s["at"]))).alias("hit"),
        F.greatest(done["upto"], s["at"] + s["length"]).alias("upto")), lambda done: done["hit"].cast("long"))
    return held.select("row", "doc_id", "n_words", covered.alias("n_hit"), "classes")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`doc_id`, `n_words`, `n_hit`, `n_items`, `items` (sorted ids as strings, joined by commas), `contaminated`."""
    held = kept_table(item_windows(items), "winnowed-items")
    windows = kept_table(classes_of(held), "winnowed-windows")
    hits = kept_table(document_hits(docs, windows), "winnowed-hits")
    # Every distinct set of classes once: its classes, their items, and the items in order.
    sets = hits.where(F.size("classes") > 0).select("classes").distinct()
    sets = sets.select(F.xxhash64(F.lit(5), "classes").alias("set"), F.xxhash64(F.lit(6), "classes").alias("set2"), "classes")
    owners = held.join(windows.select("key", "key2", "class"), ["key", "key2"]).where(F.col("item_id").isNotNull()).select(
        "class", F.col("item_id").cast("string").alias("name")).distinct()
    opened = sets.select("set", "set2", F.explode("classes").alias("class")).join(owners, "class").select("set", "set2", "name").distinct()
    lists = opened.groupBy("set", "set2").agg(F.array_sort(F.collect_list("name")).alias("names"))
    lists = kept_table(lists.select(F.concat_ws(",", F.col("set"), F.col("set2")).alias("set"), F.size("names").cast("long").alias("n_items"),
                                    F.array_join("names", ",").alias("items")), "winnowed-sets")
    named = hits.withColumn("set", F.when(F.size("classes") > 0, F.concat_ws(",", F.xxhash64(F.lit(5), "classes"), F.xxhash64(F.lit(6), "classes"))))
    joined = join_lookup(named.select("doc_id", "n_words", "n_hit", "set"), lists, "set", "left")
    return joined.select("doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                         F.coalesce("items", F.lit("")).alias("items"), (F.col("n_hit") > 0).alias("contaminated"))
