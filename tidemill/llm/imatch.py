"""I-Match fingerprints of documents with several randomised lexicons, in columns alone.

The lexicon is the terms whose document frequency lies in a band (neither in nearly every document nor in hardly any).
A document's distinct lexicon terms are hashed as a set, once for each of many random subsets of the lexicon. The
subsets come in levels, each a quarter as dense as the one before, because a change of a few terms leaves most sparse
subsets alone but nearly always hits a dense one; a long document has terms enough for the sparse levels, a short one
for the dense ones. A fingerprint is the list of those hashes; an empty subset is marked. The likeness of two
fingerprints is the share of equal hashes on the sparsest level of which half the subsets hold terms in one or other.
The first hash of a fingerprint covers the whole lexicon, as in the method's plain form.

The lexicon is broadcast: it is at most `LEXICON` hashes of eight bytes, since the lower edge of the band rises (by
doubling) until no more terms remain. Documents move once, dealt by ranges of doc_id so that each meets its successor;
the first of each range also goes to the range before. Everything after that stays in place.

Cases: a null text reads as empty; a document without lexicon terms has marks only, and its likeness to anything is 0. Rows follow each other by doc_id (null first), of equal ones by text; the last is
followed by the first, a single row by itself. Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, fold, kept_table, shuffle_partitions

#: Share of the documents that hold a term of the lexicon, at least and at most.
LOWEST, HIGHEST = 5e-4, 0.5
LEXICON = 131_072
SUBSETS = 16
#: Bits of a term's hash that are zero in the terms of a level: a quarter, a sixteenth and so on.
LEVELS = (2, 4, 6, 8)
_FIRST = -2**63


def term_hashes(text: Column) -> Column:
    """Distinct words of a text, A-Z in lower case, as 64-bit hashes."""
    words = F.filter(F.split(fold(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST, most: int = LEXICON) -> DataFrame:
    """`term`: hashes of the terms inside the band, at most `most` of them."""
    rows = documents_of(docs)
    counts = rows.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    total = rows.count()
    counts = kept_table(counts.where((F.col("n") >= max(2, lowest * total)) & (F.col("n") <= max(2, highest * total))), "imatch-terms")
    # How many terms each doubling of the lower edge would leave: at most 64 numbers.
    steps = {r["step"]: r["k"] for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).agg(
        F.count("*").alias("k")).collect()}
    edge = 0
    while sum(k for step, k in steps.items() if step >= edge) > most:
        edge += 1
    return counts.where(F.floor(F.log2("n")) >= edge).select("term")


def subset_levels(term: Column) -> Column:
    """How many levels of each subset hold a term, three bits for each subset."""
    packed = F.lit(0).cast("long")
    for i in range(SUBSETS):
        spread = F.xxhash64(term, F.lit(i))
        held = sum((F.when(spread.bitwiseAND((1 << bits) - 1) == 0, 1).otherwise(0) for bits in LEVELS), F.lit(0))
        packed = packed.bitwiseOR(F.shiftleft(held.cast("long"), 3 * i))
    return packed


def subset_hashes(term: Column, levels: Column) -> list[Column]:
    """Aggregates: a hash of all distinct terms of a group, then of those on each level of each subset (null: none).

    Exclusive or over the terms' hashes: it depends on the set of terms alone, which is what sorting them before a
    hash is for, and it needs no list of them.
    """
    hashes = [F.bit_xor(term)]
    for i in range(SUBSETS):
        held = F.shiftright(levels, 3 * i).bitwiseAND(7)
        hashes += [F.bit_xor(F.when(held > k, term)) for k in range(len(LEVELS))]
    return hashes


def likeness(left: Column, right: Column) -> Column:
    """Share of equal hashes on the sparsest level of which at least half the subsets hold terms; where none is, that
    of the hashes of all terms (0 if there are no terms)."""
    at = lambda prints, i, k: F.get(prints, i * len(LEVELS) + (1 + k))
    subsets = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    share = F.when(F.get(left, F.lit(0)) == F.get(right, F.lit(0)), F.lit(1.0)).otherwise(F.lit(0.0))
    for k in range(len(LEVELS)):
        held = F.size(F.filter(subsets, lambda i: at(left, i, k).isNotNull() | at(right, i, k).isNotNull()))
        equal = F.size(F.filter(subsets, lambda i: at(left, i, k) == at(right, i, k)))
        share = F.when(held * 2 >= SUBSETS, equal / held).otherwise(share)
    return share


def as_text(prints: Column) -> Column:
    """Four hexadecimal digits of each hash, four dashes for an empty subset."""
    digits = lambda h: F.coalesce(F.lower(F.lpad(F.hex(F.pmod(h, F.lit(65_536))), 4, "0")), F.lit("----"))
    return F.array_join(F.transform(prints, digits), "")


def _in_order(docs: DataFrame) -> DataFrame:
    """Documents dealt into ranges of doc_id (`dest`), with the first of each range once more (`ghost`) at the end of
    the range before it, and the first of all at the end of the last."""
    rows = documents_of(docs).withColumn("place", F.coalesce("doc_id", F.lit(_FIRST)))
    parts = shuffle_partitions(docs.sparkSession)
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(rows.agg(F.percentile_approx("place", shares, 10 * parts)).first()[0] or [])) if shares else []
    limits = F.array(*[F.lit(b).cast("long") for b in bounds]).cast("array<long>")
    dest = F.size(F.filter(limits, lambda b: b < F.col("place")))
    # One row per range, in order; the range before the first is the last.
    firsts = rows.select("place", dest.alias("own")).groupBy("own").agg(F.min("place").alias("least")).orderBy("own").collect()
    before = {r["least"]: firsts[k - 1]["own"] for k, r in enumerate(firsts)}
    back = F.lit(None).cast("int")
    if before:
        keys, homes = zip(*before.items())
        at = F.array_position(F.array(*[F.lit(k).cast("long") for k in keys]), F.col("place"))
        back = F.when(at > 0, F.get(F.array(*[F.lit(h) for h in homes]), (at - 1).cast("int")))
    home = F.struct(dest.alias("dest"), F.lit(False).alias("ghost"))
    guest = F.when(back.isNotNull(), F.array(home, F.struct(back.alias("dest"), F.lit(True).alias("ghost")))).otherwise(F.array(home))
    return rows.select("doc_id", "text", "place", F.inline(guest))


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_chars`, `text`'s and its edited text's fingerprint (`print`, `edited_print`), `edited_sha256`, and
    the fingerprint of the next document (`next_print`)."""
    words = kept_table(lexicon(docs), "imatch-lexicon")
    # A mark that every document holds keeps those without lexicon terms.
    mark = F.lit(_FIRST).cast("long")
    words = words.where(F.col("term") != mark).select("term", subset_levels(F.col("term")).alias("levels"))
    words = words.union(words.sparkSession.range(1).select(mark, F.lit(0).cast("long")))
    chain = Window.partitionBy("dest").orderBy("ghost", "place", "text")
    rows = _in_order(docs).select("dest", "ghost", "doc_id", "text", F.lead("text").over(chain).alias("next"),
                                  F.row_number().over(chain).alias("rn"), F.length("text").cast("long").alias("n_chars"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")),
                      F.substring(F.coalesce("next", F.lit("")), F.lit(1), cut))
    # The digest stands below the Generate: beside it, it would be taken again for every term.
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    sided = lambda side, text: F.transform(F.array_append(term_hashes(text), mark), lambda t: F.struct(
        F.lit(side).alias("side"), t.alias("term")))
    opened = rows.select("dest", "ghost", "rn", "doc_id", "n_chars", "edited_sha256",
                         F.inline(F.concat(sided(0, F.col("text")), sided(1, F.col("edited")))))
    held = opened.join(F.broadcast(words), "term")
    term = F.when(F.col("term") != mark, F.col("term"))
    keys = ("dest", "rn", "side", "ghost", "doc_id", "n_chars", "edited_sha256")
    hashes = [h.alias(f"h{i}") for i, h in enumerate(subset_hashes(term, F.col("levels")))]
    printed = held.groupBy(*keys).agg(*hashes).select(*keys, F.array(*[f"h{i}" for i in range(len(hashes))]).alias("print"))
    # Each document has two rows, its text's and its edited text's; its successor's follow.
    follow = Window.partitionBy("dest").orderBy("rn", "side")
    lined = printed.withColumn("edited_print", F.lead("print", 1).over(follow)).withColumn("next_print", F.lead("print", 2).over(follow))
    return lined.where((F.col("side") == 0) & ~F.col("ghost")).select(
        "doc_id", "n_chars", "edited_sha256", "print", "edited_print", "next_print")


def compare(prints: DataFrame) -> DataFrame:
    """`doc_id`, `n_chars`, `edited_sha256`, both fingerprints as text, `near_edited`, `near_next`."""
    return prints.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"),
                         as_text(F.col("edited_print")).alias("edited_fingerprint"),
                         likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                         likeness(F.col("print"), F.col("next_print")).alias("near_next"))
