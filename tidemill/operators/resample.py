"""Train/test split and balancing of a rare class by synthetic rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.neighbors import nearest_positions, positions
from tidemill.operators.premiums import with_position
from tidemill.operators.skew import join_state
from tidemill.session import checkpoint_dir

# Seed, test share 1 / TEST_PARTS, neighbours used for balancing.
SEED = 42
TEST_PARTS = 5
NEIGHBOURS = 5

# Copies of one rare row that are numbered in one go.
CHUNK = 10_000


def _hex_number(digest: Column, start: int) -> Column:
    """Eight hex digits of a digest as a number below 2^32."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("long")


def with_test_flag(frame: DataFrame, key: str, seed: int = SEED, parts: int = TEST_PARTS) -> DataFrame:
    """Add `is_test`, true for one row in `parts`. It depends on the key alone, not on how the rows are laid out."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return frame.withColumn("is_test", F.pmod(_hex_number(digest, 1), F.lit(parts)) == 0)


def train_test_split(frame: DataFrame, key: str, seed: int = SEED, parts: int = TEST_PARTS) -> tuple[DataFrame, DataFrame]:
    flagged = with_test_flag(frame, key, seed, parts)
    return flagged.where(~F.col("is_test")).drop("is_test"), flagged.where("is_test").drop("is_test")


def class_counts(frame: DataFrame, label: str) -> DataFrame:
    """Rows per class."""
    return frame.groupBy(label).agg(F.count("*").alias("n"))


def synthetic_rows(frame: DataFrame, key: str, features: Sequence[str], label: str, k: int = NEIGHBOURS,
                   seed: int = SEED, box_points: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """New rows of the rarer of two classes, as many as it lacks: (`base`, `copy`, features..., label).

    A new row lies between a rare row and one of its k nearest rare rows. Rare rows take turns in key order; which
    neighbour and how far follows from a digest of seed, key and turn. Keys are unique integers, features not null.
    """
    counts = sorted((row["n"], row[label]) for row in class_counts(frame, label).limit(3).collect())
    if len(counts) != 2:
        raise ValueError("balancing needs exactly two classes")
    (few, rare), (many, _) = counts
    if few < 2 <= many:
        raise ValueError("balancing needs at least two rows of the rarer class")
    if few == many:
        return frame.select(F.col(key).alias("base"), F.lit(1).cast("long").alias("copy"),
                            *[F.col(f).cast("double").alias(f) for f in features], label).limit(0)
    minority = frame.where(F.col(label) == rare).select(key, *features)
    checkpoint_dir(frame.sparkSession)
    places = positions(minority, key, features, k).checkpoint()  # read several times below
    pairs = nearest_positions(places, k, box_points)
    target = places.select(F.col("pos").alias("near"), F.col("x").alias("near_x"), F.slice("members", 1, k).alias("ids"))
    others = pairs.join(target, "near").select(
        "pos", F.inline(F.transform("ids", lambda i: F.struct(F.col("d2"), i.alias("id"), F.col("near_x").alias("x")))))
    own = places.select(
        "pos", F.inline(F.transform("members", lambda i: F.struct(F.lit(0.0).alias("d2"), i.alias("id"), F.col("x")))))
    # At most (k + 1) * k entries per position.
    near = others.unionByName(own).groupBy("pos").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("d2", "id", "x"))), 1, k + 1).alias("near"))
    by_place = places.select("pos", *[F.col("x")[i].alias(f) for i, f in enumerate(features)]).join(near, "pos").drop("pos")

    missing = many - few
    turns = F.lit(missing // few) + F.when(F.col("position") < missing % few, 1).otherwise(0)
    bases = with_position(minority, key).select(
        F.col(key).alias("base"), *[F.col(f).cast("double").alias(f) for f in features], turns.alias("turns")).where("turns > 0")
    weights = bases.groupBy(*features).agg(F.count("*").alias("rows"))
    matched = join_state(bases, by_place.join(weights, list(features)), list(features), "rows")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("base").cast("string"), F.col("copy").cast("string")))
    # Copies are numbered in chunks, so that no array grows with the turns; many chunks of a row go to many tasks.
    turns = F.col("turns").cast("long")
    chunked = matched.select(
        "base", *features, "turns",
        F.slice(F.filter("near", lambda n: n["id"] != F.col("base")), 1, k).alias("near"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((turns - 1) / chunk).cast("long"))).alias("chunk"))
    if missing // few >= chunk:
        chunked = chunked.repartition("base", "chunk")
    first = F.col("chunk") * chunk + 1
    drawn = chunked.select(
        "base", *features, "near",
        F.explode(F.sequence(first, F.least(first + (chunk - 1), turns))).alias("copy"),
    ).withColumn("_digest", digest)
    chosen = F.col("near")[F.pmod(_hex_number(F.col("_digest"), 1), F.size("near")).cast("int")]["x"]
    along = _hex_number(F.col("_digest"), 9) / F.lit(4294967296.0)
    moved = drawn.withColumn("_x", chosen).withColumn("_u", along)
    return moved.select(
        "base", "copy",
        *[(F.col(f) + F.col("_u") * (F.col("_x")[i] - F.col(f))).alias(f) for i, f in enumerate(features)],
        F.lit(rare).alias(label),
    )


def oversample(frame: DataFrame, key: str, features: Sequence[str], label: str, k: int = NEIGHBOURS,
               seed: int = SEED, box_points: int | None = None) -> DataFrame:
    """Features and label of all rows plus the synthetic ones; both classes end up with the same count."""
    columns = [*[F.col(f).cast("double").alias(f) for f in features], F.col(label)]
    added = synthetic_rows(frame, key, features, label, k, seed, box_points)
    return frame.select(*columns).unionByName(added.select(*columns))
