"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only).

Each source's target is a share of all words by weight, at most ``most`` times its own size; what is cut
off goes to the other sources by weight.  A source takes every document ``floor(target / size)`` times,
and once more those documents whose hash is below a threshold.  The threshold comes from sums of words by
source and hash bucket: the running sum finds the bucket in which the budget ends, only that bucket is
summed again by the next hash bits, and so on.  Nothing is sorted but at most ``2 ** bits`` sums a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import fresh, stash

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than blank, tab to carriage return; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size), which has one row a source.

    Sources in code point order, null last, weigh ``weights`` in turn.  A capped source has
    ``most * source_size``; the others share the rest by weight, which is where repeated resharing ends.
    """
    order = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * most
    # In order of the level at which a source reaches its cap, the first k are capped for some k.
    ratio = W.partitionBy(F.lit(0)).orderBy((cap / F.col("w")), F.col("source").asc_nulls_last())
    whole = W.partitionBy(F.lit(0))
    before, after = ratio.rowsBetween(W.unboundedPreceding, -1), ratio.rowsBetween(0, W.unboundedFollowing)
    level = (
        ranked.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("w").over(after))
        .withColumn("fits", F.col("level") <= cap / F.col("w"))
        .withColumn("final", F.min(F.when(F.col("fits"), F.struct((cap / F.col("w")).alias("r"), F.col("level").alias("level")))).over(whole)["level"])
    )
    return level.select("source", "source_size", F.coalesce(F.least(F.col("final") * F.col("w"), cap.cast("double")), F.lit(0.0)).alias("target"))


def _hash(doc_id: Column, size: Column, bits: int) -> Column:
    """The first ``bits`` bits (a multiple of 4) of a hash of id and size."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string")))
    return F.conv(F.substring(digest, 1, bits // 4), 16, 10).cast("long")


def plan(slim: DataFrame, weights: tuple[int, ...], most: int, bits: int, levels: int) -> DataFrame:
    """One row a source: s, source_size, target, repeats, left, bound.

    ``slim`` has source, size and h.  Documents are taken ``repeats`` times, those with ``h < bound`` once more.
    """
    goal = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = stash(
        goal.withColumn("repeats", F.least(repeats, F.lit(most)))
        .withColumn("left", F.col("target") - F.col("repeats") * F.col("source_size")), "mix-goal",
    )
    # cut: the hash prefix in which the budget ends; below it all are taken, above it none.
    cut = goal.select(F.col("source").alias("s"), F.col("left").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    for k in range(1, levels + 1):
        shift = bits * (levels - k)
        above = F.shiftright("h", shift + bits) if k > 1 else F.lit(0).cast("long")
        own = slim.join(cut, F.col("source").eqNullSafe(F.col("s")) & (above == F.col("prefix")))
        sums = own.groupBy("s", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("n"), F.first("rest").alias("rest"))
        ends = sums.withColumn("below", F.sum("n").over(W.partitionBy("s").orderBy("b")) - F.col("n"))
        last = ends.filter(F.col("below") <= F.col("rest")).groupBy("s").agg(F.max(F.struct("b", "below", "n", "rest")).alias("x"))
        cut = stash(last.select("s", (F.col("x.rest") - F.col("x.below")).alias("rest"), F.col("x.b").alias("prefix"), F.col("x.n").alias("n")), "mix-cut")
    # The last bucket, of hashes that agree in all bits read, goes in if that is nearer.
    bound = cut.select("s", F.when(F.col("rest") * 2 >= F.col("n"), F.col("prefix") + 1).otherwise(F.col("prefix")).alias("bound"))
    return goal.join(bound, F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("s"), "source_size", "target", "repeats", "left", "bound")


def _times(h: Column, most: int) -> Column:
    more = F.when((F.col("left") > 0) & (h < F.col("bound")), 1).otherwise(0)
    return F.least(F.col("repeats") + more, F.lit(most)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, bits: int = 12, levels: int = 4) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs`` (doc_id, text, source).

    ``taken`` is 0 to ``most`` times the size, whole documents only.  A source's sum misses its target by
    at most half of the document at the threshold.  Null text has size 0; a null source is a source of its
    own; rows with equal doc_id (null too) and size have equal hashes and are taken together.  An empty
    table gives an empty result; a source without words has target 0.  Other columns are ignored.
    """
    size = word_count(F.col("text"))
    slim = stash(docs.select("doc_id", "source", size.alias("size"), _hash(F.col("doc_id"), size, bits * levels).alias("h")), "mix-sizes")
    each = plan(slim, weights, most, bits, levels)
    return slim.join(each, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _times(F.col("h"), most)).cast("long").alias("taken")
    )


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, bits: int = 12, levels: int = 4) -> DataFrame:
    """The rows of ``docs`` as :func:`mix` takes them: each as many times as it is taken, with all its columns.

    Nulls, repeated rows and empty tables are treated as in :func:`mix`; a document without words and one
    that isn't taken go; columns of any name are carried along.
    """
    slim = stash(docs.select("source", word_count(F.col("text")).alias("size"), _hash(F.col("doc_id"), word_count(F.col("text")), bits * levels).alias("h")), "mix-sizes")
    s, p = fresh(docs, "s", "p")
    each = plan(slim, weights, most, bits, levels).select(F.col("s").alias(s), F.struct("repeats", "left", "bound").alias(p))
    h = _hash(docs["doc_id"], word_count(docs["text"]), bits * levels)
    more = F.when((F.col(p)["left"] > 0) & (h < F.col(p)["bound"]), 1).otherwise(0)
    times = F.least(F.col(p)["repeats"] + more, F.lit(most)).cast("int")
    both = docs.join(each, docs["source"].eqNullSafe(F.col(s))).filter(times > 0)
    # The copies of a row are elements of an array; what is exploded isn't kept.
    return both.select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(0), times)).alias(s)).drop(s)
