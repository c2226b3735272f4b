"""Systematic sampling of documents so that each source comes near its target number of words.

Every document of a source expects ``target / source_size`` copies. Along the
documents of a source, in order of size, the expected copies are summed up and
one random offset per source is added; a document is emitted once for each
integer that the sum crosses while passing it. Ordering by size keeps the words
taken near the target: the error is at most about one longest document.

The sum is a rank times a constant, and the rank is put together from counts, so
no task ever orders a whole source: documents counted per source and size, then
per source, size and ``SUB_BUCKETS`` of the id, then numbered inside one such cell.

Defined results: a null source is a source of its own, last in order; a null or
empty text has size 0 and takes part with 0 words; repeated rows are separate
documents; where all sizes are 0 every target is 0 and nothing is emitted; other
columns are carried along. Reruns agree: the offset comes from the seed and the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import n_words, staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = 20
#: Cells into which one source and size are split by id.
SUB_BUCKETS = 4096


def _before(partition: list, *order) -> Window:
    window = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_COPIES) -> DataFrame:
    """Columns source, source_size, target from one row per source (source, source_size).

    Sources share ``share`` times all words by weight; none gets over ``most``
    times its own size, and what it leaves is shared again. In order of
    cap over weight, the level is the first quotient of what is left by the
    weights that are left which does not exceed the next cap over weight. The
    windows run over the sources, not over their documents.
    """
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights)).cast("double")
    capped = sizes.select(
        "source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("cap"),
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))).alias("total"),
    ).withColumn("per_weight", F.col("cap") / F.col("weight"))
    order = (F.col("per_weight"), F.col("source").asc_nulls_first())
    rest = Window.partitionBy().orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(_before([], *order)), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = capped.withColumn("level", level)
    fits = F.min(F.when(F.col("level") <= F.col("per_weight"), F.struct("per_weight", "level"))).over(Window.partitionBy())["level"]
    return levels.select(
        "source", "source_size",
        F.least(F.col("cap"), F.coalesce(fits, F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def random_offset(source: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) for each source."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(source, F.lit("null")))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def mix_sources(
    docs: DataFrame, keep=None, weights=WEIGHTS, share=SHARE, most=MOST_COPIES, seed=SEED, sub_buckets=SUB_BUCKETS
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) as struct ``row``; size, source_size, target, copies.

    Columns to keep are meant to be few and short, such as an id: they are stored.
    """
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row"),
        "doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"),
        F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(sub_buckets)).alias("sub"),
    )
    # Words are counted once where rows are thin enough to be stored, else once for the cells and once for the rows.
    if keep is not None:
        sized = staged(sized, "sized")
    cells = staged(sized.groupBy("source", "size", "sub").agg(F.count(F.lit(1)).alias("n")), "cells")
    in_size = cells.select(
        "source", "size", "sub",
        F.coalesce(F.sum("n").over(_before(["source", "size"], "sub")), F.lit(0)).alias("before_sub"),
    )
    sizes = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    in_source = sizes.select(
        "source", "size", F.coalesce(F.sum("n").over(_before(["source"], "size")), F.lit(0)).alias("before_size")
    )
    targets = source_targets(
        sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, most
    )
    t = targets.withColumnRenamed("source", "t_source")
    s = in_source.join(t, F.col("source").eqNullSafe(F.col("t_source"))).select(
        F.col("source").alias("s_source"), F.col("size").alias("s_size"), "before_size", "source_size", "target"
    )
    c = in_size.join(s, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("size") == F.col("s_size"))).select(
        F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("sub").alias("c_sub"),
        (F.col("before_size") + F.col("before_sub")).alias("before"), "source_size", "target",
    )
    numbered = sized.withColumn(
        "number", F.row_number().over(Window.partitionBy("source", "size", "sub").orderBy("doc_id", "tie"))
    )
    joined = numbered.join(
        c,
        F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")) & (F.col("sub") == F.col("c_sub")),
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank, offset = F.col("before") + F.col("number"), random_offset(F.col("source"), seed)
    crossed = F.floor(rank * each + offset) - F.floor((rank - 1) * each + offset)
    return joined.select("row", "size", "source_size", "target", crossed.cast("int").alias("copies"))


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: each kept row as often as it was drawn."""
    drawn = mixed.where("copies > 0")
    return drawn.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
