"""Mix sources to target weights by systematic sampling, in DataFrame operations only.

Targets: the total size is shared by weight; no source gets more than ``most``
times its own size, and what is left over is shared again by weight until no
source is above. In closed form: ordered by size / weight, the first sources
get their cap and all others the same amount per unit of weight.

Sampling: a source's documents expect target / size copies each. They are put in
a fixed order, their expected copies are summed up along it, one random offset
in [0, 1) is added, and a document is emitted once for each integer passed. The
order runs through classes of similar size, so that the words taken come near
the target. A document's rank is the rows of all earlier blocks of its source
plus its row number within the block; blocks are cut by size class and a hash of
id and text, so neither a source nor an id that very many rows share is in one task.
The number of blocks of a class grows with the square root of the rows: so do then
both the rows of a block and the block counts of a source, which are summed up in
one group. Rows are counted when the function is called.

The table of sources (names and weights of a mix) is ordered as one group.

Null text has size 0; a source of size 0 has target 0 and takes nothing. A null
source is a source of its own, last in order. Repeated rows (also of one id) are
separate documents; ties in size go by hash of id and text, then id. An empty table gives
an empty result. Further columns do not matter; with ``copies`` they are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.words import WORD

MOST = 3
# Blocks of a size class: as many at least, and one for so many of the root of the rows.
LEAST_SPREAD = 16
ROOT_A_BLOCK = 20
SEED = "mix"


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, most: int = MOST, weights: DataFrame | None = None) -> DataFrame:
    """One row a source: source, source_size, weight, target.

    ``sizes`` has source and size. Without ``weights`` (source, weight) sources weigh
    1, 2, 3, repeating, in order of code points, null last.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        order = Window.orderBy(F.col("source").asc_nulls_last())
        weight = ((F.row_number().over(order) - 1) % 3 + 1).cast("bigint")
        by_source = by_source.withColumn("weight", weight)
    else:
        given = weights.select(F.col("source").alias("_source"), F.col("weight"))
        by_source = by_source.join(given, F.col("source").eqNullSafe(F.col("_source")), "left")
        by_source = by_source.drop("_source").withColumn("weight", F.coalesce("weight", F.lit(0)))
    everything = Window.partitionBy()
    ratio = (most * F.col("source_size")).cast("double") / F.nullif(F.col("weight"), F.lit(0))
    rising = Window.orderBy(F.col("ratio").asc_nulls_last(), F.col("source").asc_nulls_last())
    up_to = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = by_source.withColumn("ratio", ratio).withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "all_weight": F.sum("weight").over(everything),
            "cap_here": F.sum(most * F.col("source_size")).over(up_to),
            "weight_here": F.sum("weight").over(up_to),
        }
    )
    # amount a unit of weight gets if this source and all before it were capped but this one
    cap = most * F.col("source_size")
    left = F.col("total") - (F.col("cap_here") - cap)
    rest = F.col("all_weight") - (F.col("weight_here") - F.col("weight"))
    capped = (F.col("weight") > 0) & (left * F.col("weight") >= cap * rest)
    shared = shared.withColumn("capped", capped)
    first = shared.withColumns(
        {
            "fixed": F.coalesce(
                F.sum(F.when(F.col("capped"), cap)).over(everything), F.lit(0)
            ),
            "open_weight": F.coalesce(
                F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything), F.lit(0)
            ),
        }
    )
    share = (F.col("total") - F.col("fixed")).cast("double") * F.col("weight")
    target = (
        F.when(F.col("capped"), cap.cast("double"))
        .when(F.col("open_weight") > 0, share / F.col("open_weight"))
        .otherwise(F.lit(0.0))
    )
    return first.select("source", "source_size", "weight", target.alias("target"))


def _unit(*parts) -> F.Column:
    """A number in [0, 1) from a hash of the parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def spread_of(rows: int) -> int:
    """Blocks of a size class for a table of so many rows."""
    return max(LEAST_SPREAD, math.ceil(math.sqrt(rows) / ROOT_A_BLOCK))


def _row_hash(key: str, text: str) -> F.Column:
    """Hex digits that tell rows apart by key and text, also where the key is null."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.md5(F.col(text))))


def sampled(
    docs: DataFrame,
    most: int = MOST,
    spread: int | None = None,
    seed: str = SEED,
    weights: DataFrame | None = None,
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Key, source, size, source_size, target and copies of every document."""
    spread = spread or spread_of(docs.count())
    sized = docs.select(
        F.col(key).alias("key"),
        F.col("source"),
        word_count().alias("size"),
        _row_hash(key, "text").alias("digest"),
        *(F.col(name).alias(f"_kept_{i}") for i, name in enumerate(keep)),
    )
    targets = source_targets(sized.select("source", "size"), most, weights)
    salt = F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint") % spread
    # size class: the number of binary digits and the four digits after the first
    digits = F.length(F.bin(F.col("size") + 1))
    leading = F.expr("shiftright((size + 1) * 16, length(bin(size + 1)) - 1)")
    block = (digits * 16 + leading.cast("int")) * spread + salt
    placed = sized.withColumn("block", block)
    # before each block of a source: rows of its earlier blocks
    counts = placed.groupBy("source", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("block")
    counts = counts.withColumn(
        "before",
        F.coalesce(
            F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    )
    facts = counts.alias("c").join(
        targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))
    ).select("c.source", "block", "before", "source_size", "target")
    within = Window.partitionBy("source", "block").orderBy("size", "key", "digest")
    ranked = placed.withColumn("place", F.row_number().over(within))
    joined = ranked.alias("d").join(
        facts.alias("f"),
        F.col("d.source").eqNullSafe(F.col("f.source")) & (F.col("d.block") == F.col("f.block")),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = (F.col("before") + F.col("place")).cast("double")
    offset = _unit(F.lit(seed), F.coalesce(F.col("d.source"), F.lit("\0")))
    copies = F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)
    return joined.select(
        F.col("key").alias(key),
        F.col("d.source").alias("source"),
        "size",
        "source_size",
        "target",
        copies.cast("bigint").alias("copies"),
        *(F.col(f"_kept_{i}").alias(name) for i, name in enumerate(keep)),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every document as often as it was drawn, all columns kept."""
    # fields are kept as one struct, so names that occur above cannot clash
    packed = docs.select(
        F.col("doc_id"), F.col("source"), F.col("text"), F.struct(*docs.columns).alias("row")
    )
    drawn = sampled(packed, keep=("row",), **options).where(F.col("copies") > 0)
    repeated = drawn.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")
