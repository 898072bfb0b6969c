"""Order as data: row indexes, ranks, running totals and top-k without one-task windows.

Two ways to number rows are used. ``range_index`` sorts by any key: the rows are range
partitioned, written once, and each partition's offset is added to the position inside it.
``hash_rank`` orders by a hash of the id: the leading digits of the hash are even buckets,
so bucket counts give the offsets and nothing has to be written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import cut

_POSITION_BITS = 33


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index", start: int = 0) -> DataFrame:
    """Add ``name``: the place of each row in the total order ``order``, from ``start``.

    ``order`` must end in a unique key. The sorted rows are checkpointed, so the partition
    counts and the result see the same partitions. The offsets are one row per partition.
    """
    keys = [_column(c) for c in order]
    placed = cut(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row_place", F.monotonically_increasing_id())
    )
    block = F.shiftright("_row_place", _POSITION_BITS)
    sizes = placed.groupBy(block.alias("_block")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_row_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_block", block)
        .join(F.broadcast(offsets), "_block")
        .withColumn(name, F.col("_offset") + position + F.lit(start))
        .drop("_block", "_offset", "_row_place")
    )


def running_totals(
    df: DataFrame, order: Sequence[str], totals: Mapping[str, str], group: Sequence[str] = ()
) -> DataFrame:
    """Add running sums over ``order`` inside each ``group``, the current row included.

    ``totals`` maps a new column to the column summed. A large group is spread over many
    partitions: each sums its own run, and a run that continues a group takes over the sum
    of the earlier runs. Only such runs need an offset, at most one per partition.
    """
    keys = [*group, *order]
    placed = cut(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_block", F.spark_partition_id())
    )
    runs = placed.groupBy(*group, "_block").agg(*[F.sum(src).alias(f"_sum_{dst}") for dst, src in totals.items()])
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *[F.col(c).alias(f"_group_{c}") for c in group],
        F.col("_block").alias("_run_block"),
        F.row_number().over(Window.partitionBy(*group).orderBy("_block")).alias("_run"),
        *[F.sum(f"_sum_{dst}").over(earlier).alias(f"_before_{dst}") for dst in totals],
    ).where("_run > 1")
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed
    for dst, src in totals.items():
        local = local.withColumn(f"_local_{dst}", F.sum(src).over(inside))
    same = F.col("_block") == F.col("_run_block")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_group_{c}"))
    joined = local.join(F.broadcast(offsets), same, "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"_local_{d}") + F.coalesce(F.col(f"_before_{d}"), F.lit(0))).alias(d) for d in totals],
    )


def hash_key(seed: int, key: str | Column) -> Column:
    """The random order of the toolkit: md5 of seed and id; a null id counts as an empty one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(_column(key).cast("string"), F.lit(""))))


def hash_rank(
    df: DataFrame,
    seed: int,
    key: str = "id",
    group: Sequence[str] = (),
    name: str = "row_index",
    below: int | None = None,
    digits: int = 4,
) -> DataFrame:
    """Add ``name``: the 0-based place of each row in hash order inside its ``group``.

    Rows are counted per bucket of leading hash digits, and a window numbers the rows of one
    bucket only, so a group of any size is spread evenly. With ``below`` only the first
    ``below`` rows of each group stay, and buckets beyond them are dropped before the shuffle.
    """
    keyed = df.withColumn("_hash", hash_key(seed, key)).withColumn("_bucket", F.substring("_hash", 1, digits))
    counts = keyed.groupBy(*group, "_bucket").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_group_{c}") for c in group],
        F.col("_bucket").alias("_in_bucket"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )
    same = F.col("_bucket") == F.col("_in_bucket")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_group_{c}"))
    placed = keyed.join(offsets if group else F.broadcast(offsets), same)
    if below is not None:
        placed = placed.where(F.col("_offset") < below)
    inside = Window.partitionBy(*group, "_bucket").orderBy("_hash", key)
    ranked = placed.withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
    if below is not None:
        ranked = ranked.where(F.col(name) < below)
    return ranked.select(*df.columns, name)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int, key: str, name: str = "rank", salts: int = 32
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, ranked from 1.

    Each group is first cut to ``k`` rows in ``salts`` slices, so the last window sees at
    most ``salts * k`` rows of any group.
    """
    keys = [_column(c) for c in order]
    slice_ = F.pmod(F.xxhash64(key), F.lit(salts))
    local = df.withColumn("_slice", slice_)
    local = local.withColumn(name, F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*keys)))
    local = local.where(F.col(name) <= k).drop("_slice", name)
    return local.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*keys))).where(
        F.col(name) <= k
    )


def head_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def slice_rows(df: DataFrame, order: Sequence[str | Column], offset: int, n: int) -> DataFrame:
    """Rows ``offset`` to ``offset + n`` of an order; for small offsets."""
    return df.orderBy(*order).offset(offset).limit(n)


def ordinal_rank(df: DataFrame, score: str, key: str = "id", name: str = "rank") -> DataFrame:
    """0-based rank of each score, ties by ``key``."""
    return range_index(df, [F.col(score).asc_nulls_last(), F.col(key)], name)


def rank_blend(
    left: DataFrame, right: DataFrame, left_weight: float = 0.625, right_weight: float = 0.375, score: str = "score"
) -> DataFrame:
    """``id`` and the weighted sum of its ranks in two score tables ``id, score``."""
    a = ordinal_rank(left.select("id", score), score, name="rank_a").select("id", "rank_a")
    b = ordinal_rank(right.select("id", score), score, name="rank_b").select("id", "rank_b")
    blended = F.col("rank_a") * left_weight + F.col("rank_b") * right_weight
    return a.join(b, "id").select("id", blended.alias("generated"))


def median_exact(df: DataFrame, value: str) -> float | None:
    """The exact median: distinct values are counted, then the middle ones picked by rank.

    Unlike the built-in exact percentile this keeps no value list in one task.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    ranked = running_totals(counts, [value], {"up_to": "n"})
    total = ranked.agg(F.sum("n")).first()[0]
    if not total:
        return None
    low, high = (total + 1) // 2, total // 2 + 1
    starts = F.col("up_to") - F.col("n")
    holds = lambda place: (starts < place) & (F.col("up_to") >= place)
    middle = ranked.agg(
        F.max(F.when(holds(low), F.col(value))).alias("low"), F.max(F.when(holds(high), F.col(value))).alias("high")
    ).first()
    return (middle["low"] + middle["high"]) / 2


def nearest_to_median(df: DataFrame, score: str, n: int, key: str = "id") -> DataFrame:
    """The ``n`` rows whose score lies closest to the median score."""
    middle = median_exact(df, score)
    if middle is None:
        return df.limit(0)
    return df.orderBy(F.abs(F.col(score) - F.lit(middle)), key).limit(n)
