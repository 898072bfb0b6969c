"""Keyed column updates, lookups, filters with pandas null rules, unions, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators.order import range_index
from inkwell.session import broadcast_if_small


def map_values(column: str, mapping: Mapping) -> Column:
    """Look a code up in a literal dictionary; unknown codes give null."""
    return F.create_map(*map(F.lit, chain.from_iterable(mapping.items())))[F.col(column)]


def case_category(column: str, names: Mapping[int, str]) -> Column:
    result = F.lit(None).cast("string")
    for code, name in names.items():
        result = F.when(F.col(column) == code, F.lit(name)).otherwise(result)
    return result


def differs(column: str, value) -> Column:
    """Not equal, and true for null as in a data frame comparison."""
    return ~F.col(column).eqNullSafe(F.lit(value))


def not_in(column: str, values: Sequence) -> Column:
    """Not among ``values``, and true for null."""
    return F.col(column).isNull() | ~F.col(column).isin(*values)


def equals_or_null(column: str, value) -> Column:
    return F.col(column).isNull() | (F.col(column) == value)


def composite_key(*columns: str) -> Column:
    return F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns])


def lookup_join(df: DataFrame, codes: DataFrame, on: str) -> DataFrame:
    """Left join with a code table of unique keys."""
    return df.join(broadcast_if_small(codes), on, "left")


def encode_first_seen(df: DataFrame, category: str, order: str, name: str) -> DataFrame:
    """Number the categories by where they first appear in ``order`` and add that number."""
    first = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.min(order).alias("_first"))
    codes = range_index(first, ["_first", category], name).select(category, name)
    return lookup_join(df, codes, category)


def bind_scores(df: DataFrame, *scores: DataFrame, key: str = "id") -> DataFrame:
    """Attach score tables by key; each holds one row per key."""
    return reduce(lambda a, b: a.join(b, key), scores, df)


def assert_one_to_one(df: DataFrame, scores: DataFrame, key: str = "id") -> None:
    """Fail unless both tables hold the same keys, each once."""
    sides = df.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        scores.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_key = sides.groupBy(key).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    bad = per_key.where("_l <> 1 OR _r <> 1").limit(1).count()
    if bad:
        raise ValueError(f"{key} is not matched one to one")


def join_frequent(left: DataFrame, right: DataFrame, on: list[str], weight: str, how: str = "inner", share: int = 1_000) -> DataFrame:
    """Inner or left join with a written table of one row per key, whose column ``weight`` counts the rows of ``left`` that hold it.

    Keys of more than a ``share``-th of all these rows are fewer than ``share`` and are broadcast, so
    that no frequent key meets in one task; all others are left to Spark.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    often = F.broadcast(right.where(F.col(weight) * share > total))
    rest = left.join(often.select(*on), on, "left_anti").join(right.where(F.col(weight) * share <= total), on, how)
    return left.join(often, on).unionByName(rest)


def update_join(df: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """Overwrite shared columns where the key matches and the new value is not null."""
    shared = [c for c in updates.columns if c != key and c in df.columns]
    renamed = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in shared])
    joined = df.join(broadcast_if_small(renamed), key, "left")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in shared else F.col(c) for c in df.columns]
    )


def union_all(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a missing column gives null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def weighted_union(df: DataFrame, source: str, weights: Mapping[str, int]) -> DataFrame:
    """List the rows of some sources more than once."""
    times = F.coalesce(map_values(source, weights), F.lit(1))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def dedup_rows(df: DataFrame) -> DataFrame:
    """The distinct rows. Strings meet under 256-bit digests, so no text is a shuffle key."""
    keys = []
    for name, kind in df.dtypes:
        keys += [F.sha2(name, 256)] if kind == "string" else [F.col(name)]
    best = df.groupBy(*[k.alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(F.first(F.struct(*df.columns)).alias("_row"))
    return best.select("_row.*")


def dedup_key_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per value of ``key``, the first in ``order``.

    Copies meet under a 256-bit digest of the key. The minimum is kept as a partial
    aggregate, so a value held by a third of all rows leaves each map task as one row.
    """
    rest = [c for c in df.columns if c != order]
    best = (
        df.groupBy(F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256), F.col(key).isNull())
        .agg(F.min_by(F.struct(order, *rest), order).alias("_row"))
        .select("_row.*")
    )
    return best.select(*df.columns)


def first_orders(df: DataFrame, key: str, order: str) -> DataFrame:
    """``order`` of the rows that ``dedup_key_first`` keeps; no other column leaves the map tasks."""
    digest = F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256)
    return df.groupBy(digest, F.col(key).isNull()).agg(F.min(order).alias(order)).select(order)
