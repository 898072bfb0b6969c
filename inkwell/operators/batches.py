"""User functions over rows, batches and whole columns, in their Arrow form."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_scalar(column: Column, function: Callable, returns: str) -> Column:
    """A Python function per value, run over Arrow batches; null stays null."""

    @F.pandas_udf(returns)
    def run(values: pd.Series) -> pd.Series:
        return values.map(function, na_action="ignore")

    return run(column)


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A function from batch to batch, as in a batched dataset map."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)


def chunk_sizes(df: DataFrame, size: int, column: str) -> DataFrame:
    """``chunk, rows, total``: the texts handed on in chunks of ``size`` rows per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.Series] = []
        held, chunk = 0, 0

        def hand_on(values: pd.Series) -> pd.DataFrame:
            return pd.DataFrame({"chunk": [chunk], "rows": [len(values)], "total": [int(values.str.len().sum())]})

        for batch in batches:
            kept.append(batch[column])
            held += len(batch)
            while held >= size:
                values = pd.concat(kept)
                yield hand_on(values.iloc[:size])
                kept, held, chunk = [values.iloc[size:]], held - size, chunk + 1
        if held:
            yield hand_on(pd.concat(kept))

    return df.select(column).mapInPandas(run, "chunk bigint, rows bigint, total bigint")
