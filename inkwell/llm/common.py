"""Helpers shared by the operators: tables, written intermediates, batches and word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import scratch_path

BATCH_ROWS = 500
BROADCAST_MB = 16

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the rows of an Arrow batch, so that a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores at its end as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (name + "_" * k for k in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def lookup(df: DataFrame, row_bytes: int, limit_mb: int = BROADCAST_MB) -> DataFrame:
    """Mark a written table for broadcast if its counted rows fit ``limit_mb``; else Spark joins by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit_mb << 20 else df


def join_unique(left: DataFrame, right: DataFrame, on: list[str], weight: str, share: int = 1_000) -> DataFrame:
    """``left`` with the other columns of ``right``, a written table of one row per key (nulls where it has none).

    ``weight`` is a column of ``right``: how many rows of ``left`` hold the key. Keys of more than a
    ``share``-th of these rows, hence fewer than ``share`` keys, are broadcast; the rest meet by shuffle.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    if not total:
        return left.join(right.drop(weight), on, "left")
    often = F.broadcast(right.where(F.col(weight) * share > total))
    seldom = right.where(F.col(weight) * share <= total)
    hot = left.join(often.drop(weight), on)
    rest = left.join(often.select(*on), on, "left_anti").join(seldom.drop(weight), on, "left")
    return hot.unionByName(rest)


def slices(texts: Iterable[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts as UTF-8 of about ``limit`` bytes (one text at least), with the first one's place."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if held and size + len(data) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64: every bit of the input moves every bit of the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15))


class Rolling:
    """Polynomial hashes of any span of a sequence of 64-bit numbers, modulo 2**64, through prefix sums."""

    def __init__(self, seed: int):
        self.base = int(stream(seed, 1)[0]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverses = np.ones(1, dtype=np.uint64)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        n = len(values) + 1
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(values * self.powers[: n - 1], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``[start, end)``, the length mixed in."""
        return mix((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


BYTES = stream(1, 256)
LETTERS, WORDS, OTHER = Rolling(2), Rolling(3), Rolling(4)


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words of all texts, and where each text's words begin (one more than texts)."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        data = LOWER[data]
    starts, ends = word_places(data)
    hashes = LETTERS.spans(LETTERS.prefix(BYTES[data]), starts, ends)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, bounds)


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[0::2], edges[1::2]
