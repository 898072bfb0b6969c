"""Sharding by histogram sort: splitters are refined from exact byte counts, then rows move once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from inkwell.llm.common import written

LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Splitters:
    """Sorted lower bounds ``(hash, tie)`` of all ranges but the first."""

    hashes: np.ndarray
    ties: np.ndarray

    def place(self, hashes: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """The range of each key: how many splitters are not above it."""
        at = np.searchsorted(self.hashes, hashes, side="left")
        for same in np.unique(self.hashes):
            rows = hashes == same
            if rows.any():
                first, last = np.searchsorted(self.hashes, same, "left"), np.searchsorted(self.hashes, same, "right")
                at[rows] = first + np.searchsorted(self.ties[first:last], ties[rows], side="right")
        return at


def range_column(splitters: Splitters, hash_col: str, tie_col: str):
    def place(hashes: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(splitters.place(hashes.to_numpy(np.int64), ties.to_numpy(np.int64)))

    return F.pandas_udf(place, LongType())(F.col(hash_col), F.col(tie_col))


def find_splitters(keys: DataFrame, targets: np.ndarray, tolerance: float, probes: int = 32) -> Splitters:
    """Key boundaries below which the bytes are as near to ``targets`` as the tolerance asks.

    Each round counts, in one job over all partitions, the exact bytes below ``probes`` even key
    boundaries inside every open interval. A splitter is settled once a boundary between two hashes
    is within ``tolerance`` bytes. An interval of one hash holds equal texts only; then, and only
    then, the search goes on inside the group by its second key, whose boundaries may cut the group.
    What comes back in a round is bounded by splitters x probes.
    """
    n = len(targets)
    found = [None] * n
    # open interval of each splitter: level 0 searches hashes, level 1 ties inside one hash
    state = [{"level": 0, "lo": LOW, "hi": HIGH, "hash": 0} for _ in range(n)]
    while any(f is None for f in found):
        marks = set()
        for i in (i for i in range(n) if found[i] is None):
            s = state[i]
            width = s["hi"] - s["lo"]
            for j in range(1, min(probes, width) + 1):
                p = s["lo"] + (width * j) // min(probes, width)
                marks.add((p, LOW) if s["level"] == 0 else (s["hash"], p))
            if s["level"] == 0:
                marks.add((s["lo"], LOW))
        marks = sorted(marks)
        probe = Splitters(np.array([m[0] for m in marks], dtype=np.int64), np.array([m[1] for m in marks], dtype=np.int64))
        sums = keys.groupBy(range_column(probe, "shard_hash", "shard_tie").alias("at")).agg(F.sum("size").alias("size"))
        counts = np.zeros(len(marks) + 1, dtype=np.int64)
        for row in sums.collect():
            counts[row["at"]] = row["size"]
        below = dict(zip(marks, np.cumsum(counts)[:-1].tolist()))
        for i in (i for i in range(n) if found[i] is None):
            s = state[i]
            inside = [m for m in marks if (s["level"] == 0 and m[1] == LOW and s["lo"] <= m[0] <= s["hi"])
                      or (s["level"] == 1 and m[0] == s["hash"] and s["lo"] <= m[1] <= s["hi"])]
            best = min(inside, key=lambda m: (abs(below[m] - targets[i]), m))
            place = 0 if s["level"] == 0 else 1
            under = [m for m in inside if below[m] <= targets[i]]
            over = [m for m in inside if below[m] > targets[i]]
            lo = max((m[place] for m in under), default=s["lo"])
            hi = min((m[place] for m in over), default=s["hi"])
            if abs(below[best] - targets[i]) <= tolerance or (s["level"] == 1 and hi - lo <= 1):
                found[i] = best
            elif hi - lo <= 1 and s["level"] == 0:
                state[i] = {"level": 1, "lo": LOW, "hi": HIGH, "hash": lo}
            else:
                s["lo"], s["hi"] = lo, hi
    found.sort()
    return Splitters(np.array([f[0] for f in found], dtype=np.int64), np.array([f[1] for f in found], dtype=np.int64))


def shard_by_bytes(rows: DataFrame, id_col: str, text_col: str, shards: int = 24, tolerance: float = 0.002,
                   range_rows: int = 250_000) -> DataFrame:
    """Add ``size``, ``shard`` and ``slot`` to ``rows``: ``shards`` runs of the sorted rows with near equal bytes.

    Rows sort by a hash of the text, so equal texts stand together and are cut only where a group is
    larger than the tolerance (a share of the mean shard). Inside a group a hash of the id
    orders the rows. Every shard is cut into ranges of about ``range_rows`` rows by the same search,
    so that numbering needs no task larger than a range, whatever the shard holds. Null texts count
    as empty; null ids and repeated rows are kept (repeated rows cannot be told apart, so a group of
    them is not cut); an empty table gives no rows. Columns named ``shard_hash``, ``shard_tie``,
    ``shard_range``, ``size``, ``shard`` and ``slot`` are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = rows.withColumn("size", F.octet_length(text).cast("long") + 8)
    keyed = keyed.withColumn("shard_hash", F.xxhash64(text)).withColumn("shard_tie", F.xxhash64(F.col(id_col)))
    keys = written(keyed.select("shard_hash", "shard_tie", "size"), "shard-keys")
    total = keys.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    pieces = max(1, -(-total["n"] // (shards * range_rows)))
    ranges = shards * pieces
    size = total["size"] or 0
    targets = np.array([size * i / ranges for i in range(1, ranges)])
    if not total["n"]:
        splitters = Splitters(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    else:
        splitters = find_splitters(keys, targets, tolerance * size / ranges)
    placed = keyed.withColumn("shard_range", range_column(splitters, "shard_hash", "shard_tie"))
    counts = {r["at"]: r["n"] for r in keys.groupBy(range_column(splitters, "shard_hash", "shard_tie").alias("at"))
              .agg(F.count("*").alias("n")).collect()}
    starts, seen = [], 0
    for r in range(ranges):
        seen = 0 if r % pieces == 0 else seen
        starts.append(seen)
        seen += counts.get(r, 0)
    begin = F.element_at(F.lit(starts), (F.col("shard_range") + 1).cast("int"))
    order = Window.partitionBy("shard_range").orderBy("shard_hash", "shard_tie", F.col(id_col))
    out = placed.withColumn("slot", F.row_number().over(order).cast("long") - 1 + begin)
    out = out.withColumn("shard", F.floor(F.col("shard_range") / pieces).cast("int"))
    return out.drop("shard_hash", "shard_tie", "shard_range")
