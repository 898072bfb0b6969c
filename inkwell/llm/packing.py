"""Best-fit packing of token sequences: a configuration linear program over the length histogram.

The histogram has at most ``capacity`` lengths, so the program is small whatever the corpus holds.
Its plan (so many sequences filled like this) is a list of rank segments per length, and each piece
finds its sequence from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import free_names, small_batches, written

CAPACITY = 1024
END = 2
SALTS = 64
MEMO = 800_000


class ByteTokens:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, the same as the tokenizer library gives.

    A text of single blanks between words is cut at the blanks, where the vocabulary's pattern always
    cuts, and each distinct word is encoded once. Any other text is encoded as a whole.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import base64

        import public_tokenizers as public
        import tiktoken
        from tokenizers import Tokenizer

        with open(public.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.words = tiktoken.Encoding("words", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.whole = Tokenizer.from_file(public.path(f"{name}.json"))
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text of a batch."""
        out: list = [None] * len(texts)
        memo, fresh, waiting = self.memo, {}, []
        for i, text in enumerate(texts):
            first, *rest = text.split(" ")
            found = list(map(memo.get, rest))
            missing = [k for k, f in enumerate(found) if f is None] if None in found else []
            # white space next to a blank, and special tokens, need the whole text
            if any(not rest[k] or rest[k][0].isspace() for k in missing) or any(s in text for s in self.special):
                out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
                continue
            waiting.append((i, first, rest, found, missing))
            fresh.update((rest[k], None) for k in missing)
        self.learn(list(fresh))
        for i, first, rest, found, missing in waiting:
            for k in missing:
                found[k] = memo[rest[k]]
            out[i] = np.array(self.words.encode_ordinary(first), dtype="<u4").tobytes() + b"".join(found)
        if len(memo) > MEMO:
            memo.clear()
        return out

    def learn(self, words: list[str], limit: int = 20_000) -> None:
        """Encode new words together; their places are found again by the bytes each id stands for."""
        for part in range(0, len(words), limit):
            chosen = words[part : part + limit]
            ids = np.array(self.words.encode_ordinary(" " + " ".join(chosen)), dtype="<u4")
            ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in chosen])
            cuts = np.append(0, np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1).tolist()
            data = ids.tobytes()
            for word, a, b in zip(chosen, cuts, cuts[1:]):
                self.memo[word] = data[4 * a : 4 * b]


PIECE = "piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every text with its end id; texts of more than
    ``capacity`` ids are cut from the end, so that only the first piece may be shorter."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, end = ByteTokens(), np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            out = []
            texts = [t if isinstance(t, str) else "" for t in batch.iloc[:, 1]]
            for doc, data in zip(batch.iloc[:, 0], tokens.encode_all(texts)):
                data += end
                n = len(data) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    part = data[4 * at : 4 * (at + size)]
                    out.append((doc, piece, at, size, zlib.crc32(part)))
                    at, piece = at + size, piece + 1
            yield pd.DataFrame({
                "doc_id": pd.array([o[0] if o[0] == o[0] else None for o in out], dtype="Int64"),
                "piece": np.array([o[1] for o in out], dtype=np.int32),
                **{c: np.array([o[k] for o in out], dtype=np.int64) for k, c in enumerate(("start", "length", "ids_crc32"), 2)},
            })

    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return columns.mapInPandas(run, f"doc_id long, {PIECE}")


def price(values: np.ndarray, room: np.ndarray, capacity: int, margin: float) -> list[np.ndarray]:
    """Patterns whose value is within ``margin`` of the best one: an unbounded knapsack over all capacities.

    The dynamic program gives the best filling of every capacity, hence the best pattern that holds
    a given length. No pattern asks for more pieces of a length than ``room`` has.
    """
    gains = np.where(room[1:] > 0, values[1:], -np.inf)
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, dtype=np.int64)
    for size in range(1, capacity + 1):
        sums = best[size - 1 :: -1][:size] + gains[:size] if size > 1 else best[:1] + gains[:1]
        k = int(sums.argmax())
        if sums[k] > best[size - 1]:
            best[size], take[size] = sums[k], k + 1
        else:
            best[size] = best[size - 1]
    with_one = np.where(room[1:] > 0, gains + best[capacity - 1 :: -1], -np.inf)
    found: dict[bytes, np.ndarray] = {}
    for length in np.flatnonzero(with_one >= best[capacity] * (1 - margin)) + 1:
        pattern = np.zeros(capacity + 1, dtype=np.int64)
        pattern[length] = 1
        size = capacity - length
        while size > 0:
            k = take[size]
            if not k:
                size -= 1
                continue
            if pattern[k] < room[k]:
                pattern[k] += 1
            size -= k
        found.setdefault(pattern.tobytes(), pattern)
    return list(found.values())


def solve_program(counts: np.ndarray, capacity: int, rounds: int, eta: float) -> list[tuple[np.ndarray, float]]:
    """A fractional covering of ``counts`` by patterns, by multiplicative weights.

    The weight of a length falls by how well it is covered so far. In each round the knapsack prices
    the patterns of largest weight and the round's even share of the sequences goes to them, no
    length beyond its count.
    """
    used = np.flatnonzero(counts)
    covered = np.zeros(capacity + 1)
    share = float(counts @ np.arange(capacity + 1)) / capacity / rounds
    found: dict[bytes, list] = {}
    for _ in range(rounds):
        rate = covered[used] / counts[used]
        if rate.min() >= 1 - 1e-9:
            break
        weight = np.zeros(capacity + 1)
        weight[used] = used * np.exp(-eta * (rate - rate.min()))
        patterns = price(weight, np.where(covered < counts - 1e-9, counts, 0), capacity, 1e-3 * eta)
        budget = share
        for pattern in sorted(patterns, key=lambda p: -float(weight @ p)):
            need = pattern > 0
            each = min(budget, max(share / 16, share / len(patterns)), float(((counts[need] - covered[need]) / pattern[need]).min()))
            if each > 0:
                covered += each * pattern
                found.setdefault(pattern.tobytes(), [pattern, 0.0])[1] += each
                budget -= each
    return [(p, x) for p, x in found.values()]


def plan_sequences(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = 60, eta: float = 0.5,
                   shares: tuple = (0.25, 0.5, 0.75, 0.9)) -> list[list]:
    """Groups ``[pattern, number of sequences]`` that hold exactly ``counts`` pieces of each length.

    The fractional solution is rounded down at several ``shares`` of itself; the plan with the fewest
    sequences is used.
    """
    left = counts.astype(np.int64).copy()
    left[capacity] = 0
    program = solve_program(left, capacity, rounds, eta) if left.any() else []
    plans = [round_program(counts, capacity, program, share) for share in shares]
    return min(plans, key=lambda groups: sum(n for _, n in groups))


def round_program(counts: np.ndarray, capacity: int, program: list[tuple[np.ndarray, float]], share: float) -> list[list]:
    """Whole sequences from the fractional solution.

    ``share`` of each pattern's number is rounded down. The rest goes by best fit, longest first, into
    the gaps and then into new sequences, a group at a time, so the work depends on the lengths, not
    on the pieces.
    """
    left = counts.astype(np.int64).copy()
    groups: dict[int, list[list]] = {}
    lengths = np.arange(capacity + 1)

    def put(pattern: np.ndarray, n: int) -> None:
        if n:
            groups.setdefault(capacity - int(pattern @ lengths), []).append([pattern, n])

    full = np.zeros(capacity + 1, dtype=np.int64)
    full[capacity] = 1
    put(full, int(left[capacity]))
    left[capacity] = 0
    for pattern, x in sorted(program, key=lambda p: -p[1]):
        need = pattern > 0
        n = min(int(share * x + 1e-9), int((left[need] // pattern[need]).min()))
        put(pattern, n)
        left -= n * pattern
    for length in range(capacity, 0, -1):
        while left[length]:
            free = min((f for f, g in groups.items() if f >= length and g), default=None)
            if free is None:
                each = min(capacity // length, int(left[length]))
                pattern = np.zeros(capacity + 1, dtype=np.int64)
                pattern[length] = each
                n = int(left[length]) // each
                left[length] -= n * each
                put(pattern, n)
                continue
            pattern, n = groups[free].pop()
            k = min(n, int(left[length]))
            fuller = pattern.copy()
            fuller[length] += 1
            put(fuller, k)
            put(pattern, n - k)
            left[length] -= k
    return [g for gs in groups.values() for g in gs]


def rank_segments(groups: list[list], capacity: int) -> np.ndarray:
    """Rows ``length, first rank, first sequence, sequences, offset`` sorted by length and rank."""
    rows, base, next_rank = [], 0, np.zeros(capacity + 1, dtype=np.int64)
    for pattern, n in groups:
        offset = 0
        for length in np.flatnonzero(pattern)[::-1]:
            for _ in range(pattern[length]):
                rows.append((length, next_rank[length], base, n, offset))
                next_rank[length] += n
                offset += length
        base += n
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(pieces: DataFrame, length_col: str, key_cols: list[str], capacity: int = CAPACITY, rounds: int = 60) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (a table that reads the same twice), whose lengths are 1 to ``capacity``.

    Ranks within a length come from counts per length and salt and a row number inside each, so a
    length that a third of all pieces share is spread over many tasks. Rows of a null or other length
    have no place and get nulls; repeated rows are packed one by one; an empty table gives no rows. Columns ``sequence_id``
    and ``offset`` are replaced, all others stay.
    """
    salt, number, spot = free_names(pieces, "pack_salt", "pack_number", "pack_place")
    length, fits = F.col(length_col), F.col(length_col).between(1, capacity)
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64(*key_cols), F.lit(SALTS)).cast("int"))
    tally = salted.where(fits).groupBy(length.alias("length"), F.col(salt).alias("salt")).count().collect()
    counts = np.zeros((capacity + 1, SALTS), dtype=np.int64)
    for row in tally:
        counts[row["length"], row["salt"]] = row["count"]
    segments = rank_segments(plan_sequences(counts.sum(axis=1), capacity, rounds), capacity)
    firsts = np.cumsum(counts, axis=1) - counts
    keys = segments[:, 0] * (1 << 44) + segments[:, 1]

    def place(lengths: pd.Series, salts: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        ok = lengths.between(1, capacity).to_numpy(dtype=bool, na_value=False)
        size = lengths.where(ok, 0).to_numpy(np.int64)
        rank = firsts[size, salts.to_numpy(np.int64)] + numbers.to_numpy(np.int64) - 1
        at = np.searchsorted(keys, size * (1 << 44) + rank, side="right") - 1
        if not len(segments):
            empty = pd.array([None] * len(ok), dtype="Int64")
            return pd.DataFrame({"sequence_id": empty, "offset": empty})
        found = segments[np.maximum(at, 0)]
        return pd.DataFrame({
            "sequence_id": pd.Series(found[:, 2] + rank - found[:, 1], dtype="Int64").where(ok),
            "offset": pd.Series(found[:, 4], dtype="Int64").where(ok),
        })

    order = Window.partitionBy(length_col, salt).orderBy(*key_cols)
    numbered = salted.withColumn(number, F.row_number().over(order))
    places = F.pandas_udf(place, "sequence_id long, offset long")(length, F.col(salt), F.col(number))
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    return numbered.withColumn(spot, places).select(*own, f"{spot}.*")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Cut every text into pieces and pack them; null texts count as empty and hold the end id alone."""
    pieces = written(cut_pieces(docs, id_col, text_col, capacity), "pieces")
    return pack(pieces, "length", ["doc_id", "piece", "ids_crc32"], capacity)
