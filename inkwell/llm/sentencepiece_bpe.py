"""SentencePiece encoding and decoding with vectorised merge rounds over flat symbol arrays.

The words of a batch stand in one flat array of symbol ids. A round looks up the rank of every pair
of neighbours, takes the smallest rank of each word by a segmented minimum, merges its leftmost
place in all words at once and compacts the array; words without a pair left drop out. Distinct
words are encoded once and kept in a bounded memory, so long texts of known words cost a lookup.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import small_batches

BLANK = "▁"
LONG_WORD = 128
MEMO = 700_000
NONE = np.iinfo(np.int64).max


class PieceModel:
    """The pieces of a model file, as lookup tables, and exact encoding and decoding.

    Holds for models of the merge kind with byte fallback, no normalisation and a blank put before
    the text; others are refused.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.end = model.eos_id()
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.bytes_of = [b""] * n
        for i in range(n):
            if model.is_byte(i):
                value = int(pieces[i][1:-1], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
        ids = {pieces[i]: i for i in normal}
        if any(BLANK in p.lstrip(BLANK) for p in ids) or model.decode(model.encode("  a\tＡ ")) != "  a\tＡ ":
            raise ValueError("only models without normalisation, whose pieces hold blanks at the front, are supported")
        for piece, i in ids.items():
            self.bytes_of[i] = piece.replace(BLANK, " ").encode()
        self.chars = {p: i for p, i in ids.items() if len(p) == 1}
        # symbols are piece ids; a character without a piece is a symbol of its own beyond them
        self.unknown = n
        self.texts = pieces
        rank = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in normal}, reverse=True))}
        pairs, ranks, results = [], [], []
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs.append(left * (n + 1) + right)
                    ranks.append(rank[model.get_score(i)])
                    results.append(i)
        order = np.argsort(pairs)
        self.width = n + 1
        self.pairs = np.array(pairs, dtype=np.int64)[order]
        self.ranks = np.array(ranks, dtype=np.int64)[order]
        self.results = np.array(results, dtype=np.int64)[order]
        known = set("".join(ids))
        # no piece crosses a blank run's end; a character that no piece holds also ends a word
        self.word = re.compile(rf"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+" if "\n" not in known else rf"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.codes = np.full(0x110000, self.unknown, dtype=np.int64)
        for char, i in self.chars.items():
            self.codes[ord(char)] = i
        self.names = [str(i) for i in range(n)]
        self.memo: dict[str, str] = {}
        self.table: dict[int, tuple[int, int]] = {}

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the table of merges, or -1."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, at, -1)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        out: list = [[] for _ in words]
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG_WORD]
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                out[i] = self.merge_long(word)
        for part in range(0, len(short), 20_000):
            chosen = short[part : part + 20_000]
            for i, ids in zip(chosen, self.merge_rounds([words[i] for i in chosen])):
                out[i] = ids
        return out

    def symbols(self, text: str) -> np.ndarray:
        return self.codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]

    def merge_rounds(self, words: list[str]) -> list[list[int]]:
        flat = "".join(words)
        symbol = self.symbols(flat)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        char = np.arange(len(symbol))
        at = np.full(len(symbol), -1)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        at[inner] = self.find(symbol[inner], symbol[inner + 1])
        done_owner, done_symbol, done_char = [], [], []
        while len(symbol):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            # rank and place in one number: the segmented minimum is the leftmost place of the best rank
            keyed = np.where(at >= 0, self.ranks[at] * (1 << 32) + np.arange(len(symbol)), NONE)
            least = np.minimum.reduceat(keyed, starts)
            ended = np.repeat(least == NONE, np.diff(np.append(starts, len(symbol))))
            done_owner.append(owner[ended])
            done_symbol.append(symbol[ended])
            done_char.append(char[ended])
            first = least[least != NONE] & ((1 << 32) - 1)
            symbol[first] = self.results[at[first]]
            keep = ~ended
            keep[first + 1] = False
            merged = (np.cumsum(keep) - 1)[first]
            owner, symbol, char, at = owner[keep], symbol[keep], char[keep], at[keep]
            # only the pairs on both sides of a merged symbol are new
            touched = np.concatenate([merged, merged[merged > 0] - 1])
            at[touched] = -1
            touched = touched[touched + 1 < len(symbol)]
            touched = touched[owner[touched] == owner[touched + 1]]
            at[touched] = self.find(symbol[touched], symbol[touched + 1])
        owner, symbol, char = map(np.concatenate, (done_owner, done_symbol, done_char))
        order = np.argsort(owner, kind="stable")
        owner, symbol, char = owner[order], symbol[order], char[order]
        cuts = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        strange = {owner[i]: None for i in np.flatnonzero(symbol == self.unknown)}
        ids = symbol.tolist()
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in strange:
            own = char[cuts[i] : cuts[i + 1]]
            out[i] = self.with_bytes(out[i], [flat[c] for c in own])
        return out

    def with_bytes(self, symbols: list[int], chars: list[str]) -> list[int]:
        """Replace each unknown symbol by the ids of the bytes of its character."""
        out: list[int] = []
        for symbol, char in zip(symbols, chars):
            out.extend(self.byte_ids[list(char.encode("utf-8", "surrogatepass"))].tolist() if symbol == self.unknown else [symbol])
        return out

    def merge_long(self, word: str) -> list[int]:
        """The same merges for one very long word, by a heap over a linked list: n log n instead of a round per merge."""
        symbols = self.symbols(word)
        n = len(symbols)
        symbol, before, after = symbols.tolist(), list(range(-1, n - 1)), [*range(1, n), -1]
        if not self.table:
            self.table.update(zip(self.pairs.tolist(), zip(self.ranks.tolist(), self.results.tolist())))
        table = self.table
        heap: list = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (hit := table.get(symbol[i] * self.width + symbol[after[i]])):
                heapq.heappush(heap, (hit[0], i, symbol[i], after[i], symbol[after[i]], hit[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, j, right, result = heapq.heappop(heap)
            if symbol[i] != left or after[i] != j or symbol[j] != right:
                continue
            symbol[i], symbol[j], after[i] = result, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        kept = [i for i in range(n) if symbol[i] >= 0]
        return self.with_bytes([symbol[i] for i in kept], [word[i] for i in kept])

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the pieces, without the blank that encoding puts before a text."""
        return b"".join([self.bytes_of[i] for i in ids])

    def split(self, text: str) -> list[str]:
        """The words of a text with the blank put before it; a single blank before a word is left out."""
        if not text:
            return []
        if text[0] != " " and text[-1] != " " and "  " not in text and BLANK not in text:
            return text.split(" ")
        words = self.word.findall(BLANK + text.replace(" ", BLANK))
        return [w[1:] if w[0] == BLANK and w[1:2] not in ("", BLANK) else BLANK + w for w in words]

    def learn(self, words: list[str]) -> None:
        """Encode new words, decode their ids, and keep both; a word that starts with a blank is kept as it is."""
        full = [w[1:] if w[:1] == BLANK else BLANK + w for w in words]
        names = self.names
        encoded = self.encode_words(full)
        if self.decode([i for ids in encoded for i in ids]) != "".join(full).replace(BLANK, " ").encode("utf-8", "surrogatepass"):
            raise ValueError("the ids of some word do not decode to it")
        self.memo.update((word, " ".join([names[i] for i in ids])) for word, ids in zip(words, encoded))


def encode_texts(model: PieceModel, texts: list[str]) -> Iterator[tuple[int, str, str]]:
    """Number of ids with the end id, ids as text, and the decoded text, of each text."""
    memo, fresh, held = model.memo, {}, []
    for text in texts:
        words = model.split(text)
        found = list(map(memo.get, words))
        missing = [k for k, f in enumerate(found) if f is None] if None in found else []
        fresh.update((words[k], None) for k in missing)
        held.append((found, [(k, words[k]) for k in missing]))
    model.learn(list(fresh))
    for text, (found, missing) in zip(texts, held):
        for k, word in missing:
            found[k] = memo[word]
        found.append(model.names[model.end])
        ids = " ".join(found)
        # every word decodes to itself with its blanks, so the text does; the blank put before it goes
        yield ids.count(" ") + 1, ids, text.replace(BLANK, " ")
    if len(memo) > MEMO:
        memo.clear()


def encode_documents(docs: DataFrame, model_name: str, id_col: str = "doc_id", text_col: str = "text", full: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every text, or their digests if not ``full``.

    Ids end with the end id. A null text counts as empty: one id, decoded to the empty text. Null ids
    and repeated rows are kept; an empty table gives no rows; other columns are left out.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers as public

        model = PieceModel(public.path(model_name))
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            rows = list(encode_texts(model, texts))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "n_tokens": np.array([r[0] for r in rows], dtype=np.int64),
                "ids": [r[1] if full else hashlib.sha256(r[1].encode()).hexdigest() for r in rows],
                "decoded": [r[2] if full else hashlib.sha256(r[2].encode()).hexdigest() for r in rows],
            })

    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return columns.mapInPandas(run, "doc_id long, n_tokens long, ids string, decoded string")
