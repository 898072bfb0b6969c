"""Removal of repeated word windows by a relative Lempel-Ziv parse against the whole corpus.

Every text is cut into phrases at content-defined places: the windows of 35 words that share their
smallest 8-word fingerprint (the anchor) make one phrase, so equal passages are cut alike wherever
they stand. All phrases of the corpus together are the reference, indexed by anchor. A phrase that
occurs again is a factor longer than a window, and all its windows are repeated. Where a factor
breaks off, the phrases share an anchor but differ; only there, at factor boundaries, single windows
are compared. Two equal windows have the same anchor at the same place, so nothing is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import OTHER, WORDS, free_names, slices, small_batches, word_hashes, word_places, written

WINDOW = 35
ANCHOR = 8

PHRASES = "doc_key long, text_hash long, anchor long, phrase long, start int, windows short"


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the leftmost place of the least value among ``width`` values (doubling, two overlapping blocks)."""
    place, step = np.arange(len(values)), 1
    while 2 * step <= width:
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[left] <= values[right], left, right)
        step *= 2
    n = len(values) - width + 1
    left, right = place[:n], place[width - step : width - step + n]
    return np.where(values[left] <= values[right], left, right)


def phrases_of(hashes: np.ndarray, firsts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Text number, first word, number of windows, anchor and phrase hash of all phrases of a run of texts.

    ``firsts`` holds the place of each text's first word and, last, the number of words. Texts
    shorter than a window have no phrase.
    """
    n, width = len(hashes), window - ANCHOR + 1
    empty = np.zeros(0, dtype=np.int64)
    if n < window:
        return empty, empty, empty, empty, empty
    sums = WORDS.prefix(hashes)
    starts = np.arange(n - ANCHOR + 1)
    anchors = WORDS.spans(sums, starts, starts + ANCHOR)
    least = leftmost_least(anchors, width)
    text = np.searchsorted(firsts, np.arange(n), side="right") - 1
    ends = firsts[text + 1]
    places = np.flatnonzero(np.arange(n - window + 1) + window <= ends[: n - window + 1])
    if not len(places):
        return empty, empty, empty, empty, empty
    least = least[places]
    new = np.append(True, (least[1:] != least[:-1]) | (places[1:] != places[:-1] + 1) | (text[places[1:]] != text[places[:-1]]))
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(places)))
    begin = places[at]
    other = OTHER.prefix(hashes)
    phrase = OTHER.spans(other, begin, begin + count - 1 + window)
    return text[begin], begin, count, signed(anchors[least[at]]), signed(phrase)


def windows_of(hashes: np.ndarray, sums: np.ndarray, begin: int, count: int, window: int = WINDOW) -> np.ndarray:
    starts = np.arange(begin, begin + count)
    return signed(OTHER.spans(sums, starts, starts + window))


def phrase_table(docs: DataFrame, window: int) -> DataFrame:
    """All phrases of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            doc, text_hash = batch["doc_key"].to_numpy(np.int64), batch["text_hash"].to_numpy(np.int64)
            for first, texts in slices(batch["text"]):
                hashes, firsts = word_hashes(texts)
                text, begin, count, anchor, phrase = phrases_of(hashes, firsts, window)
                for part in range(0, len(text), 200_000):
                    cut = slice(part, part + 200_000)
                    own = text[cut] + first
                    yield pd.DataFrame({
                        "doc_key": doc[own], "text_hash": text_hash[own], "anchor": anchor[cut], "phrase": phrase[cut],
                        "start": (begin[cut] - firsts[text[cut]]).astype(np.int32), "windows": count[cut].astype(np.int16),
                    })

    return docs.mapInPandas(run, PHRASES)


def window_table(asked: DataFrame, window: int) -> DataFrame:
    """The windows of the asked phrases: ``asked`` has a text and its ``phrases`` (anchor, start, windows, copies)."""
    schema = "doc_key long, text_hash long, anchor long, window long, start int, copies int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, text_hash, text, phrases in zip(batch["doc_key"], batch["text_hash"], batch["text"], batch["phrases"]):
                hashes, _ = word_hashes([text.encode("utf-8", "surrogatepass")])
                sums = OTHER.prefix(hashes)
                begin = np.array([p["start"] for p in phrases], dtype=np.int64)
                count = np.array([p["windows"] for p in phrases], dtype=np.int64)
                anchor = np.array([p["anchor"] for p in phrases], dtype=np.int64)
                copies = np.array([p["copies"] for p in phrases], dtype=np.int32)
                starts = np.repeat(begin - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
                yield pd.DataFrame({
                    "doc_key": doc, "text_hash": text_hash, "anchor": np.repeat(anchor, count),
                    "window": signed(OTHER.spans(sums, starts, starts + window)),
                    "start": starts.astype(np.int32), "copies": np.repeat(copies, count),
                })

    return asked.mapInPandas(run, schema)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_key, text_hash, start, windows``: runs of consecutive repeated windows, maybe overlapping, of keyed texts."""
    phrases = written(phrase_table(docs, window), "phrases")
    kinds = written(
        phrases.groupBy("anchor", "phrase").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_key", "text_hash", "start", "windows")).alias("first")),
        "phrase-kinds",
    )
    # an anchor with several kinds of phrases is where factors break off
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("n")).where("n > 1")
    anchors = written(anchors, "anchors")
    repeats = written(kinds.where("n > 1").select("anchor", "phrase"), "factors")
    # long factors: phrases that occur again
    held = phrases.join(repeats, ["anchor", "phrase"], "left_semi")
    spans = held.select("doc_key", "text_hash", "start", F.col("windows").cast("int").alias("windows"))
    # factor boundaries: one phrase of each kind stands for its copies
    broken = anchors.where("kinds > 1").select("anchor")
    open_kinds = kinds.join(broken, "anchor", "left_semi")
    asked = open_kinds.select("first.doc_key", "first.text_hash",
                              F.struct("anchor", "first.start", "first.windows", F.least("n", F.lit(2)).cast("int").alias("copies")).alias("p"))
    asked = written(asked.groupBy("doc_key", "text_hash").agg(F.collect_list("p").alias("phrases")), "asked")
    texts = docs.join(asked, ["doc_key", "text_hash"])
    # rows that share key and text are copies, whose windows are all repeated: counting them twice changes nothing
    windows = written(window_table(texts.select("doc_key", "text_hash", "text", "phrases"), window), "windows")
    again = windows.groupBy("anchor", "window").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor", "window")
    again = written(again, "windows-again")
    single = windows.where("copies = 1").join(again, ["anchor", "window"], "left_semi")
    return spans.union(single.select("doc_key", "text_hash", "start", F.lit(1).alias("windows")))


def covered(n: int, starts: np.ndarray, windows: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words stand in a repeated window."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + windows - 1 + window, -1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, tidy: bool = False) -> DataFrame:
    """``docs`` with the words of repeated windows removed, as ``kept``, with ``n_words`` and ``n_removed``.

    Words are runs of other characters than blank, tab, line feed, vertical tab, form feed and
    return. A window of ``window`` words is repeated if its words start anywhere else, in the same
    text or another; windows are judged on the input. ``kept`` joins the words left by one blank;
    with ``tidy`` a text that loses nothing stays as it is and others keep their own white space. A
    null text has no words. Null ids and repeated rows are allowed (copies lose everything); an
    empty table gives no rows; columns ``kept``, ``n_words``, ``n_removed`` are replaced,
    all others stay.
    """
    small_batches(docs.sparkSession)
    key, digest, own_spans, cut_result = free_names(docs, "doc_key", "text_hash", "spans", "cut_result")
    keyed = docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(-1)))
    keyed = keyed.withColumn(digest, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    texts = keyed.select(F.col(key).alias("doc_key"), F.col(digest).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = repeated_spans(texts, window)
    marks = spans.groupBy("doc_key", "text_hash").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    marks = written(marks, "spans")
    marks = marks.select(F.col("doc_key").alias(key), F.col("text_hash").alias(digest), F.col("spans").alias(own_spans))
    marked = keyed.join(marks, [key, digest], "left")

    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in parts:
            rows = []
            for text, found in zip(texts, spans):
                data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
                array = np.frombuffer(data, dtype=np.uint8)
                starts, ends = word_places(array)
                n, gone = len(starts), np.zeros(len(starts), dtype=bool)
                if found is not None and len(found):
                    at = np.array([s["start"] for s in found], dtype=np.int64)
                    gone = covered(n, at, np.array([s["windows"] for s in found], dtype=np.int64), window)
                if not tidy:
                    kept = b" ".join([data[starts[i] : ends[i]] for i in np.flatnonzero(~gone)]) if gone.any() else b" ".join(words(data))
                elif gone.any():
                    keep = np.ones(len(data), dtype=bool)
                    follow = np.append(starts[1:], len(data))
                    for i in np.flatnonzero(gone):
                        keep[starts[i] : follow[i]] = False
                    kept = array[keep].tobytes().rstrip(b" \t\n\x0b\x0c\r")
                else:
                    kept = data
                rows.append((kept.decode("utf-8", "surrogatepass"), n, int(gone.sum())))
            yield pd.DataFrame(rows, columns=["kept", "n_words", "n_removed"])

    result = F.pandas_udf(cut, "kept string, n_words long, n_removed long")(F.col(text_col), F.col(own_spans))
    own = [c for c in docs.columns if c not in ("kept", "n_words", "n_removed")]
    return marked.withColumn(cut_result, result).select(*own, f"{cut_result}.*")


def words(data: bytes) -> list[bytes]:
    """The words of a text; ``bytes.split`` cuts at the same six characters."""
    return data.split()
