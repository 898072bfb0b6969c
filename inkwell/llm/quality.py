"""Quality by co-training: a text-content view and a metadata view teach each other, then score together.

The content view sees how words are formed (hashed word shapes and their shares). The metadata view
sees source, language, size and layout numbers, and no word. Each starts from labelled rows; in every
round each view labels the unlabelled rows it is surest of for the other. At the end both are
calibrated on labelled rows that neither was fitted on, and their calibrated log-odds are added up.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import small_batches, written

BINS = 2048
HASHED = 64
PIECE = 64
NUMBERS = 13
CUTS = 9
RUN = re.compile(r"(.)\1+")
MEMO = 300_000
THRESHOLD = 0.5


class Shapes:
    """Bins of word shapes: letters become a or A, digits 9, runs of one character once; other characters stay.

    A word of more than ``PIECE`` characters counts as its consecutive pieces of that length.
    """

    def __init__(self):
        self.memo: dict[str, int] = {}

    def bin_of(self, word: str) -> int:
        shape = "".join(c if not c.isalnum() else "9" if c.isdigit() else "A" if c.isupper() else "a" for c in word)
        return zlib.crc32(RUN.sub(r"\1", shape).encode("utf-8", "surrogatepass")) % BINS

    def content(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places and square-rooted shares of the shapes of a text; every word counts, and all of it."""
        if words and max(map(len, words)) > PIECE:
            words = [word[k : k + PIECE] for word in words for k in range(0, len(word), PIECE)]
        found = list(map(self.memo.get, words))
        if None in found:
            if len(self.memo) > MEMO:
                self.memo.clear()
            for k, f in enumerate(found):
                if f is None:
                    found[k] = self.memo[words[k]] = self.bin_of(words[k])
        counts = np.bincount(np.array(found, dtype=np.int64), minlength=1)
        places = np.flatnonzero(counts)
        return places, np.sqrt(counts[places] / max(len(words), 1))


def layout(text: str, words: list[str], lang: str | None, source: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of size and layout, then hashed language and source."""
    n = max(len(text), 1)
    lines = text.split("\n")
    data = np.frombuffer(text.encode("utf-8", "surrogatepass") or b" ", dtype=np.uint8)
    upper = ((data >= 65) & (data <= 90)).mean()
    letters = upper + ((data >= 97) & (data <= 122)).mean() + (data >= 128).mean()
    digits = ((data >= 48) & (data <= 57)).mean()
    blank = ((data == 32) | ((data >= 9) & (data <= 13))).mean()
    numbers = [
        np.log1p(n) / 10, np.log1p(len(lines)) / 5, np.log1p(n / len(lines)) / 8, upper, letters, digits, blank,
        1 - letters - digits - blank, len(set(words)) / max(len(words), 1), len(set(lines)) / len(lines),
        sum(map(str.__eq__, words, words[1:])) / max(len(words), 1), len(zlib.compress(data, 1)) / len(data),
        len(set(zip(words, words[1:]))) / max(len(words) - 1, 1),
    ]
    hashed = [NUMBERS + zlib.crc32(f"{k}:{v}".encode()) % HASHED for k, v in (("lang", lang), ("source", source))]
    return np.append(np.arange(NUMBERS), np.unique(hashed)), np.append(np.array(numbers), np.ones(len(set(hashed))))


@dataclass
class Sparse:
    """Rows that are zero in most places: the row, place and value of each other entry."""

    row: np.ndarray
    at: np.ndarray
    values: np.ndarray
    shape: tuple[int, int]

    @staticmethod
    def of(rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> Sparse:
        row = np.repeat(np.arange(len(rows)), [len(places) for places, _ in rows])
        at = np.concatenate([np.zeros(0, np.int64), *(places for places, _ in rows)]).astype(np.int64)
        return Sparse(row, at, np.concatenate([np.zeros(0), *(values for _, values in rows)]), (len(rows), width))

    def __len__(self) -> int:
        return self.shape[0]

    def __getitem__(self, rows: np.ndarray) -> Sparse:
        place = np.full(len(self), -1)
        place[rows] = np.arange(len(rows))
        keep = place[self.row] >= 0
        return Sparse(place[self.row[keep]], self.at[keep], self.values[keep], (len(rows), self.shape[1]))

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.values * weights[self.at], minlength=len(self))

    def back(self, weights: np.ndarray, power: int = 1) -> np.ndarray:
        """Sums over the rows of each place's values (to ``power``), rows weighted."""
        return np.bincount(self.at, weights=self.values**power * weights[self.row], minlength=self.shape[1])


def back(x: Sparse | np.ndarray, weights: np.ndarray, power: int = 1) -> np.ndarray:
    return x.back(weights, power) if isinstance(x, Sparse) else weights @ (x if power == 1 else x**power)


@dataclass
class View:
    """Logistic regression over sparse or dense rows; columns are centred and scaled by the training rows.

    Mean and scale are folded into the weights, so the rows are never copied. The first ``numbers`` columns also enter as the quantile interval of the training rows they fall in.
    """

    width: int
    numbers: int = 0
    edges: np.ndarray | None = None
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    slope: float = 1.0
    shift: float = 0.0

    def table(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse | np.ndarray:
        """The rows as a table: dense if there are numbers to cut into intervals."""
        if not self.numbers:
            return Sparse.of(rows, self.width)
        out = np.zeros((len(rows), self.width))
        for i, (places, values) in enumerate(rows):
            out[i, places] = values
        return out

    def widen(self, x: Sparse | np.ndarray) -> Sparse | np.ndarray:
        if not self.numbers:
            return x
        parts = [np.eye(CUTS + 1)[np.searchsorted(self.edges[:, k], x[:, k], side="right")] for k in range(self.numbers)]
        return np.column_stack([x, *parts])

    def fit(self, x: Sparse | np.ndarray, y: np.ndarray, steps: int = 200, l2: float = 1e-3) -> None:
        if self.numbers:
            self.edges = np.quantile(x[:, : self.numbers], np.linspace(0, 1, CUTS + 2)[1:-1], axis=0)
        x = self.widen(x)
        rows = np.ones(len(x))
        self.mean = back(x, rows) / len(x)
        self.scale = np.sqrt(np.maximum(back(x, rows, 2) / len(x) - self.mean**2, 0.0))
        self.scale[self.scale < 1e-9] = np.inf
        by = np.maximum(self.scale, 0.02)
        weight = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3)) / len(y)
        w, push, squares = (np.zeros(len(by) + 1) for _ in range(3))
        for step in range(1, steps + 1):
            u = w[:-1] / by
            p = 1 / (1 + np.exp(-np.clip(x @ u + (w[-1] - self.mean @ u), -30, 30)))
            r = (p - y) * weight
            g = np.append((back(x, r) - self.mean * r.sum()) / by, r.sum()) + l2 * w
            push, squares = 0.9 * push + 0.1 * g, 0.99 * squares + 0.01 * g * g
            w -= 0.1 * (push / (1 - 0.9**step)) / (np.sqrt(squares / (1 - 0.99**step)) + 1e-8)
        self.weights = w

    def odds(self, x: Sparse | np.ndarray) -> np.ndarray:
        u = self.weights[:-1] / np.maximum(self.scale, 0.02)
        return np.clip(self.widen(x) @ u + (self.weights[-1] - self.mean @ u), -30, 30)

    def calibrate(self, odds: np.ndarray, y: np.ndarray) -> None:
        """Slope and shift that make the odds fit the labels (Platt), held near 1 and 0: damped Newton steps."""
        a, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
        x = np.column_stack([odds, np.ones(len(odds))])

        def loss(a: np.ndarray) -> float:
            z = x @ a
            return float((np.logaddexp(0, z) - y * z).sum() + ((a - start) ** 2).sum() / 2)

        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
            step, size = np.linalg.solve(h, x.T @ (p - y) + (a - start)), 1.0
            while size > 1e-6 and loss(a - size * step) > loss(a):
                size /= 2
            a = a - size * step
            if np.abs(size * step).max() < 1e-6:
                break
        self.slope, self.shift = max(float(a[0]), 1e-3), float(a[1])


@dataclass
class QualityModel:
    content: View
    layout: View
    prior: float = 0.0

    def score(self, content: Sparse, layout: np.ndarray) -> np.ndarray:
        """Both calibrated log-odds added up as views that err apart, the log-odds of the labels counted once."""
        total = sum(v.slope * v.odds(x) + v.shift for v, x in ((self.content, content), (self.layout, layout)))
        return 1 / (1 + np.exp(-np.clip(total - self.prior, -30, 30)))


def view_rows(texts: list[str], langs: list, sources: list, shapes: Shapes) -> tuple[list, list]:
    content, layouts = [], []
    for text, lang, source in zip(texts, langs, sources):
        words = text.split()
        content.append(shapes.content(words))
        layouts.append(layout(text, words, lang, source))
    return content, layouts


def co_train(content: Sparse, layouts: np.ndarray, y: np.ndarray, prior: float, rounds: int = 4, share: float = 0.1) -> QualityModel:
    """``y``: 1, 0, or NaN for unlabelled rows. A quarter of the labelled rows is kept for calibration.

    ``prior`` is the share of label 1 among all labelled rows; the sample may have another.
    """
    model = QualityModel(View(BINS), View(NUMBERS + HASHED, NUMBERS))
    known = np.flatnonzero(~np.isnan(y))
    spare = known[::4] if len(known) >= 40 else known[:0]
    fit = np.setdiff1d(known, spare)
    given = {"content": y.copy(), "layout": y.copy()}
    for labels in given.values():
        labels[spare] = np.nan
    pool = np.setdiff1d(np.flatnonzero(np.isnan(y)), known)
    per_round = max(1, int(share * len(fit)))
    if len(np.unique(y[fit])) < 2:
        constant = float(np.nanmean(y)) if len(known) else 1.0
        for view in (model.content, model.layout):
            view.edges = np.zeros((CUTS, NUMBERS))
            width = view.width + view.numbers * (CUTS + 1)
            view.mean, view.scale, view.weights = np.zeros(width), np.ones(width), np.zeros(width + 1)
            view.weights[-1] = np.log((constant + 1e-3) / (1 - constant + 1e-3))
        model.prior = float(model.layout.weights[-1])
        return model
    good = y[fit].mean()
    for round_ in range(rounds + 1):
        for name, x in (("content", content), ("layout", layouts)):
            rows = np.flatnonzero(~np.isnan(given[name]))
            getattr(model, name).fit(x[rows], given[name][rows])
        if round_ == rounds or not len(pool):
            break
        views = {"content": model.content.odds(content[pool]), "layout": model.layout.odds(layouts[pool])}
        for name, other in (("content", "layout"), ("layout", "content")):
            odds, contrary = views[name], views[other]
            order = np.argsort(odds, kind="stable")
            free = np.isnan(given[other][pool])
            for label, ranked, n in ((1.0, order[::-1], per_round * good), (0.0, order, per_round * (1 - good))):
                sign = 1 if label else -1
                # what the receiving view is itself sure to be the opposite is not taken over
                sure = [i for i in ranked if free[i] and sign * odds[i] > 1 and sign * contrary[i] > -1][: int(np.ceil(n))]
                given[other][pool[sure]] = label
    check = spare if len(spare) and len(np.unique(y[spare])) > 1 else fit
    for view, x in ((model.content, content), (model.layout, layouts)):
        view.calibrate(view.odds(x[check]), y[check])
        own = float(np.clip(y[check].mean(), 1e-3, 1 - 1e-3))
        view.shift += np.log(prior / (1 - prior)) - np.log(own / (1 - own))
    model.prior = float(np.log(prior / (1 - prior)))
    return model


def column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, pool: int = 4000) -> QualityModel:
    """Co-train on a bounded sample: at most ``sample`` labelled rows of the learning part (crc32 of the
    id modulo 3 is not 1), half of each label where there are enough, and ``pool`` unlabelled ones,
    both taken by a hash of the id.

    Texts that many rows repeat stand for one row of a part, that of the smallest id; rows that repeat
    an id and its text count once. Null texts are empty, rows with a null id are not learned from, of
    several labels of an id the larger holds. With labels of one kind or none the score is constant.
    """
    small_batches(docs.sparkSession)
    known = labels.where("quality is not null and doc_id is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("double").alias("label"))
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        column_or_null(docs, "lang").alias("lang"), column_or_null(docs, "source").alias("source"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    rows = texts.select("doc_id", "text_hash").join(known, "doc_id", "left")
    rows = rows.withColumn("part", F.when(F.col("label").isNull() | held, 2).otherwise(F.col("label").cast("int")))
    ids = rows.groupBy("text_hash", "part").agg(F.min("doc_id").alias("doc_id"))
    ids = ids.withColumn("label", F.when(F.col("part") < 2, F.col("part").cast("double"))).withColumn("order", F.xxhash64("doc_id"))
    by = "order", "doc_id", "text_hash"
    picked = [ids.where(F.col("part") == p).orderBy(*by).limit(n) for p, n in ((0, sample // 2), (1, sample // 2), (2, pool))]
    chosen = written(picked[0].union(picked[1]).union(picked[2]), "quality-sample")
    # sample + pool rows, at most
    taken = texts.join(F.broadcast(chosen), ["doc_id", "text_hash"])
    taken = taken.groupBy("doc_id", "text_hash", "part", "label", "order").agg(*(F.min(c).alias(c) for c in ("text", "lang", "source")))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = Shapes()
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            content, layouts = view_rows(texts, list(batch["lang"]), list(batch["source"]), shapes)
            yield pd.DataFrame({
                "order": batch["order"], "part": batch["part"], "text_hash": batch["text_hash"], "label": batch["label"],
                "c_at": [c[0] for c in content], "c": [c[1] for c in content], "l_at": [x[0] for x in layouts], "l": [x[1] for x in layouts],
            })

    schema = "order long, part int, text_hash long, label double, c_at array<long>, c array<double>, l_at array<long>, l array<double>"
    found = written(taken.mapInPandas(features, schema), "quality-features").orderBy("order", "part", "text_hash").toPandas()
    model = QualityModel(View(BINS), View(NUMBERS + HASHED, NUMBERS))
    content = model.content.table(list(zip(found["c_at"], found["c"])))
    layouts = model.layout.table(list(zip(found["l_at"], found["l"])))
    share = rows.where("part < 2").agg(F.avg("label").alias("share")).first()["share"]
    prior = float(np.clip(0.5 if share is None else share, 1e-3, 1 - 1e-3))
    return co_train(content, layouts, found["label"].to_numpy(float), prior)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if score >= 0.5).

    Null and empty texts are scored by their metadata and an empty content row; null metadata is a
    value of its own. Repeated rows get equal scores; columns of the two names are replaced; an empty
    table gives no rows.
    """
    small_batches(docs.sparkSession)

    def score(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shapes = Shapes()
        for texts, langs, sources in parts:
            content, layouts = view_rows([t if isinstance(t, str) else "" for t in texts], list(langs), list(sources), shapes)
            yield pd.Series(model.score(model.content.table(content), model.layout.table(layouts)), dtype=float)

    scored = F.pandas_udf(score, "double")(F.col("text"), column_or_null(docs, "lang"), column_or_null(docs, "source"))
    return docs.withColumn("score", scored).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
