"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters are lexicons and patterns. One lexicon is given, and so are two patterns: an insult next to a
word of address, and runs of exclamation or question marks. The other lexicons hold words and word
beginnings that labelled rows of the learning part show to be signs of the label, cut in groups so
that voters err apart. Signs are counted by their hash in 2**22 places, so that tallies and lexicons
have one size for any corpus and every sign that passes the test is kept. A generative model with
class balance, an accuracy per voter and class, and a damping for pairs of voters that agree beyond
what the classes explain, is fitted to the counts of all vote patterns of the corpus by expectation
maximisation. Its posterior labels a bounded sample, on which a linear classifier over hashed words
and word beginnings is trained; the classifier scores all rows.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import small_batches, written

#: Common insults of English, German, French and Spanish.
INSULTS = [
    "idiot", "idiots", "idiotic", "moron", "morons", "stupid", "dumb", "loser", "losers", "pathetic", "worthless", "scum", "trash", "clown",
    "disgusting", "vermin", "filth", "garbage", "imbecile", "fool", "bastard", "bitch", "asshole", "jerk", "retard", "whore", "slut", "cretin",
    "dumm", "dummkopf", "trottel", "arschloch", "abschaum", "versager", "widerlich", "hurensohn", "schlampe", "idioten", "ekelhaft",
    "imbécile", "crétin", "connard", "salaud", "ordure", "débile", "abruti", "pourriture", "dégoûtant",
    "idiota", "imbécil", "estúpido", "estúpida", "escoria", "basura", "asqueroso", "asquerosa", "payaso", "perdedor", "inútil", "cabrón",
]

#: Words that turn to a reader, in the same languages.
ADDRESS = frozenset(["you", "your", "u", "du", "dich", "dein", "ihr", "tu", "toi", "ton", "vous", "te", "eres", "usted", "ustedes"])

WORD = re.compile(r"[^\W\d_]+")
SHOUT = re.compile(r"[!?]{2}")
PREFIXES = (4, 5, 6)
NEAR = 3
GROUPS = 6
VOTERS = GROUPS + 5
BITS = 18
SIGN_BITS = 22
MEMO = 200_000
RUN = 1 << 20
THRESHOLD = 0.7

INSULT_SET = frozenset(INSULTS)


def word_list(text: str) -> list[str]:
    return WORD.findall(unicodedata.normalize("NFC", text).lower())


def addressed(words: list[str]) -> bool:
    """Whether an insult stands within ``NEAR`` words of a word of address."""
    last, insult = -NEAR - 1, -NEAR - 1
    for i, word in enumerate(words):
        if word in ADDRESS:
            last = i
        elif word in INSULT_SET:
            insult = i
        else:
            continue
        if abs(last - insult) <= NEAR and min(last, insult) >= 0:
            return True
    return False


class Words(dict):
    """Numbers of words, given as they are met, and the hashes of each word's signs.

    Signs are the word, marked ``=``, and its beginnings, marked ``<``; short words repeat the first hash.
    """

    def __init__(self):
        super().__init__()
        self.signs: list[tuple[int, ...]] = []
        self.insults: list[bool] = []

    def __missing__(self, word: str) -> int:
        own = zlib.crc32(b"=" + word.encode("utf-8", "surrogatepass"))
        beginnings = (zlib.crc32(b"<" + word[:n].encode("utf-8", "surrogatepass")) if len(word) >= n else own for n in PREFIXES)
        self.signs.append((own, *beginnings))
        self.insults.append(word in INSULT_SET)
        number = len(self)
        self[word] = number
        return number


class Reader:
    """Hashed signs and votes of runs of texts; what a word gives is worked out once and kept in a bounded memory."""

    def __init__(self, lexicon: np.ndarray | None = None):
        self.groups = np.zeros(1 << SIGN_BITS, dtype=np.uint8)
        if lexicon is not None and len(lexicon):
            self.groups[lexicon] = 1 << (lexicon % GROUPS)
        self.forget()

    def forget(self) -> None:
        self.words = Words()
        self.signs, self.hits, self.insults = np.zeros((0, 4), np.int64), np.zeros(0, np.uint8), np.zeros(0, bool)

    def learn(self) -> None:
        """Bring the tables up to the words met so far."""
        new = np.array(self.words.signs[len(self.signs) :], dtype=np.int64).reshape(-1, 4)
        if len(new):
            self.insults = np.append(self.insults, self.words.insults[len(self.signs) :])
            self.signs = np.concatenate([self.signs, new])
            self.hits = np.append(self.hits, np.bitwise_or.reduce(self.groups[new & ((1 << SIGN_BITS) - 1)], axis=1))

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each distinct word of each text the text's place and the word's number; and the votes, a row a text."""
        if len(self.words) > MEMO:
            self.forget()
        number, found, sizes = self.words.__getitem__, [], []
        for text in texts:
            before = len(found)
            found.extend(map(number, set(word_list(text))))
            sizes.append(len(found) - before)
        self.learn()
        words, rows = np.array(found, dtype=np.int64), np.repeat(np.arange(len(texts)), sizes)
        votes = np.zeros((len(texts), VOTERS), dtype=np.int64)
        insults = np.bincount(rows[self.insults[words]], minlength=len(texts))
        votes[:, 0], votes[:, 1] = insults > 0, insults > 1
        for i in np.flatnonzero(insults):
            votes[i, 2] = addressed(word_list(texts[i]))
        votes[:, 3] = [SHOUT.search(text) is not None for text in texts]
        for k in range(GROUPS):
            votes[rows[(self.hits[words] >> k & 1).astype(bool)], 4 + k] = 1
        votes[:, -1] = votes[:, 4:-1].sum(axis=1) > 1
        return rows, words, votes

    def places(self, rows: np.ndarray, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct hashed signs of each text: its place among the texts and the sign's."""
        keys = np.sort((np.repeat(rows, 4) << bits) | (self.signs[words].ravel() & ((1 << bits) - 1)))
        keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
        return keys >> bits, keys & ((1 << bits) - 1)


def runs(texts: Iterable[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``RUN`` characters (one text at least), with the first one's place; null is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text if isinstance(text, str) else ""
        if held and size + len(text) > RUN:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def pattern_of(votes: np.ndarray) -> np.ndarray:
    """Each row of votes as the bits of a number."""
    return votes @ (1 << np.arange(VOTERS))


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return (np.asarray(patterns, dtype=np.int64)[:, None] >> np.arange(VOTERS) & 1).astype(float)


@dataclass
class LabelModel:
    """P(label | votes) from class balance and the votes' likelihood by class; votes are 1 or abstention, 0."""

    prior: float
    hit: np.ndarray  # voters x 2: P(vote | label)
    damping: np.ndarray  # voters: share of its evidence that correlated voters do not repeat

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes, no = np.log(self.hit), np.log1p(-self.hit)
        # a vote counts with its damping, a silence in full
        score = np.log(self.prior / (1 - self.prior)) + votes @ ((yes[:, 1] - yes[:, 0]) * self.damping) + (1 - votes) @ (no[:, 1] - no[:, 0])
        return 1 / (1 + np.exp(-np.clip(score, -50, 50)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, known: tuple[np.ndarray, np.ndarray], rounds: int = 100) -> LabelModel:
    """Expectation maximisation over the distinct vote patterns of all rows, anchored by labelled rows.

    ``known`` holds, by class, how many labelled rows there are and how many of them each voter
    marked; they weigh as much as all other rows together, so the classes cannot change places.
    After the accuracies settle, the agreement of each pair of voters inside the positive class
    beyond independence is their correlation; a voter's damping is one over one plus its correlations
    with the others, and the fit is repeated with it.
    """
    rows, marked = known
    scale = max(1.0, counts.sum() / max(rows.sum(), 1.0))
    rows, marked = rows * scale, marked * scale
    start = (marked + [0.01, 0.5]) / (rows + 1.0)
    model = LabelModel(float((rows[1] + 0.05) / (rows.sum() + 1)), np.clip(start, 1e-5, 1 - 1e-5), np.ones(patterns.shape[1]))
    for _ in range(2):
        for _ in range(rounds):
            p = model.posterior(patterns)
            for label, share in ((1, p * counts), (0, (1 - p) * counts)):
                seen = share @ patterns + marked[:, label]
                model.hit[:, label] = (seen + (0.01, 0.5)[label]) / (share.sum() + rows[label] + 1.0)
            model.hit = np.clip(model.hit, 1e-5, 1 - 1e-5)
            model.prior = float(np.clip((p @ counts + rows[1]) / (counts.sum() + rows.sum()), 1e-4, 0.5))
        share = model.posterior(patterns) * counts
        mean = (share @ patterns) / max(share.sum(), 1e-9)
        both = (patterns * share[:, None]).T @ patterns / max(share.sum(), 1e-9)
        spread = np.sqrt(np.clip(mean * (1 - mean), 0, None)) + 1e-6
        corr = np.clip((both - np.outer(mean, mean)) / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(corr, 0)
        model.damping = 1 / (1 + corr.sum(axis=1))
    return model


@dataclass
class ToxicityModel:
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    labels: LabelModel | None = None
    weights: np.ndarray | None = None

    def score(self, texts: list[str], reader: Reader) -> np.ndarray:
        rows, words, votes = reader.read(texts)
        at, place = reader.places(rows, words, BITS)
        n = np.bincount(at, minlength=len(texts))
        signs = np.bincount(at, weights=self.weights[place], minlength=len(texts)) / np.sqrt(n + 1)
        total = signs + votes @ self.weights[1 << BITS : -1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def sign_counts(rows: DataFrame) -> DataFrame:
    """``place, marked, plain``: in how many rows of each label a hashed sign stands; a task hands on one sum per place."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, tally = Reader(), np.zeros((2, 1 << SIGN_BITS), dtype=np.int32)
        for batch in batches:
            labels = batch["label"].to_numpy(np.int64)
            for first, texts in runs(batch["text"]):
                rows, words, _ = reader.read(texts)
                at, place = reader.places(rows, words, SIGN_BITS)
                for label in (0, 1):
                    own = place[labels[first + at] == label]
                    tally[label] += np.bincount(own, minlength=1 << SIGN_BITS).astype(np.int32)
        found = np.flatnonzero(tally.any(axis=0))
        for part in range(0, len(found), 100_000):
            at = found[part : part + 100_000]
            yield pd.DataFrame({"place": at, "marked": tally[1, at].astype(np.int64), "plain": tally[0, at].astype(np.int64)})

    pieces = rows.select("text", "label").mapInPandas(run, "place long, marked long, plain long")
    return pieces.groupBy("place").agg(F.sum("marked").alias("marked"), F.sum("plain").alias("plain"))


def learn_lexicon(rows: DataFrame, prior: float, precision: float, doubt: float = 0.01) -> np.ndarray:
    """The places of all signs of the label, at most 2**22; the voter of a place is its remainder by the groups.

    A sign must be marked in ``precision`` of its rows, by more than chance can explain for as many
    signs as were looked at: rows x divergence from the prior >= log(signs / ``doubt``).
    """
    counts = written(sign_counts(rows), "signs")
    tested = counts.count()
    n = F.col("marked") + F.col("plain")
    share = F.col("marked") / n
    lift = share * F.log(share / prior) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    good = counts.where((share >= precision) & (n * lift >= float(np.log(max(tested, 1) / doubt))))
    return np.sort(good.select("place").toPandas()["place"].to_numpy(np.int64))


def fit_linear(features: list[np.ndarray], votes: np.ndarray, target: np.ndarray, rounds: int = 10, rate: float = 0.3) -> np.ndarray:
    """Logistic regression with adaptive steps over votes and presence features, rows weighted to even the classes.

    Presence features are scaled to a row length of one, so that few signs never outweigh the votes.
    The last place is the bias.
    """
    width = votes.shape[1]
    weights, squares = np.zeros((1 << BITS) + width + 1), np.full((1 << BITS) + width + 1, 1.0)
    positive = float(np.clip(target.sum(), 1.0, len(target) - 1.0)) if len(target) > 1 else 1.0
    weight = np.where(target >= 0.5, len(target) / (2 * positive), len(target) / (2 * max(len(target) - positive, 1.0)))
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(features)):
            x, value = row_of(features[i], votes[i])
            p = 1 / (1 + np.exp(-np.clip(weights[x] @ value, -50, 50)))
            g = (p - target[i]) * min(weight[i], 20) * value
            squares[x] += g * g
            weights[x] -= rate * g / np.sqrt(squares[x])
    return weights


def row_of(signs: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a row: hashed signs, votes that were cast, bias."""
    cast = (1 << BITS) + np.flatnonzero(np.append(votes, 1))
    return np.concatenate([signs, cast]), np.append(np.full(len(signs), 1 / np.sqrt(len(signs) + 1)), np.ones(len(cast)))


def learnable(id_col: Column) -> Column:
    """Whether a row may be learned from: crc32 of the id modulo 3 is not 1."""
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(3)) != 1


def labelled(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """``doc_id, text, text_hash, label`` of the labelled rows that may be learned from; a text that many rows repeat is one example.

    Copies are merged by id and digest, so that texts move once; both joins shuffle at every size,
    as the labels grow with the documents.
    """
    known = labels.where(F.col(label_col).isNotNull() & learnable(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where(learnable(F.col("doc_id")))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    found = rows.select("doc_id", "text_hash").join(known.hint("merge"), "doc_id")
    found = found.groupBy("text_hash", "label").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(found.hint("merge"), ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash", "label"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = 4000, precision: float = 0.95) -> ToxicityModel:
    """Learn the voters, the label model and the classifier.

    ``sample`` bounds the rows the linear classifier is fitted on: labelled rows of the learning
    part, up to half of them posterior positives, taken by a hash of the id. Sign counts cover all
    labelled rows of that part, vote patterns all rows. Null texts are empty, rows with a null id or
    label teach nothing but their votes, of several labels of an id the larger holds, equal texts of
    one label are one example. Without labelled rows the voters are those given.
    """
    small_batches(docs.sparkSession)
    known = written(labelled(docs, labels, "toxic"), "toxic-labelled")
    first = known.agg(F.avg("label").alias("share")).first()
    prior = float(np.clip(first["share"] or 0.05, 0.005, 0.5))
    model = ToxicityModel(lexicon=learn_lexicon(known, prior, precision))
    lexicon = model.lexicon

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, tally = Reader(lexicon), np.zeros(1 << VOTERS, dtype=np.int64)
        for batch in batches:
            for _, texts in runs(batch["text"]):
                tally += np.bincount(pattern_of(reader.read(texts)[2]), minlength=1 << VOTERS)
        found = np.flatnonzero(tally)
        yield pd.DataFrame({"pattern": found.astype(np.int32), "n": tally[found]})

    def vote_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lexicon)
        for batch in batches:
            for first, texts in runs(batch["text"]):
                own = batch.iloc[first : first + len(texts)]
                yield own[["doc_id", "text_hash", "label"]].assign(pattern=pattern_of(reader.read(texts)[2]).astype(np.int32))

    found = docs.select("text").mapInPandas(vote, "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
    own = written(known.mapInPandas(vote_rows, "doc_id long, text_hash long, label int, pattern int"), "toxic-votes")
    tally = own.groupBy("label", "pattern").count().orderBy("label", "pattern").toPandas()
    rows, marked = np.zeros(2), np.zeros((VOTERS, 2))
    for label in (0, 1):
        part = tally[tally["label"] == label]
        rows[label] = part["count"].sum()
        marked[:, label] = votes_of(part["pattern"].to_numpy()).T @ part["count"].to_numpy(float)
    model.labels = fit_label_model(votes_of(found["pattern"].to_numpy()), found["n"].to_numpy(float), (rows, marked))

    # at most 2**VOTERS patterns have a posterior; features are worked out for the chosen rows alone
    seen = np.unique(tally["pattern"].to_numpy(np.int64))
    targets = dict(zip(seen.tolist(), model.labels.posterior(votes_of(seen)).tolist()))
    surely = F.col("pattern").isin([k for k, p in targets.items() if p >= 0.5])
    order = F.xxhash64("doc_id"), F.col("doc_id"), F.col("text_hash"), F.col("label")
    picked = [own.where(side).orderBy(*order).limit(sample // 2) for side in (surely, ~surely)]
    chosen = written(picked[0].union(picked[1]), "toxic-sample")
    texts = known.join(F.broadcast(chosen), ["doc_id", "text_hash", "label"])

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lexicon)
        for batch in batches:
            for first, texts in runs(batch["text"]):
                rows, words, votes = reader.read(texts)
                at, place = reader.places(rows, words, BITS)
                own = batch.iloc[first : first + len(texts)]
                slots = np.split(place.astype(np.int32), np.cumsum(np.bincount(at, minlength=len(texts)))[:-1])
                yield own[["doc_id", "text_hash", "label", "pattern"]].assign(slots=slots)

    schema = "doc_id long, text_hash long, label int, pattern int, slots array<int>"
    taken = texts.mapInPandas(features, schema).orderBy(*order).toPandas()
    target = np.array([targets[p] for p in taken["pattern"]])
    model.weights = fit_linear([np.asarray(x, dtype=np.int64) for x in taken["slots"]], votes_of(taken["pattern"].to_numpy()), target)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``held_out, score, predicted`` from the text alone; null and empty texts get the score of no sign.

    ``held_out`` is false for a null id. Repeated rows get equal scores; columns of the three names
    are replaced; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.weights))

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, weights = shared.value
        own, reader = ToxicityModel(lexicon=lexicon, weights=weights), Reader(lexicon)
        for texts in parts:
            found = [own.score(run, reader) for _, run in runs(texts)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0), dtype=float)

    out = docs.withColumn("held_out", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)))
    out = out.withColumn("score", F.pandas_udf(score, "double")(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
