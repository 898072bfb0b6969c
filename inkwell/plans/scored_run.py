"""The scored run: topics, matching training rows, spell repair, self-training, refinement, blend.

Every stage is written under a name that holds a digest of its settings and of the tables it was made
from. A run that was lost is called again with the same folder and goes on after its last whole stage.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.numeric import affine_blend
from inkwell.operators.aggregates import top_n_categories
from inkwell.operators.learners import topic_fit, topic_predict
from inkwell.operators.relational import assert_one_to_one, union_all
from inkwell.operators.spelling import dictionary_keys, spell_repair
from inkwell.plans.self_training import Corpora, self_training, weak_refine

# The prompts of a target table too small to show any.
USUAL_PROMPTS = ("Facial action coding system", "Driverless cars", "Exploring Venus", "The Face on Mars", "A Cowboy Who Rode the Waves")
FEW_TARGETS = 3


@dataclass(frozen=True)
class RunSettings:
    """Rounds and sizes of the learners, and the weight of the refined scores in the last blend."""

    rounds: int = 4
    top: int = 1000
    bottom: int = 1500
    growth: int = 250
    middle: int = 50
    similar: int = 100
    vocab_size: int = 5_000
    tol: float = 1e-4
    min_df: int = 2
    refined: float = 0.8


class Stages:
    """Written results of a run, each found again by the digest of what it was made from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.digests: dict[str, str] = {}
        self.made: list[str] = []

    def given(self, name: str, df: DataFrame) -> DataFrame:
        """An input table: its digest is its row count and the sum of its rows' hashes."""
        row = df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64(*sorted(df.columns)), F.lit(1 << 40)))).first()
        self.digests[name] = hashlib.sha256(json.dumps([sorted(df.dtypes), list(row)]).encode()).hexdigest()
        return df

    def keep(self, name: str, inputs: Sequence[str], settings: dict, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table, read if it was written whole from the same inputs and settings, else built and written."""
        facts = json.dumps([name, [self.digests[i] for i in inputs], settings], sort_keys=True)
        self.digests[name] = hashlib.sha256(facts.encode()).hexdigest()
        path = f"{self.folder}/{name}-{self.digests[name][:16]}"
        if not self.done(path):
            build().write.mode("overwrite").parquet(path)
            self.made.append(name)
        return self.spark.read.parquet(path)

    def done(self, path: str) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)


def target_prompts(train: DataFrame, target: DataFrame) -> DataFrame:
    """``prompt_name``: as many of the prompts predicted for the targets as they have prompt ids, most frequent first.

    The model's vocabulary and idf come from all texts, its coefficients from those with a prompt.
    """
    spark = train.sparkSession
    n, wanted = target.agg(F.count("*"), F.count_distinct("prompt_id")).first()
    if n <= FEW_TARGETS:
        return spark.createDataFrame([(p,) for p in USUAL_PROMPTS], "prompt_name string")
    predicted = topic_predict(topic_fit(train, "prompt_name"), target)
    return top_n_categories(predicted, "prompt_name", wanted).select("prompt_name")


def scored_run(
    train: DataFrame, generated: DataFrame, old: DataFrame, target: DataFrame, dictionary: DataFrame, encoder_scores: DataFrame,
    feedback: Callable[[DataFrame, DataFrame, DataFrame], DataFrame], folder: str, settings: RunSettings = RunSettings(),
) -> DataFrame:
    """``id, generated``: the final score of every target.

    ``train`` holds ``id, text, prompt_name, label``, ``generated`` and ``old`` ``id, text, label``, ``target`` ``id, text, prompt_id``,
    ``dictionary`` ``word, freq``, ``encoder_scores`` ``id, score``. ``feedback(train, picked, target)`` returns
    ``id, score`` of an encoder that has seen the pseudo-labelled rows. Ids are unique over ``train`` and ``old``.
    """
    stages, facts = Stages(train.sparkSession, folder), asdict(settings)
    tables = {"train": train, "generated": generated, "old": old, "target": target}
    for name, df in {**tables, "dictionary": dictionary, "encoder": encoder_scores}.items():
        stages.given(name, df)
    prompts = stages.keep("prompts", ["train", "target"], {}, lambda: target_prompts(train, target))
    matching = stages.keep(
        "matching", ["train", "old", "prompts"], {},
        lambda: union_all(train.join(F.broadcast(prompts), "prompt_name", "left_semi").select("id", "text", "label"), old.select("id", "text", "label")),
    )
    tables["matching"] = matching
    keys = stages.keep("keys", ["dictionary"], {}, lambda: dictionary_keys(dictionary))
    repaired = {
        name: stages.keep(f"repaired_{name}", [name, "dictionary"], {}, lambda name=name: spell_repair(tables[name], dictionary, keys))
        for name in ("matching", "generated", "old", "target")
    }
    data = Corpora(
        repaired["matching"], repaired["generated"].select("id", "text", "label"), repaired["old"].select("id", "text", "label"),
        repaired["target"].select("id", "text"),
    )
    made_from = [f"repaired_{name}" for name in repaired] + ["encoder"]
    strong_settings = {k: facts[k] for k in ("rounds", "top", "bottom", "growth", "vocab_size", "tol", "min_df")}
    found: dict[str, DataFrame] = {}

    def strong(part: str) -> DataFrame:
        if not found:
            found["strong"], found["picked"] = self_training(data, encoder_scores, **strong_settings)
        return found[part]

    scores = stages.keep("strong", made_from, strong_settings, lambda: strong("strong"))
    picked = stages.keep("picked", made_from, strong_settings, lambda: strong("picked"))
    weak_settings = {k: facts[k] for k in ("middle", "similar", "vocab_size", "tol", "min_df")}
    refined = stages.keep("refined", [*made_from, "strong"], weak_settings, lambda: weak_refine(data, scores, encoder_scores, **weak_settings))
    fed_back = stages.keep("feedback", [*made_from, "picked"], {}, lambda: feedback(data.train, picked, data.target).select("id", "score"))

    def last() -> DataFrame:
        assert_one_to_one(refined, fed_back)
        assert_one_to_one(target, refined)
        both = refined.join(fed_back.withColumnRenamed("score", "other"), "id")
        mixed = affine_blend((settings.refined, F.col("score")), (1 - settings.refined, F.col("other")))
        return both.select("id", mixed.alias("generated"))

    return stages.keep("blended", ["refined", "feedback", "target"], {"refined": settings.refined}, last)
