"""Three classifiers by country, blended behind a gate, with thresholds, singleton rescue and closure.

The gate: the second and third model only score pairs whose first score reaches ``gate``. That loses nothing where every
decision needs more than w0 * gate + w1 + w2, which ``check_gate`` proves or refuses. The pairs below the gate keep their
first score and never reach the other models: the frame is split, scored, and put together again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinmatch.functions import constants as c
from kinmatch.operators import evaluate
from kinmatch.operators.features import FEATURE_NAMES


@dataclass(frozen=True)
class Settings:
    """Sizes of the three models. ``weight``: of a positive row in the first."""

    iterations: int = 40
    depth: int = 5
    trees: int = 40
    weight: float = 5.0
    step: float = 0.1
    seed: int = 42


@dataclass
class Bundle:
    """Models by country, each three, and thresholds; a country without its own has ``default``'s."""

    models: dict[str, list[PipelineModel]]
    thresholds: dict[str, float]
    default: str = c.DEFAULT_COUNTRY

    def of(self, country: str) -> str:
        if country in self.models:
            return country
        return self.default if self.default in self.models else sorted(self.models)[0]

    def save(self, spark: SparkSession, path: str) -> None:
        for country, three in self.models.items():
            for i, m in enumerate(three):
                m.write().overwrite().save(f"{path}/models/{country}/{i}")
        about = json.dumps({"countries": sorted(self.models), "thresholds": self.thresholds, "default": self.default, "features": FEATURE_NAMES})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        if tuple(about["features"]) != FEATURE_NAMES:
            raise ValueError("the models were made for other features")
        return cls({n: [PipelineModel.load(f"{path}/models/{n}/{i}") for i in range(3)] for n in about["countries"]}, about["thresholds"], about["default"])


def check_gate(least: float, gate: float = c.GATE, blend: tuple[float, float, float] = c.BLEND) -> None:
    """Raises where a pair below the gate could reach a decision at ``least``."""
    if least <= blend[0] * gate + blend[1] + blend[2]:
        raise ValueError(f"a threshold of {least} can be reached below the gate of {gate}")


def fit(rows: DataFrame, s: Settings = Settings()) -> list[PipelineModel]:
    """Boosted trees with weighted positives, boosted trees on subsamples, and a forest with balanced classes, from
    feature rows with ``label``. The forest is a regression on the labels 0 and 1, whose mean is the probability: a
    classifier's model would carry a summary with the session, which cannot go to executors once a session observes
    metrics."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    even = F.when(F.col("label") == 1, total / (2 * max(1, counts.get(1, 0)))).otherwise(total / (2 * max(1, counts.get(0, 0))))
    rows = rows.withColumns({"label": F.col("label").cast("double"), "weight": F.when(F.col("label") == 1, s.weight).otherwise(1.0), "even": even})
    vector = VectorAssembler(inputCols=list(FEATURE_NAMES), outputCol="features", handleInvalid="keep")
    common = {"labelCol": "label", "featuresCol": "features", "seed": s.seed}
    parts = (
        GBTClassifier(maxIter=s.iterations, maxDepth=s.depth, stepSize=s.step, weightCol="weight", **common),
        GBTClassifier(maxIter=s.iterations, maxDepth=s.depth, stepSize=s.step, subsamplingRate=0.85, **common),
        RandomForestRegressor(numTrees=s.trees, maxDepth=min(s.depth + 3, 12), weightCol="even", featureSubsetStrategy="sqrt", **common),
    )
    return [Pipeline(stages=[vector, p]).fit(rows) for p in parts]


def baseline(rows: DataFrame, s: Settings = Settings()) -> PipelineModel:
    """One model of boosted trees without weights: what the three are held against."""
    vector = VectorAssembler(inputCols=list(FEATURE_NAMES), outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(maxIter=s.iterations, maxDepth=s.depth, stepSize=s.step, labelCol="label", featuresCol="features", seed=s.seed)
    return Pipeline(stages=[vector, trees]).fit(rows.withColumn("label", F.col("label").cast("double")))


def importances(model: PipelineModel, top: int = 10) -> list[tuple[str, float]]:
    """The features with the largest gain."""
    v = model.stages[-1].featureImportances.toArray()
    return sorted(zip(FEATURE_NAMES, map(float, v), strict=True), key=lambda x: (-x[1], x[0]))[:top]


def _score(rows: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    out = model.transform(rows)
    out = out.withColumn(name, vector_to_array("probability")[1] if "probability" in out.columns else F.col("prediction"))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def score(rows: DataFrame, bundle: Bundle, gate: float | None = c.GATE, blend: tuple[float, float, float] = c.BLEND) -> DataFrame:
    """rows with ``p``, each country by its own models. ``gate`` None: all three models score every row."""
    countries = sorted(r["country"] for r in rows.select("country").distinct().collect())  # a handful
    out = None
    for n in countries:
        three = bundle.models[bundle.of(n)]
        first = _score(rows.where(F.col("country") == n), three[0], "p0")
        above = first if gate is None else first.where(F.col("p0") >= gate)
        for i in (1, 2):
            above = _score(above, three[i], f"p{i}")
        part = above.withColumn("p", sum(w * F.col(f"p{i}") for i, w in enumerate(blend))).drop("p0", "p1", "p2")
        if gate is not None:
            part = part.unionByName(first.where(F.col("p0") < gate).withColumnRenamed("p0", "p"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else rows.withColumn("p", F.lit(0.0)).limit(0)


def threshold(country, thresholds: dict[str, float], default: str = c.DEFAULT_COUNTRY):
    out = F.lit(thresholds.get(default, max(thresholds.values())))
    for n, v in thresholds.items():
        out = F.when(country == n, v).otherwise(out)
    return out


def accepted(scored: DataFrame, thresholds: dict[str, float], rescue: float | None = None, default: str = c.DEFAULT_COUNTRY) -> DataFrame:
    """Pairs at their country's threshold or above; with ``rescue`` also the best pair of an anchor that has none, if it
    reaches that."""
    ok = F.col("p") >= threshold(F.col("country"), thresholds, default)
    if rescue is None:
        return scored.where(ok)
    own = Window.partitionBy("s1_id")
    out = scored.withColumns({"any_ok": F.max(ok.cast("int")).over(own), "place": F.row_number().over(own.orderBy(F.desc(F.round("p", 9)), "cand_ord", "cand_id"))})
    return out.where(ok | ((F.col("any_ok") == 0) & (F.col("place") == 1) & (F.col("p") >= rescue))).drop("any_ok", "place")


def training_rows(anchors: DataFrame, pool: DataFrame, truth: DataFrame, n_anchors: int = 10_000, distractors: float = 0.03, most: int = 60_000, seed: str = "train") -> tuple[DataFrame, DataFrame]:
    """(anchors, pool) to learn from: about ``n_anchors`` anchors, their true matches, and a share of the other records, by
    hash of the ids. ``most`` bounds the distractors through the share. Sampling is the feature here, for fitting only."""
    n, m = anchors.count(), pool.count()
    pick = lambda col, share: F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))
    some = anchors.where(pick("entity_id", n_anchors / max(1, n)))
    needed = truth.join(some.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").select(F.explode("ids").alias("entity_id")).distinct()
    needed = needed.withColumn("needed", F.lit(True))
    kept = pool.join(needed, "entity_id", "left").where(F.col("needed") | pick("entity_id", min(distractors, most / max(1, m)))).drop("needed")
    return some, kept


def split(rows: DataFrame, share: float = 0.15, seed: str = "split") -> tuple[DataFrame, DataFrame]:
    """(training, validation) by hash of the anchor's id: all of an anchor's pairs on one side."""
    held = F.pmod(F.xxhash64("s1_id", F.lit(seed)), F.lit(10_000)) < int(share * 10_000)
    return rows.where(~held), rows.where(held)


def train(rows: DataFrame, truth: DataFrame, settings: Settings = Settings(), grid: tuple[int, int, int] = (60, 96, 2), gate: float | None = c.GATE) -> Bundle:
    """Models and thresholds for each country of the feature rows (with ``label``). Thresholds are the lowest best ones on
    the held-out anchors."""
    models, thresholds = {}, {}
    learn, held = split(rows)
    for n in sorted(r["country"] for r in rows.where("label = 1").select("country").distinct().collect()):
        models[n] = fit(learn.where(F.col("country") == n), settings)
        one = Bundle({n: models[n]}, {}, n)
        scored = score(held.where(F.col("country") == n), one, gate)
        seen = truth.join(held.where(F.col("country") == n).select("s1_id").distinct(), "s1_id", "left_semi")
        best = evaluate.best_threshold(evaluate.sweep(seen, scored, *grid)).first()
        thresholds[n] = float(best["tau"]) if best else c.THRESHOLDS.get(n, c.THRESHOLDS[c.DEFAULT_COUNTRY])
    return Bundle(models, thresholds)
