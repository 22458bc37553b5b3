"""Pair scorers: boosted trees, calibration, the context stacker, and the interface for second-stage models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decide import context_features
from .metrics import average_precision

NOT_FEATURES = frozenset(("country", "s1", "source", "id", "label", "split", "raw_score", "prob", "new_prob"))
CONTEXT = ("prior", "scored", "new_score", "comb_max", "comb_sum", "comb_gap", "comb_n_half", "comb_rank")


def feature_columns(df: DataFrame) -> list[str]:
    """All columns but ids, labels and scores."""
    return [c for c in df.columns if c not in NOT_FEATURES]


def _assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    numbers = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in columns})
    return VectorAssembler(inputCols=columns, outputCol="_features").transform(numbers)


def train_trees(train: DataFrame, columns: list[str] | None = None, label: str = "label", depth: int = 8, rounds: int = 200, step: float = 0.05, validation: str | None = None, seed: int = 42):
    """Gradient-boosted trees. validation names a boolean column of rows that stop training early."""
    columns = columns or feature_columns(train)
    trees = GBTClassifier(featuresCol="_features", labelCol="_label", maxDepth=depth, maxIter=rounds, stepSize=step, seed=seed)
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    model = trees.fit(_assembled(train.withColumn("_label", F.col(label).cast("double")), columns))
    model.tessera_columns = columns
    return model


def score_trees(model, df: DataFrame, out: str = "raw_score") -> DataFrame:
    scored = model.transform(_assembled(df.select("*"), model.tessera_columns))
    ids = [c for c in df.columns if c in NOT_FEATURES and c != out]
    return scored.select(*ids, vector_to_array("probability")[1].alias(out))


def fit_platt(scored: DataFrame, columns: list[str], label: str = "label"):
    """Logistic regression of the label on one score or several, with the penalty of a unit prior."""
    n = max(scored.count(), 1)
    model = LogisticRegression(featuresCol="_features", labelCol="_label", regParam=1.0 / n, standardization=False).fit(_assembled(scored.withColumn("_label", F.col(label).cast("double")), columns))
    model.tessera_columns = columns
    return model


def apply_platt(model, scored: DataFrame, out: str = "prob") -> DataFrame:
    """The scored rows with calibrated probabilities, as a column expression."""
    odds = sum((F.lit(float(w)) * F.col(c) for w, c in zip(model.coefficients, model.tessera_columns)), F.lit(float(model.intercept)))
    return scored.withColumn(out, 1 / (1 + F.exp(-odds)))


def _context(pairs: DataFrame, prior: str, new: str) -> DataFrame:
    # Trees don't branch on missing values: a pair that wasn't scored again has scored = 0 and -1 for its score.
    return context_features(pairs, prior, new).withColumns({"prior": F.col(prior), "new_score": F.coalesce(F.col(new), F.lit(-1.0))})


def fit_stacker(pairs: DataFrame, prior: str = "prob", new: str = "new_prob", label: str = "label", rounds: int = 100, depth: int = 5, step: float = 0.05):
    return train_trees(_context(pairs, prior, new), list(CONTEXT), label, depth, rounds, step)


def apply_stacker(model, pairs: DataFrame, prior: str = "prob", new: str = "new_prob", out: str = "stacked") -> DataFrame:
    scored = model.transform(_assembled(_context(pairs, prior, new), model.tessera_columns))
    return scored.select(*pairs.columns, vector_to_array("probability")[1].alias(out))


def leave_one_country_out(pairs: DataFrame, columns: list[str] | None = None, **parameters) -> dict[str, float]:
    """Average precision on each country of trees trained on all others; countries without pairs of both labels are left out."""
    both = pairs.groupBy("country").agg(F.countDistinct("label").alias("n")).where("n = 2 and country is not null")
    out = {}
    for (country,) in sorted(both.select("country").collect()):
        rest = pairs.where(F.col("country") != country)
        if rest.select("label").distinct().count() < 2:
            continue
        model = train_trees(rest, columns, **parameters)
        out[country] = average_precision(score_trees(model, pairs.where(F.col("country") == country), "prob")).first()["ap"]
    return out


def align_scores(pairs: DataFrame, scores: DataFrame, score: str = "new_prob", logits: bool = False) -> DataFrame:
    """pairs with the scores of those that a second stage saw, null for others; logits go through a sigmoid."""
    s = scores.select("s1", "source", "id", F.col(score).alias("_s"))
    value = 1 / (1 + F.exp(-F.col("_s"))) if logits else F.col("_s")
    return pairs.join(s, ["s1", "source", "id"], "left").withColumn(score, value).drop("_s")


def score_pairs(pairs: DataFrame, text_a: str, text_b: str, scorer: Callable, out: str = "new_prob") -> DataFrame:
    """Second-stage scores from a column function of two texts: a cross-encoder or a judge behind predict_batch_udf, say."""
    return pairs.withColumn(out, scorer(F.col(text_a), F.col(text_b)))
