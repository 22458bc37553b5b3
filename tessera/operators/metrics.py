"""F0.5 of predicted sets, macro averages, and average precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BETA2 = 0.25


def f05(tp: Column, predicted: Column, true: Column, beta2: float = BETA2) -> Column:
    """From counts. Nothing true: 1 for an empty prediction, else 0. Something true: 0 without a hit."""
    precision, recall = tp / predicted, tp / true
    return F.when(true == 0, F.when(predicted == 0, 1.0).otherwise(0.0)).when((predicted == 0) | (tp == 0), 0.0).otherwise((1 + beta2) * precision * recall / (beta2 * precision + recall))


def truth_sets(truth: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """s1, truth: the set of true records of each S1, empty for those without any."""
    grouped = truth.groupBy("s1").agg(F.array_sort(F.collect_set(F.struct("source", "id"))).alias("truth"))
    kind = grouped.schema["truth"].dataType
    return s1_ids.select("s1").distinct().join(grouped, "s1", "left").select("s1", F.coalesce("truth", F.array().cast(kind)).alias("truth"))


def entity_f05(predicted: DataFrame, truth: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """s1_ids with n_tp, n_pred, n_true and f05; a missing prediction is an empty one. predicted, truth: s1, source, id."""
    p, t = predicted.select("s1", "source", "id").distinct(), truth.select("s1", "source", "id").distinct()
    counts = p.withColumn("p", F.lit(1)).join(t.withColumn("t", F.lit(1)), ["s1", "source", "id"], "full").groupBy("s1").agg(F.count(F.when(F.col("p").isNotNull() & F.col("t").isNotNull(), 1)).alias("n_tp"), F.count("p").alias("n_pred"), F.count("t").alias("n_true"))
    rows = s1_ids.dropDuplicates(["s1"]).join(counts, "s1", "left").fillna(0, ["n_tp", "n_pred", "n_true"])
    return rows.withColumn("f05", f05(F.col("n_tp"), F.col("n_pred"), F.col("n_true")))


def macro_f05(predicted: DataFrame, truth: DataFrame, s1_ids: DataFrame, by: str | None = None) -> DataFrame:
    """score: the mean over all S1 (0 without any). With by, also one row for each of its values, in one pass; the overall row has it null."""
    rows = entity_f05(predicted, truth, s1_ids)
    mean = F.coalesce(F.avg("f05"), F.lit(0.0)).alias("score")
    return rows.where(F.col(by).isNotNull()).rollup(by).agg(mean) if by else rows.agg(mean)


def average_precision(scored: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    """One row, ap: the sum over distinct scores of precision times the step in recall. Equal scores are one step.

    Rows are summed by score first. Running sums over the scores go through ranges of scores, so no task holds them all.
    """
    steps = scored.groupBy(F.col(score).alias("s")).agg(F.sum(F.col(label).cast("long")).alias("hits"), F.count("*").alias("n"))
    cells = steps.withColumn("cell", F.floor(F.col("s") * 4096))
    by_cell = cells.groupBy("cell").agg(F.sum("hits").alias("c_hits"), F.sum("n").alias("c_n"))
    # At most 4097 cells for scores in [0, 1].
    before = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_cell.select("cell", F.coalesce(F.sum("c_hits").over(before), F.lit(0)).alias("o_hits"), F.coalesce(F.sum("c_n").over(before), F.lit(0)).alias("o_n"), F.sum("c_hits").over(Window.partitionBy()).alias("all_hits"))
    inside = Window.partitionBy("cell").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = cells.withColumns({"i_hits": F.sum("hits").over(inside), "i_n": F.sum("n").over(inside)}).join(offsets, "cell")
    precision = (F.col("o_hits") + F.col("i_hits")) / (F.col("o_n") + F.col("i_n"))
    return rows.agg(F.coalesce(F.sum(F.when(F.col("all_hits") > 0, precision * F.col("hits") / F.col("all_hits"))), F.lit(0.0)).alias("ap"))
