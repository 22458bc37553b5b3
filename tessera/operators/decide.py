"""From scored pairs to matches: one owner for each record, then the set of expected best F0.5 for each S1."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .metrics import f05, macro_f05

BETA2 = 0.25
#: 0.05, 0.10, ... 0.95
TAU_GRID = tuple(round(0.05 * k, 2) for k in range(1, 20))
TIES = ("source", "id")


def context_features(pairs: DataFrame, prior: str = "prob", new: str = "new_prob") -> DataFrame:
    """pairs with the combined score (new where scored, else prior) in the context of its S1: comb_max, comb_sum, comb_gap, comb_n_half
    (candidates over 0.5), comb_rank; and scored (1 if new is not null)."""
    comb = F.coalesce(F.col(new), F.col(prior))
    rows = pairs.withColumn("comb", comb).withColumn("scored", F.col(new).isNotNull().cast("double"))
    own = Window.partitionBy("s1")
    ranked = Window.partitionBy("s1").orderBy(F.round(F.col("comb"), 9).desc(), *TIES)
    return rows.withColumns(
        {
            "comb_max": F.max("comb").over(own),
            "comb_sum": F.sum("comb").over(own),
            "comb_gap": F.max("comb").over(own) - F.col("comb"),
            "comb_n_half": F.sum((F.col("comb") > 0.5).cast("long")).over(own),
            "comb_rank": F.row_number().over(ranked),
        }
    )


def rank_in_s1(pairs: DataFrame, prob: str = "prob", rank: str = "prob_rank") -> DataFrame:
    """Rank from 1 within the S1 by falling probability; ties by source and id."""
    return pairs.withColumn(rank, F.row_number().over(Window.partitionBy("s1").orderBy(F.col(prob).desc(), *TIES)))


def one_owner(pairs: DataFrame, prob: str = "prob") -> DataFrame:
    """The row of the most probable S1 for each pool record; ties go to the smallest S1."""
    order = Window.partitionBy("source", "id").orderBy(F.col(prob).desc(), "s1")
    return pairs.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def best_prefix(pairs: DataFrame, prob: str = "prob", beta2: float = BETA2) -> DataFrame:
    """pairs with rn (rank by probability) and m, the size of the prefix with the largest expected F0.5; the smallest of equals.

    For a prefix of size m >= 1: P = sum of its p / m, R = the same sum / sum of all p, and F = (1 + b) P R / (b P + R). Size 0 has the
    probability that no candidate is true. Running sums over a window, then the best of a struct, take the place of a loop.
    """
    order = Window.partitionBy("s1").orderBy(F.col(prob).desc(), *TIES)
    own = Window.partitionBy("s1")
    p = F.col(prob)
    rows = pairs.withColumns({"rn": F.row_number().over(order), "_cum": F.sum(p).over(order.rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum(p).over(own), "_none": F.product(1 - p).over(own)})
    precision, recall = F.col("_cum") / F.col("rn"), F.col("_cum") / F.col("_all")
    scored = rows.withColumn("_f", F.when((F.col("_all") > 0) & (F.col("_cum") > 0), (1 + beta2) * precision * recall / (beta2 * precision + recall)).otherwise(0.0))
    best = scored.withColumn("_best", F.max(F.struct(F.round("_f", 12).alias("f"), (-F.col("rn")).alias("m"))).over(own))
    m = F.when(F.col("_best.f") > F.round("_none", 12), -F.col("_best.m")).otherwise(0)
    return best.withColumn("m", m).drop("_cum", "_all", "_none", "_f", "_best")


def decide(pairs: DataFrame, tau: float, prob: str = "prob", beta2: float = BETA2) -> DataFrame:
    """s1, source, id of the matches: the best prefix without its tail below tau. pairs have one owner each already.

    Probabilities fall along the prefix, so trimming its tail is the same as a filter.
    """
    return best_prefix(pairs, prob, beta2).where((F.col("rn") <= F.col("m")) & (F.col(prob) >= tau)).select("s1", "source", "id")


def sweep_tau(pairs: DataFrame, truth: DataFrame, s1_ids: DataFrame, prob: str = "prob", grid: tuple[float, ...] = TAU_GRID) -> DataFrame:
    """tau, score: macro F0.5 for each threshold. Prefixes are found once; each threshold only counts."""
    prefix = best_prefix(pairs, prob).where(F.col("rn") <= F.col("m"))
    hit = truth.select("s1", "source", "id").distinct().withColumn("_hit", F.lit(1))
    taus = F.explode(F.array(*[F.lit(t) for t in grid])).alias("tau")
    kept = prefix.join(hit, ["s1", "source", "id"], "left").select("s1", F.col(prob).alias("p"), F.coalesce("_hit", F.lit(0)).alias("hit"), taus).where("p >= tau")
    counts = kept.groupBy("s1", "tau").agg(F.count("*").alias("n_pred"), F.sum("hit").alias("n_tp"))
    true = truth.select("s1", "source", "id").distinct().groupBy("s1").agg(F.count("*").alias("n_true"))
    every = s1_ids.select("s1").distinct().join(true, "s1", "left").select("s1", F.coalesce("n_true", F.lit(0)).alias("n_true"), taus)
    rows = every.join(counts, ["s1", "tau"], "left").fillna(0, ["n_pred", "n_tp"])
    return rows.groupBy("tau").agg(F.avg(f05(F.col("n_tp"), F.col("n_pred"), F.col("n_true"))).alias("score"))


def best_tau(sweep: DataFrame) -> DataFrame:
    """One row, tau and score: the best score, the smallest tau among equals."""
    return sweep.orderBy(F.round("score", 12).desc(), "tau").limit(1)


def with_all(matches: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """s1, ids: each required S1 with its matches, ordered by source and id; an empty array if it has none."""
    grouped = matches.groupBy("s1").agg(F.array_sort(F.collect_set(F.struct("source", "id"))).alias("ids"))
    kind = grouped.schema["ids"].dataType
    return s1_ids.select("s1").distinct().join(grouped, "s1", "left").select("s1", F.coalesce("ids", F.array().cast(kind)).alias("ids"))


def finish_tier(vcal: DataFrame, vtest: DataFrame, test: DataFrame, truth: DataFrame, s1_vcal: DataFrame, s1_vtest: DataFrame, s1_test: DataFrame, prob: str = "prob") -> dict:
    """What every tier ends with: owners in each split, tau tuned on Vcal, matches of all splits, and Vcal's and Vtest's scores."""
    owners = {name: one_owner(df, prob) for name, df in (("vcal", vcal), ("vtest", vtest), ("test", test))}
    chosen = best_tau(sweep_tau(owners["vcal"], truth, s1_vcal, prob)).first()
    tau = chosen["tau"] if chosen else 0.5
    out: dict = {"tau": tau, "matches": {name: decide(df, tau, prob) for name, df in owners.items()}}
    for name, ids in (("vcal", s1_vcal), ("vtest", s1_vtest)):
        rows = macro_f05(out["matches"][name], truth, ids, by="country").collect()
        out[f"{name}_f05"] = next((r["score"] for r in rows if r["country"] is None), None)
        out[f"{name}_f05_by_country"] = {r["country"]: r["score"] for r in rows if r["country"] is not None}
    out["predictions"] = with_all(out["matches"]["test"], s1_test)
    return out
