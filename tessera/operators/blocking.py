"""Candidate generation: fusion of channels, pruning, competition for pool records, and its quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .index import top_k

RRF_K = 60
K_GRID = (10, 15, 20, 30, 40, 50)
RECALL_TOLERANCE, DENSE_GAIN = 0.001, 0.002


def fuse(channels: list[DataFrame], rrf_k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of channels (country, s1, source, id, rank): rrf is the sum of 1 / (rrf_k + rank). The channels' rows
    are dealt by S1 record once, for the sums and for prune()."""
    ranked = reduce(DataFrame.unionByName, [c.select("country", "s1", "source", "id", "rank") for c in channels]).repartition("country", "s1")
    return ranked.groupBy("country", "s1", "source", "id").agg(F.sum(1.0 / (rrf_k + F.col("rank"))).alias("rrf"))


def prune(fused: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each S1 (cardinality node pruning)."""
    return top_k(fused, k, score="rrf")


def competition(fused: DataFrame) -> DataFrame:
    """For each pool record over all S1, before pruning: best and second-best fused score (0 if single, the best on a tie), and count.

    max_by and a two-element slice of the sorted scores would hold all of a hot record's scores; ranks cut at two don't.
    """
    order = Window.partitionBy("country", "source", "id").orderBy(F.col("rrf").desc(), "s1")
    two = fused.withColumn("rn", F.row_number().over(order)).where("rn <= 2")
    best = two.groupBy("country", "source", "id").agg(F.max(F.when(F.col("rn") == 1, F.col("rrf"))).alias("best"), F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("rrf"))), F.lit(0.0)).alias("second"))
    count = fused.groupBy("country", "source", "id").agg(F.count("*").alias("rivals"))
    return best.join(count, ["country", "source", "id"])


def merge_competition(parts: list[DataFrame]) -> DataFrame:
    """competition() over the union of disjoint parts of the S1 records, from the parts' results alone.

    A record has one row a part at most, so a list of its scores is short. Spark may plan a union of parts that are dealt alike as dealt
    itself and then, where an exchange is reused, run it as one that isn't; so the rows are dealt here, by the keys in another order than
    competition()'s, as Spark drops an exchange that repeats the one below.
    """
    rows = reduce(DataFrame.unionByName, parts).repartition("id", "source", "country")
    scores = F.sort_array(F.flatten(F.collect_list(F.array("best", "second"))), asc=False).alias("scores")
    merged = rows.groupBy("country", "source", "id").agg(scores, F.sum("rivals").alias("rivals"))
    return merged.select("country", "source", "id", F.col("scores")[0].alias("best"), F.col("scores")[1].alias("second"), "rivals")


def known_truth(truth: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Distinct truth pairs (country, s1, source, id) whose two records exist in one country."""
    own = s1.select("country", F.col("id").alias("s1"))
    return truth.select("s1", "source", "id").join(own, "s1").join(pool.select("country", "source", "id"), ["country", "source", "id"]).select("country", "s1", "source", "id").distinct()


def quality(candidates: DataFrame, truth: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """By country: hits, n_true, n_cand, pairs completeness (1 without truth), reduction ratio, pair quality (0 without candidates)."""
    truth = known_truth(truth, s1, pool)
    hits = candidates.join(truth, ["country", "s1", "source", "id"], "left_semi").groupBy("country").agg(F.count("*").alias("hits"))
    out = s1.groupBy("country").agg(F.count("*").alias("n_s1")).join(pool.groupBy("country").agg(F.count("*").alias("n_pool")), "country", "full")
    for part in (hits, truth.groupBy("country").agg(F.count("*").alias("n_true")), candidates.groupBy("country").agg(F.count("*").alias("n_cand"))):
        out = out.join(part, "country", "left")
    out = out.fillna(0, ["n_s1", "n_pool", "hits", "n_true", "n_cand"])
    pc = F.when(F.col("n_true") == 0, 1.0).otherwise(F.col("hits") / F.col("n_true"))
    space = F.col("n_s1") * F.col("n_pool")
    rr = F.when(space == 0, 0.0).otherwise(1 - F.col("n_cand") / space)
    return out.select("country", "n_s1", "n_pool", "hits", "n_true", "n_cand", pc.alias("pc"), rr.alias("rr"), F.when(F.col("n_cand") == 0, 0.0).otherwise(F.col("hits") / F.col("n_cand")).alias("pq"))


def hit_ranks(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """Each truth pair with its rank among the candidates, null if it is none of them."""
    return truth.select("country", "s1", "source", "id").join(ranked.select("country", "s1", "source", "id", "rank"), ["country", "s1", "source", "id"], "left")


def recall_at(ranked: DataFrame, truth: DataFrame, grid: tuple[int, ...] = K_GRID) -> DataFrame:
    """k, recall: the share of all truth pairs that rank k or better."""
    ranks = hit_ranks(ranked, truth)
    one = ranks.agg(*[F.coalesce(F.avg(F.when(F.col("rank") <= k, 1.0).otherwise(0.0)), F.lit(1.0)).alias(str(k)) for k in grid])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(str(k)).alias("recall")) for k in grid])).alias("r")).select("r.*")


def choose_k(recalls: DataFrame, tolerance: float = RECALL_TOLERANCE) -> DataFrame:
    """One row: the smallest k whose recall is within tolerance of that at the largest."""
    most = recalls.agg(F.max_by("recall", "k").alias("most"))
    return recalls.join(F.broadcast(most)).where(F.col("recall") >= F.col("most") - tolerance).agg(F.min("k").alias("k"))


def admit_dense(base_recall: float, dense_recall: float, gain: float = DENSE_GAIN) -> bool:
    return dense_recall - base_recall >= gain
