"""Splits, samples and budgets, all by hashes or total orders, so reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(seed: int, *keys: str) -> Column:
    """A pseudo-random text for ordering rows: the same in any engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), *[x for k in keys for x in (F.col(k).cast("string"), F.lit(":"))]).cast("binary"))


def stratified_split(s1: DataFrame, sizes: dict[str, int], seed: int = 42, key: str = "id", check: bool = True) -> DataFrame:
    """s1 with split: for each named size its share of the rows of each country, halves rounded to even, in hash order; '' for the rest."""
    n = s1.count() if check else None
    if n is not None and n < sum(sizes.values()):
        raise ValueError(f"{sum(sizes.values())} rows are needed, {n} are there")
    own = Window.partitionBy("country")
    rows = s1.withColumns({"_n": F.count("*").over(own), "_rn": F.row_number().over(own.orderBy(shuffled(seed, key), key))})
    total = s1.agg(F.count("*").alias("_all"))
    rows = rows.join(F.broadcast(total))  # one row
    split, start = F.lit(""), F.lit(0)
    for name, size in reversed(list(sizes.items())):
        before = sum((F.bround(F.lit(v) * F.col("_n") / F.col("_all"), 0) for k, v in list(sizes.items())[: list(sizes).index(name)]), start)
        end = before + F.bround(F.lit(size) * F.col("_n") / F.col("_all"), 0)
        split = F.when((F.col("_rn") > before) & (F.col("_rn") <= end), name).otherwise(split)
    return rows.withColumn("split", split).drop("_n", "_rn", "_all")


def stratified_sample(s1: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """About n rows, each country by its share and with one row at least."""
    own = Window.partitionBy("country")
    rows = s1.withColumns({"_n": F.count("*").over(own), "_rn": F.row_number().over(own.orderBy(shuffled(seed, key), key))}).join(F.broadcast(s1.agg(F.count("*").alias("_all"))))
    return rows.where(F.col("_rn") <= F.greatest(F.lit(1), F.bround(F.lit(n) * F.col("_n") / F.col("_all"), 0))).drop("_n", "_rn", "_all")


def hash_sample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows without replacement."""
    return df.orderBy(shuffled(seed, *keys), *keys).limit(n)


def distractors(pool: DataFrame, matches: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """True records of the pool and n others of each source."""
    keys = matches.select("source", "id").distinct()
    others = pool.join(keys, ["source", "id"], "left_anti")
    order = Window.partitionBy("source").orderBy(shuffled(seed, "source", "id"), "id")
    others = others.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")
    return pool.join(keys, ["source", "id"], "left_semi").unionByName(others).dropDuplicates(["source", "id"])


def hard_negatives(ranked: DataFrame, truth: DataFrame, max_rank: int = 10) -> DataFrame:
    """Candidates of good rank that are not truth."""
    return ranked.where(F.col("rank") <= max_rank).join(truth.select("s1", "source", "id").distinct(), ["s1", "source", "id"], "left_anti")


def training_pairs(ranked: DataFrame, truth: DataFrame, n: int, max_rank: int = 10, seed: int = 42) -> DataFrame:
    """s1, source, id, label: at most n rows, half of them truth pairs, half hard negatives, by hash."""
    keys = ("s1", "source", "id")
    positive = hash_sample(truth.select(*keys).distinct(), n // 2, seed, *keys).withColumn("label", F.lit(1))
    negative = hash_sample(hard_negatives(ranked, truth, max_rank).select(*keys), n - n // 2, seed, *keys).withColumn("label", F.lit(0))
    return positive.unionByName(negative)


def uncertain_band(pairs: DataFrame, max_rank: int = 10, high: float = 0.97, prob: str = "prob", rank: str = "prob_rank") -> DataFrame:
    return pairs.where((F.col(rank) <= max_rank) & (F.col(prob) <= high))


def judge_band(pairs: DataFrame, low: float = 0.15, high: float = 0.85, first_low: float = 0.35, first_high: float = 0.65, prob: str = "prob", rank: str = "prob_rank") -> DataFrame:
    return pairs.where(F.col(prob).between(low, high) | ((F.col(rank) == 1) & F.col(prob).between(first_low, first_high)))


def closest_to_half(pairs: DataFrame, budget: int, prob: str = "prob") -> DataFrame:
    """The budget's pairs nearest to 0.5; ties by keys."""
    return pairs.orderBy(F.round(F.abs(F.col(prob) - 0.5), 9), "s1", "source", "id").limit(budget)
