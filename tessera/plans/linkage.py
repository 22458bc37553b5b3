"""The linkage plan: from records to matches, in tiers, with a gate between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import ngram_keys, word_keys
from tessera.operators import blocking, decide, features, index, models

MIN_IMPROVEMENT, MAX_COUNTRY_DROP = 0.001, 0.002


def lexical_channels(s1: DataFrame, pool: DataFrame, word_cap: int = index.WORD_CAP, ngram_cap: int = index.NGRAM_CAP, k: int = index.TOP_K) -> list[DataFrame]:
    """The word and the 3-gram channel of normalised records, each cut to k."""
    words = word_keys(F.col("name_clean"), F.col("address_clean"), F.col("addr_numbers"))
    return [index.channel_top_k(s1, pool, words, word_cap, k), index.channel_top_k(s1, pool, ngram_keys(F.col("name_nospace")), ngram_cap, k)]


def exact_channel(s1: DataFrame, pool: DataFrame, k: int = index.TOP_K) -> DataFrame:
    """The first k pool records, by source and id, with the S1 record's own clean name and address. The pool is cut before it meets the
    S1 records, so a group of equal records makes k pairs for each of them; texts meet by a hash, as any candidate is only a candidate."""
    key = F.xxhash64("name_clean", "address_clean").alias("key")
    first = index.top_k(pool.select("country", key, "source", "id").withColumn("score", F.lit(1.0)), k, by=("country", "key"))
    return s1.select("country", F.col("id").alias("s1"), key).join(first, ["country", "key"]).select("country", "s1", "source", "id", "score", "rank")


def block(s1: DataFrame, pool: DataFrame, k: int, dense: DataFrame | None = None, **caps) -> tuple[DataFrame, DataFrame]:
    """(candidates cut to k, competition over all S1 before the cut), from the lexical and the exact channels. dense: another
    channel, such as exact_knn's."""
    channels = [*lexical_channels(s1, pool, **caps), exact_channel(s1, pool)]
    fused = blocking.fuse(channels + ([dense] if dense is not None else []))
    return blocking.prune(fused, k), blocking.competition(fused)


def choose_blocking(base: DataFrame, dense: DataFrame | None, truth: DataFrame) -> dict:
    """k from the base variant's recall on the tuning truth, and whether the dense channel earns its place at that k.

    base, dense: candidates ranked to the largest k of the grid. The driver sees one row for each k."""
    recalls = {r["k"]: r["recall"] for r in blocking.recall_at(base, truth).collect()}
    most = recalls[max(recalls)]
    k = min(x for x, r in recalls.items() if r >= most - blocking.RECALL_TOLERANCE)
    out = {"k": k, "recall": recalls, "dense": False}
    if dense is not None:
        with_dense = {r["k"]: r["recall"] for r in blocking.recall_at(dense, truth).collect()}
        out |= {"dense_recall": with_dense, "dense": blocking.admit_dense(recalls[k], with_dense[k])}
    return out


def run_tier(scored: DataFrame, raw: list[str], truth: DataFrame, s1: DataFrame) -> dict:
    """Calibrates raw scores on Vcal, then finishes the tier. scored: pairs with split (Vcal, Vtest, test) and label; s1: s1, country, split."""
    model = models.fit_platt(scored.where("split = 'Vcal'"), raw)
    probable = models.apply_platt(model, scored)
    part = lambda df, name: df.where(F.col("split") == name)
    return decide.finish_tier(*[part(probable, n) for n in ("Vcal", "Vtest", "test")], truth, *[part(s1, n) for n in ("Vcal", "Vtest", "test")])


def passes_gate(baseline: dict, candidate: dict, gain: float = MIN_IMPROVEMENT, drop: float = MAX_COUNTRY_DROP) -> bool:
    """The candidate tier gains enough on Vcal, and no country that it reports loses too much."""
    if candidate["vcal_f05"] - baseline["vcal_f05"] < gain:
        return False
    scores = candidate["vcal_f05_by_country"]
    return all(c not in scores or scores[c] >= v - drop for c, v in baseline["vcal_f05_by_country"].items())


def choose_tier(reports: dict[str, dict]) -> str:
    """The last tier, in order, that passes the gate against the one chosen before it."""
    names = list(reports)
    chosen = names[0]
    for name in names[1:]:
        if passes_gate(reports[chosen], reports[name]):
            chosen = name
    return chosen


def link(s1: DataFrame, pool: DataFrame, truth: DataFrame, k: int = 10, trees: dict | None = None, **caps) -> dict:
    """Blocking, features, trees and decision in one plan, on one set of S1 records with split in T, Vcal, Vtest or test."""
    candidates, rivals = block(s1, pool, k, **caps)
    table = features.label_pairs(features.all_features(candidates, rivals, s1, pool), truth)
    table = table.join(s1.select(F.col("id").alias("s1"), "split"), "s1")
    model = models.train_trees(table.where("split = 'T'"), **(trees or {}))
    scored = models.score_trees(model, table)
    return run_tier(scored, ["raw_score"], truth, s1.select(F.col("id").alias("s1"), "country", "split"))
