"""Checks of id-list files, as tables of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCH_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")
ERRORS = ("malformed_row", "duplicate_row", "repeated_id", "self_match", "wrong_prefix", "unknown_id", "missing_s1", "extra_s1")


def violations(lists: DataFrame, required: DataFrame, known: DataFrame | None, s1: str = "source1_entity_id", ids: str = "matched_entity_ids") -> DataFrame:
    """rule, example: one row for each offender.

    lists: s1 and a comma list (null: a row without its second field). required: entity_id of the S1 that need a row.
    known: entity_id of the pool, or None if that can't be checked. A blank line is no violation.
    """
    rows = lists.select(F.col(s1).alias("s1"), F.col(ids).alias("listed"))
    whole = rows.where("listed is not null")
    parts = F.when(F.trim("listed") == "", F.array().cast("array<string>")).otherwise(F.split("listed", ","))
    split = whole.withColumn("parts", parts)
    each = split.select("s1", F.explode("parts").alias("m"))
    pool_like = F.col("m").startswith("S2-") | F.col("m").startswith("S3-")

    def rule(name: str, df: DataFrame, example: str) -> DataFrame:
        return df.select(F.lit(name).alias("rule"), F.col(example).alias("example")).distinct()

    found = [
        rule("malformed_row", rows.where("listed is null and trim(s1) <> ''"), "s1"),
        rule("duplicate_row", whole.groupBy("s1").count().where("count > 1"), "s1"),
        rule("repeated_id", split.where(F.size("parts") > F.size(F.array_distinct("parts"))), "s1"),
        rule("self_match", each.where(F.col("m").startswith("S1-")), "m"),
        rule("wrong_prefix", each.where(~F.col("m").startswith("S1-") & ~pool_like), "m"),
        rule("missing_s1", required.select(F.col("entity_id").alias("s1")).join(whole, "s1", "left_anti"), "s1"),
        rule("extra_s1", whole.join(required.select(F.col("entity_id").alias("s1")), "s1", "left_anti"), "s1"),
    ]
    if known is not None:
        found.append(rule("unknown_id", each.where(pool_like).join(known.select(F.col("entity_id").alias("m")), "m", "left_anti"), "m"))
    return reduce(DataFrame.unionByName, found)


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Matched pairs that are no candidates, as rule and example; a warning, not an error."""
    return matches.select("s1", "id").join(candidates.select("s1", "id"), ["s1", "id"], "left_anti").select(F.lit("not_candidate").alias("rule"), F.concat_ws(":", "s1", "id").alias("example")).distinct()


def list_pairs(lists: DataFrame, s1: str, ids: str) -> DataFrame:
    """s1, id of every non-empty list entry."""
    return lists.where(F.trim(F.coalesce(F.col(ids), F.lit(""))) != "").select(F.col(s1).alias("s1"), F.explode(F.split(F.col(ids), ",")).alias("id"))


def header_problem(columns: list[str], expected: tuple[str, ...]) -> str | None:
    if len(columns) == 1 and "," in columns[0]:
        return "the header has commas and no tab: the file has to be tab-separated"
    return None if [c.strip().lower() for c in columns] == list(expected) else f"unexpected header {columns}, expected {list(expected)}"


def summary(found: DataFrame, examples: int = 5) -> DataFrame:
    """rule, offenders, and a few examples, the first in order."""
    return found.groupBy("rule").agg(F.count("*").alias("offenders"), F.slice(F.sort_array(F.collect_set("example")), 1, examples).alias("examples"))
