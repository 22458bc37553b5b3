"""Entity ids: "S<source>-<number>" texts, their two parts, lists of them, and packed keys."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_source(entity_id: Column) -> Column:
    return F.regexp_extract(entity_id, r"^S(\d+)-", 1).cast("tinyint")


def id_number(entity_id: Column) -> Column:
    return F.element_at(F.split(entity_id, "-", 2), 2).cast("long")


def encode_ids(df: DataFrame, column: str, source: str = "source", number: str = "id_num") -> DataFrame:
    """Adds the two parts of an id column."""
    return df.withColumns({source: id_source(F.col(column)), number: id_number(F.col(column))})


def decode_id(source: Column, number: Column) -> Column:
    return F.concat(F.lit("S"), source.cast("string"), F.lit("-"), number.cast("string"))


def encode_id_list(listed: Column) -> Column:
    """A comma list as an array of (source, id); empty entries don't count."""
    parts = F.filter(F.split(F.coalesce(listed, F.lit("")), ","), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(id_source(x).alias("source"), id_number(x).alias("id")))


def join_ids(ids: Column) -> Column:
    """An array of (source, id) as a comma list, ordered by source and number; null and empty give an empty text."""
    ordered = F.array_sort(F.coalesce(ids, F.array().cast("array<struct<source:tinyint,id:bigint>>")))
    return F.array_join(F.transform(ordered, lambda x: decode_id(x["source"], x["id"])), ",")


def pair_key(source: Column, number: Column) -> Column:
    """One long for (source, id), for bucketing; joins use both columns."""
    return F.shiftleft(source.cast("long"), 32).bitwiseOR(number.cast("long"))


def triple_key(s1: Column, source: Column, number: Column) -> Column:
    """One long for (S1 id, source, id); ids below 2^30."""
    return F.shiftleft(s1.cast("long"), 32).bitwiseOR(F.shiftleft(source.cast("long"), 30)).bitwiseOR(number.cast("long"))


def config_hash(config: dict) -> str:
    """16 hex digits that change with any setting."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]
