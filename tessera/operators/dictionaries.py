"""Dictionaries learned from the tables: legal forms, short tokens, abbreviations, aligned transliterations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import LEGAL_FORMS, latin, tokens


def _frequent(counted: DataFrame, key: str, top_n: int, min_count: int) -> DataFrame:
    """The top_n most frequent keys of each country, those with min_count at least; ties in the key's order."""
    order = Window.partitionBy("country").orderBy(F.col("count").desc(), key)
    return counted.withColumn("rn", F.row_number().over(order)).where((F.col("rn") <= top_n) & (F.col("count") >= min_count)).select("country", key, "count")


def frequent_final_tokens(names: DataFrame, name: str = "name", min_count: int = 50, top_n: int = 30) -> DataFrame:
    last = names.select("country", F.try_element_at(tokens(F.col(name)), F.lit(-1)).alias("form")).where("form is not null")
    return _frequent(last.groupBy("country", "form").count(), "form", top_n, min_count)


def legal_form_vocabulary(names: DataFrame, name: str = "name", seeds: tuple[str, ...] = LEGAL_FORMS, min_count: int = 50, top_n: int = 30) -> DataFrame:
    """country, forms: the seeds and the country's frequent last words."""
    learned = frequent_final_tokens(names, name, min_count, top_n).groupBy("country").agg(F.collect_set("form").alias("learned"))
    countries = names.select("country").where("country is not null").distinct()
    seed = F.array(*[F.lit(s) for s in seeds])
    empty = F.array().cast("array<string>")
    return countries.join(learned, "country", "left").select("country", F.array_sort(F.array_union(seed, F.coalesce("learned", empty))).alias("forms"))


def frequent_short_tokens(names: DataFrame, name: str = "name", max_len: int = 3, top_n: int = 50, min_count: int = 20) -> DataFrame:
    """country, token, count: the most frequent tokens of up to max_len characters."""
    short = names.select("country", F.explode(tokens(F.col(name))).alias("token")).where(F.length("token") <= max_len)
    return _frequent(short.groupBy("country", "token").count(), "token", top_n, min_count)


def token_vocabulary(names: DataFrame, name: str = "name", longer_than: int = 3) -> DataFrame:
    return names.select("country", F.explode(tokens(F.col(name))).alias("token")).where(F.length("token") > longer_than).distinct()


def abbreviation_map(candidates: DataFrame, expansions: DataFrame, vocab: DataFrame) -> DataFrame:
    """country, token, expansion: proposed expansions (country, token, expansion) of the candidate tokens, in lower case, if they are
    words of the country's own vocabulary."""
    wanted = expansions.select("country", "token", F.lower("expansion").alias("expansion")).where("expansion <> ''")
    known = wanted.join(candidates.select("country", "token"), ["country", "token"], "left_semi")
    return known.join(vocab.select("country", F.col("token").alias("expansion")), ["country", "expansion"], "left_semi").select("country", "token", "expansion")


def aligned_dictionary(pairs: DataFrame, source: str = "src_tokens", target: str = "dst_tokens", min_support: int = 2, condition=None) -> DataFrame:
    """token, target, support: for each token of the first list the most frequent token at its place in the second.

    Lists are zipped up to the shorter. By default tokens of another script meet Latin ones; condition is another rule on src and dst.
    Ties go to the first target in order.
    """
    n = F.least(F.size(source), F.size(target))
    zipped = F.arrays_zip(F.slice(F.col(source), F.lit(1), n).alias("src"), F.slice(F.col(target), F.lit(1), n).alias("dst"))
    rows = pairs.where(n > 0).select(F.explode(zipped).alias("z")).select(F.col("z.src").alias("src"), F.col("z.dst").alias("dst"))
    rule = condition if condition is not None else ~latin(F.col("src")) & latin(F.col("dst"))
    counted = rows.where(rule).groupBy(F.lower("src").alias("token"), F.lower("dst").alias("target")).agg(F.count("*").alias("support"))
    order = Window.partitionBy("token").orderBy(F.col("support").desc(), "target")
    return counted.withColumn("rn", F.row_number().over(order)).where((F.col("rn") == 1) & (F.col("support") >= min_support)).drop("rn")


def missing_tokens(names: DataFrame, name: str, dictionary: DataFrame) -> DataFrame:
    """Distinct lower-case tokens of another script that the dictionary lacks."""
    found = names.select(F.explode(tokens(F.col(name))).alias("token")).distinct().where(~latin(F.col("token"))).select(F.lower("token").alias("token")).distinct()
    return found.join(dictionary.select("token"), "token", "left_anti")


def extend_dictionary(dictionary: DataFrame, missing: DataFrame, model: Callable) -> DataFrame:
    """token, target: the dictionary and what a model (a column function) gives for missing tokens, in lower case; empty outputs don't count."""
    more = missing.select("token", F.lower(model(F.col("token"))).alias("target")).where("target <> ''")
    return dictionary.select("token", "target").unionByName(more)
