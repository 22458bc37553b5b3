"""The test tables in the roles of a linkage task.

Every document is a record: its source decides its role (src0 to src4 the reference side S1, src5 to src9 pool source 2, the rest
pool source 3), its language is the country, its first line the name and the rest of its text the address. Truth pairs are
S1 and pool records of one country with equal normalised name and address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import LEGAL_FORMS
from tessera.sources import tables

from .normalize import normalize_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    number = F.expr("try_cast(substring(source, 4) as int)")
    text = F.coalesce("text", F.lit(""))
    cut = F.instr(text, "\n")
    return docs.select(
        F.when(number < 5, 1).when(number < 10, 2).otherwise(3).alias("source"),
        F.col("doc_id").alias("id"),
        F.col("lang").alias("country"),
        F.when(cut > 0, F.substring(text, F.lit(1), cut - 1)).otherwise(text).alias("name"),
        F.when(cut > 0, F.expr("substring(coalesce(text, ''), instr(coalesce(text, ''), '\n') + 1)")).otherwise(F.lit("")).alias("address"),
    )


_STAGED: dict[tuple[str, str, int], DataFrame] = {}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised records, as a stage table: both sides of a join, their vocabularies and the features read columns of it. It is written
    once for a version of the documents."""
    key = (spark.sparkContext.applicationId, sf_dir, tables.modified(spark, f"{sf_dir}/documents.parquet"))
    if key not in _STAGED:
        tables.small_batches(spark)
        _STAGED[key] = tables.stage(normalize_records(raw_records(spark, sf_dir)), "records")
    return _STAGED[key]


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(S1, pool)."""
    rows = records(spark, sf_dir)
    return rows.where("source = 1"), rows.where("source > 1")


def truth(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Texts meet by their SHA-256, so that no text is shuffled."""
    text = F.concat(F.length("name_clean").cast("string"), F.lit(":"), F.col("name_clean"), F.col("address_clean"))
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    return s1.select("country", digest, F.col("id").alias("s1")).join(pool.select("country", digest, "source", "id"), ["country", "digest"]).select("country", "s1", "source", "id")


# The same in DuckDB's SQL, as the start of a chain of common table expressions.


def clean_sql(x: str) -> str:
    folded = f"strip_accents(replace(lower(nfc_normalize({x})), 'ß', 'ss'))"
    step = f"regexp_replace({folded}, '^\\s*(--+|\\*\\*\\*+|>>+|\\[\\.\\.\\]|#|@)\\s*', '')"
    step = f"regexp_replace({step}, '([0-9A-Za-z_])\\.(com|in|fr|net|org|co)\\b', '\\1', 'gi')"
    step = f"regexp_replace(regexp_replace({step}, '[,;]', ' ', 'g'), '[.()\\[\\]/]', '', 'g')"
    return f"trim(regexp_replace({step}, '\\s+', ' ', 'g'))"


_FORMS = f"({', '.join(repr(f) for f in LEGAL_FORMS)})"
RECORDS_SQL = f"""raw AS (
  SELECT doc_id AS id, lang AS country,
         CASE WHEN try_cast(substr(source, 4) AS INTEGER) < 5 THEN 1 WHEN try_cast(substr(source, 4) AS INTEGER) < 10 THEN 2 ELSE 3 END AS source,
         split_part(coalesce(text, ''), chr(10), 1) AS name,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS address
  FROM documents),
folded AS (SELECT id, country, source, {clean_sql("name")} AS n, {clean_sql("address")} AS address_clean FROM raw),
worded AS (SELECT *, list_filter(string_split(n, ' '), lambda t: t <> '') AS words, list_filter(list_transform(regexp_split_to_array(address_clean, '[\\s,]+'), lambda t: trim(t, '.,;:-')), lambda t: t <> '') AS parts FROM folded),
formed AS (SELECT *, CASE WHEN words[-1] IN {_FORMS} THEN words[-1] END AS legal_form FROM worded),
rec AS (
  SELECT id, country, source, legal_form, address_clean, CASE WHEN legal_form IS NULL THEN words ELSE words[1:-2] END AS name_tokens,
         array_to_string(CASE WHEN legal_form IS NULL THEN words ELSE words[1:-2] END, ' ') AS name_clean,
         array_to_string(CASE WHEN legal_form IS NULL THEN words ELSE words[1:-2] END, '') AS name_nospace,
         list_filter(string_split(address_clean, ' '), lambda t: t <> '') AS address_tokens, parts,
         list_filter(parts, lambda t, i: i > 1 AND regexp_full_match(t, '\\d{{5,6}}'))[1] AS postcode,
         list_position(list_transform(parts, lambda t, i: i > 1 AND regexp_full_match(t, '\\d{{5,6}}')), true) AS postcode_at
  FROM formed),
numbered AS (SELECT *, list_filter(parts, lambda t, i: regexp_full_match(t, '\\d+[a-zA-Z]?') AND i IS DISTINCT FROM postcode_at) AS addr_numbers FROM rec),
s1 AS (SELECT * FROM numbered WHERE source = 1), pool AS (SELECT * FROM numbered WHERE source > 1),
truth AS (SELECT s1.country, s1.id AS s1, p.source, p.id FROM s1 JOIN pool p ON s1.country = p.country AND s1.name_clean = p.name_clean AND s1.address_clean = p.address_clean)"""

WORD_KEYS_SQL = "list_concat(list_concat(name_tokens, address_tokens), list_filter(list_transform(address_tokens, lambda t, i: CASE WHEN list_contains(addr_numbers, t) AND i < len(address_tokens) THEN t || '_' || address_tokens[i + 1] END), lambda k: k IS NOT NULL))"
NGRAM_KEYS_SQL = "CASE WHEN name_nospace = '' THEN [] WHEN length(name_nospace) < 3 THEN [name_nospace] ELSE list_transform(range(1, length(name_nospace) - 1), lambda i: substr(name_nospace, i, 3)) END"


def channel_sql(name: str, keys: str, cap: int, k: int) -> str:
    """Tables <name>_vocab, <name>_scores and <name>_top: an index channel cut to k."""
    return f"""{name}_post AS (SELECT DISTINCT country, source, id, unnest({keys}) AS key FROM pool),
{name}_n AS (SELECT country, count(*) AS n FROM pool GROUP BY country),
{name}_df AS (SELECT country, key, count(*) AS df FROM {name}_post GROUP BY country, key),
{name}_vocab AS (SELECT country, key, df, n, ln(n / (1 + df)) AS idf FROM {name}_df JOIN {name}_n USING (country) WHERE df <= {cap}),
{name}_pw AS (SELECT country, source, id, key, idf, sqrt(sum(idf * idf) OVER (PARTITION BY country, source, id)) AS norm FROM {name}_post JOIN {name}_vocab USING (country, key)),
{name}_qw AS (SELECT country, s1, key, idf, sqrt(sum(idf * idf) OVER (PARTITION BY country, s1)) AS norm FROM (SELECT DISTINCT country, id AS s1, unnest({keys}) AS key FROM s1) JOIN {name}_vocab USING (country, key)),
{name}_scores AS (SELECT country, q.s1, p.source, p.id, sum(q.idf / CASE WHEN q.norm = 0 THEN 1 ELSE q.norm END * (p.idf / CASE WHEN p.norm = 0 THEN 1 ELSE p.norm END)) AS score FROM {name}_qw q JOIN {name}_pw p USING (country, key) GROUP BY ALL),
{name}_top AS (SELECT *, row_number() OVER (PARTITION BY country, s1 ORDER BY round(score, 9) DESC, source, id) AS rank FROM {name}_scores QUALIFY rank <= {k})"""
