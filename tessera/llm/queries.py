"""The queries over the test tables, one for each operator, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, html_text, language_id, minhash, mixing, pii, quality_classifier, quality_rules, substring_dedup
from .common import documents, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded whole: doc_id, n_tokens, ids_sha256, decoded_sha256. Null and empty texts have no tokens;
    repeated rows give repeated rows; an empty table gives an empty result, here and below."""
    return bpe.encode_documents(documents(spark, sf_dir), tokenizer_path())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document with a passage of 50 words or more that others have too: see repeated_passages(). Spans as start-end,
    classes as anchor:start, comma-joined. Null, empty and short texts have no row, repeated rows one."""
    listed = F.array_join(F.transform("passages", lambda p: F.concat(p["start"].cast("string"), F.lit("-"), p["end"].cast("string"))), ",")
    return substring_dedup.repeated_passages(documents(spark, sf_dir)).withColumns({"passages": listed, "shared": F.array_join("shared", ",")})


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url and the visible text of every page. Null html gives null; repeated rows give repeated rows."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it, in training order, those that it leaves out last: doc_id, size, source_size, target,
    taken, copies, first_position. Null texts have size 0, null sources are the last source, repeated rows are taken alike."""
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.withColumn("first_position", F.try_element_at("positions", F.lit(1))).drop("positions").orderBy(F.asc_nulls_last("first_position"), "doc_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the scores of both views and of both together, learned from the labels: see score_quality(). Null and empty
    texts are scored as empty; equal rows get equal scores."""
    return quality_classifier.score_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data: counts, the digest of the base spans, and all spans, base ones first, then terms by
    start. Null counts as empty; rows with equal texts get equal spans."""
    found = pii.find_personal_data(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), pii.span_list().alias("spans"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per doc_id: n_shingles, component_id, kept. Texts without words have no shingles and are linked with nothing; repeated rows
    count once."""
    return minhash.near_duplicates(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with held_out, lang_pred and score, learned from the others. Texts that are null or have no letter get "und" and 0;
    rows without id are not held out, but teach nothing; equal texts get equal predictions."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = documents(spark, sf_dir).withColumn("held_out", held_out)
    return language_id.predict(docs, docs.where("not held_out"), keep=("held_out",))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts, base_failed, distance and kept: see quality_verdicts(). Null and empty texts have no words and
    fail; repeated rows get equal verdicts."""
    return quality_rules.quality_verdicts(documents(spark, sf_dir)).drop(*quality_rules.FEATURES)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with keep_id, group_size, kept and text_sha256. Null counts as empty; repeated rows are copies of one another."""
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each copy of a document that the last stage gets: see corpus_pipeline.run()."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (op1_bpe, op2_substring_dedup, op3_html, op4_mixing, op5_quality_classifier, op6_pii, op7_minhash, op8_language_id, op9_quality_rules, op10_exact_dedup, pipeline)}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def oracle_sql() -> dict[str, str]:
    return {
        "op7_minhash": f"""
            WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
            s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
            e AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM s),
            p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
                  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
            l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
            r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
            SELECT s.doc_id, len(s.s) AS n_shingles, min(r.c) AS component_id, min(r.c) = s.doc_id AS kept FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, len(s.s)""",
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    }
