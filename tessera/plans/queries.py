"""One query for each operator over the whole test tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import fuzzy
from tessera.functions import text as T
from tessera.functions.ids import config_hash, triple_key
from tessera.operators import blocking, decide, dense, dictionaries, features, index, metrics, models, sampling, validate
from tessera.sources import tables

from . import roles
from .linkage import exact_channel, passes_gate
from .roles import NGRAM_KEYS_SQL, RECORDS_SQL, WORD_KEYS_SQL, channel_sql

# Parameters of the queries: the operators' own caps and cut of the channels, the candidate lists' length, the length that cnp_k_choice
# settles on (pair features and decisions take that), and the budget of the second stage.
WORD_CAP, NGRAM_CAP, CUT, K_LIST, K, BUDGET = index.WORD_CAP, index.NGRAM_CAP, index.TOP_K, max(blocking.K_GRID), min(blocking.K_GRID), 300
PAIR = ["country", "s1", "source", "id"]
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return put


def _word_keys():
    return T.word_keys(F.col("name_clean"), F.col("address_clean"), F.col("addr_numbers"))


def _ngram_keys():
    return T.ngram_keys(F.col("name_nospace"))


def _channel(spark, sf, keys, cap):
    s1, pool = roles.sides(spark, sf)
    return index.channel_top_k(s1, pool, keys, cap, CUT)


def _fused(spark, sf):
    return blocking.fuse([_channel(spark, sf, _word_keys(), WORD_CAP), _channel(spark, sf, _ngram_keys(), NGRAM_CAP), exact_channel(*roles.sides(spark, sf), CUT)])


def _fused_table(spark, sf):
    """For queries that read the fused pairs more than once, as competition does."""
    return tables.stage(_fused(spark, sf), "fused")


def _r(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


_WORD, _NGRAM = channel_sql("word", WORD_KEYS_SQL, WORD_CAP, CUT), channel_sql("gram", NGRAM_KEYS_SQL, NGRAM_CAP, CUT)
_FUSED = f"WITH {RECORDS_SQL}, {_WORD}, {_NGRAM}, same AS (SELECT country, name_clean, address_clean, source, id, row_number() OVER (PARTITION BY country, name_clean, address_clean ORDER BY source, id) AS rank FROM pool QUALIFY rank <= {CUT}), ranked AS (SELECT country, s1, source, id, rank FROM word_top UNION ALL SELECT country, s1, source, id, rank FROM gram_top UNION ALL SELECT s1.country, s1.id AS s1, same.source, same.id, same.rank FROM s1 JOIN same ON s1.country = same.country AND s1.name_clean = same.name_clean AND s1.address_clean = same.address_clean), fused AS (SELECT country, s1, source, id, sum(1.0::DOUBLE / (60 + rank)) AS rrf FROM ranked GROUP BY ALL), cand AS (SELECT *, row_number() OVER (PARTITION BY country, s1 ORDER BY round(rrf, 9) DESC, source, id) AS rank FROM fused)"
#: Pairs with a probability: the 3-gram channel's cosine, so that SQL can follow.
_PROB = f"WITH {RECORDS_SQL}, {_NGRAM}, pairs AS (SELECT country, s1, source, id, rank, least(1.0, greatest(0.0, round(score, 6))) AS prob FROM gram_top WHERE rank <= {K})"


def _pairs(spark, sf):
    top = _channel(spark, sf, _ngram_keys(), NGRAM_CAP).where(F.col("rank") <= K)
    return top.select(*PAIR, "rank", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.round("score", 6))).alias("prob"))


def _truth(spark, sf):
    return roles.truth(*roles.sides(spark, sf))


def _s1_ids(spark, sf):
    return roles.raw_records(spark, sf).where("source = 1").select(F.col("id").alias("s1"), "country")


# Sources, ids, text


@query("SELECT doc_id, 'S' || (CASE WHEN try_cast(substr(source, 4) AS INTEGER) < 5 THEN 1 WHEN try_cast(substr(source, 4) AS INTEGER) < 10 THEN 2 ELSE 3 END) || '-' || doc_id AS entity_id, (CASE WHEN try_cast(substr(source, 4) AS INTEGER) < 5 THEN 1 WHEN try_cast(substr(source, 4) AS INTEGER) < 10 THEN 2 ELSE 3 END) * 4294967296 + doc_id AS pair_key FROM documents")
def id_codec(spark: SparkSession, sf: str) -> DataFrame:
    from tessera.functions.ids import decode_id, encode_ids, pair_key

    rows = roles.raw_records(spark, sf).select(F.col("id").alias("doc_id"), decode_id(F.col("source"), F.col("id")).alias("entity_id"))
    return encode_ids(rows, "entity_id").select("doc_id", "entity_id", pair_key(F.col("source"), F.col("id_num")).alias("pair_key"))


@query("SELECT DISTINCT lang AS country FROM documents WHERE lang IS NOT NULL")
def countries(spark: SparkSession, sf: str) -> DataFrame:
    return tables.countries(roles.raw_records(spark, sf))


@query(f"WITH {RECORDS_SQL} SELECT id, source, country, name_clean, legal_form, name_nospace, regexp_replace(name_nospace, '[^\\p{{L}}]|[aeiou]', '', 'g') AS name_skeleton FROM numbered")
def name_clean(spark: SparkSession, sf: str) -> DataFrame:
    return roles.records(spark, sf).select("id", "source", "country", "name_clean", "legal_form", "name_nospace", "name_skeleton")


@query(f"WITH {RECORDS_SQL} SELECT id, address_clean, postcode, array_to_string(addr_numbers, ',') AS addr_numbers FROM numbered")
def address_parts(spark: SparkSession, sf: str) -> DataFrame:
    return roles.records(spark, sf).select("id", "address_clean", "postcode", F.array_join("addr_numbers", ",").alias("addr_numbers"))


@query()
def transliterate_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles.records(spark, sf)
    return rows.groupBy("country").agg(F.count_if("name_transliterated").alias("names"), F.count_if("addr_transliterated").alias("addresses"), F.count("*").alias("n"))


@query("WITH t AS (SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: x <> '') AS w FROM part), f AS (SELECT last, count(*) AS c FROM (SELECT w[-1] AS last FROM t) WHERE last IS NOT NULL GROUP BY last), top AS (SELECT last FROM f QUALIFY row_number() OVER (ORDER BY c DESC, last) <= 3 AND c >= 5) SELECT p_partkey, array_to_string(CASE WHEN w[-1] IN (SELECT last FROM top) THEN w[1:-2] ELSE w END, ' ') AS rest, CASE WHEN w[-1] IN (SELECT last FROM top) THEN w[-1] END AS form FROM t")
def legal_form_split(spark: SparkSession, sf: str) -> DataFrame:
    part = roles.table(spark, sf, "part").select("p_partkey", F.lit("parts").alias("country"), F.col("p_name").alias("name"))
    forms = dictionaries.legal_form_vocabulary(part, seeds=("ltd",), min_count=5, top_n=3)
    rows = part.join(forms, "country").withColumn("s", T.split_legal_form(T.tokens(F.col("name")), F.col("forms")))
    return rows.select("p_partkey", F.array_join("s.rest", " ").alias("rest"), F.col("s.form").alias("form"))


@query(f"WITH {RECORDS_SQL}, f AS (SELECT country, n_last AS form, count(*) AS count FROM (SELECT country, list_filter(string_split(name_clean, ' '), lambda t: t <> '')[-1] AS n_last FROM numbered) WHERE n_last IS NOT NULL GROUP BY ALL) SELECT country, form, count FROM f QUALIFY row_number() OVER (PARTITION BY country ORDER BY count DESC, form) <= 30 AND count >= 5")
def legal_form_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return dictionaries.frequent_final_tokens(roles.records(spark, sf), "name_clean", min_count=5)


@query(f"WITH {RECORDS_SQL}, f AS (SELECT country, token, count(*) AS count FROM (SELECT country, unnest(name_tokens) AS token FROM numbered) WHERE length(token) <= 3 GROUP BY ALL) SELECT country, token, count FROM f QUALIFY row_number() OVER (PARTITION BY country ORDER BY count DESC, token) <= 50 AND count >= 20")
def short_token_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return dictionaries.frequent_short_tokens(roles.records(spark, sf), "name_clean")


_ALIGN = "pairs AS (SELECT string_split(a.p_name, ' ') AS x, string_split(b.p_type, ' ') AS y FROM part a JOIN part b ON a.p_partkey = b.p_partkey), z AS (SELECT lower(x[i]) AS token, lower(y[i]) AS target FROM (SELECT x, y, unnest(range(1, least(len(x), len(y)) + 1)) AS i FROM pairs)), c AS (SELECT token, target, count(*) AS support FROM z GROUP BY ALL)"


@query(f"WITH {_ALIGN} SELECT token, target, support FROM c QUALIFY row_number() OVER (PARTITION BY token ORDER BY support DESC, target) = 1 AND support >= 2")
def aligned_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    part = roles.table(spark, sf, "part").select(F.split("p_name", " ").alias("src_tokens"), F.split("p_type", " ").alias("dst_tokens"))
    return dictionaries.aligned_dictionary(part, condition=F.lit(True))


@query(f"WITH {RECORDS_SQL}, f AS (SELECT country, token, count(*) AS count FROM (SELECT country, unnest(name_tokens) AS token FROM numbered) WHERE length(token) <= 3 GROUP BY ALL), top AS (SELECT country, token FROM f QUALIFY row_number() OVER (PARTITION BY country ORDER BY count DESC, token) <= 50 AND count >= 20), vocab AS (SELECT DISTINCT country, token FROM (SELECT country, unnest(name_tokens) AS token FROM numbered) WHERE length(token) > 3), tried AS (SELECT country, token, token || token AS expansion FROM top UNION ALL SELECT country, token, 'th' || token FROM top) SELECT t.* FROM tried t JOIN vocab v ON t.country = v.country AND t.expansion = v.token")
def abbrev_expand(spark: SparkSession, sf: str) -> DataFrame:
    names = roles.records(spark, sf)
    candidates = dictionaries.frequent_short_tokens(names, "name_clean")
    tried = candidates.select("country", "token", F.explode(F.array(F.concat("token", "token"), F.concat(F.lit("th"), "token"))).alias("expansion"))
    return dictionaries.abbreviation_map(candidates, tried, dictionaries.token_vocabulary(names, "name_clean"))


# Index and blocking


@query(f"WITH {RECORDS_SQL}, {_WORD} SELECT country, key, df, round(idf, 6) AS idf FROM word_vocab")
def idf_vocab_word(spark: SparkSession, sf: str) -> DataFrame:
    return index.vocabulary(roles.sides(spark, sf)[1], _word_keys(), ("source", "id"), WORD_CAP).select("country", "key", "df", _r("idf"))


@query(f"WITH {RECORDS_SQL}, {_NGRAM} SELECT country, key, df, round(idf, 6) AS idf FROM gram_vocab")
def idf_vocab_ngram(spark: SparkSession, sf: str) -> DataFrame:
    return index.vocabulary(roles.sides(spark, sf)[1], _ngram_keys(), ("source", "id"), NGRAM_CAP).select("country", "key", "df", _r("idf"))


@query(f"WITH {RECORDS_SQL}, {_WORD} SELECT country, s1, source, id, rank, round(score, 6) AS score FROM word_top")
def channel_topk_word(spark: SparkSession, sf: str) -> DataFrame:
    return _channel(spark, sf, _word_keys(), WORD_CAP).select(*PAIR, "rank", _r("score"))


@query(f"WITH {RECORDS_SQL}, {_NGRAM} SELECT country, s1, source, id, rank, round(score, 6) AS score FROM gram_top")
def channel_topk_ngram(spark: SparkSession, sf: str) -> DataFrame:
    return _channel(spark, sf, _ngram_keys(), NGRAM_CAP).select(*PAIR, "rank", _r("score"))


@query(f"{_FUSED} SELECT country, s1, source, id, rank, round(rrf, 6) AS rrf FROM cand WHERE rank <= {K_LIST}")
def rrf_cnp_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.prune(_fused(spark, sf), K_LIST).select(*PAIR, "rank", _r("rrf"))


@query(f"{_FUSED}, o AS (SELECT *, row_number() OVER (PARTITION BY country, source, id ORDER BY rrf DESC, s1) AS rn FROM fused) SELECT country, source, id, round(max(rrf), 6) AS best, round(coalesce(max(CASE WHEN rn = 2 THEN rrf END), 0), 6) AS second, count(*) AS rivals FROM o GROUP BY country, source, id")
def competing_s1_stats(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.competition(_fused_table(spark, sf)).select("country", "source", "id", _r("best"), _r("second"), "rivals")


@query(f"{_FUSED}, c AS (SELECT * FROM cand WHERE rank <= {K_LIST}), h AS (SELECT c.country, count(*) AS hits FROM c JOIN truth t USING (country, s1, source, id) GROUP BY 1), a AS (SELECT country, count(*) AS n_s1 FROM s1 GROUP BY 1), b AS (SELECT country, count(*) AS n_pool FROM pool GROUP BY 1), d AS (SELECT country, count(*) AS n_true FROM truth GROUP BY 1), e AS (SELECT country, count(*) AS n_cand FROM c GROUP BY 1) SELECT country, coalesce(n_s1, 0) AS n_s1, coalesce(n_pool, 0) AS n_pool, coalesce(hits, 0) AS hits, coalesce(n_true, 0) AS n_true, coalesce(n_cand, 0) AS n_cand, round(CASE WHEN coalesce(n_true, 0) = 0 THEN 1.0::DOUBLE ELSE coalesce(hits, 0) / n_true END, 6) AS pc, round(CASE WHEN coalesce(n_s1 * n_pool, 0) = 0 THEN 0.0::DOUBLE ELSE 1 - coalesce(n_cand, 0) / (n_s1 * n_pool) END, 6) AS rr, round(CASE WHEN coalesce(n_cand, 0) = 0 THEN 0.0::DOUBLE ELSE coalesce(hits, 0) / n_cand END, 6) AS pq FROM a FULL JOIN b USING (country) LEFT JOIN d USING (country) LEFT JOIN e USING (country) LEFT JOIN h USING (country)")
def blocking_quality(spark: SparkSession, sf: str) -> DataFrame:
    s1, pool = roles.sides(spark, sf)
    return blocking.quality(blocking.prune(_fused(spark, sf), K_LIST), roles.truth(s1, pool), s1, pool).withColumns({c: F.round(c, 6) for c in ("pc", "rr", "pq")})


_GRID = blocking.K_GRID
_RECALL = f"{_FUSED}, hr AS (SELECT t.*, c.rank AS r FROM truth t LEFT JOIN cand c USING (country, s1, source, id)), rec_k AS (SELECT k, coalesce(avg(CASE WHEN r <= k THEN 1.0 ELSE 0.0 END), 1.0) AS recall FROM (SELECT unnest({list(_GRID)}) AS k) LEFT JOIN hr ON true GROUP BY k)"


@query(f"{_RECALL} SELECT k, round(recall, 6) AS recall FROM rec_k")
def recall_at_k(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.recall_at(blocking.prune(_fused(spark, sf), max(_GRID)), _truth(spark, sf), _GRID).select("k", _r("recall"))


@query(f"{_RECALL} SELECT min(k) AS k FROM rec_k WHERE recall >= (SELECT max_by(recall, k) FROM rec_k) - 0.001")
def cnp_k_choice(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.choose_k(blocking.recall_at(blocking.prune(_fused(spark, sf), max(_GRID)), _truth(spark, sf), _GRID))


_KNN = "knn AS (SELECT a.label AS country, a.vec_id AS s1, 2 AS source, b.vec_id AS id, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)"


@query(f"WITH {_KNN} SELECT country, s1, source, id, round(score, 6) AS score, row_number() OVER (PARTITION BY country, s1 ORDER BY round(score, 9) DESC, source, id) AS rank FROM knn QUALIFY rank <= 10")
def dense_exact_knn(spark: SparkSession, sf: str) -> DataFrame:
    v = roles.table(spark, sf, "embeddings").select(F.col("label").alias("country"), F.col("vec_id").alias("id"), F.lit(2).alias("source"), "embedding")
    found = dense.exact_knn(v.select("country", F.col("id").alias("s1"), "embedding"), v, 10, same_id=False)
    return found.select(*PAIR, _r("score"), "rank")


@query()
def hybrid_rrf(spark: SparkSession, sf: str) -> DataFrame:
    s1, pool = roles.sides(spark, sf)
    text = T.embedding_text(F.col("name_clean"), F.col("address_clean"))
    q, p = (dense.encode_texts(side.withColumn("_t", text), "_t") for side in (s1, pool))
    near = dense.exact_knn(q.select("country", F.col("id").alias("s1"), "embedding"), p.select("country", "source", "id", "embedding"), CUT)
    return blocking.prune(blocking.fuse([_channel(spark, sf, _ngram_keys(), NGRAM_CAP), near]), K).select(*PAIR, "rank", _r("rrf"))


# Pair features

_REC_PAIRS = f"{_PROB}, rp AS (SELECT p.country, p.s1, p.source, p.id, a.name_clean AS an, b.name_clean AS bn, a.name_tokens AS at_, b.name_tokens AS bt, a.name_nospace AS ans, b.name_nospace AS bns, a.legal_form AS al, b.legal_form AS bl, a.address_clean AS aa, b.address_clean AS ba, a.address_tokens AS aat, b.address_tokens AS bat, a.addr_numbers AS anum, b.addr_numbers AS bnum, a.postcode AS apc, b.postcode AS bpc FROM pairs p JOIN s1 a ON a.country = p.country AND a.id = p.s1 JOIN pool b ON b.country = p.country AND b.source = p.source AND b.id = p.id)"


def _jaccard_sql(x: str, y: str) -> str:
    return f"CASE WHEN len({x}) + len({y}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_distinct({x}), list_distinct({y})))::DOUBLE / len(list_distinct(list_concat({x}, {y}))) END"


def _grams_sql(x: str) -> str:
    return f"list_distinct({NGRAM_KEYS_SQL.replace('name_nospace', x)})"


_SHORT, _LONG = "(CASE WHEN len(at_) <= len(bt) THEN at_ ELSE bt END)", "(CASE WHEN len(at_) <= len(bt) THEN bt ELSE at_ END)"


@query(
    f"""{_REC_PAIRS} SELECT country, s1, source, id,
 round({_jaccard_sql("at_", "bt")}, 6) AS name_jaccard,
 round(CASE WHEN ans = '' OR bns = '' THEN 0.0::DOUBLE ELSE len(list_intersect({_grams_sql("ans")}, {_grams_sql("bns")})) / sqrt((len({_grams_sql("ans")}) * len({_grams_sql("bns")}))::DOUBLE) END, 6) AS name_ngram_cosine,
 round(CASE WHEN len({_SHORT}) = 0 THEN 0.0::DOUBLE ELSE len(list_filter({_SHORT}, lambda t: len(list_filter({_LONG}, lambda u: starts_with(u, t))) > 0))::DOUBLE / len({_SHORT}) END, 6) AS name_abbrev_subseq,
 (array_to_string(list_transform(at_, lambda t: t[1]), '') = bns OR array_to_string(list_transform(bt, lambda t: t[1]), '') = ans)::INT::DOUBLE AS name_acronym_match,
 CASE WHEN al IS NULL OR bl IS NULL THEN 0 WHEN al = bl THEN 2 ELSE 1 END AS legal_form,
 round({_jaccard_sql("aat", "bat")}, 6) AS addr_jaccard,
 len(list_intersect(list_distinct(anum), list_distinct(bnum))) AS addr_shared_numbers,
 (len(anum) > 0 AND len(bnum) > 0 AND len(list_intersect(anum, bnum)) = 0)::INT::DOUBLE AS addr_number_conflict,
 coalesce(apc <> '' AND apc = bpc, false)::INT::DOUBLE AS addr_postcode_equal,
 (aa = '' OR ba = '')::INT::DOUBLE AS addr_missing FROM rp"""
)
def pair_set_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.set_features(features.pair_records(_pairs(spark, sf), *roles.sides(spark, sf)))
    rounded = {c: F.round(c, 6) for c in ("name_jaccard", "name_ngram_cosine", "name_abbrev_subseq", "addr_jaccard")}
    return rows.withColumns(rounded).select(*PAIR, *rounded, "name_acronym_match", "legal_form", "addr_shared_numbers", "addr_number_conflict", "addr_postcode_equal", "addr_missing")


_IDF = "fi AS (SELECT country, key, ln(n / (1 + df)) AS idf FROM (SELECT country, key, count(*) AS df FROM (SELECT DISTINCT country, source, id, unnest(list_concat(name_tokens, address_tokens)) AS key FROM pool) GROUP BY ALL) JOIN (SELECT country, count(*) AS n FROM pool GROUP BY 1) USING (country))"


def _cosine_sql(name: str, a: str, b: str) -> str:
    side = "SELECT country, s1, source, id, unnest(list_distinct({})) AS key FROM rp"
    return f"""{name}_m AS (SELECT country, s1, source, id, key, x.s1 IS NOT NULL AS ia, y.s1 IS NOT NULL AS ib FROM ({side.format(a)}) x FULL JOIN ({side.format(b)}) y USING (country, s1, source, id, key)),
{name}_w AS (SELECT m.*, idf * idf AS sq FROM {name}_m m JOIN fi ON fi.country = m.country AND fi.key = m.key),
{name} AS (SELECT s1, source, id, CASE WHEN sum(CASE WHEN ia THEN sq ELSE 0 END) > 0 AND sum(CASE WHEN ib THEN sq ELSE 0 END) > 0 THEN sum(CASE WHEN ia AND ib THEN sq ELSE 0 END) / sqrt(sum(CASE WHEN ia THEN sq ELSE 0 END) * sum(CASE WHEN ib THEN sq ELSE 0 END)) ELSE 0.0 END AS v FROM {name}_w GROUP BY ALL)"""


@query(f"{_REC_PAIRS}, {_IDF}, {_cosine_sql('nc', 'at_', 'bt')}, {_cosine_sql('ac', 'aat', 'bat')} SELECT rp.country, rp.s1, rp.source, rp.id, round(coalesce(nc.v, 0), 6) AS name_idf_cosine, round(coalesce(ac.v, 0), 6) AS addr_idf_cosine FROM rp LEFT JOIN nc USING (s1, source, id) LEFT JOIN ac USING (s1, source, id)")
def pair_idf_cosine(spark: SparkSession, sf: str) -> DataFrame:
    out = features.idf_cosines(_pairs(spark, sf), *roles.sides(spark, sf))
    return out.select(*PAIR, _r("name_idf_cosine"), _r("addr_idf_cosine"))


@query(f"WITH {RECORDS_SQL}, {_IDF}, sh AS (SELECT country, id AS s1, name_tokens, count(*) OVER (PARTITION BY country, name_clean) AS s1_name_share_count FROM s1), su AS (SELECT x.country, x.s1, sum(idf) AS v FROM (SELECT country, s1, unnest(name_tokens) AS key FROM sh) x JOIN fi ON fi.country = x.country AND fi.key = x.key GROUP BY ALL) SELECT sh.country, sh.s1, s1_name_share_count, round(coalesce(v, 0), 6) AS s1_name_idf_sum FROM sh LEFT JOIN su ON su.country = sh.country AND su.s1 = sh.s1")
def name_rarity(spark: SparkSession, sf: str) -> DataFrame:
    s1, pool = roles.sides(spark, sf)
    return features.name_rarity(s1, features.feature_idf(pool)).select("country", "s1", "s1_name_share_count", _r("s1_name_idf_sum"))


@query(f"{_REC_PAIRS} SELECT country, s1, source, id, CASE WHEN an = bn THEN 1.0::DOUBLE WHEN an = '' OR bn = '' THEN 0.0 ELSE round(jaro_winkler_similarity(an, bn), 6) END AS name_jaro_winkler FROM rp")
def pair_jaro_winkler(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.pair_records(_pairs(spark, sf), *roles.sides(spark, sf))
    return rows.select(*PAIR, F.round(fuzzy.winkler(F.col("a_name_clean"), F.col("b_name_clean")), 6).alias("name_jaro_winkler"))


@query()
def pair_indel_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.fuzzy_features(features.pair_records(_pairs(spark, sf), *roles.sides(spark, sf)))
    return rows.select(*PAIR, "name_ratio", "name_token_sort", "name_token_set", "addr_token_set")


@query(f"{_FUSED}, o AS (SELECT *, row_number() OVER (PARTITION BY country, source, id ORDER BY rrf DESC, s1) AS rn FROM fused), comp AS (SELECT country, source, id, max(rrf) AS best, coalesce(max(CASE WHEN rn = 2 THEN rrf END), 0) AS second FROM o GROUP BY ALL), c AS (SELECT *, max(rrf) OVER (PARTITION BY country, s1) AS top FROM cand WHERE rank <= {K}) SELECT c.country, c.s1, c.source, c.id, round(rrf, 6) AS fused_score, rank AS fused_rank, round(top - rrf, 6) AS gap_to_s1_best, CASE WHEN rrf >= best - 1e-9 THEN 1 WHEN rrf >= second - 1e-9 THEN 2 ELSE 3 END AS reverse_rank, round(greatest(best - rrf, 0), 6) AS gap_to_record_best, (c.source = 3)::INT::DOUBLE AS is_s3 FROM c JOIN comp ON comp.country = c.country AND comp.source = c.source AND comp.id = c.id")
def graph_features(spark: SparkSession, sf: str) -> DataFrame:
    fused = _fused_table(spark, sf)
    rows = features.graph_features(blocking.prune(fused, K), blocking.competition(fused))
    return rows.withColumns({c: F.round(c, 6) for c in ("fused_score", "gap_to_s1_best", "gap_to_record_best")})


# Decision and metrics

_OWN = f"{_PROB}, own AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY prob DESC, s1) = 1)"
_PREFIX = f"{_OWN}, run AS (SELECT *, row_number() OVER w AS rn, sum(prob) OVER (w ROWS UNBOUNDED PRECEDING) AS cum, sum(prob) OVER (PARTITION BY s1) AS total, product(1 - prob) OVER (PARTITION BY s1) AS none FROM own WINDOW w AS (PARTITION BY s1 ORDER BY prob DESC, source, id)), f AS (SELECT *, CASE WHEN total > 0 AND cum > 0 THEN 1.25 * (cum / rn) * (cum / total) / (0.25 * (cum / rn) + cum / total) ELSE 0 END AS ef FROM run), b AS (SELECT *, first_value(rn) OVER (PARTITION BY s1 ORDER BY round(ef, 12) DESC, rn) AS bm, max(round(ef, 12)) OVER (PARTITION BY s1) AS bf FROM f), pre AS (SELECT *, CASE WHEN bf > round(none, 12) THEN bm ELSE 0 END AS m FROM b)"


@query(f"{_OWN} SELECT country, s1, source, id, rank, prob FROM own")
def record_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return decide.one_owner(_pairs(spark, sf))


@query(f"{_PREFIX} SELECT s1, source, id FROM pre WHERE rn <= m AND prob >= 0.5")
def expected_f05_decision(spark: SparkSession, sf: str) -> DataFrame:
    return decide.decide(decide.one_owner(_pairs(spark, sf)), 0.5)


_F05 = "CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0::DOUBLE ELSE 0.0 END WHEN n_pred = 0 OR n_tp = 0 THEN 0.0 ELSE 1.25 * (n_tp / n_pred) * (n_tp / n_true) / (0.25 * (n_tp / n_pred) + n_tp / n_true) END"
_SWEEP = f"{_PREFIX}, taus AS (SELECT round(unnest(range(1, 20)) * 0.05, 2)::DOUBLE AS tau), kp AS (SELECT s1, tau, count(*) AS n_pred, count(t.id) AS n_tp FROM pre p LEFT JOIN (SELECT DISTINCT s1, source, id FROM truth) t USING (s1, source, id) JOIN taus ON p.prob >= tau WHERE rn <= m GROUP BY ALL), nt AS (SELECT s1, count(*) AS n_true FROM (SELECT DISTINCT s1, source, id FROM truth) GROUP BY 1), ev AS (SELECT s.id AS s1, coalesce(n_true, 0) AS n_true, tau FROM s1 s LEFT JOIN nt ON nt.s1 = s.id CROSS JOIN taus), sc AS (SELECT ev.tau, avg({_F05}) AS score FROM (SELECT ev.*, coalesce(n_pred, 0) AS n_pred, coalesce(n_tp, 0) AS n_tp FROM ev LEFT JOIN kp ON kp.s1 = ev.s1 AND kp.tau = ev.tau) ev GROUP BY 1)"


@query(f"{_SWEEP} SELECT tau, round(score, 6) AS score FROM sc")
def tau_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return decide.sweep_tau(decide.one_owner(_pairs(spark, sf)), _truth(spark, sf), _s1_ids(spark, sf)).select("tau", _r("score"))


@query(f"{_SWEEP} SELECT tau, round(score, 6) AS score FROM sc ORDER BY round(score, 12) DESC, tau LIMIT 1")
def best_tau(spark: SparkSession, sf: str) -> DataFrame:
    return decide.best_tau(decide.sweep_tau(decide.one_owner(_pairs(spark, sf)), _truth(spark, sf), _s1_ids(spark, sf))).select("tau", _r("score"))


_ENTITY = f"{_PREFIX}, pred AS (SELECT s1, source, id FROM pre WHERE rn <= m AND prob >= 0.5), tr AS (SELECT DISTINCT s1, source, id FROM truth), ent AS (SELECT s.id AS s1, s.country, (SELECT count(*) FROM pred WHERE pred.s1 = s.id) AS n_pred, (SELECT count(*) FROM tr WHERE tr.s1 = s.id) AS n_true, (SELECT count(*) FROM pred JOIN tr USING (s1, source, id) WHERE s1 = s.id) AS n_tp FROM s1 s)"


def _predicted(spark, sf):
    return decide.decide(decide.one_owner(_pairs(spark, sf)), 0.5)


@query(f"{_ENTITY} SELECT s1, n_tp, n_pred, n_true, round({_F05}, 6) AS f05 FROM ent")
def entity_f05(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.entity_f05(_predicted(spark, sf), _truth(spark, sf), _s1_ids(spark, sf)).select("s1", "n_tp", "n_pred", "n_true", _r("f05"))


@query(f"{_ENTITY} SELECT round(avg({_F05}), 6) AS score FROM ent")
def macro_f05(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.macro_f05(_predicted(spark, sf), _truth(spark, sf), _s1_ids(spark, sf)).select(_r("score"))


@query(f"{_ENTITY} SELECT country, round(avg({_F05}), 6) AS score FROM ent GROUP BY ROLLUP (country)")
def macro_f05_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.macro_f05(_predicted(spark, sf), _truth(spark, sf), _s1_ids(spark, sf), by="country").select("country", _r("score"))


@query(f"{_PROB}, r AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY prob DESC, source, id) AS prob_rank FROM pairs) SELECT country, s1, source, id, prob, prob_rank FROM r WHERE prob_rank <= 10 AND prob <= 0.97")
def uncertain_band(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.uncertain_band(decide.rank_in_s1(_pairs(spark, sf)), max_rank=10).select(*PAIR, "prob", "prob_rank")


@query(f"{_PROB}, r AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY prob DESC, source, id) AS prob_rank FROM pairs) SELECT country, s1, source, id, prob, prob_rank FROM r WHERE prob BETWEEN 0.15 AND 0.85 OR (prob_rank = 1 AND prob BETWEEN 0.35 AND 0.65)")
def judge_band(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.judge_band(decide.rank_in_s1(_pairs(spark, sf))).select(*PAIR, "prob", "prob_rank")


@query(f"{_PROB} SELECT country, s1, source, id, prob FROM pairs ORDER BY round(abs(prob - 0.5), 9), s1, source, id LIMIT {BUDGET}")
def budget_closest_half(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.closest_to_half(_pairs(spark, sf), BUDGET).select(*PAIR, "prob")


@query(f"{_PROB}, c AS (SELECT *, CASE WHEN rank <= 3 THEN round(prob * prob, 6) END AS new_prob FROM pairs), d AS (SELECT *, coalesce(new_prob, prob) AS comb, (new_prob IS NOT NULL)::INT::DOUBLE AS scored FROM c) SELECT country, s1, source, id, scored, round(max(comb) OVER o, 6) AS comb_max, round(sum(comb) OVER o, 6) AS comb_sum, round(max(comb) OVER o - comb, 6) AS comb_gap, count(*) FILTER (comb > 0.5) OVER o AS comb_n_half, row_number() OVER (PARTITION BY s1 ORDER BY round(comb, 9) DESC, source, id) AS comb_rank FROM d WINDOW o AS (PARTITION BY s1)")
def context_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = _pairs(spark, sf).withColumn("new_prob", F.when(F.col("rank") <= 3, F.round(F.col("prob") * F.col("prob"), 6)))
    return decide.context_features(rows).select(*PAIR, "scored", _r("comb_max"), _r("comb_sum"), _r("comb_gap"), "comb_n_half", "comb_rank")


_LABELLED = f"{_PROB}, lab AS (SELECT p.*, (t.id IS NOT NULL)::INT AS label FROM pairs p LEFT JOIN (SELECT DISTINCT s1, source, id FROM truth) t USING (s1, source, id))"


@query(f"{_LABELLED} SELECT country, s1, source, id, label FROM lab")
def label_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return features.label_pairs(_pairs(spark, sf), _truth(spark, sf)).select(*PAIR, "label")


@query(f"{_LABELLED} SELECT country, s1, source, id, rank FROM lab WHERE label = 0 AND rank <= 10")
def hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hard_negatives(_pairs(spark, sf), _truth(spark, sf)).select(*PAIR, "rank")


@query(f"{_LABELLED}, st AS (SELECT round(prob, 9) AS s, sum(label) AS hits, count(*) AS n FROM lab GROUP BY 1), cu AS (SELECT *, sum(hits) OVER w AS ch, sum(n) OVER w AS cn, sum(hits) OVER () AS t FROM st WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)) SELECT round(coalesce(sum(CASE WHEN t > 0 THEN ch / cn * hits / t END), 0), 6) AS ap FROM cu")
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.label_pairs(_pairs(spark, sf), _truth(spark, sf)).withColumn("prob", F.round("prob", 9))
    return metrics.average_precision(rows).select(_r("ap"))


@query(f"WITH {RECORDS_SQL}, k AS (SELECT DISTINCT source, id FROM truth), o AS (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || source || ':' || id || ':'), id) AS rn FROM pool WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.source = pool.source AND k.id = pool.id)) SELECT source, id FROM k UNION ALL SELECT source, id FROM o WHERE rn <= 50")
def distractor_sample(spark: SparkSession, sf: str) -> DataFrame:
    s1, pool = roles.sides(spark, sf)
    return sampling.distractors(pool.select("source", "id"), roles.truth(s1, pool), 50)


_SPLIT = "s AS (SELECT id, country, n, c, row_number() OVER (PARTITION BY country ORDER BY md5('42:' || id || ':'), id) AS rn FROM (SELECT doc_id AS id, lang AS country, count(*) OVER () AS n, count(*) OVER (PARTITION BY lang) AS c FROM documents)), q AS (SELECT *, round_even(100.0::DOUBLE * c / n, 0) AS a, round_even(50.0::DOUBLE * c / n, 0) AS b FROM s)"


@query(f"WITH {_SPLIT} SELECT id, CASE WHEN rn <= a THEN 'T' WHEN rn <= a + b THEN 'Vcal' WHEN rn <= a + b + b THEN 'Vtest' ELSE '' END AS split FROM q")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("country"))
    return sampling.stratified_split(rows, {"T": 100, "Vcal": 50, "Vtest": 50}).select("id", "split")


_LISTS = f"WITH {RECORDS_SQL}, lists AS (SELECT s.id AS s1, coalesce((SELECT string_agg('S' || source || '-' || id, ',' ORDER BY source, id) FROM (SELECT DISTINCT s1, source, id FROM truth) t WHERE t.s1 = s.id), '') AS listed FROM s1 s)"


@query(f"{_LISTS} SELECT 'S1-' || s1 AS source1_entity_id, listed AS matched_entity_ids FROM lists")
def format_match_lists(spark: SparkSession, sf: str) -> DataFrame:
    return tables.format_lists(decide.with_all(_truth(spark, sf), _s1_ids(spark, sf)))


@query(f"{_LISTS} SELECT s1, split_part(m, '-', 1)[2:]::INT AS source, split_part(m, '-', 2)::BIGINT AS id FROM (SELECT s1, unnest(string_split(listed, ',')) AS m FROM lists WHERE listed <> '')")
def explode_ground_truth(spark: SparkSession, sf: str) -> DataFrame:
    return tables.explode_truth(format_match_lists(spark, sf)).select("s1", F.col("source").cast("int").alias("source"), "id")


@query(f"{_FUSED} SELECT 'S1-' || s1 AS source1_entity_id, string_agg('S' || source || '-' || id, ',' ORDER BY rank) AS candidate_entity_ids FROM cand WHERE rank <= {K_LIST} GROUP BY s1")
def format_candidate_lists(spark: SparkSession, sf: str) -> DataFrame:
    return tables.format_candidates(blocking.prune(_fused(spark, sf), K_LIST))


@query(
    """WITH l AS (SELECT 'S1-' || o_custkey AS s1, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'S' || (o_orderkey % 5) || '-' || o_orderkey || ',S2-' || o_custkey END AS listed FROM orders),
w AS (SELECT * FROM l WHERE listed IS NOT NULL), e AS (SELECT s1, unnest(string_split(listed, ',')) AS m FROM w), k AS (SELECT 'S2-' || c_custkey AS m FROM customer), r AS (SELECT 'S1-' || c_custkey AS s1 FROM customer)
SELECT DISTINCT rule, example FROM (
SELECT 'malformed_row' AS rule, s1 AS example FROM l WHERE listed IS NULL UNION ALL
SELECT 'duplicate_row', s1 FROM w GROUP BY s1 HAVING count(*) > 1 UNION ALL
SELECT 'repeated_id', s1 FROM w WHERE split_part(listed, ',', 1) = split_part(listed, ',', 2) UNION ALL
SELECT 'self_match', m FROM e WHERE starts_with(m, 'S1-') UNION ALL
SELECT 'wrong_prefix', m FROM e WHERE NOT starts_with(m, 'S1-') AND NOT starts_with(m, 'S2-') AND NOT starts_with(m, 'S3-') UNION ALL
SELECT 'unknown_id', m FROM e WHERE (starts_with(m, 'S2-') OR starts_with(m, 'S3-')) AND m NOT IN (SELECT m FROM k) UNION ALL
SELECT 'missing_s1', s1 FROM r WHERE s1 NOT IN (SELECT s1 FROM w) UNION ALL
SELECT 'extra_s1', s1 FROM w WHERE s1 NOT IN (SELECT s1 FROM r))"""
)
def validate_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Lists made from orders, most of them faulty in some way, against the customers."""
    orders, customer = roles.table(spark, sf, "orders"), roles.table(spark, sf, "customer")
    listed = F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("S"), (F.col("o_orderkey") % 5).cast("string"), F.lit("-"), F.col("o_orderkey").cast("string"), F.lit(",S2-"), F.col("o_custkey").cast("string")))
    lists = orders.select(F.concat(F.lit("S1-"), F.col("o_custkey").cast("string")).alias("source1_entity_id"), listed.alias("matched_entity_ids"))
    ids = lambda s: customer.select(F.concat(F.lit(f"S{s}-"), F.col("c_custkey").cast("string")).alias("entity_id"))
    return validate.violations(lists, ids(1), ids(2))


def _tier(score: str) -> str:
    return _ENTITY.replace("round(score, 6)))", f"round({score}, 6)))")


_REPORT = "SELECT country, avg({f05}) AS score FROM ent GROUP BY ROLLUP (country)"


@query(f"WITH base AS ({_tier('score')} {_REPORT.format(f05=_F05)}), cand AS ({_tier('sqrt(greatest(score, 0))')} {_REPORT.format(f05=_F05)}) SELECT round(b.score, 6) AS baseline, round(c.score, 6) AS candidate, c.score - b.score >= 0.001 AND NOT EXISTS (SELECT 1 FROM base x JOIN cand y ON x.country = y.country WHERE y.score < x.score - 0.002) AS passes FROM base b, cand c WHERE b.country IS NULL AND c.country IS NULL")
def tier_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gate between two tiers' reports: one decides by the 3-gram cosine, the other by its square root."""
    truth, ids = tables.stage(_truth(spark, sf), "truth"), _s1_ids(spark, sf)
    top = tables.stage(_channel(spark, sf, _ngram_keys(), NGRAM_CAP).where(F.col("rank") <= K), "pairs")
    pairs = top.select(*PAIR, "rank", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.round("score", 6))).alias("prob"))
    other = top.select(*PAIR, "rank", F.least(F.lit(1.0), F.round(F.sqrt(F.greatest("score", F.lit(0.0))), 6)).alias("prob"))
    reports = []
    for scored in (pairs, other):
        found = metrics.macro_f05(decide.decide(decide.one_owner(scored), 0.5), truth, ids, by="country").collect()  # a row for each country
        reports.append({"vcal_f05": next(r["score"] for r in found if r["country"] is None), "vcal_f05_by_country": {r["country"]: r["score"] for r in found if r["country"] is not None}})
    return spark.createDataFrame([(round(reports[0]["vcal_f05"], 6), round(reports[1]["vcal_f05"], 6), passes_gate(*reports))], "baseline double, candidate double, passes boolean")


# Sources, sinks and stages


@query(f"WITH {RECORDS_SQL} SELECT id, name_clean, country FROM numbered WHERE country = 'en'")
def stage_table(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised records written by country, then read with the country and the columns pushed to the scan."""
    path = tables.stage_dir(spark, "normalized")
    tables.save(roles.records(spark, sf), path, by="country")
    return tables.load(spark, path, ["id", "name_clean", "country"], "en")


@query("SELECT 2::INTEGER AS source, c_custkey AS id, c_nationkey::VARCHAR AS country, c_name AS name, c_mktsegment AS address FROM customer")
def source_file(spark: SparkSession, sf: str) -> DataFrame:
    """A tab-separated source written from the customers and loaded again."""
    path = tables.stage_dir(spark, "source")
    rows = roles.table(spark, sf, "customer").select(F.concat(F.lit("S2-"), F.col("c_custkey").cast("string")).alias("entity_id"), F.col("c_name").alias("business_name"), F.col("c_mktsegment").alias("business_address"), F.col("c_nationkey").cast("string").alias("country"))
    tables.write_tsv(rows, path)
    return tables.load_source(spark, path).withColumn("source", F.col("source").cast("int"))


@query("SELECT 'S2-' || c_custkey AS entity_id FROM customer UNION SELECT 'S3-' || s_suppkey FROM supplier")
def match_targets(spark: SparkSession, sf: str) -> DataFrame:
    """All ids of two source files: what may be matched."""
    paths = []
    for name, table, key in (("S2", "customer", "c_custkey"), ("S3", "supplier", "s_suppkey")):
        paths.append(tables.stage_dir(spark, name))
        ids = F.concat(F.lit(f"{name}-"), F.col(key).cast("string"))
        tables.write_tsv(roles.table(spark, sf, table).select(ids.alias("entity_id"), *[F.lit("x").alias(c) for c in tables.SOURCE_COLUMNS[1:]]), paths[-1])
    return tables.match_targets(spark, paths)[0]


@query(f"{_LISTS} SELECT 'S1-' || s1 AS s1, unnest(string_split(listed, ',')) AS id FROM lists WHERE listed <> ''")
def match_file_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """A matching file written, read as it stands, and its non-empty rows taken apart."""
    path = tables.stage_dir(spark, "matches")
    tables.write_tsv(format_match_lists(spark, sf), path)
    return validate.list_pairs(tables.read_lists(spark, path, tables.TRUTH_COLUMNS), *tables.TRUTH_COLUMNS)


_CONFIG = {"word_cap": index.WORD_CAP, "ngram_cap": index.NGRAM_CAP}


@query(f"SELECT 'candidates' AS stage, true AS done, false AS done_otherwise, '{config_hash(_CONFIG)}' AS config, count(*) AS n FROM nation")
def stage_marker(spark: SparkSession, sf: str) -> DataFrame:
    """A stage table with its marker, promoted to another place with it."""
    first, last = tables.stage_dir(spark, "tier"), tables.stage_dir(spark, "chosen")
    tables.save(roles.table(spark, sf, "nation"), f"{first}/rows")
    tables.mark_done(spark, first, _CONFIG)
    tables.promote(spark, first, last)
    report = tables.read_report(spark, f"{last}/DONE.json")
    row = ("candidates", tables.is_done(spark, last, _CONFIG), tables.is_done(spark, last, {**_CONFIG, "k": 1}), report["config"], tables.load(spark, f"{last}/rows").count())
    return spark.createDataFrame([row], "stage string, done boolean, done_otherwise boolean, config string, n long")


@query(f"WITH {RECORDS_SQL} SELECT source, count(*) AS records, count(DISTINCT id) AS ids FROM pool GROUP BY source")
def pool_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles.records(spark, sf)
    return tables.pool(rows.where("source = 2"), rows.where("source = 3")).groupBy("source").agg(F.count("*").alias("records"), F.countDistinct("id").alias("ids"))


@query(f"WITH {_SPLIT}, p AS (SELECT id, CASE WHEN rn <= a THEN 'T' WHEN rn <= a + b THEN 'Vcal' WHEN rn <= a + b + b THEN 'Vtest' ELSE '' END AS split FROM q) SELECT id, split FROM p WHERE split IN ('Vcal', 'Vtest')")
def validation_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tables.of_splits(stratified_split(spark, sf), "Vcal", "Vtest")


@query(f"WITH {RECORDS_SQL} SELECT source, id, name_clean FROM pool WHERE (source, id) IN (SELECT source, id FROM truth)")
def records_of_truth(spark: SparkSession, sf: str) -> DataFrame:
    s1, pool = roles.sides(spark, sf)
    return tables.of_records(pool, roles.truth(s1, pool), "source", "id").select("source", "id", "name_clean")


@query(f"WITH {RECORDS_SQL} SELECT s1, source, id, s1::BIGINT * 4294967296 + source::BIGINT * 1073741824 + id AS triple FROM truth")
def triple_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _truth(spark, sf).select("s1", "source", "id", triple_key(F.col("s1"), F.col("source"), F.col("id")).alias("triple"))


_TEXTS = f"WITH {RECORDS_SQL}, t AS (SELECT id, trim(CASE WHEN legal_form IS NULL THEN name_clean ELSE name_clean || ' ' || legal_form END) || ' | ' || address_clean AS text FROM numbered)"


@query(f"{_TEXTS} SELECT id, md5(text) AS text_md5, length(text) AS characters FROM t")
def pair_texts(spark: SparkSession, sf: str) -> DataFrame:
    text = T.pair_text(F.col("name_clean"), F.col("legal_form"), F.col("address_clean"))
    return roles.records(spark, sf).select("id", F.md5(text.cast("binary")).alias("text_md5"), F.length(text).cast("long").alias("characters"))


@query("SELECT o.n_name AS a, r.r_name AS b, 'Decide whether the two records describe the same business. Answer Yes or No.' || chr(10) || chr(10) || 'Record A: acme' || chr(10) || 'Record B: acme ltd' || chr(10) || 'Same business? Yes' || chr(10) || chr(10) || 'Record A: ' || n_name || chr(10) || 'Record B: ' || r_name || chr(10) || 'Same business? ' AS prompt FROM nation o JOIN region r ON o.n_regionkey = r.r_regionkey")
def judge_prompts(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles.table(spark, sf, "nation").join(roles.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(F.col("n_name").alias("a"), F.col("r_name").alias("b"), T.judge_prompt(F.col("n_name"), F.col("r_name"), [("acme", "acme ltd", True)]).alias("prompt"))


@query("SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda t: t <> ''), lambda t: CASE t WHEN 'red' THEN 'rd' WHEN 'blue' THEN 'bl' ELSE t END), ' ') AS name FROM part")
def abbreviated_names(spark: SparkSession, sf: str) -> DataFrame:
    mapping = F.create_map(*[F.lit(x) for x in ("red", "rd", "blue", "bl")])
    return roles.table(spark, sf, "part").select("p_partkey", F.array_join(T.apply_abbreviations(T.tokens(F.col("p_name")), mapping), " ").alias("name"))


@query(f"{_FUSED}, o AS (SELECT *, row_number() OVER (PARTITION BY country, source, id ORDER BY rrf DESC, s1) AS rn FROM fused) SELECT country, source, id, round(max(rrf), 6) AS best, round(coalesce(max(CASE WHEN rn = 2 THEN rrf END), 0), 6) AS second, count(*) AS rivals FROM o GROUP BY country, source, id")
def competition_of_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Competition of each third of the S1 records by itself, then merged."""
    fused = _fused_table(spark, sf)
    parts = [blocking.competition(fused.where(F.col("s1") % 3 == k)) for k in range(3)]
    return blocking.merge_competition(parts).select("country", "source", "id", _r("best"), _r("second"), "rivals")


@query(f"{_PROB} SELECT country, s1, source, id, prob, CASE WHEN rank <= 3 THEN round(1 / (1 + exp(-(4 * prob - 2))), 6) END AS new_prob FROM pairs")
def aligned_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The logits of a second stage that saw the first three candidates of each S1."""
    pairs = _pairs(spark, sf)
    seen = pairs.where("rank <= 3").select("s1", "source", "id", (4 * F.col("prob") - 2).alias("logit"))
    return models.align_scores(pairs, seen.withColumnRenamed("logit", "new_prob"), logits=True).select(*PAIR, "prob", _r("new_prob"))


@query(f"{_PROB} SELECT DISTINCT 'not_candidate' AS rule, s1 || ':' || id AS example FROM truth t WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.s1 = t.s1 AND p.id = t.id AND rank <= 2)")
def matches_without_candidate(spark: SparkSession, sf: str) -> DataFrame:
    return validate.not_candidates(_truth(spark, sf), _pairs(spark, sf).where("rank <= 2"))


@query(f"{_PROB} SELECT country, s1, source, id FROM pairs ORDER BY md5('7:' || s1 || ':' || source || ':' || id || ':'), s1, source, id LIMIT 100")
def sampled_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_sample(_pairs(spark, sf).select(*PAIR), 100, 7, "s1", "source", "id")


_ORDERED = "ORDER BY md5('42:' || s1 || ':' || source || ':' || id || ':'), s1, source, id"


@query(f"{_LABELLED}, pos AS (SELECT DISTINCT s1, source, id FROM truth {_ORDERED} LIMIT 20), neg AS (SELECT s1, source, id FROM lab WHERE label = 0 AND rank <= 10 {_ORDERED} LIMIT 20) SELECT s1, source, id, 1 AS label FROM pos UNION ALL SELECT s1, source, id, 0 FROM neg".replace("SELECT DISTINCT s1, source, id FROM truth ORDER", "SELECT s1, source, id FROM (SELECT DISTINCT s1, source, id FROM truth) ORDER"))
def training_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.training_pairs(_pairs(spark, sf), _truth(spark, sf), 40)


@query(f"WITH {_SPLIT}, w AS (SELECT *, round_even(60.0::DOUBLE * c / n, 0) AS want FROM s) SELECT id, country FROM w WHERE rn <= greatest(1, want)")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = roles.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("country"))
    return sampling.stratified_sample(rows, 60).select("id", "country")


# Models: no SQL form


def _training(spark, sf):
    """Candidate pairs with all 26 features, labels, the split of their S1 record by thirds of a hash, and the 3-gram channel's prob."""
    s1, pool = roles.sides(spark, sf)
    fused = _fused_table(spark, sf)
    rows = features.all_features(blocking.prune(fused, K), blocking.competition(fused), s1, pool)
    split = F.element_at(F.array(F.lit("T"), F.lit("Vcal"), F.lit("Vtest")), (F.pmod(F.xxhash64("s1"), F.lit(3)) + 1).cast("int"))
    return features.label_pairs(rows, roles.truth(s1, pool)).withColumns({"split": split, "prob": F.round("name_ngram_cosine", 6)})


@query()
def all_features(spark: SparkSession, sf: str) -> DataFrame:
    return _training(spark, sf).drop("split", "prob")


def _trees(rows: DataFrame):
    """Trees of the operator's own size, trained on T; rounds end when the loss on Vcal gets no better."""
    part = rows.where("split in ('T', 'Vcal')").withColumn("held", F.col("split") == "Vcal")
    return models.train_trees(part, models.feature_columns(rows), validation="held", rounds=TREE_ROUNDS)


#: Rounds at most; the operator's default is 200, and the loss on Vcal ends training earlier.
TREE_ROUNDS = 60


@query()
def gbdt_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.stage(_training(spark, sf), "training")
    return models.score_trees(_trees(rows), rows.drop("prob").where("split = 'Vtest'"))


@query()
def platt_calibration(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.stage(_training(spark, sf), "training")
    columns = ["prob", "addr_jaccard"]
    return models.apply_platt(models.fit_platt(rows.where("split = 'Vcal'"), columns), rows.where("split = 'Vtest'"), "calibrated").select(*PAIR, "calibrated")


@query()
def context_stacker(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.stage(_training(spark, sf).select(*PAIR, "fused_rank", "label", "split", "prob", F.when(F.col("fused_rank") <= 3, F.col("addr_jaccard")).alias("new_prob")), "training")
    return models.apply_stacker(models.fit_stacker(rows.where("split = 'Vcal'"), rounds=TREE_ROUNDS), rows.where("split = 'Vtest'")).select(*PAIR, "stacked")


@query()
def loco_ap(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.stage(_training(spark, sf).drop("prob", "split"), "training")
    found = models.leave_one_country_out(rows, models.feature_columns(rows), rounds=10)
    return spark.createDataFrame(list(found.items()), "country string, ap double")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
