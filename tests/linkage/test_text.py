import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import fuzzy, ids, similarity
from tessera.functions import text as T
from tessera.plans.normalize import normalize_records

DEVANAGARI = "मोहन ट्रेडर्स"


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("raw", "clean"),
    [("-- acme", "acme"), ("*** acme", "acme"), (">> acme", "acme"), ("[..] acme", "acme"), ("harbourworks.com", "harbourworks"), ("fromagerie.fr", "fromagerie"), ("a, b; c.(d) [e]/f", "a b cd ef"), ("- acme", "- acme"), ("x.company", "xcompany"), ("  ", "")],
)
def test_clean_noise(spark, raw, clean):
    assert one(spark, T.clean_noise(F.col("s")), s=raw) == clean


def test_fold(spark):
    assert one(spark, T.fold(F.col("s")), s="Thé Mélange ﬁ STRASSE ß") == "the melange fi strasse ss"
    assert one(spark, T.nfkc_casefold(F.col("s")), s="MÉLANGE ①") == "mélange 1"
    assert one(spark, T.strip_accents(F.col("s")), s="é ñ") == "e n"


def test_scripts():
    assert T.is_latin("café-12") and not T.is_latin("मोहन") and not T.is_latin("Ａ") and not T.is_latin("º") and T.is_latin("́")
    assert T.romanize("मोहन") == "mohan" and T.romanize("मोहन ट्रेडर्स".split()[1]).isascii() and T.romanize("१२") == "12"
    known = {"Москва": "moskva", "Чайковский": "chaykovskiy", "Київ": "kiyiv", "αθήνα": "athina", "Ωμέγα": "omega", "서울": "seoul", "부산": "busan", "かな": "kana", "カメラ": "kamera", "שלום": "shlvm", "كتاب": "ktab"}
    assert {w: T.romanize(w) for w in known} == known
    # Letters without a sound here are named, so no word is lost and different ones stay different.
    odd = ["東京", "京都", "株式会社", "ꓐꓑ", "𐎀𐎁"]
    assert len({T.romanize(w) for w in odd}) == len(odd) and all(T.romanize(w) and T.romanize(w).isascii() for w in odd)


def test_transliterate(spark):
    words = {"मोहन": "mohan", "ट्रेडर्स": "traders"}
    got = one(spark, T.transliterate(words)(F.col("s")), s=DEVANAGARI)
    assert (got.text, got.changed) == ("mohan traders", True)
    plain = one(spark, T.transliterate(words)(F.col("s")), s="plain  name")
    assert (plain.text, plain.changed) == ("plain name", False)


def test_normalize_records(spark):
    rows = [(1, 1, "x", "-- Borealis Private Limited", "17 Quay Street, Cork, 560034"), (1, 2, "x", DEVANAGARI, ""), (1, 3, "y", "Intl Bank", "8841 Cedar Loop, 5a Pier"), (1, 4, None, None, None)]
    records = spark.createDataFrame(rows, "source int, id long, country string, name string, address string")
    forms = spark.createDataFrame([("x", ["private limited", "limited"])], "country string, forms array<string>")
    short = spark.createDataFrame([("y", "intl", "international")], "country string, token string, expansion string")
    out = {r.id: r for r in normalize_records(records, forms, short, {"मोहन": "mohan", "ट्रेडर्स": "traders"}).collect()}
    assert (out[1].name_clean, out[1].legal_form, out[1].postcode) == ("borealis", "private limited", "560034") and "17" in out[1].addr_numbers
    assert (out[2].name_clean, out[2].name_skeleton, out[2].name_transliterated) == ("mohan traders", "mhntrdrs", True)
    assert out[3].name_clean == "international bank" and out[3].postcode is None and out[3].addr_numbers == ["8841", "5a"]
    assert out[4].name_clean == "" and out[4].address_clean == ""


def test_keys(spark):
    grams = lambda s: one(spark, T.char_ngrams(F.col("s")), s=s)
    assert grams("abcde") == ["abc", "bcd", "cde"] and grams("ab") == ["ab"] and grams("") == []
    keys = one(spark, T.number_street_keys(F.col("a"), F.array(F.lit("221"), F.lit("9"))), a="221 main st 9")
    assert keys == ["221_main"]


def test_ids(spark):
    df = ids.encode_ids(spark.createDataFrame([("S2-47",)], ["e"]), "e")
    assert df.select("source", "id_num", ids.decode_id(F.col("source"), F.col("id_num"))).first()[:3] == (2, 47, "S2-47")
    listed = ids.encode_id_list(F.col("l"))
    assert one(spark, ids.join_ids(listed), l="S3-5,S2-10,S2-9,") == "S2-9,S2-10,S3-5" and one(spark, ids.join_ids(listed), l="") == ""
    assert one(spark, ids.triple_key(F.col("a"), F.lit(3), F.lit(7)), a=5) == (5 << 32) | (3 << 30) | 7
    assert ids.config_hash({"a": 1, "b": 2}) == ids.config_hash({"b": 2, "a": 1}) != ids.config_hash({"a": 2, "b": 2})


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = (before + 1 if x == y else max(row[j], row[j + 1])), row[j + 1]
    return row[-1]


def test_fuzzy_against_loops():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert fuzzy.lcs_length(a, b) == lcs(a, b)
        assert 0 <= fuzzy.token_set_ratio(a, b) <= 1 and fuzzy.token_set_ratio(a, b) == pytest.approx(fuzzy.token_set_ratio(b, a))
    assert fuzzy.indel_ratio("", "") == 1 and fuzzy.token_set_ratio("", "") == 0 and fuzzy.token_set_ratio("a b", "b a c") == 1
    assert fuzzy.token_sort_ratio("b a", "a b") == 1 and fuzzy.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert fuzzy.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4) and fuzzy.jaro_winkler("", "a") == 0


def test_similarities(spark):
    row = dict(a=["a", "b"], b=["b", "c"], e=[""], s="national bank", t="natl bank")
    empty = F.array().cast("array<string>")
    assert one(spark, similarity.token_jaccard(F.col("a"), F.col("b")), **row) == pytest.approx(1 / 3)
    assert one(spark, similarity.token_jaccard(empty, empty), **row) == 1
    assert one(spark, similarity.ngram_cosine(F.lit("abcd"), F.lit("bcde")), **row) == pytest.approx(0.5)
    assert one(spark, similarity.ngram_cosine(F.lit(""), F.lit("")), **row) == 0
    assert one(spark, similarity.abbreviation_share(F.split(F.lit("int bank"), " "), F.split(F.lit("international bank group"), " ")), **row) == 1
    assert one(spark, similarity.acronym_match(F.split(F.lit("big blue"), " "), empty, F.lit("bigblue"), F.lit("bb")), **row) == 1
    codes = [one(spark, similarity.legal_form_code(F.lit(x), F.lit(y)), **row) for x, y in (("inc", "inc"), ("inc", "llc"), (None, "llc"))]
    assert codes == [2, 1, 0]
    assert one(spark, T.pair_text(F.lit("acme"), F.lit("inc"), F.lit("main")), **row) == "acme inc | main"
    assert one(spark, T.judge_prompt(F.lit("x"), F.lit("y"), [("a", "b", True)]), **row).count("Record A") == 2
