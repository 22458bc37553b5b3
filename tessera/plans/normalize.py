"""Normalised records from source records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T


def normalize_records(records: DataFrame, forms: DataFrame | None = None, abbreviations: DataFrame | None = None, dictionary: dict[str, str] | None = None) -> DataFrame:
    """records (source, id, country, name, address and others) with name_clean, legal_form, name_transliterated, name_nospace,
    name_skeleton, address_clean, postcode, addr_numbers, addr_transliterated in place of name and address.

    forms: country, forms (legal forms; the fixed ones if None). abbreviations: country, token, expansion.
    Scripts are romanised before accents go, because vowel signs are combining marks.
    """
    latinize = T.transliterate(dictionary)
    rows = records.withColumns({"_n": latinize(F.coalesce("name", F.lit(""))), "_a": latinize(F.coalesce("address", F.lit("")))})
    rows = rows.withColumns({"_name": T.tokens(T.clean_noise(T.fold(F.col("_n.text")))), "_address": T.clean_noise(T.fold(F.col("_a.text")))})
    if abbreviations is not None:
        maps = abbreviations.groupBy("country").agg(F.map_from_entries(F.collect_list(F.struct("token", "expansion"))).alias("_map"))
        rows = rows.join(maps, "country", "left")
        known = F.col("_map").isNotNull()
        rows = rows.withColumns({"_name": F.when(known, T.apply_abbreviations(F.col("_name"), F.col("_map"))).otherwise(F.col("_name")), "_address": F.when(known, F.array_join(T.apply_abbreviations(T.tokens(F.col("_address")), F.col("_map")), " ")).otherwise(F.col("_address"))})
    seeds = F.array(*[F.lit(f) for f in T.LEGAL_FORMS])
    if forms is not None:
        rows = rows.join(forms.select("country", F.col("forms").alias("_forms")), "country", "left")
        seeds = F.coalesce("_forms", seeds)
    rows = rows.withColumn("_split", T.split_legal_form(F.col("_name"), seeds))
    name, nospace = F.array_join("_split.rest", " "), F.array_join("_split.rest", "")
    out = rows.withColumns(
        {
            "name_clean": name,
            "legal_form": F.col("_split.form"),
            "name_transliterated": F.col("_n.changed"),
            "name_nospace": nospace,
            "name_skeleton": T.consonant_skeleton(nospace),
            "address_clean": F.col("_address"),
            "postcode": T.postcode(F.col("_address")),
            "addr_numbers": T.house_numbers(F.col("_address")),
            "addr_transliterated": F.col("_a.changed"),
        }
    )
    return out.drop("name", "address", "_n", "_a", "_name", "_address", "_split", *(["_map"] if abbreviations is not None else []), *(["_forms"] if forms is not None else []))
