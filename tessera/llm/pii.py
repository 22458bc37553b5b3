"""Personal data: base patterns, and information-theoretic sanitisation of the terms that give protected entities away.

Protected entities are the values that the base patterns find, an attribute of each (an address's domain, an IP's network, a
card's issuer, a phone's area) and their kinds. A term (a word of letters, lowered) discloses an entity by its pointwise
mutual information with it. The event space is the corpus's distinct texts: with N of them, n(t) that hold the term, n(e) that hold the
entity and n(t, e) that hold both, anywhere in the text, p(e) = n(e) / N and p(e | t) = (n(t, e) + p(e)) / (n(t) + 1), smoothed by one
text as average as the corpus; PMI = log2(p(e | t) / p(e)), and the entity's information is IC = -log2 p(e). Who knows the term
is left with IC - PMI bits of uncertainty about the entity. Terms that leave `generalise` bits or less are generalised, those that
leave `remove` bits or less removed. With one bit, a term that stands in the only text of an entity and nowhere else is just
enough, so entities seen once are protected too, however large the corpus. Of kinds, which are frequent, nearly all is
asked (`of_kind`): words that hardly ever come without one. A disclosing term is marked wherever it stands, in texts
without the entity too.

Three passes read the texts. The first only hashes them, for a filter of fixed size over texts that occur more than once. The
second yields, for each document, its base spans, entities and (with an entity) terms, and for each partition the number of
texts that hold each term, summed in a bounded table before anything is written; the words of texts that the filter lets
through are written apart, once a partition, and counted once a text. The estimates are equi-joins and sums over these. A pair
can disclose only if n(t) + 1 <= 2^generalise (n(e) + p(e)), so others are dropped before they are made. The
third pass looks up every word in a filter of fixed size over the disclosing terms, and a join on the term decides.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import free_name, materialize, small_batches

KINDS = ("email", "ip", "card", "phone")
#: Bits of uncertainty.
GENERALISE, REMOVE, OF_KIND = 1.0, 0.42, 0.15
TERM_TABLE = 400_000
#: Bits of the filters over repeated texts and disclosing terms: a fuller one lets more through to the joins, and none is missed.
FILTER_BITS = 1 << 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from every later digit, so only starts of runs are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{2,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost non-overlapping matches: a match's local part reaches back to the end of the match before, at most."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points, by kind and start. Matches that fail their check are dropped without retry."""
    out = [(0, s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        # Parts are compared as numbers; a part of very many digits is over 255 unless it is all but zeros.
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _name(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _free_terms(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the terms of the whole text that touch no base span."""
    merged: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e in spans):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    at = 0
    for m in _TERM.finditer(text):
        a, b = m.span()
        while at < len(merged) and merged[at][1] <= a:
            at += 1
        if at == len(merged) or b <= merged[at][0]:
            yield a, b


def _entities(text: str, spans: list[tuple[int, int, int]]) -> set[int]:
    """Names of the protected entities: values, attributes and kinds (whose names are even; all others are odd)."""
    out = set()
    for kind, s, e in spans:
        value = text[s:e].lower() if kind < 2 else _digits(text[s:e])
        attribute = (value.rpartition("@")[2], value.rpartition(".")[0], value[:6], value[:5])[kind]
        out |= {_name(f"{KINDS[kind]}:{value}") | 1, _name(f"of {KINDS[kind]}:{attribute}") | 1, _name(KINDS[kind]) & ~1}
    return out


def _words(text: str) -> set[str]:
    """The distinct terms of a text, lowered one by one."""
    low = text.lower()
    # A text can be lowered as a whole if that changes no word's letters otherwise: it keeps its length, and has no final sigma.
    return set(_TERM.findall(low)) if len(low) == len(text) and "\u03a3" not in text else {w.lower() for w in set(_TERM.findall(text))}


def _has(bits: bytes, name: int) -> bool:
    bit = name % FILTER_BITS
    return bool(bits[bit >> 3] >> (bit & 7) & 1)


def _marks(repeated):
    names = ["id", "text_key", "base", "n_email", "n_ip", "n_card", "n_phone", "entities", "words", "term", "n"]
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = repeated.value
        held: Counter[str] = Counter()
        hashed: dict[str, int] = {}
        written: set[int] = set()
        id_type = None

        def flush() -> pa.RecordBatch:
            n = len(held)
            empty = [pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), *[pa.nulls(n, pa.int64())] * 4, *[pa.nulls(n, longs)] * 2]
            out = pa.RecordBatch.from_arrays([*empty, pa.array([_name(t) for t in held], pa.int64()), pa.array(list(held.values()), pa.int64())], names=names)
            held.clear()
            return out

        def name_all(words: set[str]) -> list[int]:
            if len(hashed) > TERM_TABLE:
                hashed.clear()
            for w in words.difference(hashed):
                hashed[w] = _name(w)
            return [hashed[w] for w in words]

        for batch in batches:
            id_type = batch.column(0).type
            rows = []
            for value, key in zip(batch.column(1), batch.column(2).to_pylist()):
                text = value.as_py() or ""
                spans = base_spans(text)
                counts = [0] * 4
                for kind, _, _ in spans:
                    counts[kind] += 1
                entities: set[int] | None = None
                terms = None
                often = _has(bits, key)
                if not (often and key in written):
                    # The words of a text with entities, and of one that may be repeated, go with its row, once a partition.
                    words = _words(text)
                    if spans:
                        entities = _entities(text, spans)
                    if spans or often:
                        terms = name_all(words)
                    if often:
                        if len(written) > TERM_TABLE:
                            written.clear()
                        written.add(key)
                    else:
                        held.update(words)
                rows.append((key, ",".join([f"{KINDS[k]}:{s}:{e}" for k, s, e in spans]), *counts, entities and list(entities), terms, 0 if often else None))
                if len(held) > TERM_TABLE:
                    yield flush()
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(c[0], pa.int64()), pa.array(c[1], pa.string()), *[pa.array(x, pa.int64()) for x in c[2:6]], *[pa.array(x, longs) for x in c[6:8]], pa.nulls(len(rows), pa.int64()), pa.array(c[8], pa.int64())], names=names)
        if held:
            yield flush()

    return run


def _occurrences(passing):
    """Every place of every word that the filter lets through, outside base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = passing.value
        known: set[str] = set()
        found: dict[str, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            for i, (value, key) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
                text = value.as_py() or ""
                if len(known) > TERM_TABLE:
                    known.clear()
                    found.clear()
                words = set(_TERM.findall(text))
                for w in words.difference(known):
                    if _has(bits, name := _name(w.lower())):
                        found[w] = name
                known |= words
                if not words.isdisjoint(found):
                    rows += [(i, key, name, a, b) for a, b in _free_terms(text, base_spans(text)) if (name := found.get(text[a:b])) is not None]
            c = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(c[0], pa.int64())), *[pa.array(x, t) for x, t in zip(c[1:], kinds)]], names=["id", "text_key", "term", "start", "end"])

    return run


def _filter(names: DataFrame) -> bytes:
    """FILTER_BITS bits with the places of all names in the one column set, built of bitmaps of 4 KB."""
    bit = F.pmod(F.col(names.columns[0]), F.lit(FILTER_BITS))
    out = bytearray(FILTER_BITS // 8)
    for part, bitmap in names.select(F.floor(bit / 32768).alias("part"), (bit % 32768).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit")).collect():
        out[part * 4096 : (part + 1) * 4096] = bitmap
    return bytes(out)


def disclosing_terms(marks: DataFrame, total: float, generalise: float = GENERALISE, remove: float = REMOVE, of_kind: float = OF_KIND) -> DataFrame:
    """term, removed. marks: what the second pass yields; total: distinct texts."""
    once = marks.where("words is not null").select("text_key", "entities", "words", F.col("n").isNotNull().alias("often")).dropDuplicates(["text_key"])
    counted = marks.where("term is not null").select("term", "n").unionByName(once.where("often").select(F.explode("words").alias("term"), F.lit(1).cast("long").alias("n")))
    terms = counted.groupBy("term").agg(F.sum("n").alias("n_term"))
    held = once.where("entities is not null").select("text_key", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.count("*").alias("n_entity"), (F.count("*") / total).alias("p"))
    allowed = F.when(F.col("entity") % 2 == 0, of_kind).otherwise(generalise)
    # The largest n(t) with which a term can disclose the entity, and some more for rounding.
    most = 1.000001 * (F.col("n_entity") + F.col("p")) * F.pow(F.lit(2.0), allowed) - 1
    held = materialize(held.join(entities, "entity").withColumns({"most": most, "allowed": allowed}), "held")
    tops = held.groupBy("text_key").agg(F.max("most").alias("top"))
    words = once.where("entities is not null").join(tops, "text_key").select("text_key", "top", F.explode("words").alias("term")).join(terms, "term").where(F.col("n_term") <= F.col("top"))
    pairs = words.join(held, "text_key").where(F.col("n_term") <= F.col("most"))
    pairs = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.max("n_term").alias("n_term"), F.max("p").alias("p"), F.max("allowed").alias("allowed"))
    left = -F.log2((F.col("n_both") + F.col("p")) / (F.col("n_term") + 1))  # IC - PMI
    found = pairs.withColumn("bits", left).where("bits <= allowed")
    return found.groupBy("term").agg(F.max(F.col("bits") <= F.least("allowed", F.lit(remove))).alias("removed"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE, remove: float = REMOVE, of_kind: float = OF_KIND) -> DataFrame:
    """One row per row of docs: id, n_email, n_ip, n_card, n_phone, base (spans as kind:start:end), terms (all places of
    disclosing terms: start, end, removed), and the key of the text.

    Null text counts as empty; empty text has no spans. Equal texts count once in the estimates. Ids may repeat or be null: terms
    belong to the text, so rows with equal texts get equal spans. Only the two named columns are read, so others may have any names; an
    empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    spark = docs.sparkSession
    small_batches(spark)
    schema = f"id {kind}, text_key long, base string, n_email long, n_ip long, n_card long, n_phone long, entities array<long>, words array<long>, term long, n long"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key"))
    keys = materialize(texts.groupBy("text_key").agg(F.count("*").alias("n")), "keys")
    total = float(max(keys.count(), 1))
    repeated = spark.sparkContext.broadcast(_filter(keys.where("n > 1").select("text_key")))
    marks = materialize(texts.mapInArrow(_marks(repeated), schema), "marks")
    disclosing = materialize(disclosing_terms(marks, total, generalise, remove, of_kind), "disclosing")
    passing = spark.sparkContext.broadcast(_filter(disclosing.select("term")))
    places = texts.mapInArrow(_occurrences(passing), f"id {kind}, text_key long, term long, start int, end int")
    found = places.join(disclosing, "term").groupBy("id", "text_key", "start", "end").agg(F.max("removed").alias("removed"))
    found = found.groupBy(F.col("id").alias("f_id"), F.col("text_key").alias("f_key")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("terms"))
    out = marks.where("base is not null").join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("text_key") == F.col("f_key")), "left")
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    return out.select(F.col("id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", "base", F.coalesce("terms", none).alias("terms"), "text_key")


def span_list(base: str = "base", terms: str = "terms"):
    """All spans as kind:start:end, comma-joined: base spans first, then terms by start."""
    listed = F.array_join(F.transform(terms, lambda t: F.concat(F.lit("term:"), t["start"].cast("string"), F.lit(":"), t["end"].cast("string"))), ",")
    return F.concat_ws(",", F.nullif(F.col(base), F.lit("")), F.nullif(listed, F.lit("")))


def sanitise(text: str | None, base: str | None, terms: list | None) -> str | None:
    """text with base spans replaced by their kind, disclosing terms by [term], and removed ones left out."""
    if text is None or base is None or terms is None:
        return text
    cuts = [(int(s), int(e), f"[{k}]") for k, s, e in (x.split(":") for x in base.split(",") if x)] + [(t["start"], t["end"], "" if t["removed"] else "[term]") for t in terms]
    out, at = [], 0
    for s, e, put in sorted(cuts):
        if s >= at:
            out += [text[at:s], put]
            at = e
        elif e > at:
            at = e
    return "".join([*out, text[at:]])


def sanitised_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """docs with their texts sanitised, all other columns unchanged, whatever their names. Null texts stay null; rows with equal id and
    text are sanitised alike; null ids are one id."""
    found = find_personal_data(docs, id_col, text_col, **parameters).where("base <> '' or size(terms) > 0")
    own, key, base, terms = (free_name(x, docs) for x in ("own_id", "text_key", "base", "terms"))
    found = found.groupBy(F.col(id_col).alias(own), F.col("text_key").alias(key)).agg(F.max("base").alias(base), F.max("terms").alias(terms))

    @F.pandas_udf(StringType())
    def clean(texts: pd.Series, bases: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([sanitise(*x) for x in zip(texts, bases, terms)], dtype=object)

    joined = docs.join(found, docs[id_col].eqNullSafe(F.col(own)) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col(key)), "left")
    return joined.withColumn(text_col, clean(F.col(text_col), F.col(base), F.col(terms))).drop(own, key, base, terms)
