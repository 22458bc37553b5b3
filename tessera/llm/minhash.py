"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

Sketch (after Dahlgaard, Knudsen and Thorup): t coordinates are filled in rounds. In each of the first t rounds every shingle
is hashed to one coordinate with a value that lies in [round, round + 1); in round t + i every shingle goes to coordinate i,
so each coordinate is filled by then. A coordinate keeps its smallest value, and the rounds stop as soon as all
coordinates are filled: after one or two rounds for a long text. As with classical MinHash, each coordinate of two sketches is
equal with a probability of the sets' Jaccard similarity, and the number of equal ones is concentrated.

Banding: b bands of r coordinates. Texts with equal shingle sets are one class and only the class's smallest id goes on. In
each band all classes with equal values meet; the classes in such a group are linked to one of them, verified on full sets.
Two centres are tried. If a small group then still spans several components, its pairs across them are verified; the distance
to the centre, which is known, rules some out by the triangle inequality of the Jaccard distance. The members of larger such
groups are joined exactly by prefix filtering: shingles are ordered from rare to frequent, and two sets that are similar
enough share one of their first few. What keeps a text apart from its group is rare, so its first shingles are its own, and
hardly any pairs are made. So no group has all its pairs made, and no link between texts that met is lost.
With r = 6, b = 40, two sets of similarity 0.8 meet in no band with a chance of 5e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, small_batches, without
from .components import connected_components

ROWS, BANDS = 6, 40
PERCENT = 80
SHINGLE = 2
#: Groups of a band with up to this many texts left in several components are taken pair by pair.
SMALL_GROUP = 16

_U = np.uint64
_UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)
_HASHES: dict[bytes, int] = {}
_HASH_TABLE = 200_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hash(word: bytes) -> int:
    if len(_HASHES) >= _HASH_TABLE:
        _HASHES.clear()
    _HASHES[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return h


def shingle_set(text: str, k: int = SHINGLE) -> np.ndarray:
    """64-bit names of the distinct k-word shingles, sorted; A-Z are lowered; fewer than k words are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z only and splits at the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    get = _HASHES.get
    h = np.array([get(w) or _word_hash(w) for w in words], np.uint64)
    size = min(k, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[i : len(words) - size + 1 + i])
    return np.unique(out)


def sketch(names: np.ndarray, t: int) -> np.ndarray:
    """t coordinates; each holds the round it was filled in (upper bits) and the hash value (lower 48 bits)."""
    out, step = np.full(t, _UNFILLED, np.uint64), 0
    while step < t:
        # Several rounds at a time for small sets: rounds after the last that is needed change nothing.
        last = min(t, step + max(1, 4 * t // len(names)))
        rounds = np.arange(step, last, dtype=np.uint64)[:, None]
        h = _mix(names[None, :] + (rounds + _U(1)) * _U(0x632BE59BD9B4E019))
        np.minimum.at(out, (((h & _U(0xFFFF)) * _U(t)) >> _U(16)).ravel(), ((h >> _U(16)) | (rounds << _U(48))).ravel())
        if not (out == _UNFILLED).any():
            return out
        step = last
    for i in np.flatnonzero(out == _UNFILLED):
        out[i] = (_mix(names + _U((0x632BE59BD9B4E019 * (t + int(i) + 1)) & 0xFFFFFFFFFFFFFFFF)) >> _U(16)).min() | _U((t + int(i)) << 48)
    return out


def band_keys(coordinates: np.ndarray, rows: int, bands: int) -> np.ndarray:
    grid = coordinates.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + grid[:, i])
    return key.view(np.int64)


def _sketches(rows: int, bands: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, keys = [], [], []
            for value in batch.column(1):
                names = shingle_set(value.as_py() or "", shingle)
                n.append(len(names))
                digest.append(hashlib.blake2b(names.tobytes(), digest_size=16).digest())
                keys.append(band_keys(sketch(names, rows * bands), rows, bands) if len(names) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "keys"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(v.as_py() or "", shingle).tobytes() for v in batch.column(1)], pa.binary())], names=["id", "names"])

    return run


def _names(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(v.as_py() or "", shingle).view(np.int64) for v in batch.column(1)], pa.list_(pa.int64()))], names=["id", "names"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of two sorted sets of names: how many are in both."""
    for batch in batches:
        out = []
        for x, y in zip(batch.column("names_a"), batch.column("names_b")):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            a, b = (a, b) if len(a) <= len(b) else (b, a)
            out.append(int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("n_a"), batch.column("n_b"), pa.array(out, pa.int64())], names=["a", "b", "n_a", "n_b", "both"])


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs with one of these ids. Always by shuffle: the number of ids grows with the documents."""
    return docs.join(ids.hint("merge"), "id", "left_semi")


def _by_prefix(members: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """members: rep, n, component. Pairs a, b, n_a, n_b of different components that can have the similarity, by prefix filtering."""
    kind = docs.schema["id"].dataType.simpleString()
    sets = _texts(docs, members.select(F.col("rep").alias("id"))).mapInArrow(_names(shingle), f"id {kind}, names array<long>")
    shingles = materialize(sets.select("id", F.explode("names").alias("name")).distinct(), "shingles")
    frequency = shingles.groupBy("name").agg(F.count("*").alias("texts"))
    own = shingles.join(frequency, "name").join(members, F.col("id") == F.col("rep"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("texts", "name"))
    # Any partner shares at least percent of a set, so the rest and one more of its first shingles hold a common one.
    first = materialize(own.select("rep", "n", "component", "name", "texts").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).where("texts > 1"), "prefixes")
    x, y = first.alias("x"), first.alias("y")
    need = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    similar = (F.col("x.name") == F.col("y.name")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.place") <= F.col("x.n") - need + 1) & (F.col("y.place") <= F.col("y.n") - need + 1)
    return x.join(y, similar).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """pairs: a, b, n_a, n_b. Adds both (shared shingles), from the full sets of the whole texts."""
    kind = docs.schema["id"].dataType.simpleString()
    taking_part = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = materialize(_texts(docs, taking_part).mapInArrow(_sets(shingle), f"id {kind}, names binary"), "sets")
    left, right = sets.select(F.col("id").alias("a"), F.col("names").alias("names_a")), sets.select(F.col("id").alias("b"), F.col("names").alias("names_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "names_a", "names_b").mapInArrow(_shared, f"a {kind}, b {kind}, n_a long, n_b long, both long")
    out = materialize(both, "verified")
    discard(sets)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, shingle: int = SHINGLE, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per id: id, n_shingles, component_id (smallest id reachable over links), kept (is that id).

    Two texts are linked if 100 * shared shingles >= percent * all shingles of both. Null, empty and blank texts have no
    shingles and are linked with nothing. Repeated rows of an id count once; an id on different texts stands for the text
    with the largest digest of its set. Rows without id have no part in links and come back with component_id null, kept true.
    Only the two named columns are read.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketched = materialize(rows_in.mapInArrow(_sketches(rows, bands, shingle), f"id {kind}, n long, digest binary, keys array<long>"), "sketches")
    named = sketched.where("id is not null and n > 0")
    classes = materialize(named.groupBy("digest").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.first("keys").alias("keys")), "classes")
    class_rows = classes.select("rep", "n", F.explode("keys").alias("key"))
    # Groups of a band with one class are done; partial counts go over the network, not the members.
    groups = class_rows.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("centre")).where("size > 1")
    members = materialize(class_rows.join(groups, "key").select("key", "rep", "n", "size", "centre"), "members")

    def pairs_to(centres: DataFrame) -> DataFrame:
        """centres: key, c, n_c. Pairs of each group's members with its centre, of sizes that can be similar enough."""
        joined = members.join(centres, "key").where("rep <> c").where(f"100 * least(n, n_c) >= {percent} * greatest(n, n_c)")
        return joined.select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b"), F.when(F.col("rep") < F.col("c"), F.col("n")).otherwise(F.col("n_c")).alias("n_a"), F.when(F.col("rep") < F.col("c"), F.col("n_c")).otherwise(F.col("n")).alias("n_b")).distinct()

    # First centre: the group's smallest id. Second: the member that meets most others over all bands, a likely origin of the rest.
    first = members.where("rep = centre").select("key", F.col("centre").alias("c"), F.col("n").alias("n_c"))
    met = members.groupBy("rep").agg(F.sum("size").alias("meets"))
    second = members.join(met, "rep").groupBy("key").agg(F.max(F.struct("meets", "rep", "n")).alias("m")).select("key", F.col("m.rep").alias("c"), F.col("m.n").alias("n_c"))
    checked = _verified(materialize(pairs_to(first).union(pairs_to(second)).distinct(), "pairs"), rows_in, shingle)
    linked = checked.where(f"100 * both >= {percent} * (n_a + n_b - both)")
    components = connected_components(linked.select("a", "b"))

    # What is left: groups that span several components. Pairs across them, unless the centre rules them out.
    placed = members.join(components, members.rep == components.node, "left").select("key", "rep", "n", "centre", F.coalesce("component", "rep").alias("component"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("left")).where("low <> high").select("key", "left")
    open_rows = materialize(placed.join(open_keys, "key"), "open")
    small = open_rows.where(F.col("left") <= SMALL_GROUP)
    known = checked.select("a", "b", (1 - F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))).alias("away"))
    small = small.join(known, (F.least("rep", "centre") == F.col("a")) & (F.greatest("rep", "centre") == F.col("b")), "left").select("key", "rep", "n", "component", F.when(F.col("rep") == F.col("centre"), 0.0).otherwise(F.col("away")).alias("away"))
    x, y = small.alias("x"), small.alias("y")
    across = (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.component") != F.col("y.component")) & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")) & F.coalesce(F.abs(F.col("x.away") - F.col("y.away")) <= 1 - percent / 100 + 1e-9, F.lit(True))
    rest = x.join(y, across).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"))
    large = materialize(open_rows.where(F.col("left") > SMALL_GROUP).select("rep", "n", "component").distinct(), "large")
    if not large.isEmpty():
        rest = rest.union(_by_prefix(large, rows_in, percent, shingle))
    rest = rest.distinct()
    rest = materialize(rest.join(checked.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = _verified(rest, rows_in, shingle).where(f"100 * both >= {percent} * (n_a + n_b - both)")
        if not more.isEmpty():
            components = connected_components(linked.select("a", "b").union(more.select("a", "b")))

    reps = classes.select("digest", "rep")
    ids = named.groupBy("id").agg(F.max("digest").alias("digest"), F.max_by("n", "digest").alias("n"))
    ids = ids.union(sketched.where("id is not null and n = 0").join(named, "id", "left_anti").select("id", "digest", "n").distinct())
    out = ids.join(reps, "digest", "left").join(components, F.col("rep") == F.col("node"), "left")
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "id").alias("component_id"))
    nameless = sketched.where("id is null").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return out.union(nameless).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """docs with one document of each component (the smallest id), all columns unchanged, whatever their names; rows without id,
    and all rows of an id that stays, stay."""
    return without(docs, id_col, near_duplicates(docs, id_col, **parameters).where("not kept").select(id_col))
