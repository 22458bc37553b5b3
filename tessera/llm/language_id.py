"""Language identification by a string kernel: blended-spectrum presence, Nystroem landmarks, kernel ridge regression.

The kernel of two texts is the cosine of their n-gram presence vectors for n = 1 to 4 (blended spectrum; letters lowered, all
else one blank). N-grams are hashed into 2^22 coordinates, and texts are sparse in them: a million characters of a script with
thousands of letters fill half of them. A bounded sample of labelled documents gives training rows, as many as fit a budget of
n-grams, and some of them are landmarks; the kernel to the landmarks, whitened by the landmarks' own kernel matrix, are the
features of one ridge regression per language against the rest. All of that is linear in the presence vector, so
landmarks and coefficients are multiplied out once, into a matrix with a row for each n-gram of a landmark. A batch of documents is scored by
one product of its sparse presence matrix with it; n-grams of no landmark only count for a document's norm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches

ORDERS = 4
SIZE = 1 << 22
#: Bounds of the training sample on the driver: documents of each language, of all, landmarks among them, and distinct n-grams in all.
PER_LANGUAGE, SAMPLE, LANDMARKS, GRAMS = 300, 3000, 300, 6_000_000
#: The largest languages, whose rows are thinned before they are ranked.
THINNED = 500
RIDGE = 1e-2
BATCH = 64
UNKNOWN = "und"

_letters: list[np.ndarray] = []
_places: list[np.ndarray] = []


def _table() -> np.ndarray:
    """For each code point: the lowered letter, or 0."""
    if not _letters:
        _letters.append(np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint32))
    return _letters[0]


def presence(text: str) -> np.ndarray:
    """The distinct coordinates of the n-grams of the whole text; none if the text has no letter."""
    codes = _table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return np.zeros(0, np.int32)
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]  # runs of other characters are one blank
    h, found = np.zeros(len(codes), np.uint64), []
    for n in range(1, ORDERS + 1):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        x = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append((x >> np.uint64(42)).astype(np.int32))
    at = np.concatenate(found)
    if len(at) < 20_000:
        return np.unique(at)
    # Long texts without sorting: each coordinate keeps one of its places, and that one stands for it. What earlier texts left is written over.
    if not _places:
        _places.append(np.zeros(SIZE, np.int32))
    own = np.arange(len(at), dtype=np.int32)
    _places[0][at] = own
    return at[_places[0][at] == own]


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of values of all rows, one after another: the sums of each row."""
    out = np.zeros((len(lengths), *values.shape[1:]), values.dtype)
    some = lengths > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[some], axis=0)
    return out


def fit(rows: list[np.ndarray], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """rows: presence() of texts with a letter, dealt by language in turn. The learned languages, in order, the n-grams of the
    landmarks, sorted, and the matrix (these x languages) that takes normed presence vectors to scores."""
    names = sorted(set(languages))
    if not names:
        return [], np.zeros(0, np.int32), np.zeros((0, 0), np.float32)
    norms = np.sqrt([len(r) for r in rows])
    chosen = np.linspace(0, len(rows) - 1, min(landmarks, len(rows))).astype(int)
    grams = np.unique(np.concatenate([rows[i] for i in chosen]))
    lookup = np.full(SIZE, -1, np.int32)
    lookup[grams] = np.arange(len(grams))
    # Of each n-gram the landmarks that hold it, as bits.
    bits = np.zeros((len(grams), (len(chosen) + 7) // 8), np.uint8)
    for k, i in enumerate(chosen):
        bits[lookup[rows[i]], k >> 3] |= np.uint8(1 << (k & 7))
    kernel = np.zeros((len(rows), len(chosen)))
    for i, row in enumerate(rows):
        at = lookup[row]
        held = np.unpackbits(bits[at[at >= 0]], axis=1, count=len(chosen), bitorder="little")
        kernel[i] = held.sum(0, dtype=np.int32) / (norms[i] * norms[chosen])
    values, vectors = np.linalg.eigh(kernel[chosen])
    sound = values > 1e-6 * values.max()
    whiten = vectors[:, sound] / np.sqrt(values[sound])
    features = kernel @ whiten
    target = np.where(np.array(languages)[:, None] == np.array(names)[None], 1.0, -1.0)
    weights = whiten @ np.linalg.solve(features.T @ features + ridge * len(features) / len(names) * np.eye(features.shape[1]), features.T @ target)
    matrix = np.zeros((len(grams), len(names)))
    for k, i in enumerate(chosen):
        matrix[lookup[rows[i]]] += weights[k] / norms[i]
    return names, grams, matrix.astype(np.float32)


def scores(rows: list[np.ndarray], lookup: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """One row of scores for each presence(). lookup: of each coordinate its row in the matrix, or -1."""
    at = lookup[np.concatenate(rows)] if rows else np.zeros(0, np.int32)
    known = at >= 0
    lengths = np.array([len(r) for r in rows], np.int64)
    inside = _sums(known.astype(np.int64), lengths)
    return _sums(matrix[at[known]], inside) / np.sqrt(np.maximum(lengths, 1))[:, None]


def training_sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, sample: int, grams: int) -> DataFrame:
    """rank, language, grams (presence() of a whole text). At most per_language rows of each language and sample rows in all, by a hash
    of the id, and no more than hold `grams` distinct n-grams together; each language's first rows come first.

    A language's rows are thinned by their hash to a few times as many as are wanted before they meet to be ranked, and texts
    are fetched for the chosen ids only."""
    order = Window.partitionBy("language").orderBy("place", "id")
    ids = labelled.select(F.col(lang_col).alias("language"), F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 40)).alias("place"), F.col(id_col).alias("id"))
    large = ids.groupBy("language").agg(F.count("*").alias("n")).where(F.col("n") > 8 * per_language).orderBy(F.desc("n"), "language").limit(THINNED).collect()
    shares = F.create_map(*[F.lit(x) for r in large for x in (r["language"], float(1 << 40) * (2 * per_language + 200) / r["n"])]) if large else None
    if shares is not None:
        ids = ids.where(F.col("place") <= F.coalesce(F.try_element_at(shares, F.col("language")), F.lit(float(1 << 40))))
    ids = ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).orderBy("rank", "language").limit(sample)
    chosen = ids.select(F.col("id").alias("_id"), "rank", "language").dropDuplicates(["_id"])
    # An id that stands on several texts gives one of them; what goes on is sparse presence, as far as the budget of n-grams.
    rows = labelled.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("rank", "language", "text")
    rows = rows.mapInArrow(_presences, "rank int, language string, grams array<int>, digest binary").where(F.size("grams") > 0)
    rows = rows.groupBy("rank", "language").agg(F.min(F.struct("digest", "grams"))["grams"].alias("grams"))
    before = F.sum(F.size("grams")).over(Window.orderBy("rank", "language"))  # no more than sample rows
    rows = materialize(rows, "sample")
    budget = rows.select("rank", "language", before.alias("upto")).where(F.col("upto") <= grams)
    return rows.join(F.broadcast(budget), ["rank", "language"]).select("rank", "language", "grams")


def _presences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [v.as_py() for v in batch.column("text")]
        digests = [hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("language"), pa.array([np.sort(presence(t)) for t in texts], pa.list_(pa.int32())), pa.array(digests, pa.binary())], names=["rank", "language", "grams", "digest"])


def predict(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: tuple = (), per_language: int = PER_LANGUAGE, sample: int = SAMPLE, landmarks: int = LANDMARKS, grams: int = GRAMS, ridge: float = RIDGE) -> DataFrame:
    """One row per row of docs: id, lang_pred, score in 0 to 1, and the columns in keep.

    labelled gives the training rows: those with text, label and id. lang_pred is a learned label, or "und" (score 0) if the text is
    null or has no letter, or if nothing was learned. Equal scores go to the first label in order. Equal texts get equal
    results. Only the text is used for a prediction, and all of it; only the named columns are read. An empty table gives an empty result.
    """
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    small_batches(docs.sparkSession)
    rows = sorted(training_sample(usable, id_col, text_col, lang_col, per_language, sample, grams).collect(), key=lambda r: (r["rank"], r["language"]))
    model = docs.sparkSession.sparkContext.broadcast(fit([np.array(r["grams"], np.int32) for r in rows], [r["language"] for r in rows], landmarks, ridge))
    kept = [docs.schema[c] for c in keep]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, known, matrix = model.value
        lookup = np.full(SIZE, -1, np.int32)
        lookup[known] = np.arange(len(known))
        for batch in batches:
            langs, sure = [], []
            texts = batch.column(batch.num_columns - 1)
            for at in range(0, batch.num_rows, BATCH):
                part = [presence(v.as_py() or "") for v in texts[at : at + BATCH]]
                if names:
                    values = scores(part, lookup, matrix)
                    best = values.argmax(1)
                for k, found in enumerate(part):
                    clear = len(found) > 0 and bool(names)
                    langs.append(names[best[k]] if clear else UNKNOWN)
                    sure.append(float(np.clip((values[k, best[k]] + 1) / 2, 0, 1)) if clear else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(sure, pa.float64())], names=[id_col, *keep, "lang_pred", "score"])

    return docs.select(docs[id_col], *[docs[c] for c in keep], docs[text_col]).mapInArrow(run, schema)
