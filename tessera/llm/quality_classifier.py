"""Quality classification by co-training of two views.

The text view knows the words of a document and their shapes, hashed, and the shares of kinds of characters, repeated words and
lines. The metadata view never reads the text: it knows language, source, both together, and the recorded number of characters.
Each view has a logistic regression. They start from the same bounded sample of labelled documents, a quarter of each class
kept out of training. In each round each view is calibrated on these, scores all documents and hands those it is surest of, the
same number of each class at most and none with less than `confident`, to the other view as training rows; a view that is never sure
teaches nothing. At last a logistic regression of the two calibrated log-odds, on the held-out rows, combines the views, and all
documents are scored.

Features of all documents are computed once and written; the rounds read them. The driver gets the labelled sample and the picks of
each round, both of fixed size. Which of several equal rows is taken never matters: rows are chosen by keys of their text and metadata.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches

TEXT_SIZE = 4096
STATS = 8
LANG_SLOTS, SOURCE_SLOTS, BOTH_SLOTS, SIZE_SLOTS = 16, 64, 64, 32
META_SIZE = LANG_SLOTS + SOURCE_SLOTS + BOTH_SLOTS + SIZE_SLOTS
#: Bounds: labelled rows of each class on the driver, and picks of each class, view and round.
SAMPLE, PICKS, ROUNDS = 1500, 100, 3
CONFIDENT = 0.9
HELD_OUT = 0.25
#: Fewer labelled documents of a class than this teach nothing.
MIN_CLASS = 4
RIDGE_TEXT, RIDGE_META = 1e-4, 1e-3
WORD_TABLE = 300_000

_words: dict[str, tuple[int, int]] = {}
_SHAPES = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "T" if m[0][0].isupper() else "a"), (re.compile(r"\d+"), lambda m: "0"))


def _slot(text: str, size: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") % size


def _word_slots(word: str) -> tuple[int, int]:
    shape = word
    for pattern, put in _SHAPES:
        shape = pattern.sub(put, shape)
    if len(_words) >= WORD_TABLE:
        _words.clear()
    _words[word] = slots = _slot("w " + word.lower(), TEXT_SIZE), _slot("s " + re.sub(r"(.)\1+", r"\1", shape)[:12], TEXT_SIZE)
    return slots


def text_features(text: str) -> list[int]:
    """The slots that the words and word shapes of the whole text fall into, sorted, each once."""
    found: set[int] = set()
    get = _words.get
    for word in set(text.split()):
        found.update(get(word) or _word_slots(word))
    return sorted(found)


def text_stats(text: str) -> list[float]:
    n, words = max(len(text), 1), text.count(" ") + text.count("\n") + 1
    lines, tokens = text.split("\n"), text.split()
    echoes = sum(map(str.__eq__, tokens, tokens[1:])) / max(len(tokens), 1)  # words that repeat the one before
    capitals = len(re.findall("[A-Z]", text)) / n
    symbols = sum(map(text.count, "#*$%&|<>!")) / n
    digits = len(re.findall("[0-9]", text)) / n
    return [float(x) for x in (np.log(n / words), capitals**0.5, symbols**0.5, digits**0.5, len(lines) / words, 1 - len(set(lines)) / len(lines), echoes**0.5, np.log((len(set(tokens)) + 1) / (len(tokens) + 1)))]


def meta_features(lang: str | None, source: str | None, chars: int | None) -> list[float]:
    """One of each: the language's slot, the source's, that of both, and the size's (powers of two; the last for none)."""
    out = [0.0] * META_SIZE
    size = SIZE_SLOTS - 1 if chars is None else min(SIZE_SLOTS - 2, max(int(chars), 0).bit_length())
    at = 0
    for slots, slot in ((LANG_SLOTS, _slot(f"lang {lang!r}", LANG_SLOTS)), (SOURCE_SLOTS, _slot(f"source {source!r}", SOURCE_SLOTS)), (BOTH_SLOTS, _slot(f"both {lang!r} {source!r}", BOTH_SLOTS)), (SIZE_SLOTS, size)):
        out[at + slot] = 1.0
        at += slots
    return out


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, slots, stats, metas, keys = [batch.column("text"), *batch.columns[2:]], [], [], [], [[], []]
        for value, *about in zip(*texts):
            text, about = value.as_py() or "", [x.as_py() for x in about]
            slots.append(text_features(text))
            stats.append(text_stats(text))
            metas.append(meta_features(*about))
            keys[0].append(_key(text))
            keys[1].append(_key(repr(about)))
        floats = pa.list_(pa.float32())
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(k, pa.int64()) for k in keys], pa.array(slots, pa.list_(pa.int16())), pa.array(stats, floats), pa.array(metas, floats)], names=["id", "text_key", "meta_key", "slots", "stats", "meta"])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 150) -> np.ndarray:
    """Weights and, last, the intercept; accelerated gradient steps with classes weighed alike."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], 1)
    weight = np.where(y > 0.5, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):  # largest curvature by power iteration
        v = x.T @ (weight * (x @ v))
        size = float(np.linalg.norm(v)) or 1.0
        v /= size
    rate = 1 / (size / 4 + ridge)
    w = look = np.zeros(x.shape[1], np.float32)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ look, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * np.concatenate([look[:-1], [0]]).astype(np.float32)
        after = look - rate * g
        look, w = after + k / (k + 3) * (after - w), after
    return w


def _dense(rows: list) -> np.ndarray:
    out = np.zeros((len(rows), TEXT_SIZE), np.float32)
    for line, slots in zip(out, rows):
        line[slots] = 1 / max(len(slots), 1) ** 0.5
    return out


class Model:
    """Both views' weights, the scaling of what isn't hashed, and the calibration of each view and of both together."""

    def __init__(self, text_rows: list, text_y: list, meta_rows: list, meta_y: list):
        y = np.array(text_y, np.float32)
        stats = np.array([r["stats"] for r in text_rows], np.float32)
        self.centre, self.spread = stats.mean(0), stats.std(0) + 0.02
        self.text = logistic(np.concatenate([_dense([r["slots"] for r in text_rows]), (stats - self.centre) / self.spread], 1), y, RIDGE_TEXT)
        self.meta = logistic(np.array([r["meta"] for r in meta_rows], np.float32), np.array(meta_y, np.float32), RIDGE_META)
        self.platt = [(1.0, 0.0), (1.0, 0.0)]
        self.both = np.array([0.5, 0.5, 0.0])

    def odds(self, slots: list[np.ndarray], stats: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row by row, so that a row's odds don't depend on its batch."""
        words = np.array([self.text[s].sum() / max(len(s), 1) ** 0.5 for s in slots], np.float64)
        scaled = ((stats - self.centre) / self.spread).astype(np.float64)
        return words + (scaled * self.text[TEXT_SIZE:-1]).sum(1) + self.text[-1], (meta.astype(np.float64) * self.meta[:-1]).sum(1) + self.meta[-1]

    def calibrated(self, odds: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        return [np.clip(a * o + b, -30, 30) for o, (a, b) in zip(odds, self.platt)]

    def scores(self, *features) -> list[np.ndarray]:
        z = self.calibrated(self.odds(*features))
        both = np.clip(self.both[0] * z[0] + self.both[1] * z[1] + self.both[2], -30, 30)
        return [np.round(1 / (1 + np.exp(-x)), 9) for x in (*z, both)]


def _arrays(rows: list) -> tuple:
    return [np.array(r["slots"], np.int64) for r in rows], np.array([r["stats"] for r in rows], np.float32), np.array([r["meta"] for r in rows], np.float32)


def _calibrate(model: Model, held: list, held_y: np.ndarray) -> None:
    odds = model.odds(*_arrays(held))
    model.platt = [tuple(_newton(o[:, None], held_y)) for o in odds]
    model.both = _newton(np.stack(model.calibrated(odds), 1), held_y)


def _newton(x: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """A small logistic regression with smoothed targets, so that separable rows have finite weights."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    t = np.where(y > 0.5, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        w -= np.clip(np.linalg.solve(h, x.T @ (p - t) + 1e-3 * w), -2, 2)
    return w


def _scored(model, kind: str):
    schema = f"id {kind}, text_key long, meta_key long, p_text double, p_meta double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            slots = batch.column("slots")
            flat, ends = slots.flatten().to_numpy(zero_copy_only=False), slots.offsets.to_numpy() - slots.offsets[0].as_py()
            rows = [flat[a:b] for a, b in zip(ends, ends[1:])]
            stats, meta = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, n) for c, n in (("stats", STATS), ("meta", META_SIZE)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "text_key", "meta_key")), *[pa.array(p, pa.float64()) for p in m.scores(rows, stats, meta)]], names=["id", "text_key", "meta_key", "p_text", "p_meta", "score"])

    return run, schema


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", chars_col: str = "n_chars", label_col: str = "quality", sample: int = SAMPLE, picks: int = PICKS, rounds: int = ROUNDS, confident: float = CONFIDENT) -> DataFrame:
    """One row per row of docs: id, p_text, p_meta (each view, calibrated), score (both together), kept (score at least 0.5).

    labels has ids and a label of 0 or 1; null labels and ids don't count, and an id with several labels has the largest. An id that
    stands on several documents is trained on the one with the smallest keys of text and metadata. With fewer than MIN_CLASS
    labelled documents of a class nothing is learned: all scores are null and all documents kept. Null text counts as
    empty; null language, source and number of characters are values of their own. Rows with equal text and metadata get equal
    scores, in any order and partitioning; ties among the surest go by keys. Very long texts are read whole, one at a time. Only
    the named columns are read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(chars_col).cast("long").alias("chars"))
    features = materialize(rows.mapInArrow(_features, f"id {kind}, text_key long, meta_key long, slots array<short>, stats array<float>, meta array<float>"), "features")

    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("l_id")).agg(F.max(label_col).cast("int").alias("y"))
    known = known.join(features.select(F.col("id").alias("l_id")), "l_id", "left_semi")
    order = F.xxhash64(F.col("l_id").cast("string"))
    chosen = known.where("y = 1").orderBy(order, "l_id").limit(sample).union(known.where("y = 0").orderBy(order, "l_id").limit(sample))
    chosen = materialize(chosen, "chosen")  # at most 2 * sample rows
    first = features.join(F.broadcast(chosen), F.col("id") == F.col("l_id")).groupBy("id").agg(F.min(F.struct("text_key", "meta_key", "y", "slots", "stats", "meta")).alias("r"))
    taught = sorted(first.select("id", "r.*").limit(2 * sample).collect(), key=lambda r: (_slot(str(r["id"]), 1 << 62), str(r["id"])))
    held, train = [], []
    for y in (0, 1):
        own = [r for r in taught if r["y"] == y]
        if len(own) < MIN_CLASS:
            none = F.lit(None).cast("double")
            return features.select(F.col("id").alias(id_col), none.alias("p_text"), none.alias("p_meta"), none.alias("score"), F.lit(True).alias("kept"))
        cut = max(1, int(HELD_OUT * len(own)))
        held, train = held + own[:cut], train + own[cut:]
    held_y = np.array([r["y"] for r in held], float)
    text_rows, text_y = list(train), [r["y"] for r in train]
    meta_rows, meta_y = list(train), [r["y"] for r in train]
    model = Model(text_rows, text_y, meta_rows, meta_y)
    _calibrate(model, held, held_y)
    unlabelled = features.join(F.broadcast(chosen.select("l_id")), F.col("id").eqNullSafe(F.col("l_id")), "left_anti")
    taken: set[int] = set()
    for _ in range(rounds):
        run, schema = _scored(spark.sparkContext.broadcast(model), kind)
        scored = unlabelled.mapInArrow(run, schema).groupBy("text_key", "meta_key").agg(F.max("p_text").alias("p_text"), F.max("p_meta").alias("p_meta"))
        scored = materialize(scored, "scored")
        picked: dict[tuple[int, int], list[tuple[str, int]]] = {}
        for view in ("p_text", "p_meta"):
            # A text counts once for a view, with the metadata that it is surest of.
            for y, most, by in ((1, F.max_by(F.struct(view, "meta_key"), F.struct(view, "meta_key")), F.desc), (0, F.min_by(F.struct(view, "meta_key"), F.struct(view, "meta_key")), F.asc)):
                sure = scored.where(F.col(view) >= confident if y else F.col(view) <= 1 - confident).groupBy("text_key").agg(most.alias("m"))
                sure = sure.orderBy(by("m." + view), "text_key").limit(picks + len(taken)).select("text_key", "m.meta_key").collect()
                for r in [r for r in sure if r["text_key"] not in taken][:picks]:
                    picked.setdefault((r["text_key"], r["meta_key"]), []).append((view, y))
        if not picked:
            break
        taken |= {key for key, _ in picked}
        keys = F.broadcast(spark.createDataFrame(list(picked), "t_key long, m_key long"))
        found = features.join(keys, (F.col("text_key") == F.col("t_key")) & (F.col("meta_key") == F.col("m_key"))).dropDuplicates(["text_key", "meta_key"]).select("text_key", "meta_key", "slots", "stats", "meta")
        found = {(r["text_key"], r["meta_key"]): r for r in found.collect()}
        for key, says in sorted(picked.items()):
            for view, y in says:
                # What one view is sure of teaches the other.
                (meta_rows if view == "p_text" else text_rows).append(found[key])
                (meta_y if view == "p_text" else text_y).append(y)
        model = Model(text_rows, text_y, meta_rows, meta_y)
        _calibrate(model, held, held_y)
    run, schema = _scored(spark.sparkContext.broadcast(model), kind)
    out = features.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), "p_text", "p_meta", "score", (F.col("score") >= 0.5).alias("kept"))
