"""Quality rules by robust multivariate outliers.

Each document has a vector of transformed statistics. For every language and source the minimum covariance determinant is
sought over all its documents: of all cores of h = (n + d + 1) / 2 documents, the one whose covariance has the smallest determinant.
A document's distance to a centre and covariance ranks it, and the nearest h make the next centre and covariance: a concentration
step, which never makes the determinant larger.

A group is first dealt by a hash into blocks of bounded size. In each block, several deterministic starts (medians with quartile ranges, the densest
halves of the single statistics, the covariances of tanh scores, signs and spatial signs, and a few seeded cores of d + 1) take two steps each, the
best two go on until they settle, and the one with the smallest determinant is the block's estimate. The smallest of a group's blocks
and their mean then take steps over the whole group until its determinant settles, and the smaller one is kept. All
documents within the 97.5 % quantile give the reweighted estimate. A document is rejected if its squared Mahalanobis distance is
over a cutoff.

Vectors are computed once by an Arrow function over whole texts; steps over whole groups are DataFrame aggregates over the small table of
vectors. Quantiles come from counts in fixed bins (statistics in steps of a small share of their tolerance, distances in
steps of 2 %; the bin that holds the h-th document counts in part), so a hot group is combined map-side into a bounded
number of rows, and no task holds a group.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import discard, materialize, null_key, small_batches, without

BLANKS = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: The vector: logarithms of counts and smoothed shares, so that clean prose is close to normal in each.
FEATURES = ("log_words", "log_word_length", "log_distinct_share", "root_symbol_share", "log_blank_share", "root_capital_share")
#: Tolerances: their squares are added to the variances when documents are judged, so that differences below these are never a
#: reason to reject (share of symbols that are rare in prose, say). A tenth of them keeps determinants from zero in the search.
FLOOR = (1.0, 0.15, 0.2, 0.06, 0.15, 0.08)
RIDGE = tuple(0.1 * f for f in FLOOR)
#: Width of the bins that quantiles of the statistics come from, and bins to a factor of two in squared distances.
BIN = tuple(f / 16 for f in FLOOR)
OCTAVE = 32
#: Documents of a block, and steps over whole groups at most (blocks settle by themselves).
BLOCK, MOST_STEPS = 2000, 30
RANDOM_STARTS = 10
#: Steps end when no group's logarithm of the determinant changes by more than this.
SETTLED = 0.01
REWEIGHT = 0.975
#: Groups with fewer documents (ten to a statistic) have no estimate of their own; the next level's estimate judges them.
MIN_GROUP = 60
#: Estimates of up to this many groups are broadcast (two of 28 numbers each); more are joined by shuffle.
BROADCAST_GROUPS = 10_000
#: On the squared distance. A vector of 6 normal variables passes 25 with a chance of 3e-4, and the tolerance makes that less;
#: tails of real statistics are heavier, and the stage is to keep clean documents.
CUTOFF = 25.0
D = len(FEATURES)
_PAIRS = [(i, j) for i in range(D) for j in range(i, D)]


def text_statistics(text: str) -> tuple:
    """The counts of the base rules and the vector of one whole text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII blanks, as the word rule asks
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated_lines = len(lines) - len(set(lines))
    repeats = 0
    if n > WINDOW:
        keys = np.fromiter(map(hash, words), np.int64, n).astype(np.uint64)
        rolled = np.zeros(n - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + keys[k : n - WINDOW + 1 + k]
        _, back, count = np.unique(rolled, return_inverse=True, return_counts=True)
        found = np.flatnonzero(count[back] > 1)
        if len(found):
            # Equal sums are compared word by word.
            windows = [tuple(words[i : i + WINDOW]) for i in found.tolist()]
            times = Counter(windows)
            edges = np.zeros(n + 1, np.int64)
            starts = np.array([i for i, w in zip(found.tolist(), windows) if times[w] > 1], np.int64)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + WINDOW, -1)
            repeats = int((np.cumsum(edges)[:n] > 0).sum())
    letters = max(chars, 1)
    ascii_upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    vector = (
        np.log1p(n),
        np.log((chars + 1) / (n + 1)),
        np.log((len(set(words)) + 1) / (n + 1)),
        np.sqrt(min(1.0, symbols / letters)),
        np.log((len(text) - chars + 1) / (n + 1)),
        np.sqrt(ascii_upper / letters),
    )
    return n, chars, symbols, repeated_lines, repeats, *map(float, vector)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES]
    for batch in batches:
        rows = [text_statistics(v.as_py() or "") for v in batch.column("text")]
        columns = list(zip(*rows)) or [()] * len(names)
        arrays = [pa.array(c, pa.int64() if i < 5 else pa.float64()) for i, c in enumerate(columns)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("group"), batch.column("level"), *arrays], names=["id", "group", "level", *names])


def _chi2(x: float, d: int) -> float:
    """Of a chi-square variable with an even number of degrees of freedom: the chance of no more than x."""
    term, total = 1.0, 0.0
    for k in range(d // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def _chi2_quantile(q: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2(middle, d) < q else (low, middle)
    return high


@F.pandas_udf(ArrayType(DoubleType()))
def _medians(cells: pd.Series) -> pd.Series:
    """Of a group's bins (i, bin, n), which are bounded in number: the medians."""
    out = []
    for rows in cells:
        found = np.zeros(D)
        for i in range(D):
            bins = sorted((r["bin"], r["n"]) for r in rows if r["i"] == i)
            n = np.cumsum([c for _, c in bins])
            found[i] = (bins[int(np.searchsorted(n, 0.5 * n[-1]))][0] + 0.5) * BIN[i]
        out.append(found)
    return pd.Series(out)


def _starts(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Centres and covariances to start from."""
    ridge = np.square(RIDGE)
    low, median, high = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    spread = np.sqrt(((high - low) / 1.349) ** 2 + ridge)
    yield median, np.diag(spread**2)
    ordered, half = np.sort(x, axis=0), (len(x) + 1) // 2
    lengths = ordered[half - 1 :] - ordered[: len(x) - half + 1]
    at = lengths.argmin(0)
    yield (ordered[at + half - 1, range(D)] + ordered[at, range(D)]) / 2, np.diag((lengths[at, range(D)] / 1.349) ** 2 + ridge)
    u = (x - median) / spread
    spatial = u / np.maximum(np.sqrt((u * u).sum(1, keepdims=True)), 1e-12)
    tanh, sign = np.tanh(u), np.sign(u)
    rng = np.random.default_rng(0)
    for _ in range(RANDOM_STARTS):
        core = x[rng.choice(len(x), min(len(x), D + 1), replace=False)]
        yield core.mean(0), np.cov(core.T, bias=True) + np.diag(ridge)
    for shape in (tanh.T @ tanh / len(x), np.sin(np.pi / 2 * np.clip(sign.T @ sign / len(x), -1, 1)), D * spatial.T @ spatial / len(x)):
        values, vectors = np.linalg.eigh(shape)
        yield median, ((vectors * np.maximum(values, 0.05)) @ vectors.T) * np.outer(spread, spread)


def minimum_determinant(x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Logarithm of the determinant (with the ridge), centre and covariance of the best core found among the rows of x."""
    h, x = (len(x) + D + 1) // 2, x[np.lexsort(x.T)]  # in an order of their own, so that the starts are always the same

    def step(centre: np.ndarray, cov: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        away = x - centre
        d2 = ((away @ np.linalg.inv(cov)) * away).sum(1)
        core = x[np.argpartition(d2, h - 1)[:h]] if h < len(x) else x
        cov = np.cov(core.T, bias=True) + np.diag(np.square(RIDGE))
        return float(np.linalg.slogdet(cov)[1]), core.mean(0), cov

    tried = []
    for centre, cov in _starts(x):
        for _ in range(2):
            now, centre, cov = step(centre, cov)
        tried.append((now, len(tried), centre, cov))
    done = []
    for then, k, centre, cov in sorted(tried, key=lambda t: t[:2])[:2]:
        for _ in range(200):
            now, centre, cov = step(centre, cov)
            if now >= then - 1e-9:
                break
            then = now
        done.append((now, k, centre, cov))
    now, _, centre, cov = min(done, key=lambda t: t[:2])
    return now, centre, cov


def _block_estimate(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    now, centre, cov = minimum_determinant(block[list(FEATURES)].to_numpy(float))
    # As moments, so that blocks can be averaged and are taken in like a core's sums.
    return pd.DataFrame({"group": [key[0]], "log_det": [now], "moments": [[1.0, *centre, *(cov - np.diag(np.square(RIDGE)) + np.outer(centre, centre))[np.triu_indices(D)]]]})


def _square(upper: np.ndarray) -> np.ndarray:
    out = np.zeros((D, D))
    out[np.triu_indices(D)] = upper
    return out + np.triu(out, 1).T


def _packed(centre: np.ndarray, cov: np.ndarray, ridge: tuple) -> list[float]:
    """Centre, upper triangle of the inverse of the covariance with its ridge, logarithm of the determinant."""
    cov = cov + np.diag(np.square(ridge))
    return [*centre, *np.linalg.inv(cov)[np.triu_indices(D)], float(np.linalg.slogdet(cov)[1])]


def _moments_to(ridge: tuple, factor: float):
    @F.pandas_udf(ArrayType(DoubleType()))
    def estimate(moments: pd.Series) -> pd.Series:
        """Of weight, sums and sums of products."""
        out = []
        for m in moments:
            mean = np.array(m[1 : D + 1]) / m[0]
            out.append(_packed(mean, factor * (_square(np.array(m[D + 1 :])) / m[0] - np.outer(mean, mean)), ridge))
        return pd.Series(out)

    return estimate


def _distance(estimate: str):
    """The squared distance as one expression over the vector's columns and the estimate's array."""
    away = [F.col(f) - F.col(estimate)[i] for i, f in enumerate(FEATURES)]
    return sum(((away[i] * away[j] * F.col(estimate)[D + k] * (1.0 if i == j else 2.0)) for k, (i, j) in enumerate(_PAIRS)), F.lit(0.0))


def _log_det():
    return F.col("estimate")[D + len(_PAIRS)]


def _few(df: DataFrame, groups: int) -> DataFrame:
    return F.broadcast(df) if groups <= BROADCAST_GROUPS else df


def _placed(vectors: DataFrame, estimates: DataFrame, groups: int) -> DataFrame:
    """vectors with each of their group's estimates and the bin of the distance to it."""
    near = vectors.join(_few(estimates.select("group", "start", "estimate"), groups), "group").withColumn("d2", _distance("estimate"))
    return near.withColumn("bin", F.floor(F.log2(F.greatest(F.least("d2", F.lit(2.0**40)), F.lit(2.0**-20))) * OCTAVE).cast("int"))


def _reach(placed: DataFrame, sizes: DataFrame, wanted) -> DataFrame:
    """group, start, last (the bin that the wanted-th nearest document falls into), part (the share of that bin that is within)."""
    cells = placed.groupBy("group", "start", "bin").agg(F.count("*").alias("n")).join(sizes, "group").withColumn("wanted", wanted)
    order = Window.partitionBy("group", "start").orderBy("bin")
    cells = cells.withColumn("upto", F.sum("n").over(order)).where(F.col("upto") >= F.col("wanted"))
    first = cells.groupBy("group", "start").agg(F.min_by(F.struct("bin", "upto", "n", "wanted"), "bin").alias("c"))
    return first.select("group", "start", F.col("c.bin").alias("last"), (1 - (F.col("c.upto") - F.col("c.wanted")) / F.col("c.n")).alias("part"))


def _moments(weight) -> list:
    return [F.sum(weight), *[F.sum(weight * F.col(f)) for f in FEATURES], *[F.sum(weight * F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in _PAIRS]]


def _step(vectors: DataFrame, estimates: DataFrame, sizes: DataFrame, groups: int) -> DataFrame:
    """One concentration step for each group and start; then: the logarithm of the determinant before."""
    placed = _placed(vectors, estimates, groups)
    reach = _reach(placed, sizes, F.floor((F.col("n_group") + D + 1) / 2))
    core = placed.join(_few(reach, groups), ["group", "start"]).where("bin <= last")
    weight = F.when(F.col("bin") < F.col("last"), 1.0).otherwise(F.col("part"))
    after = core.groupBy("group", "start").agg(F.array(*_moments(weight)).alias("moments"), F.max(_log_det()).alias("then"))
    return materialize(after.select("group", "start", "then", _moments_to(RIDGE, 1.0)("moments").alias("estimate")), "mcd")


def medians(cells: DataFrame) -> DataFrame:
    """cells: group, i, bin, n. group, n_group, medians."""
    n = F.sum(F.when(F.col("i") == 0, F.col("n")).otherwise(0))
    return cells.groupBy("group").agg(n.alias("n_group"), F.collect_list(F.struct("i", "bin", "n")).alias("cells")).select("group", "n_group", _medians("cells").alias("medians"))


def statistic_cells(vectors: DataFrame, *by: str) -> DataFrame:
    """by, i, bin, n: how many vectors fall into each bin of each statistic."""
    bins = F.array(*[F.floor(F.col(f) / b).cast("int") for f, b in zip(FEATURES, BIN)])
    return vectors.select(*by, F.posexplode(bins).alias("i", "bin")).groupBy(*by, "i", "bin").agg(F.count("*").alias("n"))


def robust_estimates(vectors: DataFrame, sizes: DataFrame) -> DataFrame:
    """vectors: group, spread (a hash of the row) and FEATURES; sizes: group and n_group of the groups that are wanted. One row a group:
    group, n_group, estimate (reweighted, for judging, with the tolerance), log_det (of the raw minimum determinant
    estimate, with the ridge)."""
    groups = sizes.count()
    dealt = vectors.join(_few(sizes, groups), "group").withColumn("block", F.pmod("spread", F.ceil(F.col("n_group") / BLOCK)))
    blocks = dealt.select("group", "block", *FEATURES).groupBy("group", "block").applyInPandas(_block_estimate, "`group` string, log_det double, moments array<double>")
    mean = F.array(*[F.avg(F.col("moments")[k]) for k in range(1 + D + len(_PAIRS))])
    starts = blocks.groupBy("group").agg(F.array(F.min_by("moments", "log_det"), mean).alias("starts"), F.count("*").alias("blocks"))
    starts = starts.select("group", F.posexplode(F.slice("starts", F.lit(1), F.least("blocks", F.lit(2)).cast("int"))).alias("start", "moments"))
    estimates = materialize(starts.select("group", "start", _moments_to(RIDGE, 1.0)("moments").alias("estimate")), "mcd")
    for _ in range(MOST_STEPS):
        after = _step(vectors, estimates, sizes, groups)
        discard(estimates)
        estimates = after
        changed = after.agg(F.max(F.abs(F.col("then") - _log_det()))).first()[0]
        if changed is None or changed <= SETTLED:
            break
    best = Window.partitionBy("group").orderBy("log_det", "start")
    raw = estimates.withColumn("log_det", _log_det()).withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")
    # The raw covariance is that of the inner half: scaled so that the median distance is that of a chi-square variable.
    placed = _placed(vectors, raw, groups).join(_few(sizes, groups), "group")
    scale = F.pow(F.lit(2.0), (F.col("last") + F.col("part")) / OCTAVE) / _chi2_quantile(0.5, D)
    middle = _reach(placed.drop("n_group"), sizes, F.col("n_group") / 2).select("group", scale.alias("scale"))
    limit = _chi2_quantile(REWEIGHT, D)
    within = placed.join(_few(middle, groups), "group").where(F.col("d2") <= limit * F.col("scale"))
    moments = within.groupBy("group").agg(F.array(*_moments(F.lit(1.0))).alias("moments"), F.max(_log_det()).alias("log_det"), F.max("n_group").alias("n_group"))
    return materialize(moments.select("group", "n_group", "log_det", _moments_to(FLOOR, REWEIGHT / _chi2(limit, D + 2))("moments").alias("estimate")), "mcd")


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple = ("lang", "source"), cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per row of docs: id, the five counts, base_failed, distance, kept.

    Null text has no words (so it fails the base rules), and nor has empty text. Null group values form groups of their own. Estimates
    are of documents that pass the base rules. Groups with fewer than min_group of them are judged by the estimate over all
    groups with the same first group column (the language); if these are too few as well, by the scatter of all documents
    about their groups' medians, put around the group's own median. With fewer than min_group documents in all, only the base
    rules decide (distance null). Repeated rows get equal verdicts, and ties in distance too. Only the named columns are read, so others
    may have any names. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)
    schema = f"id {kind}, `group` string, level string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = docs.select(F.col(id_col).alias("id"), null_key(*group_cols).alias("group"), F.concat(F.lit("*"), null_key(*group_cols[:1])).alias("level"), F.col(text_col).alias("text"))
    rows = materialize(rows.mapInArrow(_statistics, schema), "statistics")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    sound = rows.where("not base_failed").withColumn("spread", F.when(F.col("id").isNotNull(), F.xxhash64("id")).otherwise(F.monotonically_increasing_id()))

    cells = materialize(statistic_cells(sound, "group", "level"), "cells")
    own = materialize(medians(cells).join(cells.select("group", "level").distinct(), "group"), "medians")
    levels = own.groupBy("level").agg(F.sum("n_group").alias("n_level"), F.min("n_group").alias("least"))
    # Estimates of a level are sought where a group needs them.
    levels = materialize(levels.where(F.col("least") < min_group), "levels")
    wanted = own.where(F.col("n_group") >= min_group).select("group", "n_group").unionByName(levels.where(F.col("n_level") >= min_group).select(F.col("level").alias("group"), F.col("n_level").alias("n_group")))
    everywhere = [sound.select(F.explode(F.array("group", "level")).alias("group"), "spread", *FEATURES)]
    if not levels.where(F.col("n_level") < min_group).isEmpty():
        wanted = wanted.unionByName(own.agg(F.sum("n_group").alias("n_group")).where(F.col("n_group") >= min_group).select(F.lit("*").alias("group"), "n_group"))
        everywhere.append(sound.join(own.select("group", "medians"), "group").select(F.lit("*").alias("group"), "spread", *[(F.col(f) - F.col("medians")[i]).alias(f) for i, f in enumerate(FEATURES)]))
    estimates = robust_estimates(reduce(DataFrame.unionByName, everywhere), materialize(wanted, "sizes"))

    groups = own.count()
    best = own.select("group", "level", "medians").join(estimates.select("group", F.col("estimate").alias("own_estimate")), "group", "left")
    best = best.join(estimates.select(F.col("group").alias("level"), F.col("estimate").alias("level_estimate")), "level", "left")
    general = estimates.where("group = '*'").agg(F.first("estimate").alias("all_estimate"))  # one row
    around = F.concat(F.transform(F.sequence(F.lit(0), F.lit(D - 1)), lambda i: F.col("medians")[i] + F.col("all_estimate")[i]), F.slice("all_estimate", D + 1, len(_PAIRS) + 1))
    best = best.crossJoin(F.broadcast(general)).select("group", F.coalesce("own_estimate", "level_estimate", around).alias("estimate"))
    judged = rows.join(_few(materialize(best, "mcd"), groups), "group", "left").withColumn("distance", F.when(~F.col("base_failed") | F.col("estimate").isNotNull(), _distance("estimate")))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"), *FEATURES)


def keep_sound(docs: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """docs without rejected documents, all columns unchanged, whatever their names; all rows with an id that is rejected go, rows
    without id stay."""
    return without(docs, id_col, quality_verdicts(docs, id_col, **parameters).where("not kept").select(id_col).distinct())
