"""Exact nearest neighbours by blocked matrix products, and the interface for text encoders."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .index import top_k

TOP_K = 60
BLOCK = 2048
#: Blocks of each side that meet in one task.
SIDE = 8


def _block_counts(df: DataFrame, rows: int) -> DataFrame:
    return df.groupBy("country").agg(F.greatest(F.ceil(F.count("*") / rows), F.lit(1)).alias("n_blocks"))


def _blocks(df: DataFrame, ids: tuple[str, ...], vector: str, rows: int) -> DataFrame:
    """Records packed into blocks of about `rows`, numbered within their country: so many that no block grows with the table."""
    spread = df.join(_block_counts(df, rows), "country").withColumn("block", F.pmod(F.xxhash64(*ids), F.col("n_blocks")))
    return spread.groupBy("country", "block").agg(F.collect_list(F.struct(*ids, F.col(vector).alias("v"))).alias("rows"))


def _cells(blocks: DataFrame, own: str, other: str, counts: DataFrame, side: int) -> DataFrame:
    """Blocks by the cells of a grid: `own` is the part of `side` blocks that a block is in, and it stands once in each `other` part."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_blocks") - 1) / side))
    return blocks.join(counts, "country").select("country", F.floor(F.col("block") / side).alias(own), F.explode(parts).alias(other), "rows")


def exact_knn(queries: DataFrame, pool: DataFrame, k: int = TOP_K, vector: str = "embedding", block: int = BLOCK, side: int = SIDE, same_id: bool = True) -> DataFrame:
    """country, s1, source, id, score, rank: the k pool records of the same country with the largest inner product.

    queries: country, s1, vector; pool: country, source, id, vector. Blocks of queries meet blocks of the pool, each pair of blocks
    is one matrix product of which the best k of each query go on. The pairs of a country's blocks are dealt over a grid of cells of
    side x side pairs, so a task's work doesn't grow with the country, however large it is. same_id=False leaves out pool records with the query's number.
    """
    q = _cells(_blocks(queries, ("s1",), vector, block), "q_part", "p_part", _block_counts(pool, block), side).withColumnRenamed("rows", "q_rows")
    p = _cells(_blocks(pool, ("source", "id"), vector, block), "p_part", "q_part", _block_counts(queries, block), side).withColumnRenamed("rows", "p_rows")

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for country, qs, ps in zip(frame["country"], frame["q_rows"], frame["p_rows"]):
                q_ids = np.array([r["s1"] for r in qs])
                ids, sources = np.array([r["id"] for r in ps]), np.array([r["source"] for r in ps])
                scores = np.array([r["v"] for r in qs], np.float64) @ np.array([r["v"] for r in ps], np.float64).T
                if not same_id:
                    scores[q_ids[:, None] == ids[None, :]] = -np.inf
                for i in range(0, len(q_ids), 256):
                    part = np.round(scores[i : i + 256], 9)
                    if part.shape[1] > k:
                        # All that are not worse than the k-th: ties at the edge are settled by the final order.
                        edge = -np.partition(-part, k - 1, axis=1)[:, k - 1 : k]
                        row, col = np.nonzero((part >= edge) & (part > -np.inf))
                    else:
                        row, col = np.nonzero(part > -np.inf)
                    yield pd.DataFrame({"country": country, "s1": q_ids[i + row], "source": sources[col], "id": ids[col], "score": scores[i + row, col]})

    kinds = {f.name: f.dataType.simpleString() for f in [*queries.schema, *pool.schema]}
    schema = f"country {kinds['country']}, s1 {kinds['s1']}, source {kinds['source']}, id {kinds['id']}, score double"
    return top_k(q.join(p, ["country", "q_part", "p_part"]).mapInPandas(best, schema), k)


def hashed_ngram_vectors(size: int = 256, n: int = 3):
    """A column function: unit vectors of hashed character n-grams. A stand-in for a text encoder where no model is at hand."""
    import zlib

    @F.pandas_udf(ArrayType(FloatType()))
    def encode(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            v = np.zeros(size, np.float32)
            text = f" {text or ''} "
            for i in range(len(text) - n + 1):
                h = zlib.crc32(text[i : i + n].encode())
                v[h % size] += 1 if h & 0x10000 else -1
            norm = np.linalg.norm(v)
            out.append((v / norm if norm else v).tolist())
        return pd.Series(out)

    return encode


def encode_texts(df: DataFrame, text: str, encoder: Callable | None = None, vector: str = "embedding") -> DataFrame:
    """df with a vector for each text. encoder is a column function, such as one made by predict_batch_udf from a model."""
    return df.withColumn(vector, (encoder or hashed_ngram_vectors())(F.col(text)))
