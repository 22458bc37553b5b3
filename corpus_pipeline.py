"""The corpus pipeline: quality rules, exact dedup, MinHash near-dedup, mixing to target weights, BPE encoding and decoding.

Each stage takes all that the stage before it kept. All but the last return the columns of documents, whatever other columns there
are. The mixing stage's rows are sorted by training position, and the last stage reads each row's place from the files, so its rows,
one for each copy of a document, carry the training order whatever order Spark reads them in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import encode_documents
from tessera.llm.common import documents, free_name, materialize
from tessera.llm.exact_dedup import drop_copies
from tessera.llm.minhash import keep_one_of_each
from tessera.llm.mixing import in_training_order, stored_order
from tessera.llm.quality_rules import keep_sound


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source. Null and empty texts fail; repeated rows
    stay or go together; rows without id stay."""
    return keep_sound(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) the row with the largest id; repeated rows leave one."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of documents that share 80 % of their 5-word shingles. Texts without words are linked with
    nothing and stay, as do rows without id."""
    return keep_one_of_each(docs, shingle=5)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (not at all, once, twice), sorted by training position. Null sources are one source;
    rows without id are taken alike."""
    return in_training_order(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded text, training_order (rises with the training position) and copy (1 for a
    document's first place in the order) of each row. Null texts are encoded as empty. training_order is null, and copies are
    numbered in any order, if docs isn't read from files."""
    place = free_name("place", docs)
    rows = encode_documents(stored_order(docs, place), tokenizer_path(), keep=(place,)).withColumnRenamed(place, "training_order")
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("training_order")))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: No SQL form of robust estimates, sketches or BPE merges: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each copy of a document that the mix takes, with its tokens' digests and its place in the training order. An
    empty table of documents gives an empty result."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
