"""Exact dedup by distributed MSD radix partitioning.

Documents are split by their length and first bytes, then each group by its next bytes, until a group is a single
document or all its texts have ended. Texts are compared byte by byte in the shuffle keys; no digest decides equality.
The radix grows from round to round up to a bound, so a text of n bytes takes about log16(n) rounds and one more for every
MAX_DIGIT bytes, and only documents that still share everything read so far go to the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, without

FIRST_BYTES = 64
GROWTH = 16
#: The widest digit: shuffle keys are no longer than this, and longer texts take a round for each.
MAX_DIGIT = 1 << 18


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first_bytes: int = FIRST_BYTES) -> DataFrame:
    """One row per row of docs: id, keep_id (largest id among equal texts), group_size, kept, text_sha256.

    Null text counts as empty, and empty texts equal each other. Rows with the same id and text are copies too: all of
    them have kept=true if that id is the largest, and drop_copies() then leaves one. Null ids lose to any other id; a
    group of null ids only has keep_id null and kept=true. An empty table gives an empty result. Only the two named
    columns are read, so others may have any name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.encode(text, "UTF-8").alias("bytes"), F.sha2(text, 256).alias("sha")).withColumn("len", F.octet_length("bytes"))
    # A group is named by its largest row name. Ids serve as row names unless they repeat; then rows are numbered and written first.
    rows = rows.withColumn("uid", F.col("id")) if repeated_ids(docs, id_col).isEmpty() else materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "rows")

    head = F.substring("bytes", 1, first_bytes)
    groups = rows.select("id", "uid", "len", head.alias("digit")).groupBy("len", "digit").agg(F.count("*").alias("n"), F.max("id").alias("keep"), F.max("uid").alias("group"))
    # Written first, so that the join below has nothing but exchanges under it and its large partitions can be split;
    # always by shuffle, as the number of groups grows with the documents.
    groups = materialize(groups.where("n > 1").select(F.col("len").alias("g_len"), F.col("digit").alias("g_digit"), "n", "keep", "group"), "groups")
    split = rows.join(groups.hint("merge"), (F.col("len") == F.col("g_len")) & (head == F.col("g_digit")), "left")
    # The text goes on only where a group has more bytes to read.
    more = F.col("n").isNotNull() & (F.col("len") > first_bytes)
    level = materialize(split.select("id", "uid", "sha", "len", "n", F.when(F.col("n").isNotNull(), F.col("keep")).otherwise(F.col("id")).alias("keep"), "group", F.when(more, F.expr(f"substring(bytes, {first_bytes + 1})")).alias("bytes")), "radix")
    done = [level.where("bytes is null").select("id", "sha", F.coalesce("n", F.lit(1)).alias("n"), "keep")]
    width = min(first_bytes * GROWTH, MAX_DIGIT)
    active = level.where("bytes is not null")
    # Each round's groups are those of the round before and the next bytes; length is equal within a group.
    while (left := active.agg(F.max(F.octet_length("bytes"))).first()[0]) is not None:
        digit = F.substring("bytes", 1, width)
        keys = active.select("id", "uid", "len", F.col("group").alias("g_group"), digit.alias("g_digit")).groupBy("g_group", "len", "g_digit").agg(F.count("*").alias("g_n"), F.max("id").alias("g_keep"), F.max("uid").alias("g_next"))
        keys = materialize(keys.withColumnRenamed("len", "g_len"), "groups")
        split = active.join(keys.hint("merge"), F.col("group").eqNullSafe(F.col("g_group")) & (F.col("len") == F.col("g_len")) & (digit == F.col("g_digit")))
        more = (F.col("g_n") > 1) & (F.octet_length("bytes") > width)
        level = materialize(split.select("id", "uid", "sha", "len", F.col("g_n").alias("n"), F.col("g_keep").alias("keep"), F.col("g_next").alias("group"), F.when(more, F.expr(f"substring(bytes, {width + 1})")).alias("bytes")), "radix")
        done.append(level.where("bytes is null").select("id", "sha", "n", "keep"))
        active = level.where("bytes is not null")
        if left <= width:
            break
        width = min(width * GROWTH, MAX_DIGIT)
    out = reduce(DataFrame.unionByName, done)
    kept = F.col("id").eqNullSafe(F.col("keep"))
    return out.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").cast("long").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def repeated_ids(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.groupBy(id_col).count().where("count > 1").select(id_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without copies: of equal texts the row with the largest id stays. All columns are kept as they are.

    Repeated rows (same id and text) leave one row. Rows without id stay. Other columns may have any names. An id that stands on different texts leaves all of them if one of
    them is dropped, because ids name documents here.
    """
    verdicts = materialize(exact_groups(docs, id_col, text_col), "copies")
    left = without(docs, id_col, verdicts.where("not kept").select(id_col).distinct())
    if verdicts.where("kept and group_size > 1").groupBy(id_col).count().where("count > 1").isEmpty():
        return left
    return left.dropDuplicates([id_col, text_col])
