"""Mixing sources to target weights by a time-varying curriculum, with DataFrame functions only.

Targets: sources in order of their names take weights from a repeating list and share a budget of words; no source gets
more than max_epochs times its words, and what it can't take goes to the others by weight (water filling in closed form
over the sources sorted by the level at which they fill up).

Order: each source's schedule says how dense its words lie over training time t in [0, 1]: 1 + tilt * (2 t - 1). Its
integral, (1 - tilt) t + tilt t^2, is inverted at a document's share of the source's cumulative token demand, and that t is
the document's training position. A source that is taken more than once has its documents once for each epoch.

Cumulative demand needs no sort of the documents: they fall by a hash of their id into buckets of their source, running sums
go over the buckets (sources x buckets rows), and a document's place inside its bucket is the rest of its hash. The epoch
that a source takes in part takes whole buckets, so what is taken misses the target by half a bucket at most.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize, null_key, word_count

WEIGHTS = (5, 2, 1)
TILTS = (0.5, 0.0, -0.5)
BUDGET = 1.5
MAX_EPOCHS = 2
BUCKETS = 2048
#: A table of buckets with no more rows than this is broadcast (about 64 bytes each); a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def _cycle(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS, tilts: tuple = TILTS) -> DataFrame:
    """sizes: source_name, source_size (one row a source). Adds weight, tilt, target. One window over all sources: a row each."""
    by_name = Window.orderBy(F.asc_nulls_last("source_name"))
    rank = F.row_number().over(by_name)
    rows = sizes.select("*", _cycle(weights, rank).alias("weight"), _cycle(tilts, rank).alias("tilt"), (F.col("source_size") * float(max_epochs)).alias("cap"))
    full_at = F.col("cap") / F.col("weight")
    filled = Window.orderBy("full_at", F.asc_nulls_last("source_name")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("full_at", full_at)
    everything = Window.partitionBy()
    rows = rows.select("*", F.coalesce(F.sum("cap").over(filled), F.lit(0.0)).alias("cap_before"), F.coalesce(F.sum("weight").over(filled), F.lit(0.0)).alias("weight_before"), F.sum("weight").over(everything).alias("weight_all"), (F.sum("source_size").over(everything) * float(budget)).alias("demand"))
    # The level if just the sources that fill up earlier are full; the first source whose own level is not below it settles it.
    level = (F.col("demand") - F.col("cap_before")) / (F.col("weight_all") - F.col("weight_before"))
    rows = rows.withColumn("level", level)
    settled = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(settled * F.col("weight"), F.col("cap")))
    return rows.select("source_name", "source_size", "weight", "tilt", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, tilts: tuple = TILTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS, buckets: int = BUCKETS, keep: tuple = ()) -> DataFrame:
    """One row per row of docs: id, size, source_size, target, taken, copies, positions (one training position for each copy), and
    the columns in keep, unchanged.

    Null text has size 0; null sources are one source, ordered last; null ids share one hash. A source without words has target 0.
    Rows with equal ids and sources get equal places, so repeated rows are taken alike. The same rows give the same mix in any
    order and partitioning. An empty table gives an empty result. Names of other columns don't matter.
    """
    spread = F.xxhash64(F.lit("mix"), F.col(id_col).cast("string"))
    own = [F.col(c) for c in keep]
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.struct(*own).alias("own") if own else F.lit(None).cast("int").alias("own")).alias("row"), F.col(source_col).alias("source_name"), null_key(source_col).alias("source_key"), word_count(F.col(text_col)).alias("size"), F.pmod(spread, F.lit(buckets)).alias("bucket"), (F.pmod(F.shiftrightunsigned(spread, 24), F.lit(1 << 20)) / float(1 << 20)).alias("inside"))

    cells = materialize(rows.groupBy("source_name", "source_key", "bucket").agg(F.sum("size").alias("words")), "cells")
    targets = source_targets(cells.groupBy("source_name").agg(F.sum("words").alias("source_size")), weights, budget, max_epochs, tilts).select(null_key("source_name").alias("source_key"), "source_size", "tilt", "target")
    order = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = cells.select("source_key", "bucket", "words", F.coalesce(F.sum("words").over(order), F.lit(0)).alias("before")).join(targets, "source_key")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    part = F.col("target") - whole * F.col("source_size")
    copies = (whole + F.when(F.col("before") + F.col("words") / 2.0 < part, 1).otherwise(0)).cast("int")
    places = materialize(places.withColumn("copies", copies).withColumn("all_taken", F.sum(F.col("words") * F.col("copies")).over(Window.partitionBy("source_key"))), "places")
    if places.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)

    # Demand before the j-th copy: j whole epochs and what lies before in this one, as a share of all that the source is taken.
    start = lambda j: F.least(F.lit(1.0), (j * F.col("source_size") + F.col("before") + F.col("inside") * F.col("words")) / F.greatest(F.col("all_taken"), F.lit(1)))
    slope = 1 - F.col("tilt")
    at = lambda u: F.when(F.col("tilt") == 0, u).otherwise((F.sqrt(slope * slope + 4 * F.col("tilt") * u) - slope) / (2 * F.col("tilt")))
    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda j: at(start(j)))).otherwise(F.array().cast("array<double>"))
    out = rows.join(places, ["source_key", "bucket"])
    return out.select(F.col("row.id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies", positions.alias("positions"), *[F.col("row.own")[c].alias(c) for c in keep])


def in_training_order(docs: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """The rows of docs as often as the mix takes them, range-sorted by training position (then id and copy), with the columns of
    docs, whatever their names. Written as Parquet, the rows stand in this order in files in order of their names;
    stored_order() gives each its place when they are read again.
    """
    row = free_name("whole_row", docs)
    whole = docs.select(F.struct(*[docs[c].alias(c) for c in docs.columns]).alias(row), docs[id_col].alias(id_col), *[docs[c].alias(c) for c in (parameters.get("text_col", "text"), parameters.get("source_col", "source"))])
    mixed = mix(whole, id_col=id_col, keep=(row,), **parameters)
    placed = mixed.select(F.posexplode("positions").alias("copy", "position"), F.col(row).alias("whole_row"))
    return placed.orderBy("position", F.col("whole_row")[id_col], "copy").select("whole_row.*")


def stored_order(docs: DataFrame, name: str) -> DataFrame:
    """docs, as read from Parquet files that a sorted table was written to, with the column name: a long that rises in the order of
    the rows as they were written (the file's number in its name, then the row's number in the file).

    Spark reads large files first and small ones together, so the order of reading says nothing. Null if docs isn't
    read from files, or its files have no number."""
    try:
        at = docs.metadataColumn("_metadata")
        file = F.regexp_extract(at["file_name"], r"part-(\d+)-", 1)
        return docs.select("*", (file.try_cast("long") * (1 << 40) + at["row_index"]).alias(name))
    except AnalysisException:
        return docs.select("*", F.lit(None).cast("long").alias(name))
