"""What the corpus operators share: reading tables, cutting lineage, and word rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only for a local master without that setting."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends there, lost executors cost nothing
    that was written, and later reads prune columns. The files go when the driver's JVM ends, or by discard()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tessera-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes what materialize() wrote for frames that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_tessera_path", None):
            sc = df.sparkSession.sparkContext
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def small_batches(spark: SparkSession) -> None:
    """Lets Arrow batches hold 4 MB instead of 64, so that a worker's memory depends on its longest text only. A smaller
    setting of the session's own is left as it is."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("67108864b", "64m"):
        spark.conf.set(name, "4m")


def free_name(name: str, *frames: DataFrame) -> str:
    """name, with as many underscores after it as it takes to be no column of these frames (names differ in more than case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """The rows of docs whose id isn't in the one column of gone. Rows without id stay; columns may have any names."""
    name = free_name("gone", docs)
    return docs.join(gone.toDF(name), docs[id_col] == F.col(name), "left_anti")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def null_key(*columns: str) -> Column:
    """A string that is equal for equal values, with nulls equal to nulls only."""
    return F.concat(*[F.when(F.col(c).isNull(), F.lit("n;")).otherwise(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"), F.lit(";"))) for c in columns])
