"""Sources and sinks: tab-separated source tables, stage tables in Parquet, id-list files, reports and stage markers."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.ids import config_hash, encode_id_list, encode_ids, join_ids

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A tab-separated file with a header, all texts; an empty field is an empty text, never null."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def load_source(spark: SparkSession, path: str) -> DataFrame:
    """source, id, country, name, address."""
    df = encode_ids(read_tsv(spark, path, SOURCE_COLUMNS), "entity_id", "source", "id")
    return df.select("source", "id", "country", F.col("business_name").alias("name"), F.col("business_address").alias("address"))


def explode_truth(truth: DataFrame) -> DataFrame:
    """s1, source, id of every entry of the truth's lists."""
    rows = encode_ids(truth, "source1_entity_id", "_s", "s1").select("s1", F.explode(encode_id_list(F.col("matched_entity_ids"))).alias("m"))
    return rows.select("s1", F.col("m.source").alias("source"), F.col("m.id").alias("id"))


def load_truth(spark: SparkSession, path: str) -> DataFrame:
    return explode_truth(read_tsv(spark, path, TRUTH_COLUMNS))


def save(df: DataFrame, path: str, by: str | None = None, codec: str = "zstd") -> None:
    """Parquet, replacing what was there once the job has committed. by: a column to lay out folders by, for pruning."""
    writer = df.write.mode("overwrite").option("compression", codec)
    (writer.partitionBy(by) if by else writer).parquet(path)


def load(spark: SparkSession, path: str, columns: list[str] | None = None, country: str | None = None) -> DataFrame:
    """A stage table; columns and country reach the scan."""
    df = spark.read.parquet(path)
    df = df.where(F.col("country") == country) if country is not None else df
    return df.select(*columns) if columns else df


def stage_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for stage tables, in the one that driver and executors share (spark.checkpoint.dir), deleted when the driver
    ends; a temporary one only for a local master without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where, files = _path(spark, path)
    files.deleteOnExit(where)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """df written as a stage table in a folder of its own and read back: lineage ends there, and every reader finds it, whatever executors
    are lost in between."""
    path = stage_dir(df.sparkSession, name)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Lets Arrow batches hold 4 MB instead of 64, as long texts and key lists fill a worker's memory otherwise. A smaller setting of the
    session's own is left as it is."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("67108864b", "64m"):
        spark.conf.set(name, "4m")


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed."""
    p, fs = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def pool(s2: DataFrame, s3: DataFrame) -> DataFrame:
    return s2.unionByName(s3)


def countries(df: DataFrame) -> DataFrame:
    return df.select("country").where("country is not null").distinct().orderBy("country")


def of_records(df: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """The rows with keys in ids: a semi-join, whatever the number of ids."""
    return df.join(ids.select(*keys).distinct(), list(keys), "left_semi")


def of_splits(df: DataFrame, *splits: str) -> DataFrame:
    return df.where(F.col("split").isin(*splits))


def id_set(spark: SparkSession, path: str, columns: tuple[str, ...] = SOURCE_COLUMNS) -> DataFrame:
    """The distinct ids in a file's first column."""
    return read_tsv(spark, path, columns).select(F.col(columns[0]).alias("entity_id")).distinct()


def match_targets(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[str]]:
    """All ids that may be matched, and warnings. If a file is missing, ids can't be checked: None."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        return None, [f"{p} is missing: matched ids are not checked against the sources" for p in missing]
    out = id_set(spark, paths[0])
    for p in paths[1:]:
        out = out.union(id_set(spark, p))
    return out.distinct(), []


def read_lists(spark: SparkSession, path: str, columns: tuple[str, str]) -> DataFrame:
    """An id-list file as it stands: a row without a tab has a null list; used for validation."""
    lines = spark.read.text(path).where(~F.lower("value").startswith(columns[0] + "\t"))
    cut = F.instr("value", "\t")
    return lines.select(F.when(cut > 0, F.substring("value", F.lit(1), cut - 1)).otherwise(F.col("value")).alias(columns[0]), F.when(cut > 0, F.expr("substring(value, instr(value, '\t') + 1)")).alias(columns[1]))


def format_lists(predictions: DataFrame, names: tuple[str, str] = TRUTH_COLUMNS) -> DataFrame:
    """predictions (s1, ids) as id texts: one row an S1, ids by source and number, empty for no match."""
    return predictions.select(F.concat(F.lit("S1-"), F.col("s1").cast("string")).alias(names[0]), join_ids(F.col("ids")).alias(names[1]))


def format_candidates(ranked: DataFrame, names: tuple[str, str] = ("source1_entity_id", "candidate_entity_ids")) -> DataFrame:
    """Candidate lists in rank order."""
    lists = ranked.groupBy("s1").agg(F.array_sort(F.collect_list(F.struct("rank", "source", "id"))).alias("c"))
    text = F.array_join(F.transform("c", lambda x: F.concat(F.lit("S"), x["source"].cast("string"), F.lit("-"), x["id"].cast("string"))), ",")
    return lists.select(F.concat(F.lit("S1-"), F.col("s1").cast("string")).alias(names[0]), text.alias(names[1]))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "\u0000").csv(path)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A small JSON document, through Spark's file systems."""
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(report, indent=1, sort_keys=True, default=str).encode()))
    out.close()


def _read_small(spark: SparkSession, path: str) -> str | None:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()) if exists(spark, path) else None


def read_report(spark: SparkSession, path: str) -> dict | None:
    text = _read_small(spark, path)
    return None if text is None else json.loads(text)


def mark_done(spark: SparkSession, directory: str, config: dict) -> None:
    write_report(spark, {"config": config_hash(config)}, f"{directory}/DONE.json")


def is_done(spark: SparkSession, directory: str, config: dict) -> bool:
    """True if the stage has ended under the same settings."""
    return (read_report(spark, f"{directory}/DONE.json") or {}).get("config") == config_hash(config)


def promote(spark: SparkSession, source: str, target: str) -> None:
    """Copies a chosen tier's files to their final place."""
    jvm = spark.sparkContext._jvm
    (a, fa), (b, fb) = _path(spark, source), _path(spark, target)
    fb.delete(b, True)
    jvm.org.apache.hadoop.fs.FileUtil.copy(fa, a, fb, b, False, spark.sparkContext._jsc.hadoopConfiguration())
