"""Readers and writers for the tables the preparation jobs exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from asrprep import schemas


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, na_tokens: list[str] | None = None,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header. Columns are found by their header names, every column of the file is
    kept as a string in the file's order, and those named in ``schema`` are cast to its types; a
    name that the header lacks is an error. Only the empty field is null unless ``na_tokens`` lists more strings to treat as missing. ``multi_line=False``
    lets Spark split files whose fields hold no line ends."""
    df = (spark.read.option("header", "true").option("multiLine", str(multi_line).lower())
          .option("escape", '"').option("mode", "PERMISSIVE")
          .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    wanted = _struct(schema).fields if schema is not None else []
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in header {df.columns}")
    types = {f.name: f.dataType for f in wanted}
    return df.select(*[_field(c, types.get(c), na_tokens) for c in df.columns])


def _struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _field(name: str, kind, na_tokens: list[str] | None):
    col = F.col(f"`{name}`")
    if na_tokens:
        col = F.when(~col.isin(*na_tokens), col)
    if kind is not None and kind.simpleString() != "string":
        col = col.try_cast(kind)
    return col.alias(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the Hadoop file system it names (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no index column; an empty result still writes its header."""
    (df.write.mode(mode).option("header", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_features(df: DataFrame, path: str, rows_per_file: int = 1000, mode: str = "append",
                   partition_cols: list[str] | None = None) -> None:
    """Parquet, snappy, at most ``rows_per_file`` rows per file (dictionary and statistics are on by
    default in the Parquet writer)."""
    w = (df.write.mode(mode).option("compression", "snappy")
         .option("maxRecordsPerFile", str(rows_per_file)))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def read_ledger_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Import ``{"processed_ids": [...]}`` checkpoint objects (one per line, any number of lines and
    files) as a distinct ``(id)`` table; ``multi_line`` for one pretty-printed object per file."""
    raw = spark.read.option("multiLine", str(multi_line).lower()).json(path)
    return raw.select(F.explode("processed_ids").alias("id")).distinct()


def write_ledger_json(df: DataFrame, path: str, id_col: str = "id", ids_per_object: int = 1 << 16) -> None:
    """Export an id table in the ``{"processed_ids": [...]}`` form: one object per ``ids_per_object``
    ids of a partition, so no object grows with the table."""
    row = F.monotonically_increasing_id()  # partition index << 33 | record number in the partition
    (df.select(id_col).withColumn("_g", F.floor(row / F.lit(ids_per_object)))
     .groupBy("_g").agg(F.collect_list(id_col).alias("processed_ids")).select("processed_ids")
     .write.mode("overwrite").json(path))


def read_audio_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Ingest audio objects as rows ``(path, file_name, length, content, status)``."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df.select("path", F.substring_index("path", "/", -1).alias("file_name"), "length", "content",
                     F.when(F.col("length") > 0, F.lit("Success")).otherwise(F.lit("empty")).alias("status"))


def read_audio_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Audio dataset stored as Parquet partitioned by ``split`` (``split=train/...``); the audio
    stays encoded bytes. Selecting a split prunes the other split directories."""
    df = spark.read.schema(schemas.AUDIO_DATASET).parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def read_stream_parquet(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(path))
