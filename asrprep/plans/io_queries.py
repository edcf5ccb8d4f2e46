"""Registered source/sink queries: each writes data Spark derives from a driver table to the shared
scratch folder and reads it back through the library's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.operators import sampling
from asrprep.plans.stand_ins import table
from asrprep.session import scratch_path
from asrprep.sources import io as aio
from asrprep.sources.locations import read_locations

SEED = 42


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, "csv-roundtrip")
    aio.write_csv(d, path)
    return aio.read_csv(spark, path, "doc_id long, lang string, text string")


def ledger_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    path = scratch_path(spark, "ledger-json")
    aio.write_ledger_json(ids, path)
    return aio.read_ledger_json(spark, path)


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with more columns, in another order, than the reader names: all come back, by name."""
    path = scratch_path(spark, "csv-by-name")
    aio.write_csv(table(spark, sf_dir, "documents").select("source", "text", "n_chars", "doc_id", "lang"), path)
    return aio.read_csv(spark, path, "doc_id long, n_chars long")


def audio_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page stored as one object (the text writer, a file per record, many to a folder; the page's
    number is the first line), ingested with the binary-file reader: size and status per object."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    path = scratch_path(spark, "objects")
    pages.select(F.concat_ws("\n", "page_id", "html")).write.option("maxRecordsPerFile", "1").text(path)
    files = aio.read_audio_files(spark, path, glob="*.txt")
    number = F.split(F.decode(F.substring("content", 1, 24), "ISO-8859-1"), "\n")[0]
    return files.select(number.cast("long").alias("page_id"), (F.col("length") - F.length(number) - 1).alias("length"), "status")


class PageClient:
    """Pages behind URLs, with the body as the location's query: one in five is gone, empty, fails twice or always fails."""

    def __init__(self):
        self.calls: dict = {}

    def __call__(self, location: str) -> bytes:
        import base64
        kind, body = location.split("?", 1)[1].split("=", 1)
        self.calls[location] = self.calls.get(location, 0) + 1
        if kind == "gone":
            raise FileNotFoundError("404")
        if kind == "broken" or (kind == "late" and self.calls[location] % 3):
            raise OSError("try again")
        return b"" if kind == "empty" else base64.b64decode(body)


def ingest_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page fetched by its location, with its name, length, status and the number of tries."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    kinds = F.array(*[F.lit(k) for k in ("gone", "empty", "late", "broken", "fine")])
    where = F.concat(F.substring_index("url", "?", 1), F.lit("?"), F.get(kinds, (F.col("page_id") % 5).cast("int")), F.lit("="),
                     F.base64(F.encode("html", "UTF-8")))
    rows = pages.select("page_id", F.when(F.col("page_id") % 11 != 0, where).alias("location"))
    return read_locations(rows, "location", PageClient, ("page_id",), delay=0, with_content=False).select(
        "page_id", "file_name", "length", "status", "attempts")


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    return sampling.train_test_split(d, "doc_id", test_size=0.1, seed=SEED)


ORACLES = {
    "ingest_locations": """
SELECT page_id, CASE WHEN page_id % 11 != 0 THEN list_extract(string_split(string_split(url, '?')[1], '/'), -1) END AS file_name,
  CASE WHEN page_id % 11 = 0 OR page_id % 5 IN (0, 3) THEN NULL WHEN page_id % 5 = 1 THEN 0 ELSE strlen(html) END AS length,
  CASE WHEN page_id % 11 = 0 THEN 'missing' ELSE ['missing', 'empty', 'Success', 'failed', 'Success'][page_id % 5 + 1] END AS status,
  CASE WHEN page_id % 11 = 0 THEN 0 ELSE [1, 1, 3, 3, 1][page_id % 5 + 1] END AS attempts FROM pages""",
    "csv_by_name": "SELECT source, text, n_chars, doc_id, lang FROM documents",
    "csv_roundtrip": "SELECT doc_id, lang, text FROM documents",
    "ledger_roundtrip": "SELECT DISTINCT doc_id AS id FROM labels",
    "audio_ingest": "SELECT page_id, strlen(html) + 1 AS length, 'Success' AS status FROM pages",
    "train_test_split": """SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.1
                                       THEN 'test' ELSE 'train' END AS split FROM documents""",
}

QUERIES = {
    "ingest_locations": ingest_locations,
    "csv_by_name": csv_by_name,
    "csv_roundtrip": csv_roundtrip,
    "ledger_roundtrip": ledger_roundtrip,
    "audio_ingest": audio_ingest,
    "train_test_split": train_test_split,
}
