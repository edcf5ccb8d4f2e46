"""Registered queries in file order, over streams and with the answer journal, with their SQL oracles. Each writes a driver
table in an order that SQL can name (the hash of the key), as files, and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.functions.hashing import seeded_md5
from asrprep.operators import file_order
from asrprep.operators.enrich import HashSigner
from asrprep.operators.journal import Journal, enrich_journaled
from asrprep.plans.prep_queries import _REFRESH_SQL, SPLITS, refresh_paths
from asrprep.plans.stand_ins import table
from asrprep.session import scratch_path
from asrprep.streaming.shuffle import LazyShuffle

FILE_ROWS = 5_000
BUFFER = 200
BATCH, SUB_BATCH = 1000, 32


def _written(spark: SparkSession, df: DataFrame, name: str, *first: str) -> str:
    """``df`` as files of a few thousand rows in the order of ``first`` and the key's hash."""
    path = scratch_path(spark, name)
    n = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    w = (df.repartitionByRange(n, *first, seeded_md5("file", "doc_id"), "doc_id")
         .sortWithinPartitions(*first, seeded_md5("file", "doc_id"), "doc_id").write.option("maxRecordsPerFile", str(FILE_ROWS)))
    (w.partitionBy(*first) if first else w).parquet(path)
    return path


def batch_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), "in-file-order")
    return file_order.batches_in_file_order(spark.read.parquet(path).select("doc_id"), BATCH, SUB_BATCH)


def interleave_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = SPLITS.split("+")
    d = table(spark, sf_dir, "documents").where(F.col("lang").isin(names)).select("doc_id", "lang")
    path = _written(spark, d, "splits", "lang")
    scans = {n: spark.read.schema("doc_id long").parquet(f"{path}/lang={n}") for n in names
             if not d.where(F.col("lang") == n).isEmpty()}
    if len(scans) < len(names):  # a split without rows: no whole round
        return spark.createDataFrame([], "doc_id long, pos long, lang string, seq long")
    return file_order.interleave_scans(scans, "lang")


def _in_name_order(spark: SparkSession, path: str) -> None:
    """Sets the files' times a second apart in the order of their names, so that a stream takes them in that order."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in fs.listStatus(root) if f.getPath().getName().endswith(".parquet")), key=lambda p: p.getName())
    for k, p in enumerate(files):
        fs.setTimes(p, 1_600_000_000_000 + 1000 * k, -1)


def lazy_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream of files through a shuffle buffer, in two runs: the second goes on from the buffer of the first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    path = _written(spark, docs, "lazy")
    _in_name_order(spark, path)
    files = len(spark.read.parquet(path).inputFiles())
    work = LazyShuffle(spark, path, docs.schema, scratch_path(spark, "lazy-out"), "doc_id", BUFFER, files_a_batch=1 + files // 4)
    checkpoint = scratch_path(spark, "lazy-ckpt")
    work.run(checkpoint)
    work.run(checkpoint)
    return work.rows()


class ForgetfulSigner(HashSigner):
    """Signs all paths but those whose length 3 divides."""

    def __call__(self, paths):
        return [None if len(p) % 3 == 0 else a for p, a in zip(paths, super().__call__(paths))]


def enrich_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URL job in two runs: the first brings half of the pages and a signer that refuses some paths, the second all pages and a
    signer that answers. Each answer is the first run's if it had one."""
    paths = refresh_paths(spark, sf_dir).select("page_id", "path")
    book = Journal(spark, scratch_path(spark, "journal"))
    book.ask(paths.where("page_id % 2 = 0"), "page_id", "path", ForgetfulSigner(), "1-half", backoff=None)
    book.compact()
    out = enrich_journaled(paths, "page_id", "path", HashSigner(), book, "2-all", "new_audio_url", backoff=None)
    return out.select("page_id", "path", "new_audio_url", "attempts", "error", "run")


_ORDER = "md5('file:' || doc_id::VARCHAR), doc_id"

ORACLES = {
    "batch_file_order": f"""SELECT doc_id, idx, idx // {BATCH} AS batch_id, (idx % {BATCH}) // {SUB_BATCH} AS sub_batch
        FROM (SELECT doc_id, row_number() OVER (ORDER BY {_ORDER}) - 1 AS idx FROM documents)""",
    "interleave_files": f"""WITH s AS (
          SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_ORDER}) - 1 AS pos,
                 list_position({SPLITS.split('+')}, lang) - 1 AS si FROM documents WHERE lang IN {tuple(SPLITS.split('+'))}),
        m AS (SELECT CASE WHEN count(*) = {len(SPLITS.split('+'))} THEN min(c) ELSE 0 END AS r FROM (SELECT lang, count(*) AS c FROM s GROUP BY lang))
        SELECT doc_id, pos, lang, pos * {len(SPLITS.split('+'))} + si AS seq FROM s, m WHERE pos < m.r""",
    "lazy_shuffle": f"""WITH a AS (SELECT doc_id, lang, row_number() OVER (ORDER BY {_ORDER}) - 1 AS position,
               ('0x' || substr(md5('42:0:' || doc_id::VARCHAR), 1, 8))::BIGINT AS h FROM documents)
        SELECT doc_id, lang, position, row_number() OVER (ORDER BY position + (h * {BUFFER}) // 4294967296, h, doc_id::VARCHAR, position) - 1
               AS out_position FROM a""",
    "enrich_journal": f"""WITH {_REFRESH_SQL}
        SELECT page_id, path, 'https://storage.example/sign/' || path || '?token=' || substr(md5(path || ':604800'), 1, 16)
               AS new_audio_url, 1::INTEGER AS attempts, NULL::VARCHAR AS error,
               CASE WHEN page_id % 2 = 0 AND length(path) % 3 <> 0 THEN '1-half' ELSE '2-all' END AS run FROM paths""",
}

QUERIES = {
    "batch_file_order": batch_file_order,
    "interleave_files": interleave_files,
    "lazy_shuffle": lazy_shuffle,
    "enrich_journal": enrich_journal,
}
