"""Command-line jobs (``python -m asrprep.cli <job> ...`` or through ``spark-submit``).

Each job reads its input, composes library functions and writes its output; the session comes
from ``get_spark`` (the submitted master and configuration win).

    curate INPUT.csv OUTPUT [--min-pair-freq 2] [--similarity 0.7] [--min-word-freq 3]
           [--metric sequence|edit] [--audit-out DIR] [--rejects-out DIR]
    prepare --input-csv MANIFEST.csv --out DIR [--sample-size Full|N] [--ledger-json FILE]
            [--audio [--loader module:callable] [--features module:callable] [--vocab DIR] [--run NAME]]
    refresh-urls INPUT.csv --output OUT [--failed FAILED] [--signer module:callable] [--batch-size 1000] [--journal DIR]
    split-urls INPUT.csv --out DIR [--frac 0.7] [--seed 42] [--column PresignedURL]
    wer PAIRS [--normalize] [--ref ref] [--hyp hyp]
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import functions as F

from asrprep.functions.text import clean_transcription
from asrprep.functions.urls import file_name, object_path, prefix_missing
from asrprep.operators import curation, features, labels, preparation, sampling, scoring
from asrprep.operators.enrich import HashSigner, enrich
from asrprep.operators.journal import Journal, enrich_journaled
from asrprep.operators.manifest import run_counters
from asrprep.session import get_spark, pin
from asrprep.sources import io as aio
from asrprep.sources.locations import open_location
from asrprep.streaming import prepare as prep


def _read_table(spark, path, fmt=None):
    """A Parquet or CSV table on any file system, by ``fmt`` or by the path's ending."""
    if (fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")) == "csv":
        return aio.read_csv(spark, path)
    return spark.read.parquet(path)


def run_curate(args) -> None:
    spark = get_spark()
    raw = aio.read_csv(spark, args.input)
    cols = raw.columns
    df = raw.withColumn("order", F.col("order").cast("double")) if "order" in cols else raw
    # the input has no row key: assign one and pin it, so every later pass sees the same ids
    df = pin(df.withColumn("_row_id", F.monotonically_increasing_id()))
    res = curation.curate(df, ["_row_id"], min_pair_freq=args.min_pair_freq, similarity_threshold=args.similarity,
                          min_word_freq=args.min_word_freq, metric=args.metric)
    aio.write_csv(res.kept.select(*cols), args.output)
    if args.audit_out:
        res.audit.write.mode("overwrite").parquet(args.audit_out)
    if args.rejects_out:
        res.rejects.select(*cols, "reject_reason").write.mode("overwrite").parquet(args.rejects_out)


def run_prepare(args) -> None:
    spark = get_spark()
    manifest = aio.read_csv(spark, args.input_csv, "id long, new_audio_url string, transcription string")
    if args.ledger_json:  # ids recorded by an earlier run are skipped; a named ledger must exist
        done = aio.read_ledger_json(spark, args.ledger_json)
        manifest = manifest.join(done, "id", "left_anti")
    if args.audio:
        _prepare_audio(spark, manifest, args)
        return
    _, counters = prep.prepare_batch(spark, manifest, args.out, sample_size=args.sample_size,
                                     lower_case=args.lower_case, remove_punct=args.remove_punctuation)
    print(json.dumps(counters))


def _prepare_audio(spark, manifest, args) -> None:
    """Features and label ids as well: loader and feature function by name, the vocabulary given or made of the manifest."""
    texts = manifest.select(clean_transcription(F.col("transcription"), args.lower_case, args.remove_punctuation).alias("transcription"))
    vocab = spark.read.parquet(args.vocab) if args.vocab else pin(labels.build_vocab(texts))
    loader = _named(args.loader) if args.loader else open_location
    featurise = _named(args.features) if args.features else features.WavFeatures()
    run = args.run or spark.sql("SELECT date_format(current_timestamp(), 'yyyyMMdd_HHmmss')").collect()[0][0]
    preparation.prepare_features_batch(spark, manifest, args.out, run, loader, featurise, vocab, args.sample_size,
                                       lower_case=args.lower_case, remove_punct=args.remove_punctuation,
                                       tries=args.tries, delay=args.delay)
    done = preparation.prepared(spark, args.out, None).where(F.col("run") == run)
    counters = {r["outcome"]: r["n"] for r in run_counters(done).collect()}
    print(json.dumps({"run": run, **dict(sorted(counters.items()))}))


def _named(spec: str):
    """``module:name``; a class is called without arguments."""
    module, _, name = spec.partition(":")
    found = getattr(importlib.import_module(module), name)
    return found() if isinstance(found, type) else found


def _load_signer(spec: str | None):
    if not spec:
        return HashSigner()
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)()


def run_refresh_urls(args) -> None:
    spark = get_spark()
    data = aio.read_csv(spark, args.input, "audio_url string").drop("new_audio_url", "path")
    data = data.withColumn("_row_id", F.monotonically_increasing_id())
    data = pin(data.withColumn("path", object_path("audio_url")).withColumn("prefix_missing", prefix_missing("audio_url")))
    if args.journal:  # answers of earlier runs are read back, new ones are kept as they come
        book = Journal(spark, args.journal)
        run = spark.sql("SELECT date_format(current_timestamp(), 'yyyyMMdd_HHmmss')").collect()[0][0]
        out = pin(enrich_journaled(data, "path", "path", _load_signer(args.signer), book, run, "new_audio_url",
                                   batch_size=args.batch_size))
        book.compact()
    else:
        signed = enrich(data.select("_row_id", "path"), "_row_id", "path", _load_signer(args.signer),
                        out_col="new_audio_url", batch_size=args.batch_size)
        out = pin(data.join(signed.select("_row_id", "new_audio_url", "attempts", "error"), "_row_id", "left"))
    columns = [c for c in data.columns if c not in ("_row_id", "path", "prefix_missing", "new_audio_url")]
    aio.write_csv(out.select(*columns, "new_audio_url"), args.output)
    if args.failed:
        aio.write_csv(out.where(F.col("error").isNotNull()).select(*columns, "path", "error"), args.failed)


def run_split_urls(args) -> None:
    spark = get_spark()
    urls = aio.read_csv(spark, args.input, f"{args.column} string").withColumn("_row_id", F.monotonically_increasing_id())
    urls = pin(urls)
    split = sampling.train_eval_split(urls, args.column, args.frac, args.seed, tie_col="_row_id")
    out = split.select(args.column, "split", file_name(args.column).alias("file_name"))
    out.write.mode("overwrite").partitionBy("split").parquet(args.out)


def run_wer(args) -> None:
    spark = get_spark()
    pairs = _read_table(spark, args.pairs, args.format)
    scored = scoring.score_pairs(pairs, args.ref, args.hyp, normalize=args.normalize)
    print(json.dumps(scoring.corpus_wer(scored).collect()[0].asDict()))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="asrprep")
    sub = p.add_subparsers(dest="job", required=True)

    c = sub.add_parser("curate", help="judge and apply word corrections to transcript chunks")
    c.add_argument("input")
    c.add_argument("output")
    c.add_argument("--min-pair-freq", type=int, default=2)
    c.add_argument("--similarity", type=float, default=0.7)
    c.add_argument("--min-word-freq", type=int, default=3)
    c.add_argument("--metric", choices=["sequence", "edit"], default="sequence")
    c.add_argument("--audit-out")
    c.add_argument("--rejects-out")
    c.set_defaults(fn=run_curate)

    r = sub.add_parser("prepare", help="resumable preparation of a manifest (text checks, rejects, ledger)")
    r.add_argument("--input-csv", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--sample-size", default="Full")
    r.add_argument("--ledger-json")
    r.add_argument("--lower-case", action="store_true")
    r.add_argument("--remove-punctuation", action="store_true")
    r.add_argument("--audio", action="store_true", help="load new_audio_url and write features and label ids too")
    r.add_argument("--loader", help="module:callable, location -> bytes (default: data: and file: locations)")
    r.add_argument("--features", help="module:callable, bytes -> (array, seconds) (default: log-Mel of WAV)")
    r.add_argument("--vocab", help="Parquet table (word, id); default: the manifest's words")
    r.add_argument("--run", help="name of the run (default: the time); a run that was committed is not repeated")
    r.add_argument("--tries", type=int, default=3)
    r.add_argument("--delay", type=float, default=5.0)
    r.set_defaults(fn=run_prepare)

    u = sub.add_parser("refresh-urls", help="expired URL -> object path -> new signed URL, keyed")
    u.add_argument("input")
    u.add_argument("--output", default="updated_dataset_with_presigned_urls.csv")
    u.add_argument("--failed", default="failed_rows.csv")
    u.add_argument("--journal", help="folder for the answers; a repeated job asks only for what it lacks")
    u.add_argument("--signer", help="module:callable returning a signer(list[str]) -> list[str]")
    u.add_argument("--batch-size", type=int, default=1000)
    u.set_defaults(fn=run_refresh_urls)

    s = sub.add_parser("split-urls", help="exact seeded 70/30 split of a URL list with file names")
    s.add_argument("input")
    s.add_argument("--out", required=True)
    s.add_argument("--frac", type=float, default=0.7)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--column", default="PresignedURL")
    s.set_defaults(fn=run_split_urls)

    w = sub.add_parser("wer", help="corpus word error rate of (ref, hyp) pairs")
    w.add_argument("pairs")
    w.add_argument("--normalize", action="store_true")
    w.add_argument("--format", choices=["csv", "parquet"], help="default: by the path's ending")
    w.add_argument("--ref", default="ref")
    w.add_argument("--hyp", default="hyp")
    w.set_defaults(fn=run_wer)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
