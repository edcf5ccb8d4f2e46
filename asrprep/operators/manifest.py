"""Preparation manifest: validity checks with reject reasons, backlog selection against the ledger
of processed ids, run counters and the ledger union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.functions.text import clean_transcription, strip
from asrprep.operators.ledger import Ledger
from asrprep.operators.selection import MERGE, any_rows, first_rows
from asrprep.session import pin

# The reject reason vocabulary, in the order the checks run.
AUDIO_MISSING = "audio_missing"
AUDIO_UNDECODABLE = "audio_undecodable"
MULTI_CHANNEL = "multi_channel"
TOO_LONG = "too_long"
FEATURE_ERROR = "feature_error"
TEXT_MISSING = "text_missing"
TEXT_BLANK = "text_blank"
TOKENIZE_ERROR = "tokenize_error"
MALFORMED_CORRECTIONS = "malformed_corrections"


def audio_format(audio_bytes) -> Column:
    """Container recognised from the leading bytes: wav, flac, ogg, mp3; null when unknown."""
    b = F.col(audio_bytes) if isinstance(audio_bytes, str) else audio_bytes
    head = F.hex(F.substring(b, 1, 12))
    return (F.when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57415645"), F.lit("wav"))
            .when(head.startswith("664C6143"), F.lit("flac"))
            .when(head.startswith("4F676753"), F.lit("ogg"))
            .when(head.startswith("494433") | head.rlike("^FF[EF][0-9A-F]"), F.lit("mp3")))


def reject_reason(audio_bytes: Column | None, text: Column, decodable: Column | None = None) -> Column:
    """First failing check, or null when the example is valid: audio present and non-empty,
    audio decodable, transcription present, transcription not blank after stripping."""
    checks = []
    if audio_bytes is not None:
        checks.append((audio_bytes.isNull() | (F.octet_length(audio_bytes) == 0), AUDIO_MISSING))
        if decodable is None:
            decodable = audio_format(audio_bytes).isNotNull()
        checks.append((~F.coalesce(decodable, F.lit(False)), AUDIO_UNDECODABLE))
    checks.append((text.isNull(), TEXT_MISSING))
    checks.append((F.length(strip(text)) == 0, TEXT_BLANK))
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def classify(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Split into (good rows, rejects with ``reject_reason``) from one expression."""
    tagged = df.withColumn("reject_reason", reason)
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def run_counters(tagged: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """Counts per outcome: ``ok`` or the reject reason (one partial+final aggregate)."""
    return (tagged.groupBy(F.coalesce(F.col(reason_col), F.lit("ok")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n")))


def select_backlog(manifest: DataFrame, ledger: DataFrame | Ledger, id_col: str = "id", text_col: str = "transcription",
                   sample_size="Full") -> DataFrame:
    """Rows still to prepare: drop rows with null text, remove ids already in the ledger (a table of ids or a
    ``Ledger``), then take the first ``sample_size`` rows by id (``'Full'`` = all). The limit counts only the rows left
    after the first two steps; only their ids are held and counted to find where it falls."""
    rows = manifest.where(F.col(text_col).isNotNull())
    todo = ledger.unseen(rows, id_col) if isinstance(ledger, Ledger) else rows.join(ledger.select(id_col), id_col, "left_anti")
    if sample_size in (None, "Full", "full"):
        return todo
    size = int(sample_size)
    if size * todo.rdd.getNumPartitions() <= MERGE:
        return todo.orderBy(id_col).limit(size)
    ids = pin(todo.select(id_col))
    cut = first_rows(ids, [F.col(id_col)], size).agg(F.max(id_col), F.count(F.lit(1))).collect()[0]
    if cut[1] < size:
        return todo
    if cut[0] is None:
        return any_rows(todo.where(F.col(id_col).isNull()), size)
    last = F.lit(cut[0])
    before, ties = ids.agg(F.count_if(F.col(id_col).isNull() | (F.col(id_col) < last)), F.count_if(F.col(id_col) == last)).collect()[0]
    if before + ties == size:
        return todo.where(F.col(id_col).isNull() | (F.col(id_col) <= last))
    return todo.where(F.col(id_col).isNull() | (F.col(id_col) < last)).unionByName(
        any_rows(todo.where(F.col(id_col) == last), size - before))


def prepare_text(df: DataFrame, text_col: str = "transcription", lower_case: bool = False,
                 remove_punct: bool = False) -> DataFrame:
    """Transcript clean-up for preparation; adds ``reject_reason`` for missing/blank text."""
    cleaned = clean_transcription(F.col(text_col), lower_case, remove_punct)
    return (df.withColumn("reject_reason", F.when(F.col(text_col).isNull(), F.lit(TEXT_MISSING))
                          .when(F.length(cleaned) == 0, F.lit(TEXT_BLANK)))
            .withColumn(text_col, cleaned))


def ledger_union(ledger: DataFrame, new_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct union of processed ids."""
    return ledger.select(id_col).unionByName(new_ids.select(id_col)).distinct()
