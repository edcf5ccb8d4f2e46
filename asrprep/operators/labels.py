"""Vocabulary label encoding, decoding and batch collation.

The vocabulary replaces a pretrained BPE tokenizer: words ranked by corpus frequency (ties by word)
after the special ids. Encoding explodes words with their position, joins the vocabulary and regroups per row
(a group is one row's own words). A vocabulary that is measured small is broadcast. Of a larger one the smallest ids, the
most frequent words, are broadcast: they answer most tokens where those are, and only tokens of the other words, none of
them hot, are shuffled to the rest of the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from asrprep.functions.text import words as words_expr
from asrprep.operators.joins import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, checked_broadcast, estimated_bytes
from asrprep.operators.ordering import with_global_index

# Special tokens and ids, and the loss-masking pad label.
PAD, BOS, EOS, UNK = "<pad>", "<bos>", "<eos>", "<unk>"
PAD_ID, BOS_ID, EOS_ID, UNK_ID = 0, 1, 2, 3
N_SPECIAL = 4
IGNORE_INDEX = -100


def build_vocab(df: DataFrame, text_col: str = "transcription", lower_case: bool = False, min_count: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """``(word, id, freq)``; ids from ``N_SPECIAL`` on by (freq desc, word)."""
    counts = (df.select(F.explode(words_expr(F.col(text_col), lower=lower_case)).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
              .where(F.col("freq") >= F.lit(min_count)))
    ranked = with_global_index(counts, [F.col("freq").desc(), F.col("word")], "_r", num_partitions)
    return ranked.select("word", (F.col("_r") + F.lit(N_SPECIAL)).cast("int").alias("id"), F.col("freq").cast("long"))


def _look_up(toks: DataFrame, vocab: DataFrame, by: str, value: str, max_bytes: int = DEFAULT_MAX_BYTES,
             max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``toks`` left-joined with ``vocab`` (word, _vid) on ``by``; ``value`` is the other column, null where there is none."""
    n, size = estimated_bytes(vocab)
    if n <= max_rows and size <= max_bytes:
        return toks.join(F.broadcast(vocab), by, "left")
    share = min(max_rows / n, max_bytes / size)  # frequent words are rather short, so about this many fit
    frequent = F.col("_vid") < F.lit(N_SPECIAL + int(0.8 * share * n))
    near = toks.join(checked_broadcast(vocab.where(frequent), max_bytes, max_rows), by, "left")
    open_ = F.col(by).isNotNull() & F.col(value).isNull()
    far = near.where(open_).drop(value).join(vocab.where(~frequent), by, "left")
    return near.where(~open_).unionByName(far)


def encode(df: DataFrame, vocab: DataFrame, key_cols: list[str], text_col: str = "transcription",
           lower_case: bool = False, add_bos: bool = True, add_eos: bool = True, out_col: str = "labels") -> DataFrame:
    """``out_col`` = [bos] + word ids (unknown words -> unk) + [eos] for every row.

    ``posexplode_outer`` keeps rows without words as one null token, so the regrouping covers every
    row and no join back to the input is needed."""
    toks = df.select(*key_cols, F.posexplode_outer(words_expr(F.col(text_col), lower=lower_case)).alias("p", "word"))
    joined = _look_up(toks, vocab.select("word", F.col("id").alias("_vid")), "word", "_vid")
    # position and id in one long: a third of a struct's size in the shuffle, and sorted as numbers
    item = F.when(F.col("word").isNotNull(), F.shiftleft(F.col("p").cast("long"), 32)
                  .bitwiseOR(F.coalesce("_vid", F.lit(UNK_ID)).cast("long")))
    per_row = joined.groupBy(*key_cols).agg(F.sort_array(F.collect_list(item)).alias("_ids"))
    ids = F.transform("_ids", lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    if add_bos:
        ids = F.concat(F.array(F.lit(BOS_ID)), ids)
    if add_eos:
        ids = F.concat(ids, F.array(F.lit(EOS_ID)))
    return per_row.select(*key_cols, ids.cast("array<int>").alias(out_col))


def decode(df: DataFrame, vocab: DataFrame, key_cols: list[str], labels_col: str = "labels",
           out_col: str = "text") -> DataFrame:
    """Ids back to text: ``-100`` first mapped to pad, special ids skipped, words joined by one space."""
    ids = F.transform(labels_col, lambda x: F.when(x == IGNORE_INDEX, F.lit(PAD_ID)).otherwise(x))
    toks = df.select(*key_cols, F.posexplode_outer(F.filter(ids, lambda x: x >= N_SPECIAL)).alias("p", "_vid"))
    joined = _look_up(toks, vocab.select("word", F.col("id").alias("_vid")), "_vid", "word")
    item = F.when(F.col("_vid").isNotNull(), F.struct("p", F.coalesce("word", F.lit(UNK)).alias("w")))
    per_row = joined.groupBy(*key_cols).agg(F.array_sort(F.collect_list(item)).alias("_w"))
    return per_row.select(*key_cols, F.array_join(F.transform("_w", lambda s: s["w"]), " ").alias(out_col))


def collate(df: DataFrame, batch_col: str = "batch_id", labels_col: str = "labels", start_id: int = BOS_ID,
            pad_label: int = IGNORE_INDEX) -> DataFrame:
    """Pad every label list to its batch's longest with ``pad_label``; then drop the first label of
    every row of a batch when *all* rows of that batch begin with ``start_id``.

    Adds ``width`` (padded length after the cut). A window per batch: batches are small groups.
    """
    w = Window.partitionBy(batch_col)
    width = F.max(F.size(labels_col)).over(w)
    all_start = F.min(F.coalesce((F.try_element_at(labels_col, F.lit(1)) == F.lit(start_id)).cast("int"), F.lit(0))).over(w) == 1
    padded = F.concat(F.col(labels_col), F.array_repeat(F.lit(pad_label), (F.col("_width") - F.size(labels_col)).cast("int")))
    # both window expressions in one projection: one Window operator, one exchange
    out = (df.select("*", width.alias("_width"), all_start.alias("_cut"))
           .withColumn(labels_col, padded)
           .withColumn(labels_col, F.when(F.col("_cut"), F.slice(labels_col, 2, F.col("_width"))).otherwise(F.col(labels_col)))
           .withColumn("width", (F.col("_width") - F.col("_cut").cast("int")).cast("long"))
           .drop("_width", "_cut"))
    return out
