"""Deterministic splitting, sampling, shuffling, interleaving and batching.

Randomness is a seeded md5 of the key (``functions.hashing``), so every engine and every re-run
agrees. Global positions come from ``ordering.with_global_index`` (range partitions, never an
un-partitioned window).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asrprep.functions.hashing import seeded_hash32, seeded_md5, seeded_unit
from asrprep.operators.ordering import with_global_index, with_group_index
from asrprep.operators.selection import first_rows


def exact_fraction_sample(df: DataFrame, key_col: str, frac: float, seed: int = 42, tie_col: str | None = None) -> DataFrame:
    """Exactly ``round_half_even(frac * n)`` rows: those with the smallest ``md5(seed:key)`` (ties by ``tie_col``). The cut is
    found by counting prefixes of the hashes; the rows stay where they are."""
    k = int(round(frac * df.count()))  # Python round = half-even
    return first_rows(df, [seeded_md5(seed, key_col), F.col(tie_col or key_col)], k, step=4)


def threshold_sample(df: DataFrame, key_col: str, frac: float, seed: int = 42) -> DataFrame:
    """Scalable variant: each key kept when its hash falls below ``frac`` (no global order; the size
    is ``frac * n`` in expectation). A narrow filter, no shuffle."""
    return df.where(seeded_unit(seed, key_col) < F.lit(frac))


def train_eval_split(df: DataFrame, value_col: str, frac: float = 0.7, seed: int = 42, tie_col: str | None = None,
                     exact: bool = True) -> DataFrame:
    """Add ``split`` = 'train' for the sample and 'eval' for the rows whose *value* is not in the
    sample (rows sharing a value with a training row belong to neither and are left out)."""
    train = (exact_fraction_sample(df, value_col, frac, seed, tie_col) if exact
             else threshold_sample(df, value_col, frac, seed))
    train_values = train.select(value_col).distinct()
    evals = df.join(train_values, value_col, "left_anti")
    return (train.withColumn("split", F.lit("train"))
            .unionByName(evals.withColumn("split", F.lit("eval"))))


def train_test_split(df: DataFrame, key_col: str, test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """``split`` = 'test' for keys whose seeded hash falls below ``test_size``, else 'train'."""
    return df.withColumn("split", F.when(seeded_unit(seed, key_col) < F.lit(test_size), F.lit("test"))
                         .otherwise(F.lit("train")))


def sample_k(df: DataFrame, key_col: str, k: int, seed: int = 42) -> DataFrame:
    """``k`` rows without replacement: smallest ``md5(seed:key)``, in no particular order."""
    return first_rows(df, [seeded_md5(seed, key_col), F.col(key_col)], k, step=4)


def shuffle_positions(df: DataFrame, key_col: str, epochs=(0,), seed: int = 42, num_shards: int = 128,
                      num_partitions: int | None = None) -> DataFrame:
    """Per-epoch permutation: ``position`` = rank of ``md5(seed:epoch:key)`` within the epoch, and
    ``shard`` = the key's shard (stable across epochs)."""
    per_epoch = [df.withColumn("epoch", F.lit(int(e)).cast("int")) for e in epochs]
    allep = reduce(DataFrame.unionByName, per_epoch)
    allep = allep.withColumn("_h", seeded_md5(seed, F.col("epoch"), key_col))
    out = with_group_index(allep, ["epoch"], [F.col("_h"), F.col(key_col)], "position", num_partitions)
    return (out.withColumn("shard", F.pmod(seeded_hash32(seed, key_col), F.lit(num_shards)).cast("int"))
            .drop("_h"))


def sharded_shuffle(df: DataFrame, key_col: str, epoch: int = 0, seed: int = 42, num_shards: int = 128) -> DataFrame:
    """Training-time stream order: ``num_shards`` partitions by key, each sorted by the epoch hash."""
    return (df.repartition(num_shards, F.col(key_col))
            .sortWithinPartitions(seeded_md5(seed, F.lit(epoch), key_col)))


def interleave(df: DataFrame, split_col: str, splits: str | list[str], order_col: str,
               num_partitions: int | None = None) -> DataFrame:
    """Round-robin interleave of the splits named ``'a+b+c'``: ``pos`` = position inside the split
    (by ``order_col``), ``seq`` = global sequence ``pos * k + split_index``. Only whole rounds are
    kept: positions below the smallest split size."""
    names = splits.split("+") if isinstance(splits, str) else list(splits)
    idx = F.array_position(F.array(*[F.lit(s) for s in names]), F.col(split_col)) - 1
    chosen = df.where(F.col(split_col).isin(names)).withColumn("_split_idx", idx.cast("long"))
    ranked = with_group_index(chosen, [split_col], [F.col(order_col)], "pos", num_partitions)
    sizes = chosen.groupBy(split_col).count().collect()  # one row per named split
    counts = {r[split_col]: r["count"] for r in sizes}
    rounds = min(counts.get(s, 0) for s in names)
    return (ranked.where(F.col("pos") < F.lit(rounds))
            .withColumn("seq", F.col("pos") * F.lit(len(names)) + F.col("_split_idx"))
            .drop("_split_idx"))


def assign_batches(df: DataFrame, order_col: str, batch_size: int = 1000, sub_batch_size: int | None = 32,
                   num_partitions: int | None = None) -> DataFrame:
    """Fixed-size batches in ``order_col`` order: ``idx``, ``batch_id`` = idx div size, and
    ``sub_batch`` = position div sub size inside the batch."""
    out = with_global_index(df, [F.col(order_col)], "idx", num_partitions)
    out = out.withColumn("batch_id", F.floor(F.col("idx") / F.lit(batch_size)).cast("long"))
    if sub_batch_size:
        out = out.withColumn("sub_batch", F.floor(F.pmod(F.col("idx"), F.lit(batch_size)) / F.lit(sub_batch_size)).cast("long"))
    return out
