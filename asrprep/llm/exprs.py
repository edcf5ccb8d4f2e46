"""Small expression helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separators of words everywhere in this subpackage: [\x20\x09-\x0D]
WS = " \t\n\x0b\f\r"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row. A column used inside a lambda is
    computed again for every element; a lambda variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ``WS``."""
    spaced = F.translate(text, WS[1:], " " * (len(WS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def without_ws(text: Column) -> Column:
    return F.translate(text, WS, "")


def count_chars(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are in ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, mod ``n``; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n)).cast("int"), F.lit(-1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
