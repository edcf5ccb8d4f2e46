"""Explicit schemas of the logical tables."""

from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType)

CHUNKS = StructType([
    StructField("row_id", LongType(), False),
    StructField("audio_id", StringType()),
    StructField("order", IntegerType()),
    StructField("transcription", StringType()),
    StructField("corrections", StringType()),
])

MANIFEST = StructType([
    StructField("id", LongType(), False),
    StructField("new_audio_url", StringType()),
    StructField("transcription", StringType()),
])

URL_MANIFEST = StructType([StructField("audio_url", StringType())])
URL_LIST = StructType([StructField("PresignedURL", StringType())])

AUDIO = StructType([StructField("bytes", BinaryType()), StructField("path", StringType())])
AUDIO_DATASET = StructType([
    StructField("id", LongType()),
    StructField("audio", AUDIO),
    StructField("transcription", StringType()),
    StructField("split", StringType()),
])

FEATURES = StructType([
    StructField("id", LongType()),
    StructField("input_features", ArrayType(ArrayType(FloatType()))),
    StructField("input_length", DoubleType()),
    StructField("labels", ArrayType(IntegerType())),
])

LEDGER = StructType([StructField("id", LongType())])

EVAL_PAIRS = StructType([
    StructField("id", LongType()),
    StructField("ref", StringType()),
    StructField("hyp", StringType()),
])
