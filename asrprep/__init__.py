"""asrprep: Spark-native preparation and scoring of speech-recognition text corpora.

Public functions take and return ``DataFrame`` / ``Column`` objects. Thresholds are keyword
arguments whose defaults are the values the original scripts use.
"""

from asrprep.session import checkpoint_dir, get_spark, pin, prepare_session

__all__ = ["get_spark", "prepare_session", "checkpoint_dir", "pin"]
