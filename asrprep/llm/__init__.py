"""Training-data preparation operators: text quality, deduplication, language-model scoring,
tokenisation and packing. Nothing else in the library imports this subpackage."""
