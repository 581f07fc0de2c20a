"""Scalar, aggregate and table functions, as column expressions and as registered SQL functions."""

from tidemark.functions.library import (
    java_split,
    string_hash,
    register_functions,
    split_words,
    weighted_average,
)

__all__ = ["java_split", "string_hash", "register_functions", "split_words", "weighted_average"]
