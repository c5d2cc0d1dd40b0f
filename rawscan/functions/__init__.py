"""Scalar functions of the other dialect as temporary SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Name, parameters, result type and body of each function.
_FUNCTIONS = [
    ("split_to_map", "t STRING, entry STRING, pair STRING", "MAP<STRING, STRING>", "str_to_map(t, concat('\\\\Q', entry, '\\\\E'), concat('\\\\Q', pair, '\\\\E'))"),
    ("json_extract_scalar", "t STRING, p STRING", "STRING", "get_json_object(t, p)"),
    ("strpos", "t STRING, s STRING", "BIGINT", "cast(locate(s, t) AS BIGINT)"),
    ("codepoint", "c STRING", "INT", "ascii(c)"),
    ("from_utf8", "b BINARY", "STRING", "make_valid_utf8(cast(b AS STRING))"),
    ("to_utf8", "t STRING", "BINARY", "cast(t AS BINARY)"),
]


def register(spark: SparkSession) -> None:
    """Makes the functions known to spark.sql in this session."""
    for name, parameters, result, body in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
