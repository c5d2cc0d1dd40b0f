"""Newline-delimited JSON objects with a schema inferred from the first rows."""

from __future__ import annotations

import json
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawscan import args, config
from rawscan.errors import RawScanError
from rawscan.sources.text import BLANKS, records, without_return
from rawscan.storage import pinned

# Accepted type names.
TYPES = {
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "BIGINT": T.LongType(), "LONG": T.LongType(), "INT64": T.LongType(),
    "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "DECIMAL": T.DoubleType(), "VARCHAR": T.StringType(), "STRING": T.StringType(),
    "JSON": T.StringType(), "TEXT": T.StringType(),
}
#: Stands after each line while it is checked.
_MARK = "rawscan-mark-6f2d9c1e"


class _Raw(str):
    """A number as it is written."""


def _fail(constant):
    raise ValueError(f"{constant} is not JSON")


def parse_object(line: str) -> list[tuple[str, object]]:
    """The fields of one JSON object in their order; numbers as written."""

    def pairs(found):
        return _Fields(found)

    try:
        value = json.loads(line, object_pairs_hook=pairs, parse_constant=_fail, parse_int=_Raw, parse_float=_Raw)
    except (ValueError, RecursionError) as e:
        raise RawScanError(f"Invalid JSON: {line[:120]}") from e
    if not isinstance(value, _Fields):
        raise RawScanError(f"Each line must be a JSON object: {line[:120]}")
    return list(value)


class _Fields(list):
    """Pairs of an object, so that arrays and objects differ."""


def type_of(value) -> T.DataType:
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, _Raw):
        whole = value.lstrip("-").isdigit() and -(1 << 63) <= int(value) < 1 << 63
        return T.LongType() if whole else T.DoubleType()
    return T.StringType()


def merged(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    return T.DoubleType() if {a, b} == {T.LongType(), T.DoubleType()} else T.StringType()


def infer(lines) -> dict[str, T.DataType]:
    """Columns in first-seen order from sample lines. A null makes its column text for good."""
    columns: dict[str, T.DataType] = {}
    for line in lines:
        for name, value in dict(parse_object(line)).items():
            kind = type_of(value)
            columns[name] = merged(columns[name], kind) if name in columns else kind
    if not columns:
        raise RawScanError("No JSON object with fields was found")
    return columns


def additional(text: str) -> dict[str, T.DataType]:
    """Columns of a list such as `name:type, other:type`."""
    found = {}
    for entry in (text or "").split(","):
        if not entry.strip():
            continue
        name, colon, kind = entry.partition(":")
        if not colon or not name.strip() or not kind.strip():
            raise RawScanError(f"Invalid column definition: {entry.strip()}")
        if kind.strip().upper() not in TYPES:
            raise RawScanError(f"Unsupported type: {kind.strip()}")
        found[name.strip()] = TYPES[kind.strip().upper()]
    return found


def _valid(value: Column) -> Column:
    """Whether a line is one JSON object and nothing else.

    The line stands in an array before a marked object. Both must be all that the array has: text that ends the array
    early hides the mark, a second value makes three, and other text is not JSON.
    """
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    both = F.from_json(F.concat(F.lit("["), value, F.lit(f',{{"{_MARK}":1}}]')), f"array<struct<`{_MARK}`:int>>", options)
    alone = lambda b: (F.size(b) == 2) & F.get(b, F.lit(0)).isNotNull() & (F.get(b, F.lit(1))[_MARK] == 1)
    return F.coalesce(F.exists(F.array(both), alone), F.lit(False))  # so that it is parsed once


def _as_written(line: Column) -> Column:
    """The scalars of the line's object, in their order: structs of key and, for numbers, the value as it is written.

    A fold over the line's pieces, which are escapes, quotes, brackets, colons, commas and what stands between these.
    """
    pieces = F.regexp_extract_all(line, F.lit(r'(?s)\\.|"|[{}\[\],:]|[^\\"{}\[\],:]+'), F.lit(0))
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(False).alias("quoted"),
        F.lit(False).alias("value"),
        F.lit("").alias("key"),
        F.array().cast("array<struct<key:string,written:string>>").alias("found"),
    )

    def step(st, x):
        here, quote = st["depth"] == 1, x == '"'
        found = lambda written: F.array_append(st["found"], F.struct(st["key"].alias("key"), written.alias("written")))
        scalar = here & st["value"] & ~st["quoted"] & ~x.rlike("^(?:[{}\\[\\],:]|\\s*)$")
        plain = ~st["quoted"]
        return F.struct(
            F.when(plain & x.isin("{", "["), st["depth"] + 1).when(plain & x.isin("}", "]"), st["depth"] - 1).otherwise(st["depth"]).alias("depth"),
            F.when(quote, plain).otherwise(st["quoted"]).alias("quoted"),
            F.when(plain & here & (x == ":"), True).when(plain & here & (x == ","), False).otherwise(st["value"]).alias("value"),
            F.when(~here | st["value"], st["key"]).when(quote & plain, "").when(st["quoted"] & ~quote, F.concat(st["key"], x)).otherwise(st["key"]).alias("key"),
            F.when(scalar & ~quote, found(F.when(x.rlike("^\\s*-?[0-9]"), F.btrim(x, F.lit(" \t\r\n")))))
            .when(scalar & quote, found(F.lit(None).cast("string")))
            .otherwise(st["found"])
            .alias("found"),
        )

    told = lambda x: F.when(F.contains(x["key"], F.lit("\\")), F.get(F.from_json(F.concat(F.lit('["'), x["key"], F.lit('"]')), "array<string>"), F.lit(0))).otherwise(x["key"])
    return F.transform(F.aggregate(pieces, start, step, lambda st: st["found"]), lambda x: F.struct(told(x).alias("key"), x["written"].alias("written")))


def json_load(
    spark: SparkSession,
    path: str,
    encoding: str = "UTF-8",
    split_size_mb: int = -1,
    schema_sample_rows: int = 100,
    additional_columns: str = "",
    exact_numbers: bool = True,
) -> DataFrame:
    """One row for each line that isn't blank; a line that is not one JSON object fails the query, whatever is selected.

    A value of another type than its column's is null. Text columns get strings as they are, other scalars as they are
    written, containers as compact JSON. Lines with numbers that Spark would write otherwise than they stand there are
    folded over once more for them, unless exact_numbers is false.
    """
    target = args.require_path(path)
    charset, split, rows = args.charset(encoding), config.split_bytes(spark, split_size_mb), args.sample_rows(schema_sample_rows)
    pin = pinned(spark, target)
    lines = records(spark, pin, "\n", charset, split).select(without_return(F.col("value")).alias("value"))
    lines = lines.where(F.btrim("value", F.lit(" \t\r\n" if charset == "UTF-8" else BLANKS)) != "")
    columns = infer(islice((r.value for r in lines.limit(rows).collect()), rows)) | additional(additional_columns)
    checked = lines.where(
        F.when(_valid(F.col("value")), True).otherwise(F.raise_error(F.concat(F.lit("Invalid JSON object: "), F.substring("value", 1, 120))).cast("boolean"))
    )
    schema = T.StructType([T.StructField(n, t) for n, t in columns.items()])
    parsed = checked.select("value", F.from_json("value", schema).alias("j"))
    texts = [n for n, t in columns.items() if t == T.StringType()]
    field = lambda n: F.col("j").getField(n)
    named = lambda n: lambda x: x["key"] == n
    out = []
    if texts and exact_numbers:
        numeric = F.lit(False)
        for n in texts:
            numeric = numeric | F.coalesce(field(n).rlike("^-?[0-9]"), F.lit(False))
        odd = numeric & F.col("value").rlike("[0-9]\\.[0-9]|[0-9][eE]|[0-9]{17}|-0")
        parsed = parsed.withColumn("w", F.when(odd, _as_written(F.col("value"))))
    for n, t in columns.items():
        c = field(n)
        if t == T.DoubleType():
            c = F.when(~F.isnan(c), c)
        elif t == T.StringType() and exact_numbers:
            written = F.try_element_at(F.filter("w", named(n)), F.lit(-1))["written"]
            c = F.when(c.rlike("^-?[0-9]") & written.isNotNull(), written).otherwise(c)
        out.append(c.alias(n))
    return parsed.select(*out)
