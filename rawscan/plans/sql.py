"""SQL with calls of the loaders: TABLE(catalog.format.function(name => literal, ...)) becomes a temporary view."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from rawscan import functions, sources
from rawscan.errors import RawScanError

# Schema and function of each loader, and the names of its arguments.
LOADERS = {
    ("json", "load"): (sources.json_load, ("path", "encoding", "split_size_mb", "schema_sample_rows", "additional_columns")),
    ("csv", "load"): (sources.csv_load, ("path", "delimiter", "header", "multiline", "encoding", "split_size_mb")),
    ("txt", "load"): (sources.txt_load, ("path", "line_break", "encoding", "split_size_mb")),
    ("xml", "load"): (sources.xml_load, ("path", "encoding", "row_element", "include_text", "empty_as_null", "invalid_row_column")),
    ("list", "objects"): (sources.list_objects, ("bucket", "prefix", "recursive_listing", "include_prefixes")),
    ("list", "buckets"): (sources.list_buckets, ()),
}
_TOKEN = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`(?:[^`]|``)*`|=>|\w+|\s+|.", re.S)


def _quiet(token: str) -> bool:
    return token.isspace() or token.startswith(("--", "/*"))


def _literal(token: str, negative: bool):
    if token.startswith("'"):
        return token[1:-1].replace("''", "'")
    if token.isdigit():
        return -int(token) if negative else int(token)
    if token.lower() in ("true", "false"):
        return token.lower() == "true"
    raise RawScanError(f"Arguments must be literals: {token}")


def _call(tokens: list[str], at: int):
    """(loader, arguments, index after the call) of a call TABLE(...) that begins at `at`, or None for another TABLE."""
    i = at + 1

    def nxt():
        nonlocal i
        while i < len(tokens) and _quiet(tokens[i]):
            i += 1
        i += 1
        return tokens[i - 1] if i <= len(tokens) else ""

    if nxt() != "(":
        return None
    name = [nxt()]
    while (t := nxt()) == ".":
        name.append(nxt())
    key = tuple(x.strip('"`').lower() for x in name[-2:])
    if t != "(" or len(name) < 2 or key not in LOADERS:
        return None
    loader, known = LOADERS[key]
    given, place = {}, 0
    t = nxt()
    while t != ")":
        word, back = t, i
        if nxt() == "=>":
            argument = word.strip('"').lower()
            t = nxt()
        else:
            argument, i = known[place] if place < len(known) else "", back
        negative = t == "-"
        value = _literal(nxt() if negative else t, negative)
        if argument not in known or argument in given:
            raise RawScanError(f"Unknown or repeated argument {argument.upper() or place + 1} of {'.'.join(key)}")
        given[argument] = value
        place += 1
        t = nxt()
        if t == ",":
            t = nxt()
        elif t != ")":
            raise RawScanError(f"Unexpected {t!r} in the arguments of {'.'.join(key)}")
    if nxt() != ")":
        raise RawScanError(f"TABLE({'.'.join(key)}(...)) isn't closed")
    return loader, given, i


def sql(spark: SparkSession, text: str) -> DataFrame:
    """spark.sql with loader calls, CAST to varchar without a length, double-quoted identifiers and compatible functions.

    Each call's relation is registered as a temporary view of a unique name, so that Catalyst plans over the scan itself.
    """
    functions.register(spark)
    tokens, out, i = _TOKEN.findall(text), [], 0
    while i < len(tokens):
        token = tokens[i]
        found = _call(tokens, i) if token.upper() == "TABLE" else None
        if found:
            loader, given, i = found
            view = f"rawscan_{uuid.uuid4().hex}"
            loader(spark, **given).createOrReplaceTempView(view)
            out.append(view)
            continue
        if token.startswith('"'):
            token = "`" + token[1:-1].replace('""', '"').replace("`", "``") + "`"
        elif token.upper() == "VARCHAR" and next((t for t in tokens[i + 1 :] if not _quiet(t)), "") != "(":
            token = "STRING"
        out.append(token)
        i += 1
    return spark.sql("".join(out))
