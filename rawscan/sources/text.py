"""Lines of an object with any record separator, in byte ranges read in parallel."""

from __future__ import annotations

import codecs
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan import args, config
from rawscan.storage import Pin, head, pinned, unchanged

# Fixed value: the characters that Java counts as white space.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
#: What Spark's decode() takes; other charsets are mapped from ISO-8859-1 or go through Arrow.
_BUILT_IN = ("ISO-8859-1", "UTF-16LE", "UTF-16BE")
_SPLIT, _OPEN_COST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


def without_return(value: Column) -> Column:
    """The value without one carriage return at its end."""
    return F.when(F.endswith(value, F.lit("\r")), F.left(value, F.length(value) - 1)).otherwise(value)


def single_bytes(charset: str) -> str | None:
    """The characters of the bytes 0 to 255 where each byte is one character by itself, else None."""
    found = []
    for b in range(256):
        c = codecs.getincrementaldecoder(charset)("replace").decode(bytes([b]))
        if len(c) != 1:
            return None
        found.append(c)
    return "".join(found)


def decoded(value: Column, charset: str) -> Column:
    """Bytes of the charset as text; malformed UTF-8 and bytes without a character become U+FFFD."""
    if charset == "UTF-8":
        return F.make_valid_utf8(value)
    if charset in _BUILT_IN:
        return F.decode(value.cast("binary"), charset)
    table = single_bytes(charset)
    if table is not None:
        other = [b for b in range(256) if table[b] != chr(b)]
        return F.translate(F.decode(value.cast("binary"), "ISO-8859-1"), "".join(map(chr, other)), "".join(table[b] for b in other))

    @F.pandas_udf("string")
    def through_codec(values: pd.Series) -> pd.Series:
        return values.map(lambda raw: None if raw is None else bytes(raw).decode(charset, "replace"))

    return through_codec(value.cast("binary"))


def resolved(spark: SparkSession, pin: Pin, charset: str) -> tuple[str, bool]:
    """The charset with its byte order, and whether the object begins with a mark of it that isn't text."""
    if charset != "UTF-16":
        return charset, False
    mark = head(spark, pin.path, 2)
    return "UTF-16LE" if mark == codecs.BOM_UTF16_LE else "UTF-16BE", mark in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)


def separator(text: str, charset: str) -> str | None:
    """The text whose UTF-8 bytes are those of the separator in the charset; None where no text has such bytes, or where
    they may also lie inside a character."""
    raw = text.encode(charset)
    try:
        found = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    inside = charset != "UTF-8" and charset not in _BUILT_IN and max(raw) >= 0x30 and single_bytes(charset) is None
    return None if inside else found


def own_scan(spark: SparkSession, settings: dict[str, str], make) -> DataFrame:
    """make(session) -> DataFrame of files, scanned under settings of its own.

    A file relation plans its splits by the settings of the session that made it. So it is made in a session beside the
    caller's, whose settings stay as they are, and handed over as a view.
    """
    beside = spark.newSession()
    for key, value in {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.files.")}.items():
        beside.conf.set(key, value)
    for key, value in settings.items():
        beside.conf.set(key, value)
    name = f"rawscan_{uuid.uuid4().hex}"
    make(beside).createGlobalTempView(name)
    found = spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{name}")
    spark.catalog.dropGlobalTempView(name)
    return found


def records(spark: SparkSession, pin: Pin, line_break: str, charset: str, split_bytes: int | None = None, first: bool = False) -> DataFrame:
    """value (decoded) of each record of a pinned object; on request also first, whether it is the object's first record,
    which makes the relation one that Spark doesn't take into correlated subqueries.

    Spark's text source splits the object into byte ranges, aligns them and gives each record to the range where it
    begins. Separators that no text can stand for in UTF-8 bytes make one range of the object.
    """
    charset, marked = resolved(spark, pin, charset)
    sep = separator(line_break, charset)

    def told(found: DataFrame) -> DataFrame:
        value = F.when(F.col("first"), F.ltrim("value", F.lit("\ufeff"))).otherwise(F.col("value")) if marked else F.col("value")
        return found.select(value.alias("value"), *(["first"] if first else []))

    if sep is None:
        scan = unchanged(spark.read.format("binaryFile").load(pin.path), pin)
        parts = F.split(decoded(F.col("content"), charset), re.escape(line_break), -1)
        whole = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
        return told(scan.select(F.posexplode(whole).alias("at", "value")).select("value", (F.col("at") == 0).alias("first")))

    def lines(session: SparkSession) -> DataFrame:
        scan = unchanged(session.read.option("lineSep", sep).text(pin.path), pin)
        begins = (F.monotonically_increasing_id() == 0) & (F.col("_metadata.file_block_start") == 0)
        return scan.select(decoded(F.col("value"), charset).alias("value"), *([begins.alias("first")] if first or marked else []))

    return told(lines(spark) if split_bytes is None else own_scan(spark, {_SPLIT: str(split_bytes)}, lines))


def in_order(spark: SparkSession, pin: Pin, sep: str) -> DataFrame:
    """raw: the bytes between the separators of a pinned object, in their order, which one task reads as a stream."""
    whole = str(pin.size + 1)

    def pieces(session: SparkSession) -> DataFrame:
        return unchanged(session.read.option("lineSep", sep).text(pin.path), pin).select(F.col("value").cast("binary").alias("raw"))

    return own_scan(spark, {_SPLIT: whole, _OPEN_COST: whole}, pieces)


def pieces_of(batches, sep: bytes, size: int) -> Iterator[tuple[bytes, bool]]:
    """Piece after piece of in_order(), and whether a separator stands after it.

    The reader takes a UTF-8 byte order mark away, so the object may be three bytes longer than its pieces.
    """
    last, at = None, 0
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            if last is not None:
                yield last, True
                at += len(sep)
            last = raw
            at += len(raw)
    if last is not None:
        yield last, size - at in (len(sep), len(sep) + 3)


def txt_load(spark: SparkSession, path: str, line_break: str = "\\n", encoding: str = "UTF-8", split_size_mb: int = -1) -> DataFrame:
    """line: each record of the object, blank ones too. A separator at the end makes no further record."""
    target = args.require_path(path)
    sep, charset = args.line_break(line_break), args.charset(encoding)
    split = config.split_bytes(spark, split_size_mb)
    return records(spark, pinned(spark, target), sep, charset, split).select(F.col("value").alias("line"))
