"""Delimited text: every column is text, quotes and escapes as in common CSV parsers."""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan import args, config
from rawscan.errors import RawScanError
from rawscan.shipping import ship
from rawscan.sources.text import BLANKS, in_order, pieces_of, records, resolved, separator, without_return
from rawscan.storage import pinned

QUOTE, ESCAPE = '"', "\\"


class Tokeniser:
    """Splits lines at the delimiter. A record may go on over lines while a quote is open.

    Quotes enclose; a doubled quote inside is one; the escape character takes the next quote or escape as it is and
    else vanishes outside of quotes; white space before an opening quote is ignored.
    """

    def __init__(self, delimiter: str):
        self.special = re.compile("[" + re.escape(QUOTE + ESCAPE + delimiter) + "]")
        self.fields: list[str] = []
        self.field: list[str] = []
        self.open = False

    def line(self, text: str) -> list[str] | None:
        """The fields of the record that ends with this line, or None while a quote is open."""
        if self.open:
            self.field.append("\n")
        i = 0
        while m := self.special.search(text, i):
            self.field.append(text[i : m.start()])
            i = m.end()
            c, follows = m[0], text[i : i + 1]
            if c == ESCAPE:
                if follows and (follows in (QUOTE, ESCAPE) or not self.open):
                    self.field.append(follows)
                    i += 1
            elif c == QUOTE:
                if self.open and follows == QUOTE:
                    self.field.append(QUOTE)
                    i += 1
                else:
                    self.open = not self.open
                    if self.open and not "".join(self.field).strip():
                        self.field.clear()
            elif self.open:
                self.field.append(c)
            else:
                self._end()
        self.field.append(text[i:])
        if self.open:
            return None
        self._end()
        found, self.fields = self.fields, []
        return found

    def _end(self):
        self.fields.append("".join(self.field))
        self.field = []


def tokens(text: str, delimiter: str) -> list[str]:
    found = Tokeniser(delimiter).line(text)
    if found is None:
        raise RawScanError("Unterminated quoted field at end of line")
    return found


def tokenised(value: Column, delimiter: str) -> Column:
    """tokens() as an expression: a fold over the line's pieces, which are escapes with what they escape, runs of quotes,
    delimiters and other text."""
    q, sep = re.escape(QUOTE), re.escape(delimiter)
    pieces = F.regexp_extract_all(value, F.lit(f"(?s)\\\\.?|{q}+|{sep}|[^\\\\{q}{sep}]+"), F.lit(0))
    start = F.struct(F.lit(False).alias("open"), F.lit("").alias("field"), F.array().cast("array<string>").alias("fields"))

    def step(st, x):
        one = F.substring(x, 1, 1)
        escape, quote, cut = one == ESCAPE, one == QUOTE, (x == delimiter) & ~st["open"]
        inside = F.length(x) - F.when(st["open"], 0).otherwise(1)  # quotes that stand within the quotes
        begun = F.when(st["open"] | (F.btrim(st["field"], F.lit(BLANKS)) != ""), st["field"]).otherwise("")
        quoted = F.concat(begun, F.repeat(F.lit(QUOTE), F.floor(inside / 2).cast("int")))
        return F.struct(
            F.when(quote, inside % 2 == 0).otherwise(st["open"]).alias("open"),
            F.when(cut, "").when(escape, F.concat(st["field"], F.substring(x, 2, 1))).when(quote, quoted).otherwise(F.concat(st["field"], x)).alias("field"),
            F.when(cut, F.array_append(st["fields"], st["field"])).otherwise(st["fields"]).alias("fields"),
        )

    open_end = F.raise_error(F.lit("Unterminated quoted field at end of line")).cast("array<string>")
    return F.aggregate(pieces, start, step, lambda st: F.when(st["open"], open_end).otherwise(F.array_append(st["fields"], st["field"])))


def multiline_records(lines, delimiter: str):
    """Fields of each record of (line, whether a line break follows). Records of blank lines alone are skipped; an open
    quote at the end fails."""
    state, blank = Tokeniser(delimiter), True
    for line, ended in lines:
        plain = line.removesuffix("\r") if ended else line
        blank = blank and not plain.strip()
        found = state.line(plain)
        if found is not None:
            if not blank:
                yield found
            blank = True
    if state.open:
        raise RawScanError("Unterminated quoted record at end of file")


def names_of(first: list[str] | None, header: bool) -> list[str]:
    """Column names from the first record: trimmed header tokens without the empty ones, or column_1 and so on."""
    if first is None:
        raise RawScanError("CSV file is empty")
    if not header:
        return [f"column_{i}" for i in range(1, len(first) + 1)]
    found = [t.strip() for t in first if t.strip()]
    if not found:
        raise RawScanError("CSV header has no column")
    return found


def csv_load(
    spark: SparkSession,
    path: str,
    delimiter: str = ";",
    header: str | bool = "true",
    multiline: str | bool = "false",
    encoding: str = "UTF-8",
    split_size_mb: int = -1,
) -> DataFrame:
    """One row for each record that isn't blank. Fields go to columns by their place: missing ones are null, more are dropped.

    Lines are split in the JVM, those without quote and escape by a plain split. With multiline the object is one
    stream that one task reads, since a quote may be open at any place where it could be cut; the task holds a batch of
    lines and a record, however large the object is.
    """
    target, sep = args.require_path(path), args.delimiter(delimiter)
    has_header, whole = args.optional_boolean("HEADER", header, True), args.optional_boolean("MULTILINE", multiline, False)
    charset, split = args.charset(encoding), config.split_bytes(spark, split_size_mb)
    pin = pinned(spark, target)
    if whole:
        return _stream(spark, pin, sep, has_header, charset)
    lines = records(spark, pin, "\n", charset, split, has_header)
    lines = lines.withColumn("value", without_return(F.col("value")))
    first = lines.limit(1).collect()
    names = names_of(tokens(first[0].value, sep) if first else None, has_header)
    if has_header:
        lines = lines.where(~F.col("first"))
    lines = lines.where(F.btrim("value", F.lit(BLANKS)) != "")
    plain = ~F.col("value").contains(QUOTE) & ~F.col("value").contains(ESCAPE)
    cut = lines.select(F.when(plain, F.split("value", re.escape(sep), -1)).otherwise(tokenised(F.col("value"), sep)).alias("f"))
    return cut.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def _stream(spark, pin, sep, has_header, charset) -> DataFrame:
    ship(spark)
    charset, marked = resolved(spark, pin, charset)
    feed, size = "\n".encode(charset), pin.size
    cut = separator("\n", charset)
    if cut is None:
        raise RawScanError(f"Multiline records can't be read in {charset}")
    scan = in_order(spark, pin, cut)

    def found(batches):
        texts = ((raw.decode(charset, "replace"), ended) for raw, ended in pieces_of(batches, feed, size))
        lines = ((text.removeprefix("\ufeff") if marked and not i else text, ended) for i, (text, ended) in enumerate(texts))
        return multiline_records(lines, sep)

    def rows(records_):
        part = []
        for fields in records_:
            part.append(fields)
            if len(part) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.list_(pa.string()))], ["f"])
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.list_(pa.string()))], ["f"])

    first = scan.mapInArrow(lambda batches: rows(islice(found(batches), 1)), "f array<string>").collect()
    names = names_of(first[0].f if first else None, has_header)
    cells = scan.mapInArrow(lambda batches: rows(islice(found(batches), int(has_header), None)), "f array<string>")
    return cells.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])
