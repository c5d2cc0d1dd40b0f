"""Format rules that need no session."""

import pytest
from pyspark.sql import types as T

from rawscan.errors import RawScanError
from rawscan.sources import delimited, json_lines, text, xml_rows

L, D, S, B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


@pytest.mark.parametrize("lines, found", [
    (['{"depth":3,"open":false,"tide":-0.5,"crew":[]}', '{"depth":4,"open":true,"tide":2.25,"note":"fog"}'], {"depth": L, "open": B, "tide": D, "crew": S, "note": S}),
    (['{"u":1}', '{"v":false}', '{"u":2,"w":"z"}'], {"u": L, "v": B, "w": S}),
    (['{"u":null}', '{"u":3}'], {"u": S}),
    (['{"u":3}', '{"u":0.5}', '{"u":4}'], {"u": D}),
    (['{"u":false}', '{"u":0}'], {"u": S}),
    (['{"u":-9223372036854775809}', '{"u":2}'], {"u": D}),
    (['{"u":9223372036854775807}'], {"u": L}),
    (['{"z":2,"y":{"x":1}}'], {"z": L, "y": S}),
])
def test_columns_of_a_sample(lines, found):
    assert json_lines.infer(lines) == found and list(json_lines.infer(lines)) == list(found)


@pytest.mark.parametrize("lines", [["[]"], ["fog"], ['{"u":2} y'], ['{"u":2}]{}'], ["null"], ["-4"], ['{"u":Infinity}'], ["{'u':2}"], ['{"u":2'], [], ["{}"]])
def test_samples_without_columns(lines):
    with pytest.raises(RawScanError):
        json_lines.infer(lines)


def test_further_columns():
    assert json_lines.additional(" tide:double , open:bool,, ") == {"tide": D, "open": B}
    assert ({"u": L, "v": S} | json_lines.additional("u:text,w:int64")) == {"u": S, "v": S, "w": L}
    for bad in ("tide", "tide:", ":text", "tide:date"):
        with pytest.raises(RawScanError):
            json_lines.additional(bad)


@pytest.mark.parametrize("line, found", [
    ('x;"y;z"', ["x", "y;z"]), (";;x", ["", "", "x"]), ("x\\y", ["xy"]), ('"x""y"', ['x"y']), ('x; "y;z"', ["x", "y;z"]), ("", [""]), (";", ["", ""]),
    ('"x\\"y";z', ['x"y', "z"]), ("x\\;y", ["x;y"]), ('x"y;z"w', ["xy;zw"]), ('"x\\ny"', ["xny"]),
])
def test_fields_of_a_line(line, found):
    assert delimited.tokens(line, ";") == found


def test_a_quote_that_stays_open():
    with pytest.raises(RawScanError):
        delimited.tokens('x;"y', ";")


def test_names_of_columns():
    assert delimited.names_of([" tide", "", "open "], True) == ["tide", "open"]
    assert delimited.names_of(["9", "", "7"], False) == ["column_1", "column_2", "column_3"]
    for first in (None, ["  ", ""]):
        with pytest.raises(RawScanError):
            delimited.names_of(first, True)


def test_records_over_lines():
    lines = [('"two', True), ('lines";x\r', True), ("\r", True), ('7;"y\r', True), ('\r', True), ('z"', False)]
    assert list(delimited.multiline_records(iter(lines), ";")) == [["two\nlines", "x"], ["7", "y\n\nz"]]
    with pytest.raises(RawScanError):
        list(delimited.multiline_records(iter([('7;"y', True)]), ";"))


@pytest.mark.parametrize("content", [b"u\nv\n", b"u\nv", b"\n\n", b"u", b"\xef\xbb\xbfu\nv\n", b"\xef\xbb\xbfu\nv"])
def test_pieces_tell_the_end(content):
    import pyarrow as pa

    parts = content.removeprefix(b"\xef\xbb\xbf").split(b"\n")
    parts = parts[:-1] if not parts[-1] else parts
    batches = [pa.RecordBatch.from_arrays([pa.array(parts[i : i + 1])], ["raw"]) for i in range(len(parts))]
    assert b"".join(p + b"\n" * e for p, e in text.pieces_of(batches, b"\n", len(content))) == content.removeprefix(b"\xef\xbb\xbf")


def test_separators_as_other_text():
    assert text.separator("\n", "UTF-16LE") == "\n\0" and text.separator("é", "UTF-8") == "é" and text.separator("é", "cp1252") is None
    assert text.separator("|", "gbk") is None and text.separator("\n", "gbk") == "\n" and text.separator("|", "cp1251") == "|"


def test_outline_of_a_document():
    parts = ['<fleet><boat no="1"><na', 'me>x</name></boat><dock><boat no="2" old="y"><flag/>t<name/></boat></dock></fleet>']
    assert xml_rows.outline(parts, "boat") == (["no", "old"], ["name", "flag"], True)


def test_a_row_inside_a_row_is_a_child():
    found = list(xml_rows.rows_of(["<boat><boat><boat>1</boat></boat></boat>"], "boat", False))
    assert len(found) == 1 and list(found[0].children) == ["boat"] and found[0].nested


def test_xml_of_a_row():
    row = next(iter(xml_rows.rows_of(['<s><p k="&lt;&quot;"><q/><!-- no --><![CDATA[a<b]]>&gt;</p></s>'], "p", True)))
    assert "".join(row.raw) == '<p k="&lt;&quot;"><q></q>a&lt;b&gt;</p>'


@pytest.mark.parametrize("content", ["<s><p></s>", "", "<s/>", '<!DOCTYPE s [<!ENTITY y "z">]><s><p>&y;</p></s>'])
def test_documents_that_fail(content):
    with pytest.raises(RawScanError):
        xml_rows.outline([content], "p")


def test_names_that_repeat():
    assert xml_rows.distinct_names(["q", "text", "q", "q", "text"]) == ["q", "text", "q_1", "q_2", "text_1"]
