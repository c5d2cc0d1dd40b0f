"""The sources over a local object store."""

import random
from datetime import datetime

import pytest

from rawscan import config, sources, storage
from rawscan.errors import RawScanError
from rawscan.plans.sql import sql
from rawscan.sources import delimited, text
from rawscan.streaming import txt_stream

# Ships of an invented harbour: number, name, flag, berth (of some), tons.
SHIPS = [(11, "Ærø", "DK", None, 340.5), (12, "Bella Ciao", "IT", "N4", 1200.0), (17, "Łódka", "PL", None, 12.25), (23, "São Roque", "PT", "S1", 95.0)]


@pytest.fixture
def put(spark, tmp_path):
    spark.conf.set(storage.ROOT, f"file://{tmp_path}")

    def write(key, content, bucket="harbour"):
        target = tmp_path / bucket / key
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content if isinstance(content, bytes) else content.encode())
        return f"s3://{bucket}/{key}"

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- one table in four formats ---


def test_ships_as_json(spark, put):
    put("ships.jsonl", "".join('{"no":%d,"name":"%s","flag":"%s"%s,"tons":%s}\n' % (n, name, f, f',"berth":"{b}"' if b else "", t) for n, name, f, b, t in SHIPS))
    df = sql(spark, "SELECT * FROM TABLE(h.json.load(path => 's3://harbour/ships.jsonl', schema_sample_rows => 1, additional_columns => 'berth:varchar')) ORDER BY no")
    assert df.dtypes == [("no", "bigint"), ("name", "string"), ("flag", "string"), ("tons", "double"), ("berth", "string")]
    assert [(r.no, r.name, r.flag, r.berth, r.tons) for r in df.collect()] == SHIPS


def test_ships_as_csv(spark, put):
    put("ships.csv", "no|name|flag|berth|tons\n" + "".join(f"{n}|{name}|{f}|{b or ''}|{t}\n" for n, name, f, b, t in SHIPS))
    df = sql(spark, "SELECT no, name, flag, berth, CAST(tons AS double) AS tons FROM TABLE(h.csv.load(path => 's3://harbour/ships.csv', delimiter => '|')) ORDER BY no")
    assert rows(df) == [(str(n), name, f, b or "", t) for n, name, f, b, t in SHIPS]


def test_ships_as_text(spark, put):
    put("ships.txt", "".join(f"no:{n},tons:{t}{f',berth:{b}' if b else ''}#" for n, _, _, b, t in SHIPS))
    df = sql(spark, "SELECT split_to_map(line, ',', ':') AS m FROM TABLE(h.txt.load(path => 's3://harbour/ships.txt', line_break => '#'))")
    assert rows(df.selectExpr("CAST(m['no'] AS int) AS no", "m['berth']", "CAST(m['tons'] AS double)").orderBy("no")) == [(n, b, t) for n, _, _, b, t in SHIPS]


def test_ships_as_xml(spark, put):
    put("ships.xml", "<?xml version='1.0'?><port><dock>" + "".join(f'<ship no="{n}"><name>{name}</name>{f"<berth>{b}</berth>" if b else ""}<tons>{t}</tons></ship>' for n, name, _, b, t in SHIPS) + "</dock></port>\n")
    df = sql(spark, "SELECT CAST(\"@no\" AS int) AS no, name, berth, CAST(tons AS double) AS tons FROM TABLE(h.xml.load(path => 's3://harbour/ships.xml', row_element => 'ship', invalid_row_column => '')) ORDER BY no")
    assert rows(df) == [(n, name, b, t) for n, name, _, b, t in SHIPS]


# --- listings ---


def test_listings(spark, put):
    for key in ("inbox/a.log", "inbox/old/2019/z.log", "inbox/z.log", "top"):
        put(key, key)
    put("k", "v", bucket="annex")
    assert rows(sources.list_buckets(spark).select("path", "bucket")) == [("s3://annex", "annex"), ("s3://harbour", "harbour")]
    every = sources.list_objects(spark, "harbour")
    assert every.columns == ["path", "bucket", "key", "name", "parent", "size", "last_modified", "etag", "type"]
    deep = every.where("key LIKE '%2019%'").first()
    assert (deep.path, deep.name, deep.parent, deep.size, deep.type) == ("s3://harbour/inbox/old/2019/z.log", "z.log", "inbox/old/2019/", 20, "object") and isinstance(deep.last_modified, datetime)
    assert every.count() == 4 and sources.list_objects(spark, "harbour", "inbox/z").count() == 1 and sources.list_objects(spark, "harbour", "zz").count() == 0
    flat = sources.list_objects(spark, "harbour", "inbox/", "false", "true").collect()
    assert [(r.key, r.name, r.size, r.type) for r in flat] == [("inbox/a.log", "a.log", 11, "object"), ("inbox/old/", "old", None, "prefix"), ("inbox/z.log", "z.log", 11, "object")]
    assert [r.key for r in sources.list_objects(spark, "harbour", "", False).collect()] == ["top"]


# --- splits ---


def numbered(line, n=30_000):
    return "".join(line(i) for i in range(n))


@pytest.mark.parametrize("kind", ["txt", "json", "csv"])
def test_each_record_is_in_one_split(spark, put, kind):
    lines = {"txt": lambda i: f"{i:06d}{'é' * 40}\r\n", "json": lambda i: f'{{"i":{i},"fill":"{"é" * 40}"}}\n', "csv": lambda i: f"{i};{'é' * 40}\n"}
    path = put("n", ("i;fill\n" if kind == "csv" else "") + numbered(lines[kind]))
    made = {"txt": lambda: sources.txt_load(spark, path, "\\r\\n", split_size_mb=1).selectExpr("int(substr(line, 1, 6)) AS i"), "json": lambda: sources.json_load(spark, path, split_size_mb=1), "csv": lambda: sources.csv_load(spark, path, split_size_mb=1)}[kind]()
    assert made.rdd.getNumPartitions() > 1
    assert rows(made.selectExpr("count(*)", "count(DISTINCT i)", "sum(int(i))")) == [(30_000, 30_000, 449_985_000)]


def test_split_size_counts_for_its_own_scan_alone(spark, put):
    path, before = put("n", numbered(lambda i: f"{i} {'x' * 200}\n")), dict(spark.conf.getAll)
    fine, coarse, usual = (sources.txt_load(spark, path, split_size_mb=s) for s in (1, 3, -1))
    own = [df.rdd.getNumPartitions() for df in (fine, coarse)]
    assert own[0] >= 6 and own[0] > own[1] and {k: v for k, v in spark.conf.getAll.items() if k in before} == before
    both = fine.unionByName(coarse)
    assert both.rdd.getNumPartitions() == sum(own) and both.count() == 60_000
    assert fine.join(usual, "line").count() == 30_000
    spark.conf.set(config.DEFAULT_SPLIT, "1")
    try:
        assert sources.txt_load(spark, path).rdd.getNumPartitions() == own[0]
    finally:
        spark.conf.unset(config.DEFAULT_SPLIT)


def test_utf16_in_splits(spark, put):
    path = put("u", numbered(lambda i: f"{i};ß{'y' * 30}\n", 20_000).encode("utf-16-le"))
    df = sources.csv_load(spark, path, header="false", encoding="UTF-16LE", split_size_mb=1)
    assert df.rdd.getNumPartitions() > 1 and rows(df.selectExpr("count(DISTINCT column_1)", "min(column_2) = max(column_2)")) == [(20_000, True)]


# --- JSON ---


def test_json_values(spark, put):
    path = put("v.jsonl", '{"k":5,"box":{"in":[1, "b" ]}}\r\n\n \t \n{"k":6,"more":"x","k":7}\r\n')
    assert rows(sources.json_load(spark, path).orderBy("k")) == [(5, '{"in":[1,"b"]}', None), (7, None, "x")]


@pytest.mark.parametrize("bad", ["oops", "[5]", '{"k":1} y', '{"k":1}]{}', '{"k":1}, {"k":2}', "null", '{"k":NaN}', '{"k":1}}', "{'k':1}", '{"k"', '{"k":1}]{"z":1}', '{"k":1}],"z":{}', '{"k":1}],[{"b":2}', '{"k":1},"b":{"c":2}', '{"k":1}} {', '{"k":1},', '{"k":1} {"b":2}', '{"k":01}', '{"k":1,}'])
def test_a_line_that_is_not_one_object_fails_any_query(spark, put, bad):
    df = sources.json_load(spark, put("bad.jsonl", f'{{"k":1}}\n{bad}\n'), schema_sample_rows=1)
    with pytest.raises(Exception, match="Invalid JSON"):
        df.count()


def test_json_numbers_in_text_columns_are_as_written(spark, put):
    values = ['"1.50"', "1.50", "-0", "1e2", "12345678901234567890123", "true", '"a\\"1.5e7,:{"', "[1.50]", '{"w":1.50}', "null", " 7.10 ", "0.000001", "-1.0E+5"]
    shown = ["1.50", "1.50", "-0", "1e2", "12345678901234567890123", "true", 'a"1.5e7,:{', "[1.5]", '{"w":1.5}', None, "7.10", "0.000001", "-1.0E+5"]
    lines = ['{"w":"text","n\\u0061me":"t"}', *[f'{{"x":{{"w":9.90}},"w":{v}, "n\\u0061me" : {v} ,"z":[9.90]}}' for v in values], '{"w":1.50,"w":"2"}']
    df = sources.json_load(spark, put("w.jsonl", "\n".join(lines)), schema_sample_rows=1)
    assert [r.w for r in df.collect()] == ["text", *shown, "2"] and [r.name for r in df.collect()] == ["t", *shown, None]
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)


def test_json_strings_that_look_like_ends(spark, put):
    df = sources.json_load(spark, put("s.jsonl", '{"k":"}]{"}\n{"k":"\\"]}"}\n{"k":[{}]}\n'))
    assert [r.k for r in df.collect()] == ["}]{", '"]}', "[{}]"]


def test_projection_reaches_the_parser(spark, put):
    plan = plan_of(sources.json_load(spark, put("p.jsonl", '{"a":1,"b":"x","c":2.5}\n')).select("a"))
    assert "StructField(c" not in plan and "c#" not in plan and "Python" not in plan


# --- CSV ---


def test_csv_values(spark, put):
    path = put("r.csv", "p;;q\n1;2;3\n \t \nx\n\"u;u\";\\\"v;w;more\n;;\n")
    assert rows(sources.csv_load(spark, path)) == [("1", "2"), ("x", None), ("u;u", '"v'), ("", "")]
    assert sources.csv_load(spark, path, header="false").columns == ["column_1", "column_2", "column_3"]
    for empty in ("", " ; \n"):
        with pytest.raises(RawScanError):
            sources.csv_load(spark, put("e.csv", empty))


@pytest.mark.parametrize("sep", [";", "|", "\t", "é"])
def test_the_expression_cuts_like_the_tokeniser(spark, sep):
    rng, lines, want = random.Random(5), [], []
    while len(lines) < 1500:
        line = "".join(rng.choice(['"', '"', "\\", sep, sep, " ", "a", "é", "b c", "'"]) for _ in range(rng.randint(0, 14)))
        try:
            want.append(delimited.tokens(line, sep))
            lines.append(line)
        except RawScanError:
            continue
    found = spark.createDataFrame([(x,) for x in lines], "v string").select(delimited.tokenised(text.F.col("v"), sep).alias("f"))
    assert [list(r.f) for r in found.collect()] == want
    with pytest.raises(Exception, match="Unterminated"):
        spark.createDataFrame([('a"b',)], "v string").select(delimited.tokenised(text.F.col("v"), sep)).collect()


def test_csv_needs_no_python(spark, put):
    df = sources.csv_load(spark, put("q.csv", 'a;b\n"1";2\n'))
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df) and rows(df) == [("1", "2")]


@pytest.mark.parametrize("end", ["", "\n", "\r\n"])
@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16LE", "ISO-8859-1"])
def test_multiline_csv(spark, put, end, encoding):
    rng = random.Random(len(end))
    want = [(str(i), "\n".join(rng.choice(["", "é;x", 'say "so"', "back\\slash"]) for _ in range(rng.randint(1, 5)))) for i in range(3000)]
    quoted = "\n".join(["id;note", *('%s;"%s"' % (i, t.replace("\\", "\\\\").replace('"', '""')) for i, t in want)])
    df = sources.csv_load(spark, put("m.csv", (quoted + end).encode(encoding)), multiline="true", encoding=encoding)
    assert rows(df) == want


def test_multiline_csv_with_an_open_end(spark, put):
    with pytest.raises(Exception, match="Unterminated"):
        sources.csv_load(spark, put("o.csv", 'a;b\n1;"open\n2;x\n'), multiline="true").collect()
    with pytest.raises(RawScanError):
        sources.csv_load(spark, put("z.csv", ""), multiline="true")


# --- text ---


def test_text_values(spark, put):
    assert rows(sources.txt_load(spark, put("a", "uno;due;tre"), ";")) == [("uno",), ("due",), ("tre",)]
    assert rows(sources.txt_load(spark, put("b", "u\r\n\nv\n"))) == [("u\r",), ("",), ("v",)]
    assert rows(sources.txt_load(spark, put("c", b"u\xffv\n"))) == [("u�v",)]
    assert sources.txt_load(spark, put("d", b"y" * ((9 << 20) + 7) + b"\nend\n")).count() == 2
    assert sources.txt_load(spark, put("e", "")).count() == 0


@pytest.mark.parametrize("encoding, content", [("ISO-8859-1", "çà|öß"), ("windows-1252", "“€”|–ž"), ("cp1251", "Привет|мир"), ("koi8-r", "да|нет"), ("gbk", "中文|字符"), ("shift_jis", "ソ表|テスト"), ("UTF-16", "ø|Ω"), ("utf-16be", "ø|Ω"), ("us-ascii", "plain|text")])
def test_charsets(spark, put, encoding, content):
    path = put("c", content.encode(encoding))
    assert rows(sources.txt_load(spark, path, "|", encoding)) == [(x,) for x in content.split("|")]


def test_utf16_marks(spark, put):
    for mark, order in ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"), (b"", "utf-16-be")):
        path = put("m", mark + "k;w\n1;é\n".encode(order))
        assert rows(sources.csv_load(spark, path, encoding="UTF-16")) == [("1", "é")] == rows(sources.csv_load(spark, path, encoding="UTF-16", multiline=True))
    assert rows(sources.txt_load(spark, put("x", "aéb".encode("latin-1")), "é", "ISO-8859-1")) == [("a",), ("b",)]


# --- XML ---


def test_xml_values(spark, put):
    path = put("a.xml", '<set><p k=""><q></q><r>  </r></p><p><q/></p></set>')
    assert rows(sources.xml_load(spark, path, row_element="p")) == [("", "", "", None), (None, "", None, None)]
    assert rows(sources.xml_load(spark, path, row_element="p", empty_as_null="true", invalid_row_column="")) == [(None,) * 3] * 2
    bad = put("b.xml", '<set><p k="1"><q><i>deep</i></q></p><p k="2">loose<q>x</q></p></set>')
    assert rows(sources.xml_load(spark, bad, row_element="p", invalid_row_column="broken")) == [(None, None, '<p k="1"><q><i>deep</i></q></p>'), (None, None, '<p k="2">loose<q>x</q></p>')]
    with pytest.raises(Exception, match="Unsupported row structure"):
        sources.xml_load(spark, bad, row_element="p", invalid_row_column="").collect()
    with pytest.raises(RawScanError):
        sources.xml_load(spark, bad, row_element="p", invalid_row_column="q")
    for content, message in (("<a><p></a>", "well-formed"), ("<a/>", "was not found"), ("", "well-formed")):
        with pytest.raises(Exception, match=message):
            sources.xml_load(spark, put("c.xml", content), row_element="p")


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1", "utf-16le"])
def test_xml_as_a_stream(spark, put, encoding):
    content = "<a>\n" + "".join(f'<p k="{i}"><q>é {i} &gt; &amp;</q><!-- > --></p>\n' for i in range(5000)) + "</a>\n"
    df = sources.xml_load(spark, put("s.xml", content.encode(encoding)), encoding, "p", invalid_row_column="")
    assert rows(df) == [(str(i), f"é {i} > &") for i in range(5000)]


def test_an_object_is_read_piece_by_piece():
    import pyarrow as pa

    fed = []

    def batches():
        for k in range(1000):
            fed.append(k)
            yield pa.RecordBatch.from_arrays([pa.array([b"x;1", b"y;2"])], ["raw"])

    found = delimited.multiline_records(((raw.decode(), end) for raw, end in text.pieces_of(batches(), b"\n", 8000)), ";")
    assert next(found) == ["x", "1"] and len(fed) == 1
    assert len(list(found)) == 1999


# --- objects, SQL, streams ---


def test_an_object_that_is_not_as_pinned(spark, put):
    pin = storage.pinned(spark, put("pin", "1\n"))
    storage.verify(spark, pin)
    put("pin", "1\n2\n")
    with pytest.raises(Exception, match="Object changed"):
        storage.unchanged(spark.read.text(pin.path), pin).collect()
    with pytest.raises(RawScanError, match="Object changed"):
        storage.verify(spark, pin)


def test_an_object_that_is_not_there(spark, put):
    put("k", "v")
    for path in ("s3://harbour/gone", "s3://nowhere/k"):
        with pytest.raises(RawScanError):
            sources.txt_load(spark, path)


def test_only_loader_calls_are_rewritten(spark, put):
    put("q", "o'clock\n")
    df = sql(spark, "SELECT CAST(line AS VARCHAR) AS x, 'TABLE(a.txt.load(path => 1))' AS y -- TABLE(\nFROM TABLE ( z.txt.load( path => 's3://harbour/q' , line_break=>'\\n') ) t WHERE line = 'o''clock'")
    assert rows(df) == [("o'clock", "TABLE(a.txt.load(path => 1))")]
    for bad in ("SELECT * FROM TABLE(a.txt.load(paths => 'x'))", "SELECT * FROM TABLE(a.txt.load(path => f(x)))", "SELECT * FROM TABLE(a.txt.load())"):
        with pytest.raises((RawScanError, TypeError)):
            sql(spark, bad)


def test_lines_of_arriving_objects(spark, put, tmp_path):
    put("in/a", "1\n2\n")
    query = txt_stream(spark, f"file://{tmp_path}/harbour/in").writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.line for r in spark.table("lines").collect()) == ["1", "2"]
