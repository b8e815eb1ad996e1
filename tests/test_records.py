import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedhouse.sources.lines import land_lines, number_lines
from feedhouse.sources.records import read_feed, read_header, resolve_header, split_fields

LINES = st.text(alphabet=list('ab,," "\x01\x02'), max_size=14)


def fields_of(line: str) -> list[str]:
    """Plain restatement: cut at commas that stand outside quotes."""
    out, quoted, place = [""], False, 0
    while place < len(line):
        c = line[place]
        if c == '"' and quoted and line[place + 1:place + 2] == '"':
            out[-1] += '"'
            place += 1
        elif c == '"':
            quoted = not quoted
        elif c == "," and not quoted:
            out.append("")
        else:
            out[-1] += c
        place += 1
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(LINES, min_size=1, max_size=60))
def test_split_equals_restatement(spark, lines):
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    for row in frame.select("line", split_fields(F.col("line")).alias("f")).collect():
        assert row.f == fields_of(row.line), row.line


@pytest.mark.parametrize("line, expected", [
    ('"a,b",c', ["a,b", "c"]), ('"a""b",c', ['a"b', "c"]), ('""""', ['"']), ('ab"c,d"e,f', ["abc,de", "f"]),
    ("a,,", ["a", "", ""]), ('"x,y', ["x,y"]), ('""', [""]),
])
def test_edge_lines(spark, line, expected):
    assert spark.range(1).select(split_fields(F.lit(line))).first()[0] == expected


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_row_numbers_across_many_blocks(spark, tmp_path, end):
    """Splits of a few hundred bytes, several files, blank lines in between."""
    expected = {}
    for name, count in (("a.csv", 900), ("b.csv", 1), ("c.csv", 400)):
        lines = [f"{name}-{i}-{'x' * (i % 37)}" for i in range(count)]
        text = end.join(line + (end + "  " if i % 7 == 0 else "") for i, line in enumerate(lines))
        (tmp_path / name).write_bytes(text.encode())
        expected |= {line: i + 1 for i, line in enumerate(lines)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "50")
    try:
        landing = land_lines(spark, str(tmp_path))
        assert landing.blocks.rows > 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = number_lines(landing).collect()
    assert {r.value: r._rowNumber for r in rows} == expected
    in_order = sorted(rows, key=lambda r: r._rowOrder)
    assert [r.value for r in in_order] == list(expected)


def test_landing_survives_other_read_settings(spark, tmp_path):
    """The written table, not the split plan of a later read, decides the numbers."""
    (tmp_path / "a.csv").write_text("\n".join(str(i) for i in range(2000)))
    landing = land_lines(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        assert all(int(r.value) + 1 == r._rowNumber for r in number_lines(landing).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_feed_with_malformed_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b'a, b ,c\r\n1,"x,y",z\r\n\r\n \t\r\nbad,row\r\n4,"q""q",\r\n')
    feed = read_feed(spark, str(tmp_path / "f.csv"))
    assert feed.header == ["a", " b ", "c"]
    assert [(r._rowNumber, r.a, r.b, r.c) for r in feed.rows.orderBy("_rowNumber").collect()] == [
        (2, "1", "x,y", "z"), (4, "4", 'q"q', ""),
    ]
    assert [(r._rowNumber, r.message) for r in feed.parse_errors.collect()] == [
        (3, "Row 3: column count mismatch (expected 3, got 2)")
    ]


def test_header_rules(spark, tmp_path):
    assert resolve_header([" a", "b", "a "]) == {"a": 2, "b": 1}
    with pytest.raises(ValueError, match="reserved"):
        resolve_header(["a", " _rowNumber"])
    (tmp_path / "f.csv").write_text("\n \n\nx,y\n1,2\n")
    assert read_header(spark, str(tmp_path / "f.csv")) == ["x", "y"]


def test_too_short_files_are_refused(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("\n \n")
    with pytest.raises(ValueError, match="header line"):
        read_feed(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "head.csv").write_text("a,b\n\n")
    with pytest.raises(ValueError, match="data line"):
        read_feed(spark, str(tmp_path / "head.csv"))


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="another header"):
        read_feed(spark, str(tmp_path))
