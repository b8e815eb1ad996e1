import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedhouse.functions import numbers, text

PADDED = st.text(alphabet=list(text.WHITE_SPACE) + list('ab@.|"é0'), max_size=12)


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "x string").select(*columns).first()


@settings(max_examples=25, deadline=None)
@given(st.lists(PADDED, min_size=1, max_size=30))
def test_trim_and_blank(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    x = F.col("x")
    found = frame.select("x", text.trimmed(x).alias("t"), text.is_blank(x).alias("b")).collect()
    for row in found:
        assert row.t == row.x.strip(text.WHITE_SPACE)
        assert row.b == (row.t == "")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=list("a@..@b") + [" ", chr(0x3000), chr(0x85), "é"], max_size=9), min_size=1, max_size=60))
def test_email_equals_the_pattern(spark, values):
    space = re.escape(text.WHITE_SPACE)
    pattern = re.compile(rf"[^{space}@]+@[^{space}@]+\.[^{space}@]+")
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    for row in frame.select("x", text.is_email(F.col("x")).alias("ok")).collect():
        assert row.ok == bool(pattern.fullmatch(row.x)), repr(row.x)


def test_null_is_blank(spark):
    assert one(spark, None, text.is_blank(F.col("x")))[0] is True


def test_email_is_tested_to_the_last_character(spark):
    cases = {
        "a@b.c": True, "a@b": False, "a b@c.d": False, "a@b.c\n": False, "a@@b.c": False,
        f"a{chr(0xA0)}@b.c": False, "@b.c": False, "a@b.c.d": True,
    }
    for value, expected in cases.items():
        assert one(spark, value, text.is_email(F.col("x")))[0] is expected, value


def test_phone_pattern(spark):
    cases = {"555.0200": True, "+1 (555) 123-45": True, "123456": False, "1" * 21: False, "555-0100x": False,
             f"555{chr(0x3000)}0100": True}
    for value, expected in cases.items():
        assert one(spark, value, text.is_phone(F.col("x")))[0] is expected, value


def test_clean_phone(spark):
    assert one(spark, " 555.0200 x1 ", text.clean_phone(F.col("x")))[0] == "5550200 1"


def test_hash_counts_null_as_empty_and_trims_the_whole(spark):
    row = one(spark, " Acme ", text.content_hash([F.col("x"), F.lit(None).cast("string"), F.lit("T ")]))
    assert row[0] == hashlib.sha256(b"acme ||t").hexdigest()


def test_rounding_ties_go_up(spark):
    row = spark.range(1).select(
        numbers.rounded_ratio(F.lit(2425), F.lit(1000), 2).alias("a"),
        numbers.rounded_ratio(F.lit(1), F.lit(0), 2).alias("b"),
        numbers.percent(F.lit(1), F.lit(3)).alias("c"),
        numbers.half_up(F.lit(0.5)).alias("d"),
        numbers.number_text(F.lit(100.0)).alias("e"),
        numbers.number_text(F.lit(71.49)).alias("f"),
    ).first()
    assert tuple(row) == (2.43, None, 33.33, 1, "100", "71.49")
