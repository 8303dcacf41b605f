import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from strata.functions import (
    day_of,
    fill_null,
    map_exact,
    map_prefix,
    parse_date,
    parse_timestamp,
    rename_columns,
    to_int,
    trim_headers,
)
from strata.plans.defaults import CONTINENT_ES_TO_EN, COUNTRY_PREFIX_RULES


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Feb 4, 2005", dt.date(2005, 2, 4)),
        ("Aug 13, 2006", dt.date(2006, 8, 13)),
        ("Aug 04, 2006", dt.date(2006, 8, 4)),
        ("Sept 4, 2005", None),
        ("junk", None),
        ("Feb 30, 2006", None),
        (None, None),
        # accepted differences from the original parser
        ("AUG 13, 2006", None),
        ("Aug 4 2006", dt.date(2006, 8, 4)),
        ("Aug 4, 2006 x", dt.date(2006, 8, 4)),
    ],
)
def test_parse_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_date("t").alias("d")).first()["d"] == expected


def test_parse_timestamp_iso_z_and_bad_text(spark):
    df = spark.createDataFrame([("2009-05-04T23:08:57Z",), ("not-a-time",), (None,)], "t string")
    out = df.select(parse_timestamp("t").cast("timestamp_ntz").alias("ts")).collect()
    assert [r.ts for r in out] == [dt.datetime(2009, 5, 4, 23, 8, 57), None, None]


def test_date_parts_null_in_null_out(spark):
    df = spark.createDataFrame([(dt.date(2006, 8, 4),), (None,)], "d date")
    got = df.select(day_of("d").alias("day"), F.month("d").alias("m")).collect()
    assert [(r.day, r.m) for r in got] == [(4, 8), (None, None)]


def test_to_int_accepts_padding_and_rejects_text(spark):
    df = spark.createDataFrame([("4",), ("04",), ("x",), (None,)], "t string")
    assert [r.i for r in df.select(to_int("t").alias("i")).collect()] == [4, 4, None, None]


def test_map_exact_keeps_unmapped_and_is_accent_sensitive(spark):
    df = spark.createDataFrame([("Europa",), ("África",), ("Africa",), ("Asia",), (None,)], "c string")
    got = [r.e for r in df.select(map_exact("c", CONTINENT_ES_TO_EN).alias("e")).collect()]
    assert got == ["Europe", "Africa", "Africa", "Asia", None]


def test_map_prefix_first_match_wins(spark):
    df = spark.createDataFrame(
        [
            ("Congo, the Democratic Republic of the",),
            ("Congo",),
            ("Korea, Democratic People's Republic of",),
            ("Korea, Republic of",),
            ("Russian Federation",),
            ("United States",),
            ("Spain",),
            (None,),
        ],
        "c string",
    )
    got = [r.m for r in df.select(map_prefix("c", COUNTRY_PREFIX_RULES).alias("m")).collect()]
    assert got == ["Congo", "Congo", "South Korea", "Korea, Republic of", "Russia", "United States of America", "Spain", None]
    ordered = [("A", "first"), ("AB", "second")]
    df2 = spark.createDataFrame([("ABC",)], "c string")
    assert df2.select(map_prefix("c", ordered).alias("m")).first().m == "first"


def test_fill_null(spark):
    df = spark.createDataFrame([(None,), ("Asia",)], "c string")
    assert [r.c for r in df.select(fill_null("c", "Without continent").alias("c")).collect()] == [
        "Without continent",
        "Asia",
    ]


def test_trim_headers_and_checked_rename(spark):
    df = spark.createDataFrame([("a", "b")], "`nombre` string, ` name` string")
    t = trim_headers(df)
    assert t.columns == ["nombre", "name"]
    assert rename_columns(t, {"name": "country"}).columns == ["nombre", "country"]
    with pytest.raises(ValueError):
        rename_columns(t, {"Horoscopes": "horoscopes"})
    assert rename_columns(t, {"Horoscopes": "horoscopes"}, strict=False).columns == ["nombre", "name"]


def test_trim_headers_refuses_merging(spark):
    df = spark.createDataFrame([("a", "b")], "`x` string, ` x` string")
    with pytest.raises(ValueError):
        trim_headers(df)


def test_rows_helper(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert rows(df) == [(None,), (1,), (2,)]


def test_column_helpers(spark):
    from strata.functions import drop_columns, select_plus, with_columns

    df = spark.createDataFrame([("a", 1)], "s string, n int")
    assert select_plus(df, doubled=F.col("n") * 2).columns == ["s", "n", "doubled"]
    out = with_columns(df, {"n": F.col("n") + 1, "t": F.upper("s")})
    assert [tuple(r) for r in out.collect()] == [("a", 2, "A")]
    assert drop_columns(df, ["n", "absent"]).columns == ["s"]


def test_parse_timestamp_with_pattern(spark):
    df = spark.createDataFrame([("04/05/2009 23:08",), ("bad",)], "t string")
    out = [r.ts for r in df.select(parse_timestamp("t", "dd/MM/yyyy HH:mm").cast("timestamp_ntz").alias("ts")).collect()]
    assert out == [dt.datetime(2009, 5, 4, 23, 8), None]
