import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from florilege.functions.dates import normal_date
from florilege.operators.timestamps import DateDictionary, normalise_dates

CASES = [
    ("23 décembre 2014", False, None, "2014-12-23"), ("1941/1942", False, None, "1941"), ("11/1/2020 01:08:41", True, "America/Chicago", "2020-11-01T06:08:41Z"),
    ("31/03/2004", False, None, "2004-03-31"), ("03/04/2004", True, None, "2004-03-04"), ("2017-09-24T06:34:53.934941+05:45", False, None, "2017-09-24T00:49:53Z"),
    ("28/03/2016 2:34 PM", False, None, "2016-03-28T14:34:00Z"), ("12:00 AM, 1 May 2020", False, None, "2020-05-01T00:00:00Z"), ("Mar 1860", True, None, "1860-03"),
    ("Jan. 23, 1813", True, None, "1813-01-23"), ("(c. 1751)", True, None, "1751"), ("the 1880s", False, None, "1880"), ("1930’s", False, None, "1930"), ("471 B.C.", False, None, "-0471"),
    ("-0471", False, None, "-0471"), ("20161103200247", False, None, "2016-11-03T20:02:47Z"), ("1536174572", False, None, "2018-09-05T19:09:32Z"), ("1629588000877", False, None, "2021-08-21T23:20:00Z"),
    ("19650328", False, None, "1965-03-28"), ("1896", False, None, "1896"), ("12:23,\xa08\xa0September\xa02014\xa0(UTC)", False, None, "2014-09-08T12:23:00Z"),
    ("08 July 2022 17:56:12 UTC+05:30", False, None, "2022-07-08T12:26:12Z"), ("Wed, 20 May 2009 00:16:19 +0000", False, None, "2009-05-20T00:16:19Z"), ("el 7 de septiembre de 1897", False, None, "1897-09-07"),
    ("26 Juli 2020 02:01", False, "Europe/Berlin", "2020-07-26T00:01:00Z"), ("2021-03-28 02:30:00", False, "Europe/Berlin", None), ("2020-10-25 02:30:00", False, "Europe/Berlin", "2020-10-25T00:30:00Z"),
    ("30 February 2020", False, None, None), ("1951-13-30", False, None, None), ("p. 47", False, None, None), ("18??", False, None, None), ("25:61", False, None, None), ("", False, None, None), (" ", False, None, None),
    ("sine anno", False, None, None), ("5 Foo 2020", False, None, None), ("12/1791", False, None, "1791-12"), ("from 1948 to 1953", False, None, "1948"), ("1944-1941", False, None, None),
    ("2014-01-01 10:00", False, "No/Where", None), ("1 Sep 2014 2pm", False, None, "2014-09-01T14:00:00Z"), ("2014-06-30 10:15:00.123 Europe/Paris", False, "Asia/Tokyo", "2014-06-30T08:15:00Z"), ("2014-06-30 10:15 No/Where", False, None, None), ("20140630T101500Z", False, None, "2014-06-30T10:15:00Z"), ("20140630T1015+0200", False, None, "2014-06-30T08:15:00Z"), ("17 June" + " " * 300 + "2012", False, None, "2012-06-17"), ("[" * 200 + "17 June 2012" + "]" * 200, False, None, None), ("x" * 100_000, False, None, None),
]


@pytest.mark.parametrize("text,month_first,zone,want", CASES)
def test_forms(text, month_first, zone, want):
    assert normal_date(text, month_first, zone) == want


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_is_read_without_error(text):
    got = normal_date(text, True, "America/New_York")
    assert got is None or got.lstrip("-")[:3].isdigit()


DDL = "source_id bigint, date_raw string, date_iso string, lang_tag string, venue_zone string, text string, zone string"


def test_rows_and_fallback(spark, rows):
    data = [
        (1, "03/04/2004", None, "en-US", None, "x", "y"), (2, "03/04/2004", None, "en-GB", "Europe/London", None, None), (3, None, "1999-05", None, None, None, None), (4, " \xa0", "1999", "de", None, None, None),
        (5, None, None, "fr", None, None, None), (6, "undated", "1999", "fr", None, None, None), (None, "1877", None, "fr", None, None, None), (2, "03/04/2004", None, "en-GB", "Europe/London", None, None), (7, "9" * 5000, None, "fr", " ", None, None),
    ]
    df = spark.createDataFrame(data, DDL)
    got = rows(normalise_dates(df, "source_id", "date_raw", "date_iso", "lang_tag", "venue_zone"))
    assert got == sorted([(1, "2004-03-04"), (2, "2004-04-03"), (2, "2004-04-03"), (3, "1999-05"), (4, "1999"), (None, "1877")], key=repr)
    assert normalise_dates(df.limit(0), "source_id", "date_raw", "date_iso", "lang_tag", "venue_zone").count() == 0


def test_dictionary_grows(spark, rows):
    df = spark.createDataFrame([(1, "1999", None, "fr", None, "", ""), (2, "May 2001", None, "fr", None, "", "")], DDL)
    d = DateDictionary(spark)
    normalise_dates(df.where("source_id = 1"), "source_id", "date_raw", "date_iso", "lang_tag", "venue_zone", d)
    assert d.table().count() == 1
    got = rows(normalise_dates(df, "source_id", "date_raw", "date_iso", "lang_tag", "venue_zone", d))
    assert got == [(1, "1999"), (2, "2001-05")] and d.table().count() == 2
    # another writer that began before sees nothing of it and adds the same strings: each is still given once
    other = DateDictionary(spark, d.path)
    other._parts = lambda: []
    other.update(d.table().select("text", "month_first", "zone"))
    assert len(d._parts()) == 3 and rows(d.table()) == rows(d.spark.read.parquet(*d._parts()).distinct()) and d.table().count() == 2
    assert rows(normalise_dates(df, "source_id", "date_raw", "date_iso", "lang_tag", "venue_zone", DateDictionary(spark, d.path))) == got
