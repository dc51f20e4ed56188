"""Text and date expressions against their definitions in plain Python."""

from datetime import datetime
from time import strptime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from tidemark.functions import (
    collapse_whitespace,
    legacy_timestamp,
    legacy_timestamp_invalid,
)

LOOSE = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def applied(spark, values, expression):
    rows = texts(spark, values).select("i", expression.alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def squeezed(text):
    return " ".join(text.split())


def parsed(text):
    words = text.split()
    try:
        month = strptime(words[1], "%b").tm_mon
        hour, minute, second = (int(part) for part in words[3].split(":"))
        return datetime(int(words[5]), month, int(words[2]), hour, minute, second)
    except (IndexError, ValueError):
        return None


def test_every_character_counts_as_in_python(spark):
    values = [f"a{chr(c)}b" for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    got = applied(spark, values, collapse_whitespace("s"))
    assert got == [squeezed(v) for v in values]


def test_whitespace_null_and_empty(spark):
    values = [None, "", "   ", "  a \t\n b c\x1cd "]
    assert applied(spark, values, collapse_whitespace("s")) == [None, "", "", "a b c d"]


@LOOSE
@given(st.lists(st.text(st.sampled_from("ab \t\n\r\x1c\x85\xa0 　é")), min_size=1))
def test_whitespace_random(spark, values):
    assert applied(spark, values, collapse_whitespace("s")) == [squeezed(v) for v in values]


@pytest.mark.parametrize("text, expected", [
    ("Sat Jul 04 10:11:12 -0700 2020", datetime(2020, 7, 4, 10, 11, 12)),
    ("XXX jUL 4 1:2:3 zz 2020", datetime(2020, 7, 4, 1, 2, 3)),
    ("Sun Mar 08 02:30:00 -0800 2020", datetime(2020, 3, 8, 2, 30)),
    ("Sat Feb 29 23:59:59 +0000 2020 and more", datetime(2020, 2, 29, 23, 59, 59)),
    (" Sat\tJul  +4 \n 010:00:12 -0700 0020 ", datetime(20, 7, 4, 10, 0, 12)),
    ("Sat Feb 30 10:11:12 -0700 2020", None),
    ("Sat Foo 04 10:11:12 -0700 2020", None),
    ("Sat July 04 10:11:12 -0700 2020", None),
    ("Sat Jul 04 10:11 -0700 2020", None),
    ("Sat Jul 04 10:11:12:13 -0700 2020", None),
    ("Sat Jul 04 10:11:60 -0700 2020", None),
    ("Sat Jul 04 24:00:00 -0700 2020", None),
    ("Sat Jul 00 10:11:12 -0700 2020", None),
    ("Sat Jul 04 10:11:12 -0700 0", None),
    ("Sat Jul 04 10:11:12 -0700 12020", None),
    ("Sat Jul 04 10:11:12 2020", None),
    ("Jul4 10:11:12 2020", None),
    ("xJul4 10:11:12 2020", None),
    ("Sat Jul 04", None),
    ("", None),
])
def test_legacy_timestamp(spark, text, expected):
    assert parsed(text) == expected
    assert applied(spark, [text], legacy_timestamp("s")) == [expected]
    assert applied(spark, [text], legacy_timestamp_invalid("s")) == [expected is None]


def test_legacy_timestamp_null_is_not_invalid(spark):
    assert applied(spark, [None], legacy_timestamp("s")) == [None]
    assert applied(spark, [None], legacy_timestamp_invalid("s")) == [False]


def test_legacy_timestamp_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = texts(spark, ["Sun Mar 08 02:30:00 -0800 2020"]).select(
            legacy_timestamp("s").cast("string").alias("r")
        ).first().r
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == "2020-03-08 02:30:00"


def test_legacy_timestamp_strict_names_the_text(spark):
    good, bad = "Sat Jul 04 10:11:12 -0700 2020", "Sat Jul 44 10:11:12 -0700 2020"
    assert applied(spark, [good, None], legacy_timestamp("s", strict=True))[1] is None
    with pytest.raises(PySparkException, match="Jul 44"):
        applied(spark, [good, bad], legacy_timestamp("s", strict=True))


PART = st.one_of(
    st.sampled_from(["Sat", "jul", "FEB", "29", "4", "30", "2020", "1900", "-0700", "", "x"]),
    st.builds("{}:{}:{}".format, *[st.integers(0, 62)] * 3),
)
DATE = st.builds(
    "{} {} {} {}:{}:{} {} {}".format,
    st.sampled_from(["Sat", "?"]),
    st.sampled_from(["Jan", "feb", "SEP", "Sept", "dEc", "no"]),
    st.integers(0, 33), st.integers(0, 25), st.integers(0, 61), st.integers(0, 61),
    st.sampled_from(["-0700", "Z"]), st.integers(0, 10001),
)


@LOOSE
@given(st.lists(st.one_of(DATE, st.lists(PART, max_size=8).map(" ".join)), min_size=20))
def test_legacy_timestamp_random(spark, values):
    assert applied(spark, values, legacy_timestamp("s")) == [parsed(v) for v in values]


def test_no_python_worker(spark):
    frame = texts(spark, ["a"]).select(collapse_whitespace("s"), legacy_timestamp("s"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
