"""Column functions against the values the rules ask for."""

import datetime as dt
import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rollcall.functions.clock import parse_duration, parse_timestamp
from rollcall.functions.text import (
    blank_to_null, casefold, match_key, normalise_email, normalise_header, normalise_label, normalise_name, session_key, strip,
)


def column(spark, values, function):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row.r for row in frame.select("i", function("v").alias("r")).orderBy("i").collect()]


STAMPS = {
    "3/4/26, 8:58:30 AM": dt.datetime(2026, 3, 4, 8, 58, 30),
    " 06/04/2025, 01:07 AM ": dt.datetime(2025, 6, 4, 1, 7),
    "12/31/49, 12:00:00 AM": dt.datetime(2049, 12, 31),
    "1/1/50, 12:30 pm": dt.datetime(1950, 1, 1, 12, 30),
    "1/1/75, 11:59:59 PM": dt.datetime(1975, 1, 1, 23, 59, 59),
    "3/30/25, 2:30:00 AM": dt.datetime(2025, 3, 30, 2, 30),
    "11/9/24 7:12PM": dt.datetime(2024, 11, 9, 19, 12),
    "2/30/25, 1:00 PM": None, "13/1/25, 1:00 PM": None, "11/9/24, 13:00 PM": None, "11/9/24, 0:00 AM": None,
    "11/9/24, 1:60 PM": None, "11/9/24": None, "2025-06-24 13:00:00": None, "": None, "  ": None, None: None, "junk": None,
}


def test_timestamps(spark):
    assert column(spark, list(STAMPS), parse_timestamp) == list(STAMPS.values())


def test_timestamps_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Bucharest")
        assert column(spark, ["3/30/25, 3:30:00 AM"], parse_timestamp) == [dt.datetime(2025, 3, 30, 3, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


DURATIONS = {
    "1h 32m 32s": 5552, "20m 0s": 1200, "2 H": 7200, "45 min": 2700, "10s": 10, "1h30m": 5400, "unknown": 0, "12": 0,
    "": None, "   ": None, None: None, "99999999999999999999h": None,
}


def test_durations(spark):
    assert column(spark, list(DURATIONS), parse_duration) == list(DURATIONS.values())


TEXT = st.text(alphabet=st.characters(codec="utf-8"), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_text_functions_match_python(spark, values):
    assert column(spark, values, strip) == [v.strip() for v in values]
    lowered = lambda v: re.sub(r"[^a-z0-9]+", "_", v.strip().lower())
    ascii_only = [v for v in values if v.isascii()] or ["a"]
    assert column(spark, ascii_only, normalise_header) == [re.sub("_+", "_", lowered(v)).strip("_") for v in ascii_only]
    assert column(spark, ascii_only, normalise_label) == [
        re.sub(r"[^a-z0-9]+", " ", v.replace("\x00", "").strip().casefold()).strip() for v in ascii_only
    ]


FOLDED = ["Straße", "ſummary", "ﬁnal", "ΣΊΣΥΦΟΣ", "Ŭber", "ẞ", "K", "plain", ""]


def test_casefold(spark):
    assert column(spark, FOLDED, casefold) == [v.casefold() for v in FOLDED]


def test_labels(spark):
    values = ["﻿1. Summary", " In-Meeting  Duration ", "Participant ID (UPN)", "M\x00e\x00", "ſummary"]
    assert column(spark, values, normalise_label) == ["1 summary", "in meeting duration", "participant id upn", "me", "summary"]
    assert column(spark, [" Line-Manager (E-mail) ", "__x__"], normalise_header) == ["line_manager_e_mail", "x"]


def test_blank_and_defaults(spark):
    assert column(spark, [" a ", "  ", "", None, "\ta"], blank_to_null) == ["a", None, None, None, "\ta"]
    assert column(spark, [" A@B ", None], normalise_email) == ["a@b", ""]
    assert column(spark, [" A B\n", None], normalise_name) == ["A B", ""]


def test_keys(spark):
    row = spark.createDataFrame([(" Straße ", " 1/1/25 ")], "t string, s string").select(session_key("t", "s").alias("k")).first()
    assert row.k == hashlib.sha256("strasse|1/1/25".encode()).hexdigest()
    people = spark.createDataFrame(
        [("A@X", "1", "N"), (None, "1", "N"), (None, None, "N")], "email string, participant_id string, participant_name string"
    )
    assert [r.k for r in people.select(match_key().alias("k")).collect()] == ["a@x", "1", "n"]


@pytest.mark.parametrize("value", ["1/2/25, 3:04 AM"])
def test_parsing_is_one_expression(spark, value):
    plan = spark.createDataFrame([(value,)], "v string").select(parse_timestamp("v"), parse_duration("v"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert F is not None
