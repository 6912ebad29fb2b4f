"""Edge rows of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadlens.config import RANK_DEPTH, STATE_RANK, FunnelConfig
from leadlens.functions import labels as L
from leadlens.functions import predicates as X
from leadlens.functions import temporal as T
from leadlens.functions.maps import any_count_with_prefix, min_first_seen
from leadlens.functions.rates import pct, ratio, whole

D = dt.datetime


def one(df, *exprs):
    return tuple(df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first())


@pytest.fixture
def pair(frame):
    def make(a, b):
        return frame([(a, b)], "a timestamp_ntz, b timestamp_ntz")

    return make


@pytest.mark.parametrize(
    "a, b, want",
    [
        (D(2024, 1, 1, 0, 0, 59), D(2024, 1, 1, 0, 1, 0), 1),
        (D(2024, 1, 1, 0, 0, 0), D(2024, 1, 1, 0, 0, 59), 0),
        (D(2024, 1, 1, 0, 1, 0), D(2024, 1, 1, 0, 0, 59), -1),
        (D(2023, 12, 31, 23, 59, 59, 999999), D(2024, 1, 1), 1),
        (None, D(2024, 1, 1), None),
        (D(2024, 1, 1), None, None),
    ],
)
def test_minute_diff_counts_boundaries(pair, a, b, want):
    assert one(pair(a, b), T.minute_diff("a", "b")) == (want,)


def test_minute_diff_ignores_the_session_zone(spark, pair):
    df = pair(D(2024, 3, 10, 1, 30), D(2024, 3, 10, 3, 30))  # across a US clock change
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(df, T.minute_diff("a", "b"), T.second_diff("a", "b"), F.expr("hour(b)")) == (120, 7200, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("minutes, flag", [(-1, 0), (0, 1), (2880, 1), (2881, 0), (None, 0)])
def test_maturity_flag(pair, minutes, flag):
    start = D(2024, 1, 5)
    end = None if minutes is None else start + dt.timedelta(minutes=minutes)
    assert one(pair(start, end), T.within_minutes("a", "b")) == (flag,)


def test_durations(pair):
    late, early = D(2024, 1, 2), D(2024, 1, 1)
    exprs = [
        T.tat_minutes("a", "b"),
        T.tat_minutes("a", "b", clamp=True),
        T.tat_minutes("a", "b", hi=1440),
        T.tat_minutes("a", "b", hi=1439),
    ]
    assert one(pair(early, late), *exprs) == (1440, 1440, 1440, None)
    assert one(pair(late, early), *exprs) == (None, 0, None, None)
    assert one(pair(None, late), *exprs) == (None, None, None, None)


def test_anchored_period_edges(frame):
    as_of, ad = dt.date(2024, 1, 20), dt.date(2024, 1, 11)  # ten live days
    days = {
        ad: "POST",
        as_of: "POST",
        as_of + dt.timedelta(1): None,
        ad - dt.timedelta(1): "PRE",
        ad - dt.timedelta(10): "PRE",
        ad - dt.timedelta(11): None,
    }
    df = frame([(d, ad) for d in days], "d date, ad date").select("d", T.period_anchored("d", "ad", as_of).alias("p"))
    assert {r.d: r.p for r in df.collect()} == days
    late = frame([(as_of, as_of + dt.timedelta(3))], "d date, ad date")
    assert one(late, T.period_anchored("d", "ad", as_of)) == (None,)


def test_fixed_period_and_config_windows():
    cfg = FunnelConfig(launch=dt.date(2024, 2, 10), as_of=dt.date(2024, 2, 12))
    assert (cfg.n_days, cfg.pre_start, cfg.pre_end) == (3, dt.date(2024, 2, 7), dt.date(2024, 2, 9))
    assert cfg.month_remaining == 17 and cfg.month_start == dt.date(2024, 2, 1)
    assert cfg.scan_from(5) == dt.date(2024, 2, 4)
    assert cfg.with_(history_start=dt.date(2024, 1, 1)).scan_from(5) == dt.date(2024, 1, 1)
    assert FunnelConfig(launch=dt.date(2024, 2, 10), as_of=dt.date(2024, 1, 1)).as_of == dt.date(2024, 2, 10)


def test_hour_bucket(pair):
    df = pair(D(2024, 1, 1, 7, 59), D(2024, 1, 1, 8, 0))
    assert one(df, T.hour_bucket("a", "night"), T.hour_bucket("b", "night"), T.hour_bucket("b", 8)) == (True, False, True)


def test_stage_ladder_first_rung_wins(frame):
    df = frame([(1, 1), (0, 1), (0, 0), (None, None)], "a int, b int")
    depth = L.stage_depth([("a = 1", 6), ("b = 1", 5)], 1)
    assert [r[0] for r in df.select(depth).collect()] == [6, 5, 1, 1]


def test_state_rank_and_depth(frame):
    states = [*STATE_RANK, "DECLINED", "SOMETHING_ELSE", None]
    df = frame([(s,) for s in states], "s string").select("s", L.rank_of("s", STATE_RANK).alias("r"))
    got = {r.s: (r.r, r.d) for r in df.withColumn("d", L.depth_of_rank("r", RANK_DEPTH)).collect()}
    assert got["AWAITING_SLOT_PROPOSAL"] == (1, 2) and got["DECLINED"] == (0, 2) and got[None] == (0, 2)
    assert got["TECHNICIAN_ASSIGNED"] == (4, 5) and got["AWAITING_CUSTOMER_OTP"] == (7, 6)
    assert got["RATING_PENDING"] == (8, 7) and got["SLOT_SELECTED"] == (2, 3)


def test_cohort_label(frame):
    df = frame([("p", "p"), (None, "p"), (None, None)], "r string, e string")
    assert [x[0] for x in df.select(L.cohort_label("r", "e")).collect()] == ["E", "N", None]


def test_mask_and_reason_and_label(frame):
    df = frame([("9876543210", "busy", "r1", "far"), ("1234", "", "r1", ""), ("12", None, None, "far")], "m string, a string, b string, s string")
    got = [tuple(r) for r in df.select(L.mask_key("m"), L.reason_text("a", "b", "s"), L.label_of("a", {"busy": "Busy"})).collect()]
    assert got == [("98XXXXX210", "busy / far", "Busy"), ("12XXXXX234", "r1", ""), ("12XXXXX12", " / far", None)]


def test_live_filters_and_exclusion(frame):
    df = frame([(True, "G"), (False, "A"), (None, None)], "d boolean, f string")
    assert X.live(df, "d").count() == 1
    assert X.live(df, "d", "lenient").count() == 2
    assert X.live(df, "d", "current").count() == 1
    assert [r.f for r in X.exclude_values(df, "f", ["G", "H"]).collect()] == ["A", None]
    assert [r.f for r in X.exclude_values(df, "f", ["G", "H"], keep_null=False).collect()] == ["A"]
    assert [r[0] for r in df.select(X.flag("d")).collect()] == [1, 0, 0]


def test_rates(frame):
    df = frame([(1, 8, 0), (1, 1, 0), (None, 3, 0)], "a int, b int, z int")
    got = [tuple(r) for r in df.select(pct("a", "b"), pct("a", "z"), pct("a", "z", zero_den=0.0), ratio("a", "b", 2), whole("a", "b")).collect()]
    assert got == [(12.5, None, 0.0, 0.13, 0), (100.0, None, 0.0, 1.0, 1), (None, None, 0.0, None, None)]
    half = frame([(1, 2000)], "a int, b int")
    assert one(half, pct("a", "b"), whole("1", "2")) == (0.1, 1)  # halves go up


def test_profile_map(frame):
    schema = "e map<string, struct<count: bigint, first_seen: bigint>>"
    df = frame(
        [
            ({"View_a": (0, 50), "View_b": (None, 40), "Scroll_a": (2, None)},),
            ({"View_a": (1, 0), "View_b": (1, 70), "Other": (5, 1)},),
            ({},),
            (None,),
        ],
        schema,
    )
    got = [tuple(r) for r in df.select(any_count_with_prefix("e", "View_"), any_count_with_prefix("e", "Scroll_"), min_first_seen("e", "View_")).collect()]
    assert got == [(0, 1, 40), (1, 0, 70), (0, 0, None), (0, 0, None)]
