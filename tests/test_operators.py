"""Edge rows and skewed keys of the operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from leadlens.operators import aggregates as A
from leadlens.operators import dedup as U
from leadlens.operators import joins as J
from leadlens.operators.asof import attribute_first, first_after
from leadlens.operators.cells import tagged_cells
from leadlens.operators.ordered import next_event, running_number

from conftest import plan_of, values

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


# ---- one row per key -----------------------------------------------------------------------


def test_latest_null_placement_and_ties(frame):
    rows = [("a", None, 1), ("a", at(1), 2), ("b", at(5), 3), ("b", at(5), 4)]
    df = frame(rows, "k string, ts timestamp_ntz, id int")
    assert values(U.latest_by(df, ["k"], "ts", "last", ["id"]), "k", "id") == [("a", 2), ("b", 4)]
    assert values(U.latest_by(df, ["k"], "ts", "first", ["id"]), "k", "id") == [("a", 1), ("b", 4)]
    assert values(U.earliest_by(df, ["k"], "ts", ["id"]), "k", "id") == [("a", 2), ("b", 3)]


def test_top_one_limits_groups_before_the_shuffle(frame):
    df = frame([("a", at(1), 2)], "k string, ts timestamp_ntz, id int")
    plan = plan_of(U.latest_by(df, ["k"], "ts", tiebreak=["id"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_any_flag_uses_every_row_but_only_current_ones_when_filtered(frame):
    rows = [("a", at(1), 1), ("a", at(2), 0), ("b", at(1), 0)]
    df = frame(rows, "k string, ts timestamp_ntz, f int")
    got = U.any_flag_then_latest(df, ["k"], {"any": "f = 1"}, "ts")
    assert values(got, "k", "f", "any") == [("a", 0, 1), ("b", 0, 0)]
    assert "Window" not in plan_of(got)


def test_latest_valid(frame):
    rows = [("a", at(1), "yes"), ("a", at(2), "bogus"), ("b", at(3), "no"), ("b", at(3), "yes"), ("c", at(1), "bogus")]
    df = frame(rows, "k string, ts timestamp_ntz, c string")
    assert values(U.latest_valid(df, "k", "ts", "c", ["yes", "no"]), "k", "c") == [("a", "yes"), ("b", "yes")]
    assert values(U.latest_valid(df, "k", "ts", "c", ["yes", "no"], "none"), "k", "c")[-1] == ("c", "none")


def test_dedup_events_credits_one_entity(frame):
    rows = [("d", "t1", "open", at(9), "e2"), ("d", "t1", "open", at(8), "e1"), ("d", "bad", "open", at(1), "e1")]
    df = frame(rows, "d string, ts string, n string, synced timestamp_ntz, e string")
    got = U.dedup_events(df, ["d", "ts", "n"], ["synced", "e"])
    assert values(got, "ts", "e") == [("bad", "e1"), ("t1", "e1")]


# ---- interval attribution ------------------------------------------------------------------


def brute(left, right, before, after):
    out = []
    for key, ts, nb in left:
        hits = sorted(
            (r, i)
            for k, r, i in right
            if key is not None and k == key and r is not None and ts is not None
            and ts - dt.timedelta(minutes=before) <= r <= ts + dt.timedelta(minutes=after)
            and (nb is None or r < nb)
        )
        out.append((key, ts, hits[0][1] if hits else None))
    return sorted(out, key=repr)


def attribute(frame, left, right, before, after, bucket):
    ldf = frame(left, "k string, bt timestamp_ntz, nb timestamp_ntz")
    rdf = frame(right, "k string, rt timestamp_ntz, id int")
    return attribute_first(
        ldf, rdf, ["k"], "bt", "rt", ["id"], before, after, "nb", ["id"], bucket_minutes=bucket
    )


def test_attribution_edges(frame):
    left = [("low", at(1000), None), ("high", at(1000), None), ("next", at(1000), at(1100)), ("tie", at(1000), None),
            ("none", at(1000), None), (None, at(1000), None), ("notime", None, None)]
    right = [("low", at(880), 1), ("low", at(879), 9), ("high", at(1000 + 20160), 2), ("next", at(1100), 3),
             ("tie", at(1001), 5), ("tie", at(1001), 4), (None, at(1000), 7), ("notime", at(5), 8), ("tie", None, 0)]
    got = {r.k: r.id for r in attribute(frame, left, right, 120, 20160, 60).collect()}
    assert got == {"low": 1, "high": 2, "next": None, "tie": 4, "none": None, None: None, "notime": None}


@pytest.mark.parametrize("bucket", [1, 60, 100000])
def test_attribution_equals_brute_force_with_a_hot_key(frame, bucket):
    rng = random.Random(bucket)
    keys = ["hot"] * 10 + [f"k{i}" for i in range(12)] + [None]
    left = [(rng.choice(keys), at(rng.randrange(6000)), None) for _ in range(300)]
    left = [(k, t, at((t - T0).total_seconds() // 60 + rng.randrange(1, 900)) if rng.random() < 0.7 else None) for k, t, _ in left]
    right = [(rng.choice(keys), at(rng.randrange(7000)), i) for i in range(300)]
    got = attribute(frame, left, right, 120, 600, bucket)
    assert values(got, "k", "bt", "id") == brute(left, right, 120, 600)


def test_attribution_has_no_pairwise_join(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(attribute(frame, [("a", at(1), None)], [("a", at(2), 1)], 10, 10, 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and "Broadcast" not in plan
    # The only shuffled join meets the per-bucket summary on the partitioning the window already has.
    assert plan.count("SortMergeJoin") == 1


def test_first_after_is_strict(frame):
    left = frame([("a", at(10)), ("b", at(10)), ("c", at(10))], "k string, v timestamp_ntz")
    right = frame([("a", at(10)), ("a", at(500)), ("b", at(9))], "k string, t timestamp_ntz")
    got = first_after(left, right, ["k"], "v", "t", "hit")
    assert values(got, "k", "hit") == [("a", at(500)), ("b", None), ("c", None)]


# ---- ordered numbering ---------------------------------------------------------------------


@pytest.mark.parametrize("bucket", [1, 60])
def test_next_event_and_running_number(frame, bucket):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b"]), at(rng.randrange(3000)), i) for i in range(400)]
    df = frame(rows, "k string, ts timestamp_ntz, id int")
    want_next, want_no = [], []
    for key in {"hot", "a", "b"}:
        mine = sorted((t, i) for k, t, i in rows if k == key)
        for n, (t, i) in enumerate(mine):
            want_next.append((i, mine[n + 1][0] if n + 1 < len(mine) else None))
            want_no.append((i, n + 1))
    assert values(next_event(df, ["k"], "ts", "nx", ["id"], bucket), "id", "nx") == sorted(want_next, key=repr)
    assert values(running_number(df, ["k"], "ts", "no", ["id"], bucket), "id", "no") == sorted(want_no, key=repr)


def test_half_of_the_rows_in_one_hour_of_one_key(frame):
    rng = random.Random(9)
    rows = [("hot", at(rng.randrange(60)), i) for i in range(300)] + [(f"k{i % 40}", at(rng.randrange(9000)), 300 + i) for i in range(300)]
    df = frame(rows, "k string, ts timestamp_ntz, id int")
    out = next_event(df, ["k"], "ts", "nx", ["id"])
    want = []
    for key in {k for k, _, _ in rows}:
        mine = sorted((t, i) for k, t, i in rows if k == key)
        want += [(i, mine[n + 1][0] if n + 1 < len(mine) else None) for n, (t, i) in enumerate(mine)]
    assert values(out, "id", "nx") == sorted(want, key=repr)
    assert "__bucket" in plan_of(out)


def test_rows_without_a_key_or_time_are_spread(spark, frame):
    width, n = 1000, 20000
    df = spark.range(n).selectExpr("IF(id < 0, 'x', NULL) AS k", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = next_event(df, ["k"], "ts", "nx", ["id"])
        used = out.select("nx", F.spark_partition_id().alias("p")).where("nx IS NULL").select("p").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert used > 0.9 * width


def test_rows_without_a_time(frame):
    df = frame([("a", None, 1), ("a", None, 2), ("a", at(-5000000), 3), ("a", at(7), 4)], "k string, ts timestamp_ntz, id int")
    before = at(7)
    assert values(next_event(df, ["k"], "ts", "nx", ["id"]), "id", "nx") == [(1, None), (2, None), (3, before), (4, None)]
    assert values(running_number(df, ["k"], "ts", "no", ["id"]), "id", "no") == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_rows_without_a_key_have_no_order(frame):
    df = frame([(None, at(1), 1), (None, at(2), 2)], "k string, ts timestamp_ntz, id int")
    assert values(next_event(df, ["k"], "ts", "nx", ["id"]), "id", "nx") == [(1, None), (2, None)]
    assert values(running_number(df, ["k"], "ts", "no", ["id"]), "id", "no") == [(1, None), (2, None)]


# ---- joins ---------------------------------------------------------------------------------


def test_anti_join_keeps_null(frame):
    df = frame([("x", 1), ("y", 2), (None, 3)], "k string, id int")
    listed = frame([("x",), (None,)], "k string")
    assert values(J.anti_keep_null(df, listed, ["k"]), "id") == [(2,), (3,)]


def test_lookup_spreads_null_keys(spark, frame):
    left = frame([(None, i) for i in range(500)] + [("a", -1)], "k string, id int")
    right = frame([("a", 10)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = J.lookup(left, right, ["k"], row_id=["id"])
        assert "hashpartitioning(k" in plan_of(out) and J.SPREAD in plan_of(out)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert out.filter("v = 10").count() == 1 and out.count() == 501
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 300


def test_resolve_identity(frame):
    users = frame(
        [("1", "c1", "OWNER", "ACTIVE"), ("1", "c2", "MANAGER", "ACTIVE"), ("x", "c1", "OWNER", "ACTIVE"),
         ("2", "c1", "TECHNICIAN", "ACTIVE"), ("3", "c1", "OWNER", "LEFT"), ("4", "c3", "OWNER", "ACTIVE")],
        "id string, csp_id string, role string, status string",
    )
    ents = frame([("c1", "p9", True), ("c2", "p1", True), ("c3", "p3", False)], "csp_id string, partner_id string, etl_current boolean")
    roles = ["OWNER", "MANAGER"]
    assert values(J.resolve_identity(users, ents, roles), "identity", "pid") == [("1", "p1"), ("x", "p9")]
    assert values(J.resolve_identity(users, ents, roles, integer_ids=True), "identity", "pid") == [(1, "p1")]


def test_zero_fill(frame):
    out = J.zero_fill(frame([("a",), ("b",)], "pid string"), frame([("a", 3, 1.5)], "pid string, n int, m double"), "pid", ["n"])
    assert values(out, "pid", "n", "m") == [("a", 3, 1.5), ("b", 0, None)]


# ---- aggregates ----------------------------------------------------------------------------


def test_median_rounding(frame):
    df = frame([("a", 1), ("a", 2), ("b", 7), ("c", None)], "k string, v int")
    got = df.groupBy("k").agg(A.median_round("true", "v").alias("m"))
    assert values(got, "k", "m") == [("a", 2.0), ("b", 7.0), ("c", None)]


def test_nearest_rank(frame):
    shares = [5 * k for k in range(2, 20)]  # in hundredths, so that the wanted rank is exact
    df = frame([(n, v) for n in range(1, 41) for v in range(n)], "n int, v int")
    got = df.groupBy("n").agg(*[A.nearest_rank("v", p / 100).alias(f"p{p}") for p in shares]).collect()
    assert all(r[f"p{p}"] == r.n * p // 100 for r in got for p in shares)


def test_cut_medians_keep_fractions(frame):
    df = frame([("x", "k", v) for v in (1.5, 2.5, 2.9)], "f string, d string, v double")
    assert [r.m for r in A.cut_by(df, ["f"], ["d"], {}, {"m": ("true", "v")}).collect()] == [3.0]


def test_cuts_separate_null_keys_from_rolled_up_ones(frame):
    rows = [("PRE", "x", 1, 1, 10), ("PRE", "x", None, 0, 30), ("PRE", None, 1, 1, None), ("POST", "y", 0, 1, 4), ("POST", "y", 0, 1, 7)]
    df = frame(rows, "period string, a string, b int, hit int, v int")
    wide = A.cut_by(df, ["period"], ["a", "b"], {"n": "true", "hits": "hit = 1"}, {"mid": ("hit = 1", "v")})
    assert wide.filter("g_a = 0 AND a IS NULL").count() == 1
    got = values(A.pick_cut(wide, ["period"], ["a", "b"], ["n", "hits", "mid"]), "period", "dim", "key", "n", "hits", "mid")
    assert got == sorted(
        [("PRE", "a", "x", 2, 1, 10.0), ("PRE", "b", "1", 2, 2, 10.0), ("POST", "a", "y", 2, 2, 6.0), ("POST", "b", "0", 2, 2, 6.0)],
        key=repr,
    )


def test_cut_expands_cells_and_not_facts(frame):
    df = frame([("PRE", "x", 1, 1)], "period string, a string, b int, v int")
    plan = plan_of(A.cut_by(df, ["period"], ["a", "b"], {"n": "true"}, {"mid": ("true", "v")}))
    assert plan.index("Expand") < plan.rindex("HashAggregate") and plan.rindex("Exchange") > plan.index("Expand")


def test_complement_count(frame):
    cities = frame([("1", "New Delhi"), ("1", "New Delhi"), ("2", "DELHI"), ("3", "Pune"), (None, "delhi")], "pid_ string, city string")
    out = A.complement_count(cities, "pid_", "city", "%delhi%", frame([("2",)], "pid string"))
    assert out.first()[0] == 1


def test_tagged_cells_equal_union(frame):
    rows = [(dt.date(2024, 1, 1), 3, "E", 2), (dt.date(2024, 1, 1), 3, "N", 7), (dt.date(2024, 1, 1), 3, "E", 7)]
    df = frame(rows, "d0 date, h0 int, coh string, depth int")
    tags = [("B", "d0", "h0", "coh = 'E' AND depth >= 2"), ("K", "d0", "h0", "coh = 'E' AND depth >= 7")]
    got = tagged_cells(df, tags)
    assert values(got, "k", "hr", "n") == [("B", 3, 2), ("K", 3, 1)]
