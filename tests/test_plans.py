"""Composite operators on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadlens.bindings.event_tables import CONFIG, DATE_FROM, EventRoles
from leadlens.config import FunnelConfig
from leadlens.operators.joins import lookup
from leadlens.plans import base as B
from leadlens.plans import classes as C
from leadlens.plans import document as DOC
from leadlens.plans import funnel as P
from leadlens.plans import roster as R
from leadlens.plans.journey import collect_journey
from leadlens.plans.tables import Tables
from leadlens.plans.weather import daily_weather
from leadlens.session import shared_dir, stage, staging, together
from leadlens.sources import publish_json, published, read_cohorts, read_hourly, read_profiles
from leadlens.sources.publish import EmptyPanel

from conftest import SMALL, plan_of, values

D = dt.datetime


@pytest.mark.parametrize(
    "days, recv, conf, inst, mg, mgp",
    [
        (10, 5, 2, 2, "mg_lo", "mg_lo"),
        (10, 5, 3, 0, "no_mg", "no_mg"),
        (10, 9, 5, 3, "mg_hi", "mg_hi"),  # exactly 60 %
        (6, 9, 5, 3, "mg_hi", "too_early"),
        (7, 9, 2, 2, "mg_lo", "mg_hi"),  # 2 * (7 + 4) / 7 > 3
        (8, 9, 2, 0, "mg_lo", "no_mg"),  # exactly 3 projected
        (12, 0, 0, 0, "mg_lo", "mg_lo"),
    ],
)
def test_classification(frame, days, recv, conf, inst, mg, mgp):
    cfg = FunnelConfig(launch=dt.date(2024, 1, 1), as_of=dt.date(2024, 1, 27))
    rows = [("E", "POST", "p", 7 if i < inst else 5 if i < conf else 2, int(i < conf), 0, 0, int(i < inst)) for i in range(recv)]
    base = frame(rows, "coh string, period string, mgpid string, cur_depth int, conf48 int, asgn48 int, reached48 int, inst48 int")
    people = frame([("p", days), ("late", 0)], "pid string, days int")
    got = C.classify_entities(base, people, cfg).collect()
    assert [(r.pid, r.received, r.mg, r.mgp) for r in got] == [("p", recv, mg, mgp)]


def test_projection_holds_early_entities(frame):
    cfg = FunnelConfig(launch=dt.date(2024, 1, 1), as_of=dt.date(2024, 1, 27))
    rows = frame([("a", 8, 10, 4), ("b", 6, 10, 4)], "pid string, days int, received bigint, installed bigint")
    assert tuple(C.projection_totals(rows, cfg).first()) == (25, 10)


def test_weather_edges(frame):
    def row(day, hour, rain, cloud=0.0):
        return (D(2024, 1, day, hour), rain, cloud)

    rows = [
        row(1, 12, 15.0), row(1, 22, 1.0),
        row(3, 12, 0.0, 80.0), row(3, 3, 0.0),  # the 2nd is missing: the 1st is the previous day
        row(4, 10, 2.5), row(5, 10, 0.3), row(6, 10, None, 70.0), row(7, 10, 0.2, 69.9), row(7, 8, 99.0, 100.0),
    ]
    got = daily_weather(frame(rows, "ts timestamp_ntz, precip double, cloud double").withColumn("site", F.lit("s")), ["site"])
    classes = {r.day.day: r.weather for r in got.collect()}
    assert classes == {1: "storm", 3: "wet_night", 4: "rain", 5: "showers", 6: "cloudy", 7: "clear"}


def test_journey_pages_keep_every_hop(frame):
    rows = [("hot", D(2024, 1, 1) + dt.timedelta(minutes=7 * i), i) for i in range(53)] + [("a", D(2024, 1, 1), 99), (None, D(2024, 1, 1), 0)]
    hops = frame(rows, "lead string, ts timestamp_ntz, id int")
    out = collect_journey(hops, ["lead"], "ts", ["id"], ["id"], max_hops=10).orderBy("lead", "part").collect()
    assert [(r.lead, r.part, r.n_hops) for r in out][:2] == [("a", 0, 1), ("hot", 0, 10)]
    assert [h.id for r in out if r.lead == "hot" for h in r.hops] == list(range(53))
    assert max(r.n_hops for r in out) == 10


# ---- roster --------------------------------------------------------------------------------


def test_feedback_rules(frame):
    cfg = FunnelConfig(launch=dt.date(2024, 1, 1), as_of=dt.date(2024, 1, 2), test_identities=(9,))
    users = frame([("1", "c1", "OWNER", "ACTIVE"), ("9", "c9", "OWNER", "ACTIVE")], "id string, csp_id string, role string, status string")
    dim = frame([("c1", "p1", True), ("c9", "p9", True)], "csp_id string, partner_id string, etl_current boolean")
    log = frame(
        [("1", "f3aXexcited", "3", D(2024, 1, 1)), ("1", "f3b_nonsense", "3", D(2024, 1, 2)), ("1", "f3a_questions", "2", D(2024, 1, 3)),
         ("RAW1", "f3a_dontcare", "3", D(2024, 1, 4)), ("abc", "f3a_dontcare", "3", D(2024, 1, 4)), ("9", "f3a_dontcare", "3", D(2024, 1, 4))],
        "pid string, screen string, flow string, ts timestamp_ntz",
    )
    t = Tables(users=users, entity_dim=dim, screen_log=log)
    assert values(R.feedback(t, cfg), "pid", "cat") == [("p1", "excited")]


def test_roster_columns(frame):
    anchor = frame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 5)), ("c", dt.date(2024, 1, 1))], "pid string, ad date")
    cats = frame([("a", "excited")], "pid string, cat string")
    eng = frame(
        [("a", "secured", 1, 0, 0, 1, 77), ("b", "elsewhere", 1, 1, 1, 1, 88)],
        "pid string, screen string, viewed int, scrolled int, tapped int, ticket int, view_fs bigint",
    )
    out = R.build_roster(anchor, cats, eng, frame([("b",)], "pid string"), dt.date(2024, 1, 4))
    got = values(out, "pid", "cat", "screen", "viewed", "ticket", "flow", "mg", "days", "view_fs")
    assert got == [
        ("a", "excited", "secured", 1, 1, "f1", None, 4, 77),
        ("b", "not_answered", None, None, None, "f2", None, 0, 88),
        ("c", "not_answered", None, None, None, "f1", None, 4, None),
    ]


# ---- bases: invariants on the supplied tables ------------------------------------------------


@pytest.fixture(scope="module")
def bases(spark):
    return DOC.build_bases(EventRoles(spark, SMALL), CONFIG)


def test_counts_do_not_increase_along_the_funnel(bases):
    for base, rules in ((bases.booking, P.RULES_BOOKING), (bases.entity, P.RULES_ENTITY)):
        for r in P.funnel_cuts(base, rules).collect():
            steps = [r.received, r.slot, r.confirm, r.assign, r.reached, r.install]
            assert steps == sorted(steps, reverse=True)


def test_cut_totals_match_the_cohort(bases):
    cuts = P.funnel_cuts(bases.booking, P.RULES_BOOKING).collect()
    for period in ("PRE", "POST"):
        enrolled = sum(r.received for r in cuts if r.dim == "coh" and r.key == "E" and r.period == period)
        for dim in ("cat", "flow"):
            assert sum(r.received for r in cuts if r.dim == dim and r.period == period) == enrolled


def test_one_row_per_booking(bases):
    assert bases.booking.count() == bases.booking.select("mobile", "booking_date").distinct().count()
    assert bases.entity.count() == bases.entity.select("mobile", "booking_date", "csp_id").distinct().count()


def test_base_plan_has_no_pairwise_join_and_no_python(spark):
    t = EventRoles(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            B.booking_base_v1(t, CONFIG, R.enrolled(t, CONFIG), DATE_FROM),
            B.entity_base(t, CONFIG, R.roster(t, CONFIG), DATE_FROM),
        ):
            plan = plan_of(df)
            assert "NestedLoop" not in plan and "Cartesian" not in plan
            assert "Python" not in plan and "Arrow" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_subject_gets_the_same_result(spark):
    """One subject owns a third of all events; the base still has one row per booking and day."""
    t = EventRoles(spark, SMALL)
    events = t.events
    t.__dict__["events"] = events.withColumn("user_id", F.expr("IF(event_id < 333, 3, user_id)"))
    rows = B.attributed_since(t, CONFIG, DATE_FROM)
    got = {(r.mobile, r.booking_date): r.connection_id for r in rows.collect()}
    assert len(got) == rows.count()
    # Brute force over the two collected sides.
    bookings = B.clean_bookings(t, F.lit(True)).filter(F.col("booking_date") >= F.lit(DATE_FROM)).collect()
    requests = B.requests_by_subject(t, CONFIG.min_subject).collect()
    shift, hour = dt.timedelta(minutes=330), dt.timedelta(hours=1)
    for b in bookings:
        utc = b.bt - shift
        hits = sorted(
            (r.request_ts, r.connection_id)
            for r in requests
            if r.mobile == b.mobile and utc - 2 * hour <= r.request_ts <= utc + 14 * 24 * hour
            and (b.nb is None or r.request_ts + shift < b.nb)
        )
        assert got[(b.mobile, b.booking_date)] == (hits[0][1] if hits else None)


def test_requests_are_bounded_in_the_scan(spark):
    t = EventRoles(spark, SMALL)
    bounds = B.request_bounds(CONFIG, dt.date(2024, 1, 20), dt.date(2024, 1, 20))
    bounded = B.requests_by_subject(t, CONFIG.min_subject, **bounds)
    low, high = "2024-01-19 16:30:00", "2024-02-03 18:30:00"  # 2 hours before and 14 days after, in UTC
    assert low in plan_of(bounded) and high in plan_of(bounded)
    every = [r for r in B.requests_by_subject(t, CONFIG.min_subject).collect() if low <= str(r.request_ts) <= high]
    assert sorted(map(tuple, bounded.collect())) == sorted(map(tuple, every))


def test_only_connections_that_were_met_are_aggregated(spark, frame):
    t = EventRoles(spark, SMALL)
    some = t.candidates.select("connection_id").distinct().orderBy("connection_id").limit(5)
    ids = {r.connection_id for r in some.collect()}
    every, few = B.candidate_facts(t, DATE_FROM, CONFIG), B.candidate_facts(t, DATE_FROM, CONFIG, some)
    assert "LeftSemi" in plan_of(few) and "LeftSemi" not in plan_of(every)
    assert sorted(map(str, few.collect())) == sorted(str(r) for r in every.collect() if r.connection_id in ids)


def test_a_hot_connection_is_split(spark):
    """Aggregated look-up side: the join has an exchange of its own, so adaptive execution deals the hot key anew."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    try:
        rows = spark.range(0, 300_000, 1, 8).selectExpr("if(id % 3 < 2, 1, id) AS connection_id", "uuid() AS body")
        facts = spark.range(0, 300_000, 1, 8).selectExpr("id AS connection_id", "id % 7 AS x").groupBy("connection_id").agg(F.max("x").alias("x"))
        joined = lookup(rows, facts, ["connection_id"], row_id=["body"])
        assert joined.where("x IS NOT NULL").count() == 300_000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
        for k in ("skewedPartitionThresholdInBytes", "skewedPartitionFactor"):
            spark.conf.unset(f"spark.sql.adaptive.skewJoin.{k}")


def test_dashboard_panels(spark):
    panels = DOC.dashboard(EventRoles(spark, SMALL), CONFIG, "%nation_1%")
    assert len(panels) >= 30
    cohort = panels["booking_cohorts"].collect()
    assert {r.key for r in cohort} >= {"E", "N"}
    assert all(r.recv_per_entity_d is None for r in cohort if r.key == "N")
    assert sorted(r.key for r in panels["booking_screens"].select("key").distinct().collect()) == ["almost", "keepgoing", "noleads", "secured"]
    assert panels["targeted"].count() == 1


def test_a_failing_section_leaves_the_others(spark, tmp_path):
    t = EventRoles(spark, SMALL)
    broken = F.raise_error(F.lit("no app events")).cast("string")
    t.__dict__["app_events"] = t.app_events.withColumn("device_id", broken)
    every = DOC.sections(t, CONFIG, "%nation_1%", D(2024, 1, 28, 6))
    wanted = ("summary", "app_opens", "app_opens_total", "non_enrolled", "weather", "daily", "class_counts")
    out = str(tmp_path / "document")
    publish_json({name: every[name] for name in wanted}, out, require=["summary"])
    noted = spark.read.json(f"{out}/versions").first().failed
    assert sorted(n.partition(":")[0] for n in noted) == ["app_opens", "app_opens_total"]
    now = published(spark, out)
    row = spark.read.json(f"{now}/summary").first()
    assert (row.generated[:10], row.as_of, row.gate_percent, row.month_remaining) == ("2024-01-28", str(CONFIG.as_of), 60, 4)
    days = [r.d for r in spark.read.json(f"{now}/daily").collect()]
    shown = {r.day for r in spark.read.json(f"{now}/weather").collect()}
    assert min(shown) >= str(dt.date.fromisoformat(min(days)) - dt.timedelta(days=1)) and max(shown) <= str(CONFIG.today)
    with pytest.raises(Exception, match="no app events"):
        publish_json({name: every[name] for name in wanted}, out, require=["app_opens"])
    assert published(spark, out) == now


def test_refresh_publishes_and_clears_what_it_staged(spark, tmp_path):
    import os

    def staged_blocks():
        folder = f"{shared_dir(spark)}/leadlens"
        return {name for name in os.listdir(folder) if name.startswith("block-")} if os.path.isdir(folder) else set()

    out = str(tmp_path / "document")
    written = DOC.refresh(EventRoles(spark, SMALL), CONFIG, out, "%nation_1%")
    now = published(spark, out)
    assert len(written) >= 30 and f"{now}/{DOC.MAIN_PANEL}" in written
    (text,) = spark.read.text(f"{now}/payload").collect()
    assert text.value.startswith('{"generated":null,"yest":"2024-01-27"')
    assert spark.read.json(f"{out}/versions").first().failed == []
    assert staged_blocks() == set()
    nobody = CONFIG.with_(program="none")  # no one is enrolled, and no request is early enough for the main panel
    t = EventRoles(spark, SMALL)
    t.__dict__["bookings"] = t.bookings.limit(0)
    with pytest.raises(EmptyPanel):
        DOC.refresh(t, nobody, out)
    assert published(spark, out) == now and staged_blocks() == set()


def test_payload_is_one_nested_document(spark):
    import json

    from leadlens.plans.payload import payload

    t = EventRoles(spark, SMALL)
    t.__dict__["app_events"] = t.app_events.withColumn("device_id", F.raise_error(F.lit("no app events")).cast("string"))
    with staging(spark):
        every = DOC.sections(t, CONFIG, "%nation_1%", D(2024, 1, 28, 6, 5))
        row = payload(every, CONFIG, site=3).first()
        document = json.loads(row.json)
        assert row.failed == ["app_opens"] and document["app_opens"] is None
        assert document["generated"] == "28 Jan 2024, 06:05 IST" and document["yest"] == str(CONFIG.as_of) and document["anchored"] is True
        panel = {(r.key, r.period): r for r in every["booking_cohorts"]().collect()}
        assert {p for p in document["tab1"]["enr"]} == {p for k, p in panel if k == "E"}
        for period, block in document["tab1"]["enr"].items():
            r = panel["E", period]
            assert (block["received"], block["install"], block["csp_days"], block["tat_ta"]) == (r.received, r.install, r.entity_days, r.tat_ta)
        assert [x["key"] for x in document["tab2"]] == ["excited", "questions", "dontcare", "dontknow", "not_answered"]
        assert [x["key"] for x in document["tab_mg_proj"]] == ["mg_lo", "mg_hi", "no_mg", "too_early"]
        assert [x["key"] for x in document["csp"]["tab3_engagement"]][:2] == ["Viewed", "Not viewed"]
        assert set(document["noGH"]) >= {"tab1", "tab_mg_proj", "mg_counts", "mgp_counts", "mg_proj_totals"}
        assert document["mg_counts"] == {r.key: r.entities for r in every["class_counts"]().collect()}
        daily = [(x["d"], x["b"], x["i"], x["j"]) for x in document["tab4"]["daily"]]
        assert daily == sorted((str(r.d), r.b, r.i, r.j) for r in every["daily"]().collect())
        assert len(document["tab4"]["hourly_book"]) == every["hourly"]().where("k = 'B'").count() > 0
        assert document["tab4"]["weather"] == {str(r.day): r.weather for r in every["weather"]().where("site = 3").collect()}
        assert "weather" not in document["tab4_noGH"] and document["tab4"]["from"] == document["tab4_noGH"]["from"]


def test_payload_without_the_main_part_fails(spark):
    from leadlens.plans.payload import payload

    t = EventRoles(spark, SMALL)
    t.__dict__["bookings"] = t.bookings.withColumn("mobile", F.raise_error(F.lit("no bookings")).cast("string"))
    with pytest.raises(Exception, match="no bookings"):
        payload(DOC.sections(t, CONFIG), CONFIG)


def test_staging_blocks_nest(spark):
    import os

    with staging(spark) as outer:
        kept = stage(spark.range(3), "outer")
        with staging(spark) as inner:
            assert inner.startswith(outer) and stage(spark.range(4), "inner").inputFiles()[0].removeprefix("file://").startswith(inner.removeprefix("file://"))
        assert kept.count() == 3 and not os.path.exists(inner)
    assert not os.path.exists(outer)
    assert "block-" not in stage(spark.range(2), "after").inputFiles()[0]


def test_steps_run_together_within_the_block(spark):
    import threading

    meet = threading.Barrier(3, timeout=60)  # passes only if all three run at once

    def step(n):
        meet.wait()
        return stage(spark.range(n), f"step{n}")

    with staging(spark) as folder:
        made = together(*[lambda n=n: step(n) for n in (3, 1, 2)])
        assert [df.count() for df in made] == [3, 1, 2]
        assert all(folder.removeprefix("file://") in df.inputFiles()[0] for df in made if df.inputFiles())
    ended = []
    with pytest.raises(ValueError, match="first"):
        together(lambda: (_ for _ in ()).throw(ValueError("first")), lambda: ended.append(spark.range(5).count()))
    assert ended == [5]


def test_a_shared_input_is_made_once_for_all_that_wait():
    import threading

    made, begun = [], threading.Event()

    def make():
        made.append(begun.wait(2))  # the second one asks meanwhile
        return len(made)

    shared, got = DOC.Once(make), []
    threads = [threading.Thread(target=lambda: got.append(shared())) for _ in range(2)]
    for thread in threads:
        thread.start()
    begun.set()
    for thread in threads:
        thread.join()
    assert made == [True] and got == [1, 1]


def test_cuts_make_both_bases_at_the_same_time(bases):
    import threading

    meet = threading.Barrier(2, timeout=60)  # passes only if both are made at once

    def after(df):
        meet.wait()
        return df

    found = C.classify_entities(bases.entity, bases.roster, CONFIG)
    base, classes = DOC.Once(lambda: after(bases.booking)), DOC.Once(lambda: after(found))
    panel = DOC.grain_sections(base, P.RULES_BOOKING, lambda: bases.roster, classes, CONFIG)["classes"]()
    plain = P.funnel_cuts(DOC.relabel(bases.booking, found), P.RULES_BOOKING).filter("dim = 'mg'")
    got = {tuple(r) for r in panel.filter("period IS NOT NULL").select("key", "period", "received").collect()}
    assert got == {tuple(r) for r in plain.select("key", "period", "received").collect()}


def test_parsed_events_keep_every_row_and_are_read_from_json_once(spark, frame, tmp_path):
    rows = [
        (1, D(2024, 1, 17, 3), 5, "view", 9.5, '{"k": 12}'),
        (1, D(2024, 1, 17, 3), 5, "view", 9.5, '{"k": 12}'),  # came twice
        (2, None, 5, "", None, "{}"),
        (3, D(2024, 1, 18), None, None, 1.0, "no JSON"),
        (None, D(2024, 1, 19, 0, 0, 0, 7), 6, "signup", 2.0, None),
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    frame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    t = EventRoles(spark, str(tmp_path))
    once, cols = t.parsed(), ["event_id", "ts", "user_id", "event_type", "value", "k"]
    assert once.events.schema == t.events.schema and values(once.events, *cols) == values(t.events, *cols)
    for role in ("candidates", "users", "profiles", "history"):
        assert "get_json_object" in plan_of(getattr(t, role)) and "get_json_object" not in plan_of(getattr(once, role))


def test_weather_is_optional_and_of_one_site(spark, frame):
    t = EventRoles(spark, SMALL)
    t.__dict__["hourly"] = None
    assert "weather" not in DOC.sections(t, CONFIG)
    hours = [(D(2024, 1, day, hour), 0.5, 90.0) for day in range(9, 14) for hour in (3, 12, 22)]
    hourly = frame(hours, "ts timestamp_ntz, precip double, cloud double")
    daily = frame([(dt.date(2024, 1, 12),), (dt.date(2024, 1, 11),)], "d date")
    got = DOC.weather_panel(hourly, daily, CONFIG, dt.date(2024, 1, 5))
    # The tenth starts the series: the rain of the evening before it is not read.
    assert values(got, "day", "night_rain") == [(dt.date(2024, 1, 10), 0.5), *[(dt.date(2024, 1, k), 1.0) for k in (11, 12, 13)]]


def test_fixed_window_document(spark):
    panels = DOC.fixed_window_document(EventRoles(spark, SMALL), CONFIG)
    assert set(panels) == {"summary", "pre_post", "declines", "installs_daily", "installs_hourly", "bookings_daily", "daily", "daily_non", "lag_cohorts"}
    assert panels["pre_post"].count() > 0 and panels["lag_cohorts"].count() <= 5


# ---- sources and sinks -----------------------------------------------------------------------


def test_cohort_document(spark, tmp_path):
    path = tmp_path / "cohort.json"
    path.write_text('{"flow1": ["1", "2"],\n "flow2": ["2"], "other": []}')
    assert values(read_cohorts(spark, str(path)), "pid", "flow") == [("1", "flow1"), ("2", "flow1"), ("2", "flow2")]


def test_profile_documents(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(
        '{"identity": "1", "record": {"profileData": {"screen_real": "", "screen": "almost"}, "events": {"View_a": {"count": 1}}}}\n'
        '{"identity": "2", "record": {"profileData": {"screen_real": "secured", "screen": "almost"}}}\n'
        '{"identity": "3"}\n'
    )
    df = read_profiles(spark, str(path), CONFIG.screen_fields)
    assert values(df, "identity", "screen") == [("1", "almost"), ("2", "secured")]
    assert values(R.profile_flags(df, CONFIG.event_prefixes), "identity", "viewed", "view_fs") == [("1", 1, None), ("2", 0, None)]


def test_hourly_document(spark, tmp_path):
    path = tmp_path / "h.json"
    path.write_text('{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "precipitation": [null, 1.5], "cloud_cover": [10, null]}}')
    assert values(read_hourly(spark, str(path)), "ts", "precip", "cloud") == [(D(2024, 1, 1), 0.0, 10.0), (D(2024, 1, 1, 1), 1.5, 0.0)]


def test_publish_gate(spark, frame, tmp_path):
    full, empty, out = frame([(2,), (1,)], "n int"), frame([], "n int"), str(tmp_path / "out")
    failing = full.select(F.raise_error(F.lit("no such section")).alias("n"))
    with pytest.raises(EmptyPanel):
        publish_json({"a": full, "b": empty}, out, require=["a", "b"])
    assert published(spark, out) is None
    publish_json({"a": full, "b": empty}, out, require=["a"], order={"a": ["n"]})
    first = published(spark, out)
    assert [r.n for r in spark.read.schema("n int").json(f"{first}/a").collect()] == [1, 2]
    with pytest.raises(Exception, match="no such section"):
        publish_json({"a": failing}, out, require=["a"])
    assert published(spark, out) == first
    # A panel that is not required and fails is left out and noted; the others are published.
    assert len(publish_json({"bad": failing, "a": lambda: full}, out, require=["a"])) == 1
    second = published(spark, out)
    assert second > first and spark.read.schema("n int").json(f"{second}/a").count() == 2
    noted = spark.read.json(f"{out}/versions").orderBy("version").collect()[-1].failed
    assert [n.partition(":")[0] for n in noted] == ["bad"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    staged = stage(spark.range(3), "numbers")
    assert staged.count() == 3 and shared_dir(spark) in staged.inputFiles()[0]
