"""Expressions and operators against plain Python on random rows."""

import datetime as dt
import random
import re
from decimal import ROUND_FLOOR, Decimal

import pytest
from pyspark.sql import functions as F

from labtide.functions import text, time
from labtide.operators import dedup
from labtide.plans import activity, funnel


def repaired(phone):
    """Plain statement of the phone rule."""
    phone = phone.split("/")[0]
    n = len(re.sub("[^0-9]", "", phone))
    if n == 11:
        phone = phone[1:] if re.sub("[^0-9]", "", phone)[0] == "1" else phone[:10]
    elif n == 8:
        phone += "0"
    elif not 8 <= n <= 11:
        return None
    groups = re.findall(r"\d{4}$|\d{3}", phone)
    return "-".join(groups[:3]) if len(groups) >= 3 else None


def test_phone_repair(spark):
    rnd = random.Random(1)
    phones = ["".join(rnd.choice("0123456789" * 3 + "1-() /") for _ in range(rnd.randrange(6, 16))) for _ in range(3000)]
    value, bad = text.phone_repair("p", pad=True)
    got = spark.createDataFrame([(p,) for p in phones], "p string").select("p", value.alias("v"), bad.alias("b")).collect()
    for r in got:
        assert r.v == repaired(r.p), r.p
        assert r.b == (r.v is None)


def test_short_phones_can_be_flagged(spark):
    value, bad = text.phone_repair(F.lit("20155501"))
    assert tuple(spark.range(1).select(value, bad).first()) == (None, True)


def test_hours_round_half_up(spark):
    rnd = random.Random(2)
    base = dt.datetime(2021, 1, 1)
    spans = [rnd.randrange(-(10**12), 10**12) for _ in range(2000)] + [18_000_000 + 36_000_000 * k for k in range(-50, 50)]
    rows = [(i, base, base + dt.timedelta(microseconds=us)) for i, us in enumerate(spans)]
    df = spark.createDataFrame(rows, "i int, a timestamp_ntz, b timestamp_ntz")
    for r in df.select("i", time.hours("a", "b").alias("h"), time.whole_days("a", "b").alias("d")).collect():
        exact = Decimal(spans[r.i]) / Decimal(36_000_000)
        assert round(r.h * 100) == int((exact + Decimal("0.5")).to_integral_value(ROUND_FLOOR))
        assert r.d == spans[r.i] // 86_400_000_000


def test_age(spark):
    rnd = random.Random(3)
    day = lambda: dt.date(1930, 1, 1) + dt.timedelta(days=rnd.randrange(33_000))
    pairs = [tuple(sorted((day(), day()))) for _ in range(1000)] + [(dt.date(1992, 2, 29), dt.date(2019, 2, 28))]
    df = spark.createDataFrame(pairs, "a date, b date")
    for r in df.select("a", "b", time.age_years("a", F.col("b")).alias("age")).collect():
        assert r.age == r.b.year - r.a.year - ((r.b.month, r.b.day) < (r.a.month, r.a.day))


@pytest.fixture(scope="module")
def log(spark):
    rnd = random.Random(4)
    names = ["report_sent", "report_review_approved", "sample_linked", "other", "report_cancelled", "report_generated"]
    start = dt.datetime(2021, 1, 1)
    rows = [
        (
            i,
            rnd.choice([1, 1, 1, rnd.randrange(2, 40)]),
            rnd.randrange(6),
            rnd.randrange(5),
            rnd.choice(names),
            start + dt.timedelta(microseconds=rnd.randrange(20 * 86_400 * 10**6)),
        )
        for i in range(1500)
    ]
    schema = "id long, report_id long, kit_id long, user_id long, event_type string, created_at timestamp_ntz"
    return rows, spark.createDataFrame(rows, schema)


CATEGORY = {
    "report_sent": "Sent",
    "report_review_approved": "Approved",
    "sample_linked": "Accessioned",
    "report_cancelled": "Cancelled",
    "report_generated": "Report Generated",
}


def test_first_events_both_forms(log):
    rows, df = log
    want = {}
    for _, report, _, _, name, at in rows:
        if name in CATEGORY:
            key, local = (report, CATEGORY[name]), at - dt.timedelta(hours=5)
            want[key] = min(want.get(key, local), local)
    assert {(r.report_id, r.category): r.event_at for r in funnel.first_events(df).collect()} == want
    wide = {}
    for r in funnel.report_events(df, F.col("event_type") == "other", "other").collect():
        wide.update({(r.report_id, c): r.first_times[c] for c in CATEGORY.values() if r.first_times[c] is not None})
        assert r.other == any(x[1] == r.report_id and x[4] == "other" for x in rows)
    assert wide == want


def test_elapsed_means_equal_row_by_row(spark, log):
    rows, df = log
    received = {k: dt.datetime(2020, 12, 30, 3, 4, 5, 678_901) + dt.timedelta(hours=7 * k) for k in range(5)}
    kits = spark.createDataFrame(list(received.items()), "id long, received_at timestamp_ntz")
    staff = spark.createDataFrame([(u, f"u{u}", "x") for u in range(4)], "user_id long, first_name string, last_name string")
    got = activity.by_day(activity.since_received(df, kits, staff)).collect()
    sums = {}
    for _, _, kit, user, _, at in rows:
        if kit in received and user < 4:
            sums.setdefault((at - dt.timedelta(hours=5)).date(), []).append((at - received[kit]) / dt.timedelta(seconds=1))
    assert {r.day: r.n for r in got} == {d: len(v) for d, v in sums.items()}
    for r in got:
        assert r.mean_seconds == pytest.approx(sum(sums[r.day]) / len(sums[r.day]), abs=1e-6)


def test_last_and_first_rows(log):
    rows, df = log
    last = {r.report_id: r.id for r in dedup.last_per_key(df, ["report_id"], ["created_at", "id"]).collect()}
    first = {r.report_id: r.id for r in dedup.first_per_key(df, ["report_id"], ["created_at", "id"]).collect()}
    for report in {r[1] for r in rows}:
        own = sorted((r[5], r[0]) for r in rows if r[1] == report)
        assert (first[report], last[report]) == (own[0][1], own[-1][1])
