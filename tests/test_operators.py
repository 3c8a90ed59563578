"""Table operators on hand-made rows, and neighbouring rows against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtide.operators import columns, dedup, matching, quality, reshape, sequence


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_p2_p4_p5_p6_p8_p10(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "Patient_ID long, Result_Date string, Zip double")
    assert columns.search(df, "date") == ["Result_Date"]
    assert columns.search(df, ["zip", "id"]) == ["Patient_ID", "Zip"]
    assert columns.keep_present(df, ["Zip", "missing", "Patient_ID"]).columns == ["Patient_ID", "Zip"]
    assert columns.leading(df, 2).columns == ["Patient_ID", "Result_Date"]
    assert columns.rename_all(df, ["a", "b", "c"]).columns == ["a", "b", "c"]
    assert columns.rename_where(df, str.lower).columns == ["patient_id", "result_date", "zip"]
    assert columns.of_type(df, T.StringType) == ["Result_Date"]
    assert columns.of_type(df, T.StringType, exclude=True) == ["Patient_ID", "Zip"]
    assert df.drop("Zip", "not there").columns == ["Patient_ID", "Result_Date"]
    assert columns.strip_prefix(df.toDF("properties.x", "y", "z"), "properties.").columns == ["x", "y", "z"]


def test_p7_p14_constants_and_copies(spark):
    df = spark.createDataFrame([("1", None)], "phone string, area string")
    assert tuple(columns.copy_group(df, ["area"], ["phone"]).first()) == ("1", "1")
    assert df.select(F.lit(None).cast("string").alias("x")).first().x is None


def test_w4_w5_w6(spark):
    data = [(1, 1, "a"), (1, 2, "redraw"), (1, 2, "b"), (2, 5, "c")]
    df = spark.createDataFrame(data, "k int, t int, e string")
    assert rows(dedup.last_per_key(df, ["k"], ["t", "e"]), "k") == [(1, 2, "redraw"), (2, 5, "c")]
    assert rows(dedup.first_per_key(df, ["k"], ["t", "e"]), "k") == [(1, 1, "a"), (2, 5, "c")]
    assert rows(dedup.ever(df, "k", F.col("e") == "redraw", "redraw"), "k") == [(1, True), (2, False)]


def test_o1_o2_o3_o4(spark):
    df = spark.createDataFrame([("A", i % 4) for i in range(20)] + [("B", 1)], "s string, n int")
    assert dedup.whole_rows(df).count() == 5
    top = dedup.top_per_key(dedup.whole_rows(df), ["s"], [F.col("n").asc()], 2)
    assert rows(top, "s", "n") == [("A", 0), ("A", 1), ("B", 1)]
    assert df.orderBy("s", "n").limit(6).count() == 6


def test_group_limit_runs_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.top_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def brute(data, key, order, columns_, previous):
    out = {}
    by_key = {}
    for r in data:
        by_key.setdefault(r[key], []).append(r)
    for group in by_key.values():
        group.sort(key=order)
        for i, r in enumerate(group):
            j = i - 1 if previous else i + 1
            other = group[j] if 0 <= j < len(group) else None
            out[r["id"]] = tuple(other[c] if other else None for c in columns_)
    return out


SHAPES = {
    "spread": lambda rnd: dt.timedelta(seconds=rnd.choice([0, 1, 59, 60, 61, 3_600, rnd.randrange(20_000)])),
    "crowded": lambda rnd: dt.timedelta(days=rnd.choice([0] * 20 + [900]), microseconds=rnd.randrange(50)),
    "one time": lambda rnd: dt.timedelta(0),
}


@pytest.mark.parametrize("previous", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 40, 1_000])
@pytest.mark.parametrize("shape", ["spread", "crowded", "one time"])
def test_w1_w2_w3_neighbours_equal_brute_force(spark, previous, hot_rows, shape):
    rnd = random.Random(7)
    start = dt.datetime(2021, 1, 1)
    data = [
        {
            "id": i,
            "k": rnd.choice([1, 1, 1, 1, 2, 3, 4, 5]),
            "t": start + SHAPES[shape](rnd),
            "v": rnd.choice(["a", "b", None]),
        }
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "id long, k long, t timestamp_ntz, v string")
    got = sequence.neighbour(df, "k", "t", "id", ["id", "v"], previous=previous, hot_rows=hot_rows)
    assert got.count() == len(data)
    want = brute(data, "k", lambda r: (r["t"], r["id"]), ["id", "v"], previous)
    assert {r.id: (r.next_id, r.next_v) for r in got.collect()} == want
    both = sequence.neighbours(df, "k", "t", "id", ["id", "v"], hot_rows=hot_rows).collect()
    side = (lambda r: (r.last_id, r.last_v)) if previous else (lambda r: (r.next_id, r.next_v))
    assert {r.id: side(r) for r in both} == want


@pytest.mark.parametrize("shape", SHAPES)
def test_ranges_of_a_hot_key_are_small(spark, shape):
    rnd = random.Random(8)
    data = [(i, 1, dt.datetime(2021, 1, 1) + SHAPES[shape](rnd)) for i in range(3000)]
    df = spark.createDataFrame(data + [(9_999, 2, dt.datetime(2021, 1, 1))], "id long, k long, t timestamp_ntz")
    assert sequence.longest(df, "k") == (3000, 3001)
    dealt = sequence.in_ranges(df, ["k", "t", "id"], 30)
    assert dealt.count() == 3001 and dealt.groupBy("__range").count().agg(F.max("count")).first()[0] <= 200


def test_neighbours_across_ranges_with_text_ties_and_keys(spark):
    rnd = random.Random(9)
    data = [{"id": f"x{i:03d}", "k": rnd.choice("aaaaab"), "t": dt.datetime(2021, 1, rnd.choice([1, 1, 1, 2])), "v": i} for i in range(500)]
    df = spark.createDataFrame(data, "id string, k string, t timestamp_ntz, v long")
    got = sequence.neighbours(df, "k", "t", "id", ["v"], hot_rows=20)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in text and "SinglePartition" not in text
    rows = got.collect()
    for previous, name in ((False, "next_v"), (True, "last_v")):
        want = brute(data, "k", lambda r: (r["t"], r["id"]), ["v"], previous)
        assert {r.id: (r[name],) for r in rows} == want


def test_small_windows_do_not_make_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sequence, "scratch_dir", lambda _, label: f"{tmp_path}/{label}")
    start = dt.datetime(2021, 1, 1)
    data = [{"id": i, "k": i % 3, "t": start + dt.timedelta(seconds=i * 7919 % 1000)} for i in range(900)]
    df = spark.createDataFrame(data, "id long, k long, t timestamp_ntz")
    got = sequence.neighbours(df, "k", "t", "id", ["id"], hot_rows=5).collect()
    assert len(list(tmp_path.glob("ranges/part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = spark.read.parquet(f"{tmp_path}/ranges").groupBy("__range").count()
    assert sizes.agg(F.max("count")).first()[0] <= 5
    for previous, name in ((False, "next_id"), (True, "last_id")):
        assert {r.id: (r[name],) for r in got} == brute(data, "k", lambda r: (r["t"], r["id"]), ["id"], previous)


def test_short_keys_are_read_once(spark, tmp_path):
    spark.range(200).selectExpr("id", "id % 20 AS k", "timestamp_ntz'2021-01-01' AS t").write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    text = sequence.neighbours(log, "k", "t", "id", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Broadcast" not in text


def test_neighbours_with_missing_times_and_keys(spark):
    data = [(1, 1, None), (2, 1, dt.datetime(2021, 1, 1)), (3, 1, dt.datetime(2021, 1, 2))]
    data += [(i, None, dt.datetime(2021, 1, 2)) for i in range(4, 40)]
    df = spark.createDataFrame(data, "id long, k long, t timestamp_ntz")
    for hot in (None, 2):
        got = sequence.neighbour(df, "k", "t", "id", ["id"], hot_rows=hot)
        assert {r.id: r.next_id for r in got.collect()} == {1: 2, 2: 3, **dict.fromkeys(range(3, 40))}


def test_r1_r2_r4_r6_reshape(spark):
    df = spark.createDataFrame([("ann", "mon", 1), ("ann", "mon", 2), ("bob", "tue", 5)], "name string, d string, n int")
    wide = reshape.pivot_sum(df, ["name"], "d", ["mon", "tue", "wed"], "n")
    assert rows(wide, "name") == [("ann", 3, 0, 0), ("bob", 0, 5, 0)]
    assert sum(sum(r[1:]) for r in rows(wide, "name")) == 8
    counted = reshape.pivot_count(df, ["name"], "d", ["mon", "tue"])
    assert rows(counted, "name") == [("ann", 2, None), ("bob", None, 1)]
    table = spark.createDataFrame([("mon", 1, "x"), ("tue", 2, "y")], "d string, n int, t string")
    flipped = reshape.transpose(table, [], "d", ["mon", "tue"], ["n", "t"])
    assert rows(flipped, "metric") == [("n", "1", "2"), ("t", "x", "y")]
    assert reshape.long_metrics({"a": df, "b": df}).groupBy("metric").count().count() == 2


def test_n1_n2_f12_f13(spark):
    df = spark.createDataFrame(
        [(None, None, None), ("1", None, "x"), (None, None, "y")], "accession string, gone string, other string"
    )
    kept = quality.drop_empty_rows(df)
    assert kept.count() == 2
    assert quality.drop_empty_columns(kept).columns == ["accession", "other"]
    assert quality.require(df, "accession").count() == 1
    assert quality.at_least(df, 2).count() == 1
    good, bad = quality.split_bad(df, F.col("other") == "y")
    assert (good.count(), bad.count()) == (2, 1)


def test_j4_one_level_only(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id long, parent_distributor_id long")
    assert rows(matching.family(tree, 1), "id") == [(1,), (2,)]


def test_j5_null_in_list_does_not_empty_the_result(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    sent = spark.createDataFrame([(1,), (None,)], "report_id long")
    left = matching.absent(df, sent, {"id": "report_id"})
    assert sorted(rows(left, "id"), key=str) == [(2,), (None,)]
    assert rows(matching.present(df, sent, {"id": "report_id"}), "id") == [(1,)]


def test_j16_u4_u5_sets(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(a.intersect(b), "x") == [(1,)]
    assert rows(a.distinct().exceptAll(b), "x") == [(2,)]
    assert rows(matching.union_names([a, b], "x"), "x") == [(1,), (2,), (3,)]


def test_j17_u2_errors(spark):
    files = spark.createDataFrame([("NJ", 1), ("ZZ", 2)], "state string, n int")
    numbers = spark.createDataFrame([("NJ", "555")], "state string, fax string")
    good, bad = matching.lookup_or_error(files, numbers, "state", "fax", "No PDF")
    both = matching.append(good, bad)
    assert rows(both.select("state", "fax", "error"), "state") == [("NJ", "555", None), ("ZZ", None, "No PDF")]


def test_u1_i4_new_rows_once(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "x", 9), (2, "b", 9), (2, "b", 9)], "k int, v string, extra int")
    assert rows(matching.with_new(old, new, "k"), "k") == [(1, "a", None), (2, "b", 9)]


def test_f11_modes(spark):
    df = spark.createDataFrame([("Positive",), ("Negative",), (None,)], "Result string")
    assert [matching.result_mode(df, m).count() for m in ("P", "N", "")] == [1, 2, 3]


def test_f14_segments_are_part_of_the_base(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, clinic string")
    out = matching.segments(df, {"all": F.lit(True), "x": F.col("clinic") == "x"})
    assert rows(out.select("id", "segment"), "id", "segment") == [(1, "all"), (1, "x"), (2, "all")]


def test_a9_zero_states(spark):
    states = spark.createDataFrame([("NJ",), ("NY",)], "state string")
    found = spark.createDataFrame([("NJ",), ("NJ",)], "state string")
    assert rows(matching.count_all(states, found, "state"), "state") == [("NJ", 2), ("NY", 0)]


def test_f9_f10_sentinels(spark):
    df = spark.createDataFrame([("N/A",), (None,), ("8",)], "t string")
    assert df.where(~F.col("t").eqNullSafe("N/A")).count() == 2


def test_m5_m6_m8_a13_a14(spark):
    df = spark.createDataFrame([(None, "7"), (2, "")], "n int, t string")
    assert df.na.fill(0, subset=["n"]).agg(F.sum("n")).first()[0] == 2
    assert [r[0] for r in df.select(F.col("t").try_cast("bigint").alias("t")).collect()] == [7, None]
    assert df.select((F.col("n") == 2).cast("int")).collect()[1][0] == 1
    assert tuple(df.agg(F.min("n"), F.max("n")).first()) == (2, 2)
    assert df.select(F.first("n", ignorenulls=True)).first()[0] == 2


def test_pivoted_sums_take_one_exchange(spark):
    df = spark.range(40).selectExpr("id % 3 AS k", "concat('c', id % 4) AS cell", "nullif(id, 7) AS n")
    wide = reshape.pivot_sum(df, ["k"], "cell", ["c0", "c 3", "c3"], "n")
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "pivotfirst" not in text
    assert [tuple(r) for r in wide.orderBy("k").collect()] == [(0, 72, 0, 84), (1, 48, 0, 50), (2, 60, 0, 69)]
    assert wide.columns == ["k", "c0", "c 3", "c3"]
