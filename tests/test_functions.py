"""Time, text and nested expressions on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from labtide.functions import codes, nested, text, time
from labtide.session import require_utc


def ts(value):
    return F.lit(value).cast("timestamp_ntz")


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_d1_est_has_no_summer_time(spark):
    summer, winter = one(spark, time.to_local(ts("2021-07-01 04:30:00")), time.to_local(ts("2021-01-01 04:30:00")))
    assert summer == dt.datetime(2021, 6, 30, 23, 30)
    assert winter == dt.datetime(2020, 12, 31, 23, 30)


def test_d1_column_and_literal_shift_agree(spark):
    rows = spark.sql("SELECT explode(sequence(0, 48)) AS h").select(
        F.timestamp_add("HOUR", F.col("h"), ts("2021-01-01")).alias("c")
    )
    by_literal = rows.where(time.in_window("c", "2021-01-01 10:00:00", "2021-01-02 02:00:00")).count()
    local = time.to_local("c")
    by_column = rows.where((local >= ts("2021-01-01 10:00:00")) & (local < ts("2021-01-02 02:00:00"))).count()
    assert by_literal == by_column == 16


def test_f2_closed_and_half_open(spark):
    rows = spark.range(1).select(ts("2021-01-01 05:00:00").alias("c"))
    assert rows.where(time.in_window("c", end="2021-01-01")).count() == 0
    assert rows.where(time.in_window("c", end="2021-01-01", closed=True)).count() == 1


def test_localize_formats_every_timestamp(spark):
    rows = spark.range(1).select(ts("2021-01-01 05:06:07").alias("a"), F.lit("x").alias("b"), ts(None).alias("c"))
    assert tuple(time.localize(rows, time.MINUTE_FORMAT).first()) == ("01/01/2021 00:06", "x", None)


def test_d8_half_up_at_ties(spark):
    start = ts("2021-01-01 00:00:00")
    values = one(
        spark,
        time.hours(start, ts("2021-01-01 00:00:18")),
        time.hours(start, ts("2021-01-01 00:00:17")),
        time.hours(start, ts("2020-12-31 23:59:24")),
        time.hours(start, ts("2021-01-02 12:30:00")),
    )
    assert values == (0.01, 0.0, -0.01, 36.5)


def test_d9_days_floor(spark):
    a = ts("2021-01-02 00:00:00")
    assert one(spark, time.whole_days(a, ts("2021-01-01 12:00:00")), time.whole_days(a, ts("2021-01-04 01:00:00"))) == (-1, 2)


def test_d10_hms(spark):
    assert one(
        spark, time.hms(F.lit(3_661.9)), time.hms(F.lit(90_000.0)), time.hms(F.lit(None).cast("double")), time.hms(F.lit(-1.0))
    ) == ("01:01:01", "01:00:00", "", "23:59:59")


def test_d11_day_and_time(spark):
    assert one(spark, time.parse_day_time(F.lit("1/12/2021"), F.lit("9:30 PM")), time.parse_day_time(F.lit("x"), F.lit("y"))) == (
        dt.datetime(2021, 1, 12, 21, 30),
        None,
    )


def test_d13_iso_z(spark):
    assert one(spark, time.parse_iso_z(F.lit("2021-01-02T03:04:05Z")), time.parse_iso_z(F.lit("2021-01-02 03:04:05"))) == (
        dt.datetime(2021, 1, 2, 3, 4, 5),
        None,
    )


@pytest.mark.parametrize(
    ("birth", "day", "age"),
    [("1992-02-29", "2021-02-28", 28), ("1992-02-29", "2021-03-01", 29), ("1990-05-05", "2020-05-05", 30)],
)
def test_d14_age(spark, birth, day, age):
    assert one(spark, time.age_years(F.lit(birth), time.ntz(day))) == (age,)


def test_d15_add_interval(spark):
    assert one(spark, ts("2021-01-01 00:00:30") + F.expr("interval 60 seconds")) == (dt.datetime(2021, 1, 1, 0, 1, 30),)


def test_w7_week_spine(spark):
    monday = dt.date(2021, 1, 11)
    assert one(spark, time.week_start(F.lit(dt.date(2021, 1, 17))), time.weekday_key(F.lit(dt.date(2021, 1, 17)))) == (monday, "sun")
    days = [r.day for r in time.days_from(spark, monday).orderBy("day").collect()]
    assert len(days) == 7 and days[0] == monday


def test_weeks_spanning_has_whole_weeks(spark):
    rows = spark.createDataFrame([(dt.date(2021, 1, 13), 1), (dt.date(2021, 1, 26), 2)], "day date, n int")
    days = [r.day for r in time.weeks_spanning(rows, "day").orderBy("day").collect()]
    assert days == [dt.date(2021, 1, 11) + dt.timedelta(days=i) for i in range(21)]


@pytest.mark.parametrize("value", ["01/12/2021", "2021-01-12", "20210112", "2021-01-12T00:00:00", "01/12/2021 00:00"])
def test_d16_text_dates(spark, value):
    assert one(spark, time.parse_text(F.lit(value))) == (dt.datetime(2021, 1, 12),)


def test_d16_unreadable_dates_are_null(spark):
    assert one(spark, time.parse_text(F.lit("soon")), time.parse_text(F.lit(""))) == (None, None)


def test_day_parts_and_mean(spark):
    sec, frac = time.day_parts(ts("2021-01-01 00:01:00.25"))
    assert one(spark, sec, frac, time.mean_seconds(F.lit(3), F.lit(500_000), F.lit(2))) == (60, 250_000, 1.75)


def test_x1_full_name(spark):
    assert one(spark, text.full_name(F.lit("A"), F.lit(None)), text.full_name(F.lit(None), F.lit(None))) == ("A ", " ")


def test_x2_x3_split_and_digits(spark):
    assert one(spark, text.before(F.lit("a/b"), "/"), text.before(F.lit("a"), "/"), text.digits(F.lit("+1 (2)-3"))) == ("a", "a", "123")


def test_x4_later_category_wins(spark):
    terms = [("review", "Review"), ("_approved", "Approved")]
    assert one(
        spark,
        text.last_match(F.lit("report_review_approved"), terms),
        text.last_match(F.lit("review"), terms),
        text.last_match(F.lit("other"), terms),
    ) == ("Approved", "Review", None)


def test_x5_x6_race(spark):
    assert one(
        spark,
        text.race_code(F.lit("Latin American")),
        text.race_code(F.lit(None)),
        text.race_code(F.lit("Martian")),
        text.race_code(F.lit("B")),
        text.ethnicity_code(F.lit("U")),
        text.ethnicity_code(F.lit("W")),
        text.ethnicity_code(F.lit("W"), "MO"),
    ) == ("W", "U", "U", "B", "U", "NH", "N")


@pytest.mark.parametrize(
    ("layout", "shown"), [("dashes", "201-555-0100"), ("nodashes", "2015550100"), ("national", "(201) 555-0100")]
)
def test_x7_layouts(spark, layout, shown):
    assert one(
        spark,
        text.phone_format(F.lit("+1 201.555.0100"), layout),
        text.phone_format(F.lit(None).cast("string"), layout, "2015550100"),
    ) == (shown, shown)


@pytest.mark.parametrize(
    ("phone", "value", "bad"),
    [
        ("12015550100", "201-555-0100", False),
        ("20155501009", "201-555-0100", False),
        ("20155501", "201-555-010", False),
        ("201555010", "201-555-010", False),
        ("2015550100", "201-555-0100", False),
        ("201-555-0100", "201-555-0100", False),
        ("2015550100/2015550199", "201-555-0100", False),
        ("2015550", None, True),
        ("201555010012", None, True),
        (None, None, False),
    ],
)
def test_x8_repair(spark, phone, value, bad):
    assert one(spark, *text.phone_repair(F.lit(phone).cast("string"), pad=True)) == (value, bad)


def test_x8_plain_separator(spark):
    assert one(spark, *text.phone_repair(F.lit("2015550100"), "")) == ("2015550100", False)


def test_x9_area_code(spark):
    assert one(spark, text.area_code(F.lit("2015550100")), text.without_area_code(F.lit("2015550100"))) == ("201", "5550100")


@pytest.mark.parametrize(("value", "fixed"), [("1234", "01234"), ("12345", "12345"), ("123", None), ("NJ", None), (None, None)])
def test_x10_zip(spark, value, fixed):
    assert one(spark, text.zip_repair(F.lit(value).cast("string"), F.lit("NJ"))) == (fixed,)


def test_x10_zip_equal_to_region(spark):
    assert one(spark, text.zip_repair(F.lit("12345"), F.lit("12345"))) == (None,)


def test_x11_x12(spark):
    assert one(spark, text.blank_to_null(F.lit(" ")), text.blank_to_null(F.lit("")), F.trim(F.upper(F.lit(" a ")))) == (None, "", "A")


def test_x13_codes(spark):
    assert one(
        spark,
        codes.sex_code(F.lit("male")),
        codes.sex_code(F.lit(None)),
        codes.country_name(F.lit("US")),
        codes.country_name(F.lit("CA")),
        codes.lookup(F.lit("Swab"), codes.SPECIMEN_SITE),
        codes.lookup(F.lit("Blood"), codes.SPECIMEN_SITE),
    ) == ("M", "U", "United States of America", "CA", "Nasopharynx", None)
    assert len(codes.REGIONS) == 51


@pytest.mark.parametrize(
    ("value", "number"),
    [("TRK 1000", None), ("TRK 1001", 1001), ("", None), ("abc", None), ("1234567890123456789", 1234567890123456789), (None, None)],
)
def test_m4_tracking_number(spark, value, number):
    assert one(spark, text.tracking_number(F.lit(value).cast("string"))) == (number,)


def test_f5_null_is_no_match(spark):
    assert one(spark, text.contains(F.lit(None).cast("string"), "A"), text.contains(F.lit("xAx"), "A"), text.contains(F.lit("a"), "A")) == (
        False,
        True,
        False,
    )


def test_n3_n5_p9_arrays(spark):
    empty = F.array().cast("array<struct<id:int>>")
    pair = F.array(F.struct(F.lit(1).alias("id")), F.struct(F.lit(2).alias("id")))
    assert one(
        spark,
        nested.first_of(pair)["id"],
        nested.last_of(pair)["id"],
        nested.association_id(empty),
        text.first_containing(F.array(F.lit("ab"), F.lit("bc")), "c"),
        text.first_containing(F.array(F.lit("ab")), "z"),
    ) == (1, 2, None, "bc", None)


def test_session_zone_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("tz", ["-05:00", "+05:30", "UTC", "America/New_York"])
def test_local_time_of_fixed_and_moving_zones(spark, tz):
    moment = ts("2021-07-01 02:15:00.123456")
    fast, slow = one(spark, time.to_local(moment, tz), F.convert_timezone(F.lit("UTC"), F.lit(tz), moment))
    assert fast == slow


def test_d7_seconds_cut_towards_zero(spark):
    a, b = ts("2021-01-01 00:00:00"), ts("2021-01-01 00:00:01.9")
    assert one(spark, time.seconds_between(a, b), time.seconds_between(b, a), time.micros_between(b, a)) == (1, -1, -1_900_000)


def test_shuffle_partitions_follow_the_scan(spark, tmp_path):
    from labtide.session import scan_bytes, size_for, sized

    path = f"{tmp_path}/t"
    spark.range(200_000).write.parquet(path)
    table = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    joined = table.join(table.withColumnRenamed("id", "x"), F.col("id") == F.col("x"))
    assert scan_bytes(joined) == 2 * scan_bytes(table) > 0
    assert size_for(spark, joined, target=10_000) == -(-scan_bytes(joined) // 10_000)
    assert size_for(spark, joined) == spark.sparkContext.defaultParallelism
    with pytest.raises(KeyError), sized(spark, joined):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_each_step_of_a_phone_repair_is_worked_out_once(spark):
    value, bad = text.phone_repair("p")
    plan = spark.createDataFrame([("2015550100",)], "p string").select(value.alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("regexp_replace(") == 1
