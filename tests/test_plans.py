"""Reports on hand-made tables: the decided behaviour, row by row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from labtide.config.settings import ACTIVITY_EVENTS, LabIdentity
from labtide.plans import activity, cleanse, crm, funnel, ledger, shift, state_export, template, trackers, turnaround

D = dt.datetime


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def base(spark):
    reports = spark.createDataFrame(
        [
            # id, kit, clinic, type, created, start, sent, result, expedited
            (1, 1, 1, 1, D(2021, 1, 4, 15), D(2021, 1, 4, 15, 30), D(2021, 1, 6, 12), "Positive", True),
            (2, 2, 1, 1, D(2021, 1, 4, 9), D(2021, 1, 4, 15), D(2021, 1, 5, 12), "Negative", None),
            (3, 3, 2, 2, D(2021, 1, 4, 9), D(2021, 1, 4, 15), D(2021, 1, 9, 12), None, False),
            (4, 4, 1, 1, D(2021, 1, 4, 9), None, D(2021, 1, 5, 12), "Positive", False),
            (5, 5, 1, 1, D(2021, 1, 4, 9), D(2021, 1, 4, 15), None, "Positive", False),
            (6, 6, 1, 1, D(2021, 1, 4, 9), D(2021, 1, 4, 15), D(2021, 1, 5, 12), "Positive", False),
        ],
        """id long, kit_id long, clinic_id long, report_type_id long, created_at timestamp_ntz, start_date timestamp_ntz,
           sent_date timestamp_ntz, result string, expedited boolean""",
    )
    clinics = spark.createDataFrame([(1, "Harbor", 1), (2, "North", 2)], "id long, name string, distributor_id long")
    distributors = spark.createDataFrame([(1, "Green Valley East"), (2, "Other")], "id long, name string")
    types = spark.createDataFrame([(1, "COVID PCR"), (2, "Genome")], "id long, name string")
    kits = spark.createDataFrame(
        [(1, "8-001 234"), (2, "N/A"), (3, None), (4, "x"), (5, "x"), (6, "x")], "id long, tracking_number string"
    )
    samples = spark.createDataFrame(
        [
            (11, 1, D(2021, 1, 1), D(2021, 1, 1)),
            (10, 1, D(2021, 1, 2), D(2021, 1, 1)),
            (12, 1, D(2021, 1, 5), D(2021, 1, 1)),
            (20, 2, D(2021, 1, 4), D(2021, 1, 1)),
            (30, 3, D(2021, 1, 4), D(2021, 1, 1)),
            (50, 5, D(2021, 1, 4), D(2021, 1, 1)),
        ],
        "id long, kit_id long, received_at timestamp_ntz, collection_date timestamp_ntz",
    )
    events = spark.createDataFrame(
        [
            (1, 1, 7, "first_sample_data_source_linked_to_report", D(2021, 1, 4, 16)),
            (2, 1, 8, "report_marked_redraw", D(2021, 1, 5, 16)),
            (3, 1, 8, "report_sent", D(2021, 1, 6, 12)),
            (4, 1, 8, "report_sent_to_patient", D(2021, 1, 6, 11)),
            (5, 2, 7, "report_review_approved", D(2021, 1, 5, 2)),
            (6, 3, 9, "report_generated", D(2021, 1, 5, 2)),
            (7, 5, 9, "first_sample_data_source_linked_to_report", D(2021, 1, 5, 2)),
        ],
        "id long, report_id long, user_id long, event_type string, created_at timestamp_ntz",
    )
    return reports, clinics, distributors, types, kits, samples, events


@pytest.fixture(scope="module")
def facts(base):
    return turnaround.report_facts(*base)


def test_c1_one_row_per_report(facts):
    got = {r.id: r for r in facts.collect()}
    # 4 never started, 6 has neither sample nor event
    assert sorted(got) == [1, 2, 3, 5]
    assert got[1].redraw and not got[2].redraw
    # the highest sample id wins, shown in local time
    assert got[1].receive_day == "01/04/2021" and got[1].timedelta == 36 * 3600
    assert got[1].start_hour == 10 and got[1].create_hour == 10
    assert got[5].sent_day is None


def test_c1_start_bound_is_local(base):
    assert turnaround.report_facts(*base, start="2021-01-04 10:15:00").count() == 1


def test_c2_main_branch(facts):
    out = {r.id: r for r in turnaround.turnaround(facts).collect()}
    # 2 carries the N/A marker, 3 is another test, 5 was not sent
    assert sorted(out) == [1]
    r = out[1]
    assert (r.TAT, r.goal, r.goal_missed, r.positive, r.tracking_number) == (36.0, 24, 1, 1, 8001234)
    assert (r.start_date_type, r.weekday, r.month) == ("report_created", "Monday", "January")
    assert r["72 Hours"] == 72


def test_c2_range_is_open_and_null_expedited_is_72(facts):
    assert turnaround.turnaround(facts, high=36.0).count() == 0
    late = turnaround.turnaround(facts.withColumn("tracking_number", F.lit(None).cast("string")))
    got = {r.id: (r.goal, r.goal_missed) for r in late.collect()}
    assert got == {1: (24, 1), 2: (72, 0)}


def test_c2_genomics_counts_whole_days(facts):
    got = turnaround.turnaround(facts, genomics=True)
    assert [(r.id, r.TAT) for r in got.collect()] == [(3, 5)]


def test_c2_published_columns_and_average(facts):
    out = turnaround.turnaround(facts)
    published = turnaround.published(out).columns
    assert "72 Hours" not in published and "start_day" not in published and "TAT" in published
    assert turnaround.with_average(out).first()["Average Turnaround"] == 36.0


def test_c6_positives(facts):
    assert turnaround.positives(turnaround.turnaround(facts)).columns[0] == "id"


def test_f14_rules(facts):
    from labtide.operators.matching import segments

    rules = turnaround.segment_rules(distributor_has=["Green Valley"], clinic_has=["Harbor"])
    got = segments(facts, rules).groupBy("segment").count()
    assert rows(got, "segment") == [("all", 4), ("clinics with Harbor", 3), ("distributors with Green Valley", 3)]


def test_c3_a_tracker_refresh_works_its_rows_out_once(spark, facts, tmp_path, monkeypatch):
    from labtide.plans import runs, trackers

    turnaround.turnaround(facts).write.parquet(f"{tmp_path}/rows")
    rows, read = spark.read.parquet(f"{tmp_path}/rows"), []
    landed = spark.createDataFrame([("t1", "5")], "id string, tracking_code string")
    landed = spark.createDataFrame([], trackers.SCHEMA).unionByName(landed, allowMissingColumns=True).withColumn(
        "carrier_detail", F.struct(F.lit("x").alias("origin_location"), F.lit("y").alias("destination_location"), F.lit(None).cast("string").alias("initial_delivery_attempt"))
    )
    unseen = turnaround.unseen_tracking
    monkeypatch.setattr(turnaround, "unseen_tracking", lambda r, known: read.append(r.inputFiles()) or unseen(r, known))
    runs.refresh_trackers(rows, landed, f"{tmp_path}/table", f"{tmp_path}/out")
    assert read and not any(f"{tmp_path}/rows/" in file for file in read[0])
    got = spark.read.parquet(f"{tmp_path}/out/unseen")
    assert [r.tracking_number for r in got.collect()] == [r.tracking_number for r in rows.select("tracking_number").distinct().collect()]


def test_c3_trackers_restart_the_clock(spark, facts):
    known = spark.createDataFrame(
        [("t1", 8001234, D(2021, 1, 5, 7), "u", "c", "s"), (None, 5, None, None, None, None)],
        """easypost_id string, tracking_number long, delivery_datetime timestamp_ntz, public_url string,
           picked_up_city string, picked_up_state string""",
    )
    r = turnaround.with_trackers(turnaround.turnaround(facts), known).first()
    # sent 2021-01-06 07:00 local minus delivery
    assert (r.TAT, r.start_date_type, r["Average Turnaround"]) == (24.0, "delivery_date", 24.0)
    late = known.withColumn("delivery_datetime", F.lit(D(2021, 2, 1)).cast("timestamp_ntz"))
    r = turnaround.with_trackers(turnaround.turnaround(facts), late).first()
    # negative: back to sent minus start
    assert (r.TAT, r.start_date_type) == (44.5, "delivery_date")
    assert turnaround.unseen_tracking(turnaround.turnaround(facts), known).count() == 0


def test_c4_first_per_category_and_received(base, facts):
    events = base[-1]
    firsts = {(r.report_id, r.category): r.event_at for r in funnel.first_events(events).collect()}
    assert firsts[(1, "Sent")] == D(2021, 1, 6, 6)
    assert (2, "Approved") in firsts and (2, "Review") not in firsts
    assert not [k for k in firsts if k[1] is None]
    by_event = {r.receive_day: r for r in funnel.funnel(facts).collect()}
    # received on 01/04 (report 1) and 01/03 (2 and 5); events on 01/03 do not exist
    assert by_event["01/04/2021"]["Accessioned"] == 2 and by_event["01/04/2021"]["Received"] == 1
    assert by_event["01/04/2021"]["Sent"] is None and "01/03/2021" not in by_event
    by_start = funnel.funnel(facts, day="start_day").collect()
    assert [(r.receive_day, r["Accessioned"], r["Sent"]) for r in by_start] == [("01/04/2021", 2, 1)]


def test_c5_last_event_has_no_stage_time(base):
    got = {r.id: r.micros_in_stage for r in funnel.time_in_stage(base[-1], hot_rows=0).collect()}
    assert got[3] is None and got[2] == 19 * 3_600_000_000 and got[6] is None


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(
        [(70, 7, "Ann", "A"), (80, 8, None, "B")], "id long, user_id long, first_name string, last_name string"
    )


def test_c7_accessions_credit_the_next_user(base, staff):
    got = activity.accession_metric(base[0], base[-1], staff, hot_rows=0)
    # report 5's linking event is its last one
    assert rows(got.select("day", "fullname", "n"), "day") == [(dt.date(2021, 1, 4), " B", 1)]


def test_c7_left_join_keeps_unknown_users(base, staff):
    got = activity.by_user(activity.time_of_day(base[-1], staff, how="left"))
    assert sum(r.n for r in got.collect()) == 7
    assert sum(r.n for r in got.where("fullname = ' '").collect()) == 2
    inner = activity.time_of_day(base[-1], staff)
    assert inner.agg(F.sum("n")).first()[0] == 5


def test_c7_elapsed_equals_row_by_row_mean(spark, staff):
    log = spark.createDataFrame(
        [
            (1, 1, 7, "kit_accessioning_complete", D(2021, 1, 5, 12, 0, 0, 250_000)),
            (2, 1, 7, "kit_accessioning_complete", D(2021, 1, 5, 13, 0, 1, 500_000)),
            (3, 2, 8, "kit_accessioning_complete", D(2021, 1, 5, 13)),
            (4, 3, 8, "kit_accessioning_complete", D(2021, 1, 5, 13)),
            (5, 1, 8, "other", D(2021, 1, 5, 13)),
        ],
        "id long, kit_id long, user_id long, event_type string, created_at timestamp_ntz",
    )
    kits = spark.createDataFrame(
        [(1, D(2021, 1, 4, 11, 30, 0, 750_000)), (2, D(2021, 1, 6)), (3, None)], "id long, received_at timestamp_ntz"
    )
    daily = activity.by_day(activity.event_metrics(log, kits, staff), ["metric"]).collect()
    seconds = [88_199.5, 91_800.75, -39_600.0]
    assert [(r.metric, r.n) for r in daily] == [("entries", 3)]
    assert daily[0].mean_seconds == pytest.approx(sum(seconds) / 3)
    assert set(ACTIVITY_EVENTS) == {"entries", "reviews", "scans_assigned_to_kits"}


def test_c13_unknown_users_stay_in_the_left_join(spark, staff):
    log = spark.createDataFrame(
        [(1, 1, 7, D(2021, 1, 5, 12)), (2, 1, 99, D(2021, 1, 5, 13)), (3, 1, None, D(2021, 1, 5, 13))],
        "id long, kit_id long, user_id long, created_at timestamp_ntz",
    )
    kits = spark.createDataFrame([(1, D(2021, 1, 5, 11))], "id long, received_at timestamp_ntz")
    known = activity.since_received(log, kits, staff).collect()
    every = activity.since_received(log, kits, staff, how="left").collect()
    assert [(r.n, r.sec) for r in known] == [(1, 3600)]
    assert {r.fullname: (r.n, r.sec) for r in every} == {known[0].fullname: (1, 3600), " ": (2, 14_400)}


def test_c21_neighbour_check(base):
    got = activity.next_event_check(base[-1], hot_rows=0)
    assert rows(got.select("id", "nextmatch", "lastmatch"), "id") == [(1, False, None), (7, None, None)]


def test_c8_grid_and_daily_table(spark):
    monday = dt.date(2021, 1, 4)
    long = spark.createDataFrame(
        [("tickets", monday, "Ann", 2, 7_200, 0), ("scans", dt.date(2021, 1, 10), "Bob", 1, 60, 500_000)],
        "metric string, day date, fullname string, n long, sec long, frac long",
    )
    grid = {r.fullname: r for r in shift.user_grid(long, ["tickets", "scans"]).collect()}
    assert len(shift.user_grid(long, ["tickets", "scans"]).columns) == 2 + 14
    assert grid["Ann"].mon_tickets == 2 and grid["Ann"].sun_scans == 0 and grid["Bob"].sun_scans == 1
    daily = activity.by_day(long, ["metric"])
    for week in (None, monday):
        table = {r.metric: r for r in shift.daily_table(daily, ["tickets", "scans"], week=week).collect()}
        assert table["tickets"].mon == "2" and table["tickets"].tue == "0"
        assert table["average_tickets_time"].mon == "01:00:00" and table["average_tickets_time"].tue == ""
        assert table["average_scans_time"].sun == "00:01:00"


def test_c8_empty_week_is_shown(spark):
    none = spark.createDataFrame([], "metric string, day date, n long, mean_seconds double")
    table = shift.daily_table(none, ["tickets"], week=dt.date(2021, 1, 4))
    assert {r.metric: r.wed for r in table.collect()} == {"tickets": "0", "average_tickets_time": ""}


def test_c10_matrix_row_sums(spark, staff):
    log = spark.createDataFrame(
        [(i, 7 if i % 2 else 9, "report_sent" if i % 3 else "scan_created", D(2021, 1, 4 + i % 7, 12)) for i in range(21)],
        "id long, user_id long, event_type string, created_at timestamp_ntz",
    )
    got = shift.event_matrix(log, staff).collect()
    days = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
    assert sum(r[d] for r in got for d in days) == 21
    assert {(r.event_group, r.fullname) for r in got} == {(g, n) for g in ("Sent", "Scans Created") for n in ("Ann A", " ")}


def test_c11_no_row_without_name(spark, staff):
    tickets = spark.createDataFrame(
        [(1, 7, "Redraw", D(2021, 1, 4, 12)), (2, 9, "Redraw", D(2021, 1, 4, 12)), (3, 7, "Billing", D(2021, 1, 4, 12))],
        "id long, user_id long, category string, created_at timestamp_ntz",
    )
    got = shift.ticket_matrix(tickets, staff, start=dt.date(2021, 1, 4), end=dt.date(2021, 1, 11))
    assert [(r.fullname, r.mon, r.sun) for r in got.collect()] == [("Ann A", 1, 0)]


def test_c12_weighted_time(spark):
    sheet = spark.createDataFrame(
        [("1/12/2021", "8:00 AM", 1.0, 4.0), ("1/12/2021", "10:00 AM", 3.0, 6.0), (None, "8:00 AM", 1.0, 1.0)],
        "Day string, Time string, Packages double, Samples double",
    )
    r = shift.delivery_log(sheet).first()
    assert (r.total_deliveries, r.packages, r.samples) == (2, 4.0, 10.0)
    assert r.product_mean == (3_600 + 3 * 10_800) / 2 and r.weighted_mean == (3_600 + 3 * 10_800) / 4
    assert r.weighted_average_time == "05:00:00"


LAB = LabIdentity("App", "Lab", "CL1", "1 Road", "Town", "NJ", "07000", "201-555-0100", "Box")


@pytest.fixture(scope="module")
def export_tables(spark):
    make = spark.createDataFrame
    return state_export.ExportTables(
        reports=make(
            [
                (1, 1, 1, 1, 283, 100, 15, D(2021, 1, 21, 13), "sent", "Positive"),
                (2, 2, 1, 9, 283, 101, 16, D(2021, 1, 21, 14), "approved", "Negative"),
                (3, 3, 1, 1, 283, 100, 99, D(2021, 1, 21, 13), "sent", "Positive"),
                (4, 4, 1, 1, 283, 100, 15, D(2021, 1, 21, 13), "draft", "Positive"),
                (5, 5, 1, 1, 7, 100, 15, D(2021, 1, 21, 13), "sent", "Positive"),
                (6, 6, 1, 1, 283, 100, 15, D(2021, 2, 21, 13), "sent", "Positive"),
            ],
            """id long, kit_id long, clinic_id long, provider_clinic_id long, report_type_id long, patient_user_id long,
               cached_distributor_id long, sent_date timestamp_ntz, status string, result string""",
        ),
        distributors=make(
            [(15, None, None), (16, 15, "CL16"), (99, None, "CL99")], "id long, parent_distributor_id long, clia_number string"
        ),
        clinics=make(
            [(1, "Clinic/Main", None, "201-555-0111,x"), (9, "Away", None, None)],
            "id long, name string, main_location_id long, phone string",
        ),
        locations=make(
            [
                (1, 100, None, "1 A St", None, "Newark", "NJ", "7001", "US"),
                (2, 100, None, "2 B St", "Apt 1", "Albany", "NY", "12201", "USA"),
                (3, 101, None, "3 C St", None, "Dover", "DE", "19901", "CA"),
                (9, None, 1, "9 Clinic Rd", None, "Reno", "NV", "89501", "US"),
                (8, None, 1, "8 Clinic Rd", None, "Reno", "NV", "89501", "US"),
            ],
            """id long, patient_user_id long, clinic_id long, address_1 string, address_2 string, city string, state string,
               zip string, country string""",
        ),
        report_types=make([(283, "PCR"), (7, "Other")], "id long, name string"),
        samples=make(
            [
                (1, 1, "B1", D(2021, 1, 20, 3), "Saliva"),
                (2, 1, "B2", D(2021, 1, 20, 3), "Swab"),
                (3, 1, "B3", D(2021, 1, 20, 3), "Blood"),
                (4, 2, "B4", D(2021, 1, 20, 3), "Swab"),
                (5, 3, "B5", D(2021, 1, 20, 3), "Swab"),
                (6, 4, "B6", D(2021, 1, 20, 3), "Swab"),
                (7, 5, "B7", D(2021, 1, 20, 3), "Swab"),
                (8, 6, "B8", D(2021, 1, 20, 3), "Swab"),
            ],
            "id long, kit_id long, barcode string, collection_date timestamp_ntz, collection_type string",
        ),
        sample_data_sources=make(
            [(i, "qc_approved") for i in (1, 1, 2, 3, 4, 5, 6, 7, 8)], "sample_id long, status string"
        ),
        patient_users=make(
            [(100, "Pat", "P", dt.date(1992, 2, 29), "female", None, 5), (101, "Quin", "Q", None, None, "302-555-0100,w", None)],
            """id long, first_name string, last_name string, birth_date date, gender string, phone string,
               practitioner_id long""",
        ),
        ethnicities=make([(1, "European"), (2, "African")], "id long, name string"),
        ethnicities_patient_users=make([(100, 1), (100, 2), (100, 2)], "patient_user_id long, ethnicity_id long"),
        practitioners=make([(5, "Doc", "D", "MD", "123")], "id long, first_name string, last_name string, title string, npi string"),
    )


EXPORT = dict(root=15, as_of="2021-02-28 12:00:00", report_type_ids=[283])
WINDOW = dict(start="2021-01-21 00:00:00", end="2021-01-22 00:00:00")


def test_c14_grain_and_regions(export_tables):
    got = state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW)
    assert len(got.columns) == 2 + 64
    keys = rows(got.select("report_id", "file_state", "Specimen ID / Accession Number", "Patient State"), "report_id", "file_state", "Specimen ID / Accession Number")
    assert keys == [(1, "NJ", "B1", "NJ"), (1, "NJ", "B2", "NJ"), (1, "NY", "B1", "NY"), (1, "NY", "B2", "NY"), (2, "DE", "B4", "DE")]


def test_c14_all_locations_variant(export_tables):
    got = state_export.export_rows(export_tables, LAB, all_locations=True, **EXPORT, **WINDOW)
    assert got.where("report_id = 1").count() == 8


def test_c14_fallbacks(export_tables):
    got = {(r.report_id, r.file_state): r for r in state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW).collect()}
    a, b = got[(1, "NJ")], got[(2, "DE")]
    assert a["Lab CLIA"] == "CL1" and b["Lab CLIA"] == "CL16"
    # the provider's phone keeps its text after the comma when it stands in for the patient's
    assert a["Patient Phone"] == "201-555-0111,x" and b["Patient Phone"] == "302-555-0100"
    assert a["Provider Address"] == "8 Clinic Rd " and a["Provider State"] == "NV"
    assert b["Provider Address"] == "1 Road" and b["Ordering Facility City"] == "Town"
    assert b["Provider Phone"] == "201-555-0111" and a["Ordering Facility"] == "Clinic"
    assert a["Patient Race"] == "African,European" and b["Patient Race"] == " "
    assert a["Patient Age"] == 28 and b["Patient Age"] is None
    assert (a["Patient Sex"], b["Patient Sex"]) == ("F", "U")
    assert a["Provider NPI"] == "123" and b["Provider NPI"] is None


def test_c15_finish(export_tables):
    export = state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW)
    r = state_export.finish(export).where("report_id = 1").first()
    assert r["Result Date and Time"] == "01/21/2021 08:00" and r["Patient Race"] == "African"
    assert r["Collection Date and Time"] == "01/19/2021 22:00"
    assert state_export.finish(export, mode="N").count() == 1
    assert state_export.finish(export, limit_per_state=1).count() == 3


def test_k9_manifest(spark, export_tables):
    states = spark.createDataFrame([("NJ",), ("WY",)], "file_state string")
    export = state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW)
    got = rows(state_export.manifest(states, export), "file_state")
    assert got == [("NJ", 2, "2 reports exported from NJ"), ("WY", 0, "No reports from WY")]


@pytest.fixture(scope="module")
def forms(spark):
    from importlib.resources import files

    folder = str(files("labtide.config") / "templates")
    return template.load_templates(spark, folder), template.read_catalogue(spark, f"{folder}/catalogue.csv")


def test_p12_templates(spark, forms):
    templates, catalogue = forms
    assert {k: len(v.fields) for k, v in templates.items()} == {"MO": 30, "OK": 120, "TX": 56}
    assert templates["MO"].phone_layout == "nodashes" and templates["TX"].date_format == "MM/dd/yyyy"
    assert len(catalogue) == 64 and catalogue[59] == "Patient Age"


def test_p12_template_table(spark, forms, tmp_path):
    from importlib.resources import files

    from labtide.sources import writers

    table = template.read_templates(spark, str(files("labtide.config") / "templates"))
    writers.publish(table, f"{tmp_path}/templates", by="region")
    assert template.templates_of(spark.read.parquet(f"{tmp_path}/templates")) == forms[0]


def test_packaged_forms_equal_those_read_by_spark(forms):
    templates, catalogue = forms
    assert template.packaged_catalogue() == catalogue
    assert {region: template.packaged_template(region) for region in templates} == templates


def test_catalogue_names_exist_in_the_export(forms, export_tables):
    export = state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW)
    assert set(forms[1].values()) == set(export.columns) - {"report_id", "file_state"}


@pytest.mark.parametrize(("region", "n"), [("MO", 30), ("OK", 120), ("TX", 56)])
def test_c16_columns_in_order(export_tables, forms, region, n):
    templates, catalogue = forms
    done = state_export.finish(state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW))
    out = template.transform(done, templates[region], catalogue, default_phone=LAB.phone, as_of="2021-02-28 12:00:00")
    assert out.columns == [name for name, _ in templates[region].fields] and len(out.columns) == n
    assert out.count() == 5
    if region == "OK":
        r = out.where("Patient_first_name = 'Pat'").first()
        assert (r.File_created_date, r.flatfile_version_no, r.Patient_ID_type) == ("02/28/2021", "V2021-02-28_Results", "Patient Internal")
        assert r.Patient_phone_number == "201-555-0111" and r.Patient_age == 28 and r.Patient_race == "B"
        assert r.Specimen_collection_date_time == "01/19/2021 22:00" and r.Order_test_date == "01/19/2021"
        assert r.Ordered_test_code_system == "L" and r.Patient_middle_name is None
    if region == "MO":
        r = out.where("Patient_First_Name = 'Quin'").first()
        assert (r.Patient_Area_Code, r.Patient_Phone, r.Specimen_Source, r.Race, r.Ethnicity) == ("302", "5550100", "OT", "U", "U")
        assert r.Patient_DOB is None


def test_q7_strict_drops_unknown_numbers(spark):
    export = spark.createDataFrame([("x", " ")], "A string, B string")
    form = template.Template("ZZ", (("one", 1), ("again", 1), ("blank", 2), ("lost", 50), ("absent", 3)), "dashes", "yyyy")
    catalogue = {1: "A", 2: "B", 3: "C"}
    assert tuple(template.template_select(export, form, catalogue).first()) == ("x", "x", None, None, None)
    assert template.template_select(export, form, catalogue, strict=True).columns == ["one", "again", "blank", "absent"]


def test_c17_cleanse(spark):
    head = "state string, `Accession Number` string, Result_Date string, Ship_dt string, Home_Phone string, Zip string, a string, b string"
    good = ("01/02/2021", "01/03/2021", "12015550100", "7001", "x", "y")
    data = [
        ("PA", "1", *good),
        ("PA", "1", *good),
        ("WV", "2", *good),
        ("KS", "3", "2021-01-02", "2021-01-03", "1", "123", "x", "y"),
        ("NJ", "4", "01/02/2021", "01/03/2021", "1", "NJ", "x", "y"),
        ("NJ", None, *good),
        ("NJ", "6", None, None, None, None, None, "y"),
    ]
    clean, bad = cleanse.cleanse(spark.createDataFrame(data, head))
    got = {r["Accession Number"]: r for r in clean.collect()}
    assert sorted(got) == ["1", "2", "3"] and clean.count() == 3
    assert (got["1"].Result_Date, got["1"].Ship_dt, got["1"].Home_Phone, got["1"].Zip) == ("20210102", "20210103", "2015550100", "07001")
    assert (got["2"].Result_Date, got["2"].Ship_dt, got["2"].Home_Phone) == ("01/02/2021", "01/03/2021", "201-555-0100")
    assert (got["3"].Result_Date, got["3"].Home_Phone, got["3"].Zip) == ("01/02/2021", "1", None)
    assert [(r["Accession Number"], r.Home_Phone, r.Zip) for r in bad.collect()] == [("4", "1", None)]


def test_c18_marks_once(spark, export_tables):
    log = spark.createDataFrame(
        [(2, "report_marked_state_reported", D(2021, 1, 30)), (None, "report_marked_state_reported", D(2021, 1, 30)), (1, "report_sent", D(2021, 1, 30))],
        "report_id long, event_type string, created_at timestamp_ntz",
    )
    picked = ledger.to_mark(export_tables, log, root=15, report_type_ids=[283], **WINDOW)
    assert rows(picked, "id") == [(1, 100)]
    new = ledger.ledger_rows(picked, as_of="2021-01-31 00:00:00", user_id=7)
    after = log.unionByName(new.select("report_id", "event_type", "created_at"))
    assert ledger.to_mark(export_tables, after, root=15, report_type_ids=[283], **WINDOW).count() == 0
    assert ledger.to_mark(export_tables, log, root=15, report_type_ids=[283], states=["WY"], **WINDOW).count() == 0
    export = state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW)
    assert [r.report_id for r in ledger.rows_for_exported(export, log, as_of="2021-01-31", user_id=7).collect()] == [1]
    first, last = ledger.window_of(export, "Result Date and Time")
    assert spark.range(1).select(first, last).first()[1] == D(2021, 1, 21, 14, 1)


def test_c19_trackers(spark):
    steps = [("2021-01-01T01:00:00Z", ("A", "AA")), ("2021-01-02T02:00:00Z", ("B", "BB"))]

    def tracker(name, code, status="delivered", detail=("O", "D", None), details=steps):
        return (name, "c", status, None, None, None, "u", None, code, None, 1.0, detail, details)

    data = [
        tracker("t1", "800123"),
        tracker("t2", "700123", status="in_transit"),
        tracker("t3", "800999", details=[]),
        tracker("t4", "800124", detail=None),
        tracker("t5", "`800125"),
        tracker("t6", "8" * 17),
        tracker("t7", "N/A"),
        tracker("t8", None),
    ]
    got = {r.easypost_id: r for r in trackers.normalise(spark.createDataFrame(data, trackers.SCHEMA)).collect()}
    assert sorted(got) == ["t1", "t2", "t3"]
    assert (got["t1"].picked_up_city, got["t1"].delivery_date, got["t1"].tracking_number) == ("A", "2021-01-02T02:00:00Z", 800123)
    assert got["t2"].delivery_date is None and got["t2"].delivery_datetime == D(2021, 1, 2, 2)
    assert got["t3"].picked_up_state is None and got["t3"].delivery_datetime is None
    assert len(got["t1"]) == 18
    assert trackers.normalise(spark.createDataFrame(data, trackers.SCHEMA), full_load=True).count() == 2


def test_c20_crm(spark):
    ids = "struct<results: array<struct<id: string>>>"
    deals = spark.createDataFrame(
        [("1", ("big", "9"), ((None,), ([("77",), ("78",)],))), ("2", ("small", None), None)],
        f"id string, properties struct<name: string, amount: string>, associations struct<deals: {ids}, companies: {ids}>",
    )
    got = crm.flatten_objects(deals, "deals")
    assert got.columns == ["id", "companyid", "name", "amount"]
    assert rows(got, "id") == [("1", "77", "big", "9"), ("2", None, "small", None)]
    assert crm.flatten_objects(deals, "products").columns == ["id", "name", "amount"]
    lines = spark.createDataFrame(
        [("a", "Sales", [("s1", "New"), ("s2", "Won")]), ("b", "Other", [])],
        "id string, label string, stages array<struct<id: string, label: string>>",
    )
    assert crm.deal_pipelines(lines).columns == ["id", "label"]
    assert rows(crm.stages_of(lines, "Sales"), "id") == [("a", "s1", "New"), ("a", "s2", "Won")]


def test_w1_next_event_may_lie_beyond_the_week(spark):
    from labtide.plans import activity

    reports = spark.createDataFrame([(1, dt.datetime(2021, 1, 1))], "id long, start_date timestamp_ntz")
    rows = [
        (1, 1, 7, activity.FIRST_LINK_EVENT, dt.datetime(2021, 1, 11, 4, 59)),
        (2, 1, 8, "other", dt.datetime(2021, 1, 11, 5, 1)),
    ]
    log = spark.createDataFrame(rows, "id long, report_id long, user_id long, event_type string, created_at timestamp_ntz")
    staff = spark.createDataFrame([(8, 8, "Ann", "Lee")], "id long, user_id long, first_name string, last_name string")
    week = {"start": "2021-01-04 00:00:00", "end": "2021-01-11 00:00:00"}
    assert activity.accession_metric(reports, log, staff, **week).count() == 1
    assert activity.accession_metric(reports, log.where("id = 1"), staff, **week).count() == 0


def test_f12_f13_o3_rules_give_every_reason(spark):
    from labtide.operators import rules

    df = spark.createDataFrame([("NY", "1", None), ("NY", None, None), ("TX", None, "x"), ("TX", "2", "y")], "r string, a string, b string")
    tests = [rules.Rule("no_a", F.col("a").isNull()), rules.Rule("few", rules.filled_values(df, ["r"]) < 1), rules.Rule("odd", F.col("b") == "x")]
    rows, seen = rules.observed(rules.with_reasons(df, tests), tests)
    got = [r.reasons for r in rows.collect()]
    assert got == [[], ["no_a", "few"], ["no_a", "odd"], []]
    assert seen.get == {"rows": 4, "held": 2, "no_a": 2, "few": 1, "odd": 1}
    counted = {(r.r, r.reason): r.n for r in rules.counts(rules.with_reasons(df, tests), "r").collect()}
    assert counted == {("NY", "no_a"): 1, ("NY", "few"): 1, ("TX", "no_a"): 1, ("TX", "odd"): 1}
    assert rules.with_reasons(df, []).where("size(reasons) > 0").count() == 0
