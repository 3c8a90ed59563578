"""Readers, writers, whole runs and streams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_plans import EXPORT, LAB, WINDOW, export_tables  # noqa: F401

from labtide.config.settings import DIALECTS, FileNames
from labtide.plans import runs, state_export, template, turnaround
from labtide.session import scratch_dir, scratch_root
from labtide.sources import readers, writers
from labtide.sources.ledger_store import LedgerStore, bucket_of
from labtide.sources.versions import VersionedTable
from labtide.streaming import daily_counts, file_intake, ledger_stream

D = dt.datetime


def text_file(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(content)
    return path


def files_below(path, ending=".csv"):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(ending)]


def test_scratch_is_the_checkpoint_folder(spark):
    assert scratch_dir(spark, "x").startswith(scratch_root(spark))
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_s1_sql_with_parameters(spark):
    users = spark.createDataFrame([("jones",), ("ann",)], "username string")
    got = readers.query(spark, "SELECT * FROM {users} WHERE username LIKE :like", {"users": users}, like="%one%")
    assert got.count() == 1


def test_s4_sheet(spark, tmp_path):
    path = text_file(f"{tmp_path}/sheet.csv", "Day,Time,Empty\n1/1/2021,7:00 AM,\n,,\n")
    got = readers.sheet(spark, path)
    assert got.columns == ["Day", "Time"] and got.count() == 1


def test_s5_s7_text_tables(spark, tmp_path):
    path = text_file(f"{tmp_path}/a.csv", "﻿id,zip\n1,07001\n")
    assert tuple(readers.all_text(spark, path).first()) == ("1", "07001")
    assert readers.all_text(spark, path).columns == ["id", "zip"]
    assert readers.delimited(spark, path, "id int, zip string").first().id == 1


def test_s6_id_list(spark, tmp_path):
    path = text_file(f"{tmp_path}/ids.csv", "﻿8001\n8002\n")
    assert sorted(r.id for r in readers.id_list(spark, path).collect()) == [8001, 8002]


def test_s8_region_from_file_name(spark, tmp_path):
    text_file(f"{tmp_path}/in/NJ_2021_01_21.csv", "a,b\n1,2\n")
    text_file(f"{tmp_path}/in/PA_2021_01_21.csv", "a,b\n3,4\n")
    got = readers.region_files(spark, f"{tmp_path}/in")
    assert sorted(tuple(r) for r in got.collect()) == [("NJ", "1", "2"), ("PA", "3", "4")]


def test_s9_s10_landed_json(spark, tmp_path):
    from labtide.functions import nested
    from labtide.plans import crm

    path = text_file(f"{tmp_path}/page.json", '{"results": [{"id": "1", "properties": {"name": "a"}}, {"id": "2", "properties": {"name": "b"}}]}\n')
    pages = readers.json_objects(spark, path, "results array<struct<id: string, properties: struct<name: string>>>")
    got = crm.flatten_objects(nested.explode_results(pages), "products")
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a"), ("2", "b")]


def test_s11_tracker_json(spark, tmp_path):
    from labtide.plans import trackers

    lines = [
        '{"id": "t1", "status": "delivered", "tracking_code": "8001", "carrier_detail": {"origin_location": "A"},'
        ' "tracking_details": [{"datetime": "2021-01-02T03:04:05Z", "tracking_location": {"city": "C", "state": "S"}}]}',
        '{"id": "t2", "status": "unknown", "tracking_code": "8002", "carrier_detail": null, "tracking_details": []}',
    ]
    path = text_file(f"{tmp_path}/trackers.json", "\n".join(lines) + "\n")
    got = trackers.normalise(readers.json_objects(spark, path, trackers.SCHEMA), full_load=True).collect()
    assert [(r.easypost_id, r.picked_up_city, r.delivery_datetime) for r in got] == [("t1", "C", D(2021, 1, 2, 3, 4, 5))]


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    ids = spark.range(1000).select(F.col("id").alias("report_id"), F.col("id").alias("v"))
    for name in ("bucket_a", "bucket_b"):
        writers.replace_bucketed(ids, name, f"{tmp_path}/{name}", "report_id", 4)
    a, b = spark.table("bucket_a"), spark.table("bucket_b").withColumnRenamed("v", "w")
    plan = a.hint("merge").join(b, "report_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_s12_k7_watermark(spark, tmp_path):
    path = f"{tmp_path}/mark"
    first = lambda: spark.range(1).select(readers.watermark(spark, path, "2021-01-01").alias("m")).first().m
    assert first() == D(2021, 1, 1)
    writers.write_watermark(spark, path, "2021-01-05 07:00:00")
    writers.write_watermark(spark, path, "2021-01-09 07:00:00", test_run=True)
    assert first() == D(2021, 1, 5, 7)


def test_k1_k2_publish(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, segment string")
    writers.publish(df, f"{tmp_path}/plain", fmt="csv")
    writers.publish(df, f"{tmp_path}/by", by="segment")
    writers.publish(df.limit(1), f"{tmp_path}/by", by="segment")
    assert spark.read.csv(f"{tmp_path}/plain", header=True).count() == 2
    assert spark.read.parquet(f"{tmp_path}/by").count() == 1
    path = writers.replace_table(df, f"{tmp_path}/t", "v1")
    newer = writers.replace_table(spark.read.parquet(path).where("id = 1"), f"{tmp_path}/t", "v2")
    assert (spark.read.parquet(path).count(), spark.read.parquet(newer).count()) == (2, 1)
    writers.write_tables([("x", df)], f"{tmp_path}/all")
    assert spark.read.parquet(f"{tmp_path}/all/x").count() == 2


def test_k3_k4_dialects(spark, tmp_path):
    states = ["NY", "IL", "PA", "AR", "TX", "NJ"]
    data = [(s, i, "1", None if s == "AR" and i else "Ann") for s in states for i in range(2)]
    data += [("NY", 7, "a|b", ' "q" '), ("TX", 7, "a,b", "x\ny"), ("TX", 8, None, "")]
    df = spark.createDataFrame(data, "file_state string, report_id long, `Patient ID` string, `Patient First Name` string")
    staged = writers.stage(df, f"{tmp_path}/staged")
    assert staged.where("file_state = 'NY'")._jdf.queryExecution().toString().count("PartitionFilters: [isnotnull") == 1
    lined = writers.lines(staged)
    assert lined._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert writers.region_files(lined, f"{tmp_path}/out") == {s: 1 for s in states}

    def content(state):
        found = [p for p in files_below(f"{tmp_path}/out", ".txt") if f"file_state={state}/" in p]
        return "".join(open(p, encoding="utf-8").read() for p in found)

    assert content("NY").splitlines() == ["1|Ann"] * 2 + ['"a|b"|" \\"q\\" "']
    assert content("IL").splitlines()[0] == "Patient ID~Patient First Name"
    assert content("PA").splitlines() == ["1,Ann"] * 2
    assert content("AR").splitlines() == ["Patient ID,Patient First Name", "1,Ann"]
    assert content("TX").splitlines()[0] == content("NJ").splitlines()[0] == "Patient ID,Patient First Name"
    schema = "`Patient ID` string, `Patient First Name` string"
    ny = readers.region_file(spark, f"{tmp_path}/out", ["NY", "WY"], schema, DIALECTS["NY"]).collect()
    assert sorted(map(tuple, ny)) == [("1", "Ann", "NY"), ("1", "Ann", "NY"), ("a|b", ' "q" ', "NY")]
    assert readers.region_file(spark, f"{tmp_path}/out", ["WY"], schema, DIALECTS["NY"]).count() == 0


def test_k3_large_region_has_several_whole_files(spark, tmp_path):
    df = spark.range(100).select(F.lit("TX").alias("file_state"), F.col("id").alias("report_id"), F.col("id").alias("a"))
    df = df.unionByName(spark.createDataFrame([("NY", 1, 1)], df.schema))
    assert writers.region_files(writers.lines(df), f"{tmp_path}/out", rows_per_file=30) == {"TX": 4, "NY": 1}
    found = [open(p).read().splitlines() for p in files_below(f"{tmp_path}/out", ".txt") if "TX" in p]
    assert len(found) == 4 and all(lines[0] == "a" for lines in found)
    assert sorted(int(x) for lines in found for x in lines[1:]) == [*range(100)]
    assert readers.region_file(spark, f"{tmp_path}/out", ["TX"], "a int", DIALECTS["AR"]).count() == 100
    assert writers.region_files(writers.lines(df.limit(0)), f"{tmp_path}/none") == {}


def test_k3_lines_are_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def region(n):
        seen.add(1)
        return f"R{n % 2}"

    df = spark.range(0, 50, 1, 1).select(F.udf(region, "string")("id").alias("file_state"), F.col("id").alias("report_id"), F.col("id").alias("a"))
    assert writers.region_files(writers.lines(df), f"{tmp_path}/out") == {"R0": 1, "R1": 1}
    assert seen.value == 50


def test_k5_append_twice_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "report_id long, event_type string")
    for _ in range(2):
        writers.append_new(spark, rows, f"{tmp_path}/ledger", "report_id")
    assert spark.read.parquet(f"{tmp_path}/ledger").count() == 2


def test_k6_k8_i3_deliveries(spark, tmp_path):
    counts = spark.createDataFrame([("OH", 3), ("NJ", 2), ("WY", 0)], "file_state string, n long")
    names = FileNames({"OH": "Lab Name_{day}.csv"})
    manifest = writers.delivery_manifest(counts, names, dt.date(2021, 1, 22))
    assert sorted((r.state, r.file) for r in manifest.collect()) == [("NJ", "NJ_2021_01_22.csv"), ("OH", "Lab Name_20210122.csv")]
    path = f"{tmp_path}/sent"
    writers.log_deliveries(spark, manifest, path)
    log = spark.read.parquet(path)
    assert writers.undelivered(manifest, log).count() == 0
    # a longer name that contains a logged one is still a new file
    assert writers.undelivered(manifest.withColumn("file", F.concat("file", F.lit(".bak"))), log).count() == 2


def test_i1_i5_whole_state_run_is_repeatable(spark, tmp_path, export_tables):  # noqa: F811
    from importlib.resources import files

    folder = str(files("labtide.config") / "templates")
    log = spark.createDataFrame([], "report_id long, event_type string, created_at timestamp_ntz")
    settings = dict(
        root=15,
        end=D(2021, 1, 22),
        first_start=D(2021, 1, 1),
        states=["NJ", "NY", "DE", "WY"],
        ledger_path=f"{tmp_path}/ledger",
        watermark_path=f"{tmp_path}/mark",
        deliveries_path=f"{tmp_path}/sent",
        report_type_ids=[283],
        templates={"TX": template.load_templates(spark, folder)["TX"]},
        catalogue=template.read_catalogue(spark, f"{folder}/catalogue.csv"),
    )
    manifest = runs.state_reporting(spark, export_tables, log, LAB, f"{tmp_path}/test", test_run=True, **settings)
    assert {r.file_state: r.n for r in manifest.collect()} == {"NJ": 2, "NY": 2, "DE": 1, "WY": 0}
    assert not os.path.exists(f"{tmp_path}/mark") and not os.path.exists(f"{tmp_path}/ledger")

    for out in ("one", "two"):
        runs.state_reporting(spark, export_tables, log, LAB, f"{tmp_path}/{out}", **settings)
    assert sorted(r.report_id for r in ledger_stream.store_at(spark, f"{tmp_path}/ledger").rows().collect()) == [1, 2]
    assert spark.read.parquet(f"{tmp_path}/sent").count() == 3
    marked = spark.read.parquet(f"{tmp_path}/one/marked")
    assert {r.file_state: r.n for r in marked.collect()} == {"NJ": 1, "NY": 1, "DE": 1, "WY": 0}
    assert "1 reports marked state reported from NJ" in [r.message for r in marked.collect()]
    assert spark.read.parquet(f"{tmp_path}/two/marked").agg(F.sum("n")).first()[0] == 0
    # a run is open at its end: a report sent at that moment is left for the next one
    close = {**settings, "end": D(2021, 1, 21, 8), "watermark_path": f"{tmp_path}/m2", "ledger_path": f"{tmp_path}/l2"}
    close["deliveries_path"] = f"{tmp_path}/s2"
    for out, end in (("early", D(2021, 1, 21, 8)), ("late", D(2021, 1, 22))):
        runs.state_reporting(spark, export_tables, log, LAB, f"{tmp_path}/{out}", **{**close, "end": end})
    early = {r.report_id for r in spark.read.schema("report_id long").parquet(f"{tmp_path}/early/staged").collect()}
    late = {r.report_id for r in spark.read.schema("report_id long").parquet(f"{tmp_path}/late/staged").collect()}
    assert 1 not in early and 1 in late and early | late == {1, 2}
    # files hold cleansed rows
    shown = [r.value for r in spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/one/files").collect()]
    assert shown and any("201-555" in line for line in shown), shown[:3]
    assert spark.read.parquet(f"{tmp_path}/one/quarantine").count() == 0
    # the second run starts at the watermark and finds nothing newer
    assert spark.read.parquet(f"{tmp_path}/one/staged").count() == 5
    assert spark.read.schema("report_id long").parquet(f"{tmp_path}/two/staged").count() == 0


class Died(Exception):
    pass


def reporting(tmp_path, **more):
    return dict(
        root=15, first_start=D(2021, 1, 1), states=["NJ", "NY", "DE", "WY"], ledger_path=f"{tmp_path}/ledger",
        watermark_path=f"{tmp_path}/mark", deliveries_path=f"{tmp_path}/sent", report_type_ids=[283], **more,
    )


def outcome(spark, tmp_path, out):
    """What a run leaves: files with their lines, marks, deliveries, watermark, held reports."""
    held = spark.read.schema(runs.HELD_SCHEMA).parquet(f"{tmp_path}/mark_journal/held")
    files = {
        os.path.dirname(p).split("/files/")[1]: open(p, encoding="utf-8").read() for p in files_below(f"{tmp_path}/{out}/files", ".txt")
    }
    return (
        files,
        sorted(map(str, ledger_stream.store_at(spark, f"{tmp_path}/ledger").rows().collect())),
        sorted(map(str, spark.read.parquet(f"{tmp_path}/sent").collect())),
        spark.read.parquet(f"{tmp_path}/mark").agg(F.max("last_export")).first()[0],
        sorted(map(str, held.collect())),
    )


def test_i1_c15_a_run_that_died_goes_on(spark, tmp_path, export_tables, monkeypatch):  # noqa: F811
    from labtide.plans.journal import BEGIN, FINISHED, Journal

    log = spark.createDataFrame([], "report_id long, event_type string, created_at timestamp_ntz")
    steps, note = [], Journal.note

    def run(base, end=D(2021, 1, 22)):
        return runs.state_reporting(spark, export_tables, log, LAB, f"{base}/out", end=end, **reporting(base))

    def noted(self, a_run, step):
        steps.append(step)
        note(self, a_run, step)

    monkeypatch.setattr(Journal, "note", noted)
    whole = run(f"{tmp_path}/whole")
    want = outcome(spark, f"{tmp_path}/whole", "out")
    assert steps[0] == BEGIN and steps[-1] == FINISHED and len(steps) == 10 and len(want[0]) == 3 and len(want[1]) == 2

    # One run that dies after steps in turn, before they are noted, and is called again each time.
    base = f"{tmp_path}/killed"

    def dying(self, a_run, step):
        if step == wanted:
            raise Died(step)
        note(self, a_run, step)

    for wanted in ("export", "hold", "marks", "ledger", FINISHED):
        monkeypatch.setattr(Journal, "note", dying)
        with pytest.raises(Died):
            run(base)
        monkeypatch.setattr(Journal, "note", note)
    manifest = run(base)
    assert outcome(spark, base, "out") == want
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, whole.collect()))


def test_i1_held_reports_come_back_until_marked(spark, tmp_path, export_tables):  # noqa: F811
    from dataclasses import replace

    log = spark.createDataFrame([], "report_id long, event_type string, created_at timestamp_ntz")
    phones = export_tables.patient_users
    broken = replace(export_tables, patient_users=phones.withColumn("phone", F.lit("12")))

    def run(tables, end, events=log):
        runs.state_reporting(spark, tables, events, LAB, f"{tmp_path}/out", end=end, **reporting(tmp_path))

    def held(number):
        rows = spark.read.schema(runs.HELD_SCHEMA).parquet(f"{tmp_path}/mark_journal/held/run={number}").collect()
        return {r.report_id: (r.since_run, r.reasons) for r in rows}

    def marked():
        return sorted(r.report_id for r in ledger_stream.store_at(spark, f"{tmp_path}/ledger").rows().collect())

    run(broken, D(2021, 1, 22))
    assert held(1) == {1: (1, ["bad_phone"]), 2: (1, ["bad_phone"])} and marked() == []
    quarantined = spark.read.parquet(f"{tmp_path}/out/quarantine")
    assert quarantined.count() == 5 and quarantined.where("reasons = array('bad_phone')").count() == 5
    totals = {r.rule: r.n for r in spark.read.parquet(f"{tmp_path}/out/row_rules").collect()}
    assert totals == {"rows": 5, "held": 5, "no_accession": 0, "bad_phone": 5, "few_values": 0}
    # still broken, and not in the window any more
    run(broken, D(2021, 1, 23))
    assert held(2) == held(1) and marked() == []
    # a report that the export does not show for a while stays held
    hidden = replace(broken, reports=broken.reports.where("id <> 2"))
    run(hidden, D(2021, 1, 24))
    assert held(3) == held(1)
    # someone marked report 2 by hand
    by_hand = spark.createDataFrame([(2, "report_marked_state_reported", D(2021, 1, 24))], log.schema)
    run(broken, D(2021, 1, 25), by_hand)
    assert held(4) == {1: (1, ["bad_phone"])}
    run(export_tables, D(2021, 1, 26), by_hand)
    assert held(5) == {} and marked() == [1]
    assert spark.read.parquet(f"{tmp_path}/out/staged").select("report_id").distinct().count() == 1


def test_dashboards_and_shift_runs(spark, tmp_path):
    from labtide.standins import Standins

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables are not here")
    t = Standins(spark, "/root/testdata/sf0.001")
    facts = turnaround.report_facts(t.reports, t.clinics, t.distributors, t.report_types, t.kits, t.samples, t.report_events)
    runs.dashboards(facts, f"{tmp_path}/dash", turnaround.segment_rules(), term="SMALL")
    assert spark.read.parquet(f"{tmp_path}/dash/facts").count() > 0
    assert "Received" in spark.read.parquet(f"{tmp_path}/dash/events_by_event_day").columns
    tables = {
        "staff": t.staff, "event_logs": t.lab_events, "kits": t.event_kits, "tickets": t.tickets, "scans": t.scans, "reports": t.reports,
    }
    runs.shift_reports(tables, f"{tmp_path}/shift", dt.date(2024, 1, 8))
    daily = spark.read.parquet(f"{tmp_path}/shift/data_entry/daily")
    assert daily.count() == 8 and daily.select("week_start").distinct().count() == 1


def event_files(spark, folder, parts):
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, "event_id long, ts timestamp_ntz, user_id long, event_type string")
        df.coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_t1_stream_equals_batch_for_any_batch_size_and_late_files(spark, tmp_path, files):
    folder = f"{tmp_path}/log"
    days = [1, 2, 9, 10, 3, 4, 8, 1]
    parts = [[(n * 10 + i, D(2021, 1, d, 12, i), i, "a" if i % 2 else "b") for i in range(5)] for n, d in enumerate(days)]
    event_files(spark, folder, parts)
    schema = spark.read.parquet(folder).schema
    counts = daily_counts.daily_counts(daily_counts.read_events(spark, folder, schema, files_per_batch=files))
    daily_counts.run(counts, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.schema(daily_counts.TABLE).parquet(f"{tmp_path}/out")
    assert sorted((r.day_start.day, r.kind, r.n) for r in got.collect()) == [
        (d, k, n * days.count(d)) for d in sorted(set(days)) for k, n in (("a", 2), ("b", 3))
    ]


def test_t1_only_touched_days_are_rewritten(spark, tmp_path):
    folder, out = f"{tmp_path}/log", f"{tmp_path}/out"
    event_files(spark, folder, [[(1, D(2021, 1, 1), 1, "a"), (2, D(2021, 1, 2), 1, "a")], [(3, D(2021, 1, 2), 2, "b")]])
    schema = spark.read.parquet(folder).schema

    def run():
        counts = daily_counts.daily_counts(daily_counts.read_events(spark, folder, schema))
        daily_counts.run(counts, out, f"{tmp_path}/cp").awaitTermination()
        files = {p: os.path.getmtime(p) for p in files_below(out, ".parquet")}
        rows = spark.read.schema(daily_counts.TABLE).parquet(out).collect()
        return {d: {p: t for p, t in files.items() if f"day={d}" in p} for d in ("2021-01-01", "2021-01-02")}, sorted((r.day.day, r.kind, r.n) for r in rows)

    before, rows = run()
    assert rows == [(1, "a", 1), (2, "a", 1), (2, "b", 1)]
    # a late row of the second day
    event_files(spark, folder, [[(9, D(2021, 1, 2, 5), 2, "b")]])
    after, rows = run()
    assert rows == [(1, "a", 1), (2, "a", 1), (2, "b", 2)]
    assert before["2021-01-01"] == after["2021-01-01"] and before["2021-01-02"] != after["2021-01-02"]


def test_t2_stream_marks_each_report_once(spark, tmp_path):
    folder, ledger, cp = f"{tmp_path}/log", f"{tmp_path}/ledger", f"{tmp_path}/cp"
    event_files(spark, folder, [[(1, D(2021, 1, 1), 1, "a"), (2, D(2021, 1, 1), 1, "a")], [(3, D(2021, 1, 2), 2, "a")]])
    schema = spark.read.parquet(folder).schema

    def run():
        stream = daily_counts.read_events(spark, folder, schema, files_per_batch=1)
        reports = stream.select(F.col("user_id").alias("id"), F.col("user_id").alias("patient_user_id"))
        ledger_stream.run(reports, ledger, cp, as_of="2021-02-01", user_id=7).awaitTermination()
        return sorted(r.report_id for r in ledger_stream.store_at(spark, ledger).rows().collect())

    assert run() == [1, 2]
    event_files(spark, folder, [[(4, D(2021, 1, 3), 2, "a"), (5, D(2021, 1, 3), 3, "a")]])
    assert run() == [1, 2, 3]


def test_t2_replayed_batch_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    first = spark.createDataFrame([(1, 1), (2, 2)], "id long, patient_user_id long")
    second = spark.createDataFrame([(2, 2), (3, 3)], "id long, patient_user_id long")
    for batch, rows in ((0, first), (1, second), (0, first), (1, second)):
        ledger_stream.mark_batch(rows, batch, path, as_of="2021-02-01", user_id=7)
    assert sorted(r.report_id for r in ledger_stream.store_at(spark, path).rows().collect()) == [1, 2, 3]


def marks(spark, ids):
    return spark.createDataFrame([(i, f"m{i}") for i in ids], "report_id long, note string")


def held_ids(store):
    return sorted(r.report_id for r in store.rows().collect())


def test_k5_ledger_reads_the_buckets_of_a_batch_only(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger", "report_id long, note string", buckets=16)
    history = [*range(0, 4000, 2)]
    assert store.add(marks(spark, [*history, *history[:50], None]), 0).count() == len(history)
    own = {r.b for r in marks(spark, [1, 3, 5]).select(bucket_of(F.col("report_id"), 16).alias("b")).collect()}
    # new ids: filters of their buckets are read, but hardly any marks
    store.add(marks(spark, [1, 3, 5]), 1)
    assert set(store.own_buckets) == own and set(store.read_buckets) <= own
    misses = store.fresh(marks(spark, range(100_001, 100_401, 2)))
    assert misses.count() == 200 and len(store.read_buckets) < 16
    # a known id makes its own bucket readable, and no other
    assert store.fresh(marks(spark, [8])).count() == 0
    assert store.read_buckets == store.own_buckets and len(store.read_buckets) == 1
    plan = store._marks().where(F.col("bucket").isin(store.read_buckets))._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan
    assert held_ids(store) == sorted([*history, 1, 3, 5])


def test_k5_ledger_replays_and_compaction(spark, tmp_path):
    store = LedgerStore(spark, f"{tmp_path}/ledger", "report_id long, note string", buckets=4)
    batches = [[1, 2, 3], [3, 4, 5], [5, 6, None, 6], []]
    for number, ids in enumerate(batches):
        store.add(marks(spark, ids), number)
    for number in (1, 2, 0, 1):
        store.add(marks(spark, batches[number]), number)
    assert held_ids(store) == [1, 2, 3, 4, 5, 6]
    assert (store.compact(1), store.compact(1)) == (1, 1)
    assert held_ids(store) == [1, 2, 3, 4, 5, 6]
    store.add(marks(spark, batches[2]), 2)
    assert sorted(r.report_id for r in store.add(marks(spark, [2, 4, 6, 7]), 4).collect()) == [7]
    assert store.compact(4) == 2 and held_ids(store) == [1, 2, 3, 4, 5, 6, 7]
    assert store.add(marks(spark, [1, 7]), 5).count() == 0
    again = LedgerStore(spark, f"{tmp_path}/ledger", "report_id long, note string", buckets=4)
    assert held_ids(again) == [1, 2, 3, 4, 5, 6, 7]


def test_t2_compaction_while_the_stream_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger_stream, "COMPACT_EVERY", 2)
    for batch in range(5):
        rows = spark.createDataFrame([(i, i) for i in range(batch, batch + 3)], "id long, patient_user_id long")
        store = ledger_stream.mark_batch(rows, batch, f"{tmp_path}/ledger", as_of="2021-02-01", user_id=7, buckets=4)
    assert held_ids(store) == [*range(7)] and store.pointer.current() == (2, 3)


def test_k2_i4_versions_and_the_newest_row(spark, tmp_path):
    schema = "k long, at string, v string"
    table = VersionedTable(spark, f"{tmp_path}/t", "k", ["at"])
    with pytest.raises(ValueError, match="no version"):
        table.read()
    first = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "z"), (None, "c", "w")], schema)
    second = spark.createDataFrame([(2, "b", "new"), (1, "a", "stale"), (3, None, "only"), (1, "b", "tie")], schema)
    assert (table.upsert(first), table.upsert(second)) == (1, 2)
    other = VersionedTable(spark, f"{tmp_path}/o", "k", ["at"])
    other.upsert(second)
    other.upsert(first)
    rows = lambda t, v=None: sorted(map(tuple, t.read(v).collect()))
    # the order in which rows came makes no difference, also for ties
    assert rows(table) == rows(other) and rows(table)[1:] == [(2, "b", "new"), (3, None, "only")]
    assert rows(table, 1) == [(1, "b", "y"), (2, "a", "z")]
    # a version that was written but never pointed at does not count
    first.write.parquet(f"{tmp_path}/t/v=3")
    assert table.version() == 2 and table.replace(first.limit(1)) == 3 and table.read().count() == 1


def test_s8_i3_a_file_is_taken_once_whatever_the_batches(spark, tmp_path):
    for region, n in (("NJ", 1), ("PA", 2), ("NY", 3)):
        text_file(f"{tmp_path}/in/{region}_2021_01_21.csv", "".join(f"{region}{i}\n" for i in range(n)))
    text_file(f"{tmp_path}/in/deep/file_state=TX/file=0/part-0.csv", "t\n")
    text_file(f"{tmp_path}/in/deep/file_state=TX/file=1/part-0.csv", "u\nv\n")

    def taken(out):
        rows = spark.read.schema(file_intake.FILES).parquet(f"{out}/files").collect()
        lines = spark.read.schema(file_intake.LINES).parquet(f"{out}/lines").collect()
        return sorted((r.state, r.file, r.n) for r in rows), sorted(r.value for r in lines)

    def run(out, files, checkpoint="cp", **how):
        stream = file_intake.read_files(spark, f"{tmp_path}/in", files_per_batch=files)
        file_intake.run(stream, out, f"{out}/{checkpoint}", **how).awaitTermination()
        return taken(out)

    one, all_at_once = run(f"{tmp_path}/one", 1), run(f"{tmp_path}/all", 100)
    assert one == all_at_once and [r[0] for r in one[0]] == ["NJ", "NY", "PA", "TX", "TX"] and len(one[1]) == 9
    assert ("TX", "file=1/part-0.csv", 2) in one[0]
    # the same name under another path is the same delivery; a new one is taken; a lost checkpoint changes nothing
    text_file(f"{tmp_path}/in/again/NJ_2021_01_21.csv", "changed\n")
    text_file(f"{tmp_path}/in/NJ_2021_01_22.csv", "next\n")
    files, lines = run(f"{tmp_path}/one", 1)
    assert len(files) == 6 and "next" in lines and "changed" not in lines
    assert run(f"{tmp_path}/one", 2, "lost", first_batch=100) == (files, lines)
    # a batch that comes again writes the same
    batch = spark.createDataFrame([("NJ", "new.csv", "x", 1, D(2021, 1, 1))], "state string, file string, value string, bytes long, arrived timestamp")
    file_intake.take(batch, 7_000, f"{tmp_path}/one")
    before = taken(f"{tmp_path}/one")
    file_intake.take(batch, 7_000, f"{tmp_path}/one")
    assert taken(f"{tmp_path}/one") == before and len(before[0]) == 7


PAGE = "asked string, paging struct<next: struct<after: string>>, results array<struct<id: string, properties: struct<name: string>>>"


def landed(spark, links, **names):
    rows = [(asked, None if after is None else ((after,),), [(f"{asked}-1", (names.get("name", "n"),)), (f"{asked}-2", ("n",))]) for asked, after in links]
    return spark.createDataFrame(rows, PAGE)


@pytest.mark.parametrize(
    "links, faults",
    [
        ([(None, "a"), ("a", "b"), ("b", None)], []),
        ([(None, "a"), ("a", "b"), ("b", None), ("a", "b")], []),
        ([(None, None)], []),
        ([], []),
        ([(None, "a"), ("a", "b")], [("b", "missing")]),
        ([(None, "a"), ("b", None), ("a", "x")], [("b", "unasked"), ("x", "missing")]),
        ([("a", None)], [(None, "no first page"), ("a", "unasked")]),
        ([(None, "a"), ("a", None), ("a", "c"), ("c", None)], [("a", "repeated")]),
        ([(None, "a"), ("a", "c"), ("b", "c"), ("c", None)], [("b", "unasked"), ("c", "joined")]),
        ([(None, "a"), ("a", None), ("x", "y"), ("y", "z"), ("z", "x")], [("x", "loop"), ("y", "loop"), ("z", "loop")]),
    ],
)
def test_c20_page_chains(spark, links, faults):
    from labtide.plans import crm

    assert sorted((tuple(r) for r in crm.page_faults(landed(spark, links)).collect()), key=str) == sorted(faults, key=str)


def test_c20_a_missing_page_refuses_the_swap(spark, tmp_path):
    from labtide.plans import crm

    whole, broken = [(None, "a"), ("a", None)], [(None, "a")]
    kinds = ["companies", "products"]
    tables = crm.refresh_objects({k: landed(spark, whole) for k in kinds}, f"{tmp_path}/t")
    assert sorted(map(tuple, tables["products"].read().collect()))[0] == ("None-1", "n") and tables["products"].read().count() == 4
    with pytest.raises(crm.IncompletePages, match="products: missing a"):
        crm.refresh_objects({"companies": landed(spark, whole, name="new"), "products": landed(spark, broken)}, f"{tmp_path}/t")
    assert tables["companies"].version() == 1 and tables["companies"].read().where("name = 'new'").count() == 0


def test_c20_chains_of_all_kinds_are_checked_together(spark, tmp_path, monkeypatch):
    from labtide.plans import crm

    whole, loop = [(None, "a"), ("a", "b"), ("b", None)], [(None, "a"), ("a", None), ("x", "y"), ("y", "x")]
    found = crm.chain_faults({"companies": landed(spark, whole), "products": landed(spark, loop)}).collect()
    assert sorted(map(tuple, found)) == [("products", "x", "loop"), ("products", "y", "loop")]
    found = crm.chain_faults({"companies": landed(spark, [("a", None)]), "products": landed(spark, whole[:2])}).collect()
    assert sorted(map(tuple, found), key=str) == [
        ("companies", "a", "unasked"), ("companies", None, "no first page"), ("products", "b", "missing")
    ]
    labels = []
    monkeypatch.setattr(crm, "scratch_dir", lambda s, label: labels.append(label) or scratch_dir(s, label))
    crm.refresh_objects({k: landed(spark, whole) for k in crm.OBJECTS}, f"{tmp_path}/t")
    assert labels.count("pages") == 1 and labels.count("back") == 3


def test_c8_store_replaces_whole_weeks_only(spark, tmp_path):
    from labtide.plans import weekly_store

    day = dt.date
    rows = lambda *d: spark.createDataFrame([("m", x, "Ann", n, 5, 0) for x, n in d], "metric string, day date, fullname string, n long, sec long, frac long")
    path = f"{tmp_path}/store"
    weekly_store.update(rows((day(2021, 1, 4), 1), (day(2021, 1, 12), 2)), path, day(2021, 1, 4), day(2021, 1, 18))
    first = {p: os.path.getmtime(p) for p in files_below(path, ".parquet")}
    weekly_store.update(rows((day(2021, 1, 13), 7)), path, day(2021, 1, 11), day(2021, 1, 18))
    kept = sorted((r.day, r.n) for r in weekly_store.sums(spark, path).collect())
    assert kept == [(day(2021, 1, 4), 1), (day(2021, 1, 13), 7)]
    later = {p: os.path.getmtime(p) for p in files_below(path, ".parquet")}
    assert [first[p] == later.get(p) for p in sorted(first)] == [True, False]
    assert [r.n for r in weekly_store.sums(spark, path, day(2021, 1, 11)).collect()] == [7]
    plan = weekly_store.sums(spark, path, day(2021, 1, 11), day(2021, 1, 18))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_start" in plan
    with pytest.raises(ValueError, match="Mondays"):
        weekly_store.update(rows(), path, day(2021, 1, 5), day(2021, 1, 11))


def test_s1_jdbc_options():
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **options):
            self.seen.update(options)
            return self

        def load(self):
            return self.seen

    class Session:
        read = Reader()

    seen = readers.jdbc_table(Session(), "jdbc:x", "reports", split_on="id", low=0, high=100, parts=8, options={"fetchsize": "10000"})
    assert seen["numPartitions"] == 8 and seen["partitionColumn"] == "id" and seen["fetchsize"] == "10000"


def test_unsent_rows_stay_out_of_a_window(export_tables):  # noqa: F811
    assert state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW).where(F.col("`Result Date and Time`").isNull()).count() == 0


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        scratch_root(Session())


def test_a9_manifest_lists_all_regions(spark, export_tables):  # noqa: F811
    from labtide.functions import codes

    regions = spark.createDataFrame([(r,) for r in codes.REGIONS], "file_state string")
    got = state_export.manifest(regions, state_export.export_rows(export_tables, LAB, **EXPORT, **WINDOW)).collect()
    assert len(got) == 51 and sum(r.n > 0 for r in got) == 3 and sum(r.n for r in got) == 5
