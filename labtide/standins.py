"""Domain tables read from the generic test tables, so that every report can be run on them.

Orders stand for reports and kits, line items for samples and report events, suppliers for clinics and practitioners,
customers for patients and staff, nations for distributors and regions, parts for report types, and the event stream for
the activity log. Each property reads the whole table; Catalyst prunes the columns a report does not use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.config.settings import LabIdentity
from labtide.plans.state_export import ExportTables
from labtide.session import require_utc
from labtide.sources import readers

AS_OF = "2024-02-01 12:00:00"

LAB = LabIdentity(
    application="Sample Sender",
    name="Sample Laboratory",
    clia="99D0000000",
    address="1 Example Road",
    city="Exampleton",
    state="EX",
    zip="00000",
    phone="201-555-0100",
    instrument="Sample Assay",
)


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                 o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
                   l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
                   l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def _plus_seconds(ts: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", F.pmod(seconds.cast("bigint"), F.lit(86_400)).cast("int"), F.col(ts))


def _case(c: str, table: dict[str, str], otherwise: str | None = None) -> Column:
    chain = None
    for key, value in table.items():
        chain = (F if chain is None else chain).when(F.col(c) == key, F.lit(value))
    return chain if otherwise is None else chain.otherwise(F.lit(otherwise))


class Standins:
    """Lazy domain tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = require_utc(spark), root
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = readers.table(self.spark, self.root, name, SCHEMAS.get(name))
        return self._tables[name]

    @cached_property
    def reports(self) -> DataFrame:
        lines = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("part"),
            F.min("l_suppkey").alias("low_supp"),
            F.max("l_suppkey").alias("high_supp"),
            F.max("l_shipdate").alias("last_ship"),
        )
        joined = self.raw("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        sent = _plus_seconds("last_ship", F.col("o_custkey") * 61) + F.expr("interval 3 days")
        return joined.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderkey").alias("kit_id"),
            F.col("high_supp").alias("clinic_id"),
            F.col("low_supp").alias("provider_clinic_id"),
            F.col("part").alias("report_type_id"),
            F.col("o_custkey").alias("patient_user_id"),
            F.pmod("low_supp", F.lit(25)).cast("int").alias("cached_distributor_id"),
            _plus_seconds("o_orderdate", F.floor(F.col("o_totalprice") / 2)).alias("created_at"),
            _plus_seconds("o_orderdate", F.floor("o_totalprice")).alias("start_date"),
            F.when(F.col("o_orderstatus") != "P", sent).alias("sent_date"),
            _case(
                "o_orderpriority",
                {
                    "1-URGENT": "approved",
                    "2-HIGH": "sent",
                    "3-MEDIUM": "sent_to_patient",
                    "4-NOT SPECIFIED": "consultation_pending",
                },
                "draft",
            ).alias("status"),
            _case("o_orderstatus", {"F": "Positive", "O": "Negative"}).alias("result"),
            (F.col("o_orderpriority") == "1-URGENT").alias("expedited"),
        )

    @cached_property
    def kits(self) -> DataFrame:
        key = F.col("o_orderkey").cast("string")
        number = (
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit("N/A"))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("TRK "), F.col("o_custkey").cast("string")))
            .otherwise(F.concat(F.lit("8"), F.lpad(key, 11, "0"), F.lit("-A")))
        )
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            number.alias("tracking_number"),
            _plus_seconds("o_orderdate", F.floor("o_totalprice")).alias("received_at"),
        )

    def _line_id(self) -> Column:
        line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000_000
        mixed = (
            F.col("l_partkey") * 1_000_003
            + F.col("l_suppkey") * 10_007
            + F.unix_date(F.col("l_shipdate").cast("date")) * 31
            + F.round(F.col("l_extendedprice") * 100).cast("bigint")
        )
        return line + F.pmod(mixed, F.lit(1_000_000_000))

    @cached_property
    def samples(self) -> DataFrame:
        received = _plus_seconds("l_shipdate", F.floor("l_extendedprice"))
        return self.raw("lineitem").select(
            self._line_id().alias("id"),
            F.col("l_orderkey").alias("kit_id"),
            received.alias("received_at"),
            (received - F.expr("interval 36 hours")).alias("collection_date"),
            _case("l_returnflag", {"A": "Saliva", "N": "Swab", "R": "Blood"}).alias("collection_type"),
            F.concat(F.lit("S"), self._line_id().cast("string")).alias("barcode"),
        )

    @cached_property
    def sample_data_sources(self) -> DataFrame:
        rejected = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
        status = F.when(rejected, "rejected").when(F.col("l_linestatus") == "O", "further_review").otherwise("qc_approved")
        return self.raw("lineitem").select(self._line_id().alias("sample_id"), status.alias("status"))

    @cached_property
    def report_events(self) -> DataFrame:
        """Event log of the reports: one event per line item."""
        n, flag = F.col("l_linenumber"), F.col("l_returnflag")
        name = (
            F.when(n == 1, "report_requested")
            .when(n == 2, "first_sample_data_source_linked_to_report")
            .when(n == 3, "report_transitioned_to_awaiting_review")
            .when((n == 4) & (flag == "A"), "report_result_updated")
            .when((n == 4) & (flag == "N"), "report_marked_redraw")
            .when(n == 4, "report_generated")
            .when((n == 5) & (flag == "A"), "report_electronically_signed_and_approved")
            .when((n == 5) & (flag == "N"), "report_review_approved")
            .when(n == 5, "report_cancelled")
            .when((n == 6) & (flag == "A"), "report_sent")
            .when((n == 6) & (flag == "N"), "report_sent_to_patient")
            .when(n == 6, "report_rolled_back_to_awaiting_results")
            .otherwise("kit_received")
        )
        return self.raw("lineitem").select(
            self._line_id().alias("id"),
            F.col("l_orderkey").alias("report_id"),
            F.col("l_orderkey").alias("kit_id"),
            F.col("l_suppkey").alias("user_id"),
            name.alias("event_type"),
            _plus_seconds("l_shipdate", F.col("l_partkey") * 37).alias("created_at"),
        )

    @cached_property
    def event_log(self) -> DataFrame:
        """The activity log, with the stream's own event names."""
        kit = F.get_json_object("props", "$.k").cast("bigint")
        return self.raw("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("report_id"),
            kit.alias("kit_id"),
            kit.alias("user_id"),
            F.col("event_type"),
            F.col("ts").alias("created_at"),
            "value",
        )

    @cached_property
    def lab_events(self) -> DataFrame:
        """The activity log with laboratory event names, chosen by the stream's event type and value band."""
        kind, value = F.col("event_type"), F.col("value")
        bands = {
            "signup": ("first_sample_data_source_linked_to_report", "kit_received", "kit_accessioning_complete"),
            "view": ("report_transitioned_to_awaiting_review", "kit_data_review_complete", "report_generated"),
            "click": ("report_result_updated", "scan_assigned_to_kit", "scan_created"),
            "purchase": ("report_sent", "report_electronically_signed_and_approved", "report_sent_to_patient"),
            "error": ("report_marked_redraw", "report_cancelled", "report_rolled_back_to_awaiting_results"),
        }
        name = None
        for raw, (low, mid, high) in bands.items():
            banded = F.when(value < 20, low).when(value < 60, mid).otherwise(high)
            name = (F if name is None else name).when(kind == raw, banded)
        return self.event_log.withColumn("event_type", name)

    @cached_property
    def event_kits(self) -> DataFrame:
        """Kits of the activity log; a kit was received at its first event."""
        return self.event_log.groupBy(F.col("kit_id").alias("id")).agg(F.min("created_at").alias("received_at"))

    @cached_property
    def staff(self) -> DataFrame:
        """Customers as staff; those of one market segment have ids that no log mentions, so some users stay unknown."""
        key = _aside("MACHINERY")
        return self.raw("customer").select(
            key.alias("id"),
            key.alias("user_id"),
            F.when(F.col("c_acctbal") >= 0, F.split_part("c_name", F.lit("#"), F.lit(1))).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        )

    @cached_property
    def tickets(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            _case(
                "o_orderpriority",
                {
                    "1-URGENT": "Critical Missing Information",
                    "2-HIGH": "Missing Information",
                    "3-MEDIUM": "Redraw",
                    "4-NOT SPECIFIED": "Other Error",
                },
                "Billing",
            ).alias("category"),
            _plus_seconds("o_orderdate", F.floor("o_totalprice")).alias("created_at"),
        )

    @cached_property
    def scans(self) -> DataFrame:
        return self.raw("lineitem").select(
            self._line_id().alias("id"),
            F.col("l_linenumber").alias("page"),
            F.col("l_suppkey").alias("distributor_user_id"),
            F.when(F.col("l_returnflag") != "R", F.lit("page.pdf")).alias("file_name"),
            _plus_seconds("l_shipdate", F.floor("l_extendedprice")).alias("created_at"),
        )

    @cached_property
    def clinics(self) -> DataFrame:
        key = F.col("s_suppkey")
        phone = F.concat(F.lit("201-555-"), F.lpad(F.pmod(key, F.lit(10_000)).cast("string"), 4, "0"), F.lit(",ext 1"))
        return self.raw("supplier").select(
            key.alias("id"),
            F.concat(F.col("s_name"), F.lit("/Site "), F.col("s_nationkey").cast("string")).alias("name"),
            F.col("s_nationkey").alias("distributor_id"),
            F.when(F.pmod(key, F.lit(3)) != 0, F.lit(1_000_000_000) + key * 2 + 1).alias("main_location_id"),
            F.when(F.col("s_acctbal") >= 2000, phone).alias("phone"),
        )

    @cached_property
    def distributors(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            key.alias("id"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("parent_distributor_id"),
            F.when(key % 2 == 1, F.concat(F.lit("99D"), F.lpad(key.cast("string"), 7, "0"))).alias("clia_number"),
        )

    @cached_property
    def report_types(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_type", "p_name").alias("name")
        )

    @cached_property
    def patient_users(self) -> DataFrame:
        key = F.col("c_custkey")
        text = F.lpad(F.pmod(key * 7919 + 12_345, F.lit(10_000_000)).cast("string"), 7, "2")
        phone = F.when(F.col("c_acctbal") >= 1000, F.concat(F.lit("201"), text, F.lit(",home")))
        return self.raw("customer").select(
            key.alias("id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.date_add(F.lit("1940-01-01").cast("date"), F.pmod(key * 37, F.lit(25_000)).cast("int")).alias("birth_date"),
            _case("c_mktsegment", {"MACHINERY": "male", "BUILDING": "female", "FURNITURE": "other"}).alias("gender"),
            phone.alias("phone"),
            key.alias("practitioner_id"),
        )

    @cached_property
    def practitioners(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.lit("MD").alias("title"),
            F.lpad(F.col("s_suppkey").cast("string"), 10, "1").alias("npi"),
        )

    @cached_property
    def locations(self) -> DataFrame:
        """Patient homes (a second one for some patients) and clinic sites (a blank one for some clinics)."""
        nation = self.raw("nation").select(F.col("n_nationkey"), F.col("n_name").alias("state"))
        homes = self.raw("customer").select(
            "*",
            F.explode(
                F.when(F.col("c_acctbal") > 5000, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            ).alias("nth"),
        )
        homes = homes.join(nation, F.pmod(F.col("c_nationkey") + F.col("nth"), F.lit(25)) == F.col("n_nationkey")).select(
            (F.col("c_custkey") * 4 + F.col("nth")).alias("id"),
            F.col("c_custkey").alias("patient_user_id"),
            F.lit(None).cast("bigint").alias("clinic_id"),
            F.concat(F.col("c_custkey").cast("string"), F.lit(" Home Street")).alias("address_1"),
            F.when(F.col("nth") == 1, F.lit("Unit 2")).alias("address_2"),
            F.col("c_mktsegment").alias("city"),
            "state",
            F.col("c_custkey").cast("string").alias("zip"),
            F.when(F.col("c_nationkey") < 10, "US").when(F.col("c_nationkey") < 20, "USA").otherwise("CA").alias("country"),
        )
        sites = self.raw("supplier").select(
            "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("nth")
        ).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        blank = F.col("s_acctbal") > 8000
        sites = sites.select(
            (F.lit(1_000_000_000) + F.col("s_suppkey") * 2 + F.col("nth")).alias("id"),
            F.lit(None).cast("bigint").alias("patient_user_id"),
            F.col("s_suppkey").alias("clinic_id"),
            F.when(~blank, F.concat(F.col("s_suppkey").cast("string"), F.lit(" Clinic Way"))).alias("address_1"),
            F.when(~blank & (F.col("nth") == 1), F.lit("Floor 1")).alias("address_2"),
            F.lit("Clinicville").alias("city"),
            "state",
            F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("zip"),
            F.lit("US").alias("country"),
        )
        return homes.unionByName(sites)

    @cached_property
    def ethnicities(self) -> DataFrame:
        names = {"AFRICA": "African", "AMERICA": "Latin American", "ASIA": "East Asian", "EUROPE": "European"}
        return self.raw("region").select(
            F.col("r_regionkey").alias("id"), _case("r_name", names).alias("name")
        )

    @cached_property
    def ethnicities_patient_users(self) -> DataFrame:
        """A patient's own region, and a second one for some patients; rows of one segment fit no patient."""
        own = F.pmod("c_nationkey", F.lit(5))
        both = F.when(F.col("c_acctbal") < 0, F.array(own, F.lit(3))).otherwise(F.array(own))
        return self.raw("customer").select(_aside("HOUSEHOLD").alias("patient_user_id"), F.explode(both).alias("ethnicity_id"))

    @cached_property
    def export_tables(self) -> ExportTables:
        return ExportTables(
            reports=self.reports,
            distributors=self.distributors,
            clinics=self.clinics,
            locations=self.locations,
            report_types=self.report_types,
            samples=self.samples,
            sample_data_sources=self.sample_data_sources,
            patient_users=self.patient_users,
            ethnicities=self.ethnicities,
            ethnicities_patient_users=self.ethnicities_patient_users,
            practitioners=self.practitioners,
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """Marks of an earlier run: urgent orders are already reported; one mark lost its report id."""
        urgent = self.raw("orders").where(F.col("o_orderpriority") == "1-URGENT")
        return urgent.select(
            F.when(F.col("o_orderkey") > 0, F.col("o_orderkey")).alias("report_id"),
            F.lit("report_marked_state_reported").alias("event_type"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def trackers(self) -> DataFrame:
        """Tracker records: every line of a document is one tracking step."""
        lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0)
        when = lambda x, i: F.concat(
            F.lit("2024-01-"), F.lpad((F.pmod(i, F.lit(28)) + 1).cast("string"), 2, "0"), F.lit("T08:30:00Z")
        )
        steps = F.transform(
            lines,
            lambda x, i: F.struct(
                when(x, i).alias("datetime"),
                F.struct(F.split_part(x, F.lit(" "), F.lit(1)).alias("city"), F.length(x).cast("string").alias("state")).alias(
                    "tracking_location"
                ),
            ),
        )
        key = F.col("doc_id").cast("string")
        number = (
            F.when(F.col("lang") == "de", F.concat(F.lit("`"), key))
            .when(F.col("lang") == "fr", F.concat(F.lit("8"), F.lpad(key, 11, "0")))
            .when(F.col("lang") == "es", F.lit("N/A"))
            .otherwise(F.lpad(key, 12, "7"))
        )
        detail = F.struct(
            F.col("source").alias("origin_location"),
            F.col("lang").alias("destination_location"),
            F.lit(None).cast("string").alias("initial_delivery_attempt"),
        )
        return self.raw("documents").select(
            F.concat(F.lit("trk_"), key).alias("id"),
            F.lit("carrier").alias("carrier"),
            F.when(F.col("n_chars") % 2 == 0, "delivered").otherwise("in_transit").alias("status"),
            F.col("source").alias("status_detail"),
            F.lit("2024-01-01T00:00:00Z").alias("created_at"),
            F.lit(None).cast("string").alias("est_delivery_date"),
            F.concat(F.lit("https://track.example/"), key).alias("public_url"),
            F.lit(None).cast("string").alias("signed_by"),
            number.alias("tracking_code"),
            F.lit("2024-01-02T00:00:00Z").alias("updated_at"),
            F.col("n_chars").cast("double").alias("weight"),
            F.when(F.col("source") != "src7", detail).alias("carrier_detail"),
            F.when(F.col("source") != "src3", steps).otherwise(F.array().cast(steps_type())).alias("tracking_details"),
        )


def _aside(segment: str):
    """Customer numbers, negative in one market segment."""
    key = F.col("c_custkey")
    return F.when(F.col("c_mktsegment") == segment, -key).otherwise(key)


def steps_type() -> str:
    return "array<struct<datetime:string,tracking_location:struct<city:string,state:string>>>"
