"""CRM objects, from landed API pages to flat tables that are replaced together."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.functions import nested
from labtide.operators import columns, dedup
from labtide.session import scratch_dir
from labtide.sources import writers
from labtide.sources.versions import VersionedTable

# Object tables that are refreshed together, and the association each one keeps.
OBJECTS = ["companies", "products", "deals", "line_items"]
ASSOCIATION = {"line_items": ("deals", "dealid"), "deals": ("companies", "companyid")}

ASKED, NEXT = "asked", "paging.next.after"
FAULTS = "cursor string, fault string"


class IncompletePages(ValueError):
    """The landed pages of an object kind do not make up one whole chain."""


def flatten_objects(objects: DataFrame, kind: str) -> DataFrame:
    """``id``, the object's properties and, for deals and line items, the first associated id."""
    wanted = ASSOCIATION.get(kind)
    out = objects
    if wanted and "associations" in objects.columns:
        group, name = wanted
        out = out.withColumn(name, nested.association_id(F.col(f"associations.{group}.results")))
    return columns.flatten(out.drop("associations"), "properties")


def page_links(pages: DataFrame) -> DataFrame:
    """(cursor, next, print) of the landed pages, once each: the cursor a page was asked with, null for the first one."""
    content = F.xxhash64(F.to_json(F.struct("results", F.col(NEXT).alias("next"))))
    return pages.select(F.col(ASKED).alias("cursor"), F.col(NEXT).alias("next"), content.alias("print")).distinct()


def page_faults(pages: DataFrame) -> DataFrame:
    """What keeps landed pages from being one whole chain: (cursor, fault), without rows if they are.

    ``repeated``: pages of one cursor that differ. ``missing``: a page that another one leads to is not there.
    ``unasked``: no page leads to this one. ``no first page``: none was asked without a cursor. ``joined``: several
    pages lead to this one. ``loop``: pages that lead to each other and are not reached from the first. The same page landed
    twice is no fault.
    """
    return chain_faults({"": pages}).select("cursor", "fault")


def chain_faults(landed: Mapping[str, DataFrame]) -> DataFrame:
    """``page_faults`` of every kind: (kind, cursor, fault). The chains of all kinds are checked, and walked, together."""
    spark = next(iter(landed.values())).sparkSession
    tagged = [page_links(pages).withColumn("kind", F.lit(kind)) for kind, pages in landed.items()]
    links = writers.kept(functools.reduce(DataFrame.unionByName, tagged), scratch_dir(spark, "pages"))
    named = links.where(F.col("cursor").isNotNull())
    leads = links.where(F.col("next").isNotNull()).select("kind", F.col("next").alias("to"))
    per_cursor = links.groupBy("kind", "cursor").count().where("count > 1")
    per_target = leads.groupBy("kind", "to").count().where("count > 1")
    targets = leads.withColumnRenamed("to", "cursor")

    def found(rows: DataFrame, column: str, fault: str) -> DataFrame:
        return rows.select("kind", F.col(column).alias("cursor"), F.lit(fault).alias("fault"))

    first = links.groupBy("kind").agg(F.count_if(F.col("cursor").isNull()).alias("firsts"))
    out = found(per_cursor, "cursor", "repeated")
    out = out.unionAll(found(targets.join(named, ["kind", "cursor"], "left_anti").distinct(), "cursor", "missing"))
    out = out.unionAll(found(named.join(targets, ["kind", "cursor"], "left_anti").select("kind", "cursor").distinct(), "cursor", "unasked"))
    out = out.unionAll(found(per_target, "to", "joined"))
    none = first.where("firsts = 0").select("kind", F.lit(None).cast("string").alias("cursor"), F.lit("no first page").alias("fault"))
    out = writers.kept(out.unionAll(none), scratch_dir(spark, "page-faults"))
    if not out.isEmpty():
        return out
    return found(_in_loops(named, links), "cursor", "loop")


def _in_loops(named: DataFrame, links: DataFrame) -> DataFrame:
    """Cursors that no way back leads from to the first page of their kind, where every page is led to once.

    Each page looks back along its chain, twice as far in every round, so chains of n pages take about log2(n) joins.
    """
    spark = named.sparkSession
    back = links.where(F.col("next").isNotNull()).select("kind", F.col("next").alias("cursor"), F.col("cursor").alias("before"))
    pages, reach = named.groupBy("kind").count().agg(F.max("count")).first()[0] or 0, 1
    now = writers.kept(back.where(F.col("before").isNotNull()), scratch_dir(spark, "back"))
    while reach <= pages:
        further = now.select("kind", F.col("cursor").alias("before"), F.col("before").alias("earlier"))
        now = now.join(further, ["kind", "before"]).select("kind", "cursor", F.col("earlier").alias("before"))
        now, reach = writers.kept(now, scratch_dir(spark, "back")), 2 * reach
    return now.select("kind", "cursor").distinct()


def refresh_objects(landed: Mapping[str, DataFrame], base: str) -> dict[str, VersionedTable]:
    """Replace the object tables by the landed pages of all kinds.

    Every kind's pages are checked first, all in one walk; if one has a fault, no table is replaced and the error names kind and faults. An
    object that two pages show counts once. Readers keep the version they have.
    """
    faults: dict[str, list[str]] = {}
    for r in chain_faults(landed).limit(5).collect():
        faults.setdefault(r.kind, []).append(f"{r.fault} {r.cursor or ''}".strip())
    if faults:
        raise IncompletePages("; ".join(f"{kind}: {', '.join(found)}" for kind, found in faults.items()))
    tables = {}
    for kind, pages in landed.items():
        objects = flatten_objects(nested.explode_results(pages), kind)
        whole = F.xxhash64(*objects.columns)
        tables[kind] = VersionedTable(objects.sparkSession, f"{base.rstrip('/')}/{kind}", "id", [])
        tables[kind].replace(dedup.top_per_key(objects, ["id"], [whole]))
    return tables


def deal_pipelines(objects: DataFrame) -> DataFrame:
    return objects.drop("stages")


def stages_of(objects: DataFrame, label: str) -> DataFrame:
    """Stages of the pipeline with the given label, by joining on the row instead of fetching its id."""
    chosen = objects.where(F.col("label") == label).select(F.col("id").alias("pipeline_id"), F.explode("stages").alias("stage"))
    return chosen.select("pipeline_id", "stage.*")
