"""Lineage tables: object dependencies, grant links, chains, and the snapshot document.

A snapshot of a large catalog does not fit one document, so every part stays a table, and the document is written as
lines: one header, one line per chain, link, dependency list and log entry, and one summary. Long lists have pages.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from itertools import chain as flatten

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv
from clientele.functions.joins import lookup_join

#: Tables on a page of an object's list, about.
PAGE_SIZE = 1000


def dependency_map(edges: DataFrame) -> DataFrame:
    """Each object with each table it refers to, and how many catalog rows say so."""
    return edges.groupBy(
        F.concat_ws(".", "object_owner", "object_name").alias("object_name"),
        F.concat_ws(".", "ref_owner", "ref_name").alias("table_ref"),
    ).agg(F.count(F.lit(1)).alias("edge_count"))


def page_of(ref: Column, pages: Column) -> Column:
    """A page number that depends only on the reference and the number of pages."""
    number = F.conv(F.substring(F.md5(ref), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, pages).cast("int")


def dependency_lists(mapped: DataFrame, page_size: int | None = None) -> DataFrame:
    """The tables that each object refers to, with the number of tables that the object has.

    Without a page size each table is a row of its own. With one the tables of an object are sorted lists: one list up to
    that size, and as many pages as it needs above, so that no list and no task grows with the busiest object. Beside
    ``table_refs`` stand the ``edge_counts`` of its tables, in the same order, and their sum.
    """
    sizes = mapped.groupBy("object_name").agg(F.count(F.lit(1)).alias("table_count"))
    flat = lookup_join(mapped, sizes, "object_name", "inner", spread_by="table_ref")
    if page_size is None:
        return flat
    pages = F.ceil(F.col("table_count") / F.lit(page_size)).cast("bigint")
    listed = flat.groupBy("object_name", page_of(F.col("table_ref"), pages).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("table_ref", "edge_count"))).alias("listed"),
        F.sum("edge_count").alias("edge_count"),
        F.max("table_count").alias("table_count"),
    )
    return listed.select(
        "object_name",
        "page",
        F.col("listed.table_ref").alias("table_refs"),
        F.col("listed.edge_count").cast("array<string>").alias("edge_counts"),
        "edge_count",
        "table_count",
    )


def repository_of(schema: Column, repositories: Mapping[str, str]) -> Column:
    """The repository a schema belongs to, by its upper-case name."""
    if not repositories:
        return F.lit(fv.UNKNOWN_REPOSITORY)
    names = F.create_map(*[F.lit(text) for text in flatten.from_iterable(repositories.items())])
    return F.coalesce(F.try_element_at(names, F.upper(schema)), F.lit(fv.UNKNOWN_REPOSITORY))


def grant_links(grants: DataFrame, repositories: Mapping[str, str]) -> DataFrame:
    """Cross-schema grants as links between repositories."""
    return grants.select(
        repository_of(F.col("source_schema"), repositories).alias("source_repo"),
        "source_schema",
        "source_table",
        repository_of(F.col("target_schema"), repositories).alias("target_repo"),
        "target_schema",
        F.col("privilege").alias("access_type"),
        F.lit(fv.LINK_TYPE).alias("link_type"),
    )


def chain_refs(chains: DataFrame, known: DataFrame) -> DataFrame:
    """Chains with the tables their package refers to: a row for each page of ``known`` lists, or for each ``known`` table.

    The package is known by the first two parts of its name. ``has_table_refs`` says whether it has references. A chain
    whose package has none has one row with an empty list, or no table; one without a package has nulls.
    """
    package = F.substring_index("plsql_package", ".", 2)
    with_package = F.col("plsql_package").isNotNull() & (F.col("plsql_package") != "")
    listed = "table_refs" in known.columns
    refs = ["page", F.col("table_refs").alias("plsql_table_refs")] if listed else [F.col("table_ref").alias("plsql_table_ref")]
    own = known.select(F.col("object_name").alias("package"), *refs)
    found = chains.withColumn("package", package).join(own, "package", "left").drop("package")
    held = F.col("plsql_table_refs" if listed else "plsql_table_ref").isNotNull()
    found = found.withColumn("has_table_refs", F.when(with_package, held))
    if not listed:
        return found
    none = F.array().cast("array<string>")
    return found.withColumns(
        {
            "page": F.coalesce("page", F.lit(0)),
            "plsql_table_refs": F.when(with_package, F.coalesce("plsql_table_refs", none)),
        }
    )


def as_lines(section: str, rows: DataFrame) -> DataFrame:
    document = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(F.lit(section).alias("section"), document.alias("document"))


def lineage_snapshot(
    run_date: dt.date,
    workflow: str,
    generated_at: str,
    chains: DataFrame,
    links: DataFrame,
    mapped: DataFrame,
    log: DataFrame,
    schemas: Sequence[str] = fv.TRACED_SCHEMAS,
    repositories: Mapping[str, str] | None = None,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """The snapshot as JSON lines by section: header, chains, links, dependency lists, log, summary."""
    lists = dependency_lists(mapped, page_size)
    spark = chains.sparkSession
    header = spark.range(1).select(
        F.lit(str(run_date)).alias("run_date"),
        F.lit(workflow).alias("workflow"),
        F.lit(generated_at).alias("generated_at"),
        F.array(*[F.lit(s) for s in schemas]).alias("schema_scope"),
    )
    edge_total = mapped.agg(F.coalesce(F.sum("edge_count"), F.lit(0)).alias("n")).scalar()
    summary = spark.range(1).select(
        chains.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_chains"),
        links.agg(F.count(F.lit(1)).alias("n")).scalar().alias("cross_repo_links"),
        edge_total.alias("plsql_dependencies"),
        F.array(*[F.lit(r) for r in (repositories or {}).values()]).cast("array<string>").alias("repos_involved"),
    )
    sections = (
        ("lineage_chains", chain_refs(chains, lists)),
        ("cross_repo_links", links),
        ("dependency_map", lists.drop("edge_counts", "edge_count", "table_count")),
        ("etl_execution_log", log),
        ("summary", summary),
    )
    lines = as_lines("lineage_snapshot", header)
    for section, rows in sections:
        lines = lines.unionByName(as_lines(section, rows))
    return lines
