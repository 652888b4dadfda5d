"""Questions on the wide dependency report: dependencies, users, origins, server metadata.

Results are long tables (one row per fact), so a table that occurs in a third of all report rows
never becomes one big list; every aggregate here combines partially before its shuffle.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X
from wellspring.operators.joins import left_join
from wellspring.session import materialize


def _filled(name: str) -> Column:
    """A cell, NULL when it is blank."""
    return F.when(X.strip(F.col(name)) != "", F.col(name))


def table_columns(report: DataFrame) -> list[str]:
    """Table columns in logical order: warehouse, lake, then dependencies as they come."""
    lead = [c for c in (P.DWH_COLUMN, P.LAKE_COLUMN) if c in report.columns]
    return lead + [c for c in report.columns if c.startswith(P.DEPENDENCY_PREFIX)]


def rows_with(report: DataFrame, table: str) -> DataFrame:
    """Rows that name ``table`` in any table column, whatever its casing."""
    hits = [F.lower(F.col(c)) == table.lower() for c in table_columns(report)]
    return report.where(reduce(Column.__or__, hits, F.lit(False)))


def report_long(report: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``row_id, col_name, table_name``: one row per table cell that is filled."""
    cells = table_columns(report)
    filled = report.select(row_id, *[_filled(c).alias(c) for c in cells])
    return filled.unpivot(row_id, cells, "col_name", "table_name").where("table_name IS NOT NULL")


def cooccurrence(report: DataFrame) -> DataFrame:
    """Distinct ``src, dep``: each table of a row with every later one, lower case.

    A row stands for its suffixes, one for each cell, and each distinct suffix gives the pairs of its
    first cell. Rows are chains, so many end alike: what they share is expanded once. Expressions
    grow with the number of columns, not with that of column pairs.
    """
    cells = [F.lower(_filled(c)) for c in table_columns(report)]
    named = report.select(F.array_compact(F.array(*cells)).alias("cells"))
    starts = F.sequence(F.lit(1), F.size("cells") - 1)
    suffixes = F.transform(starts, lambda i: F.slice("cells", i, F.size("cells")))
    folded = named.where(F.size("cells") > 1).select(F.explode(suffixes).alias("cells")).distinct()
    later = F.slice("cells", F.lit(2), F.size("cells"))
    return folded.select(F.col("cells")[0].alias("src"), F.explode(later).alias("dep")).distinct()


def _only(rows: DataFrame, name: Column, tables: DataFrame | None) -> DataFrame:
    """Rows whose lower-case name is in ``tables`` (``table``), or all rows."""
    return rows if tables is None else rows.join(tables, name == F.col("table"), "left_semi")


def original_names(
    report: DataFrame, row_id: str = "row_id", tables: DataFrame | None = None
) -> DataFrame:
    """``table, name``: the casing seen last for every lower-case name, or for those in ``tables``."""
    cells = table_columns(report)
    rank = F.element_at(F.create_map(*[F.lit(x) for n, c in enumerate(cells) for x in (c, n)]), F.col("col_name"))
    return (
        _only(report_long(report, row_id), F.lower("table_name"), tables)
        .groupBy(F.lower("table_name").alias("table"))
        .agg(F.max_by("table_name", F.struct(row_id, rank)).alias("name"))
    )


def origins(report: DataFrame) -> DataFrame:
    """Distinct ``table, origin``: the report columns a table occurs in."""
    cells = table_columns(report)
    lower = report.select(*[F.lower(_filled(c)).alias(c) for c in cells])
    return lower.unpivot([], cells, "origin", "table").where("table IS NOT NULL").select(
        "table", "origin"
    ).distinct()


def server_metadata(report: DataFrame) -> DataFrame:
    """Distinct ``table, attribute, value``: server metadata of the rows a table occurs in."""
    cells = table_columns(report)
    meta = [c for c in P.SERVER_COLUMNS if c in report.columns]
    filled = report.select(
        *[F.lower(_filled(c)).alias(c) for c in cells], *[_filled(c).alias(c) for c in meta]
    )
    tables = filled.unpivot(meta, cells, "origin", "table").where("table IS NOT NULL")
    facts = tables.unpivot("table", meta, "attribute", "value").where("value IS NOT NULL")
    return facts.select("table", "attribute", "value").distinct()


def priorities(report: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """``table, priority, tag``: logical order and short origin of every table.

    1 warehouse, 2 lake, 3 dependency; a table with several origins gets the first that applies.
    """
    known = origins(report)
    return _ranked(known if tables is None else known.join(tables, "table", "left_semi"))


def _ranked(origins: DataFrame) -> DataFrame:
    rank = (
        F.when(F.col("origin") == P.DWH_COLUMN, 1)
        .when(F.col("origin") == P.LAKE_COLUMN, 2)
        .when(F.contains("origin", F.lit(P.DEPENDENCY_PREFIX)), 3)
        .otherwise(4)
    )
    priority = F.col("priority")
    return (
        origins.groupBy("table")
        .agg(F.min(rank).alias("priority"))
        .withColumn(
            "tag",
            F.when(priority == 1, "RDMS")
            .when(priority == 2, "Hive")
            .when(priority == 3, "Datalake")
            .otherwise(""),
        )
    )


def table_nodes(
    report: DataFrame, row_id: str = "row_id", tables: DataFrame | None = None
) -> DataFrame:
    """``table, name, priority, tag``: every table, or those in ``tables``, with display name and
    logical order."""
    return original_names(report, row_id, tables).join(priorities(report, tables), "table")


def _neighbours(edges: DataFrame, *sides: str) -> DataFrame:
    """``table``: distinct names on the given sides of edges."""
    return edges.select(F.explode(F.array(*sides)).alias("table")).distinct()


def dependencies(report: DataFrame, row_id: str = "row_id", table: str | None = None) -> DataFrame:
    """``table, dep, dep_name, priority, tag``: direct dependencies of all tables, or of one.

    For one table only the rows that name it are stacked, and only its neighbours are named.
    """
    if table is None:
        return _named(cooccurrence(report), table_nodes(report, row_id), "src", "dep")
    edges = materialize(cooccurrence(rows_with(report, table)).where(F.col("src") == table.lower()))
    return _named(edges, table_nodes(report, row_id, _neighbours(edges, "dep")), "src", "dep")


def users(report: DataFrame, row_id: str = "row_id", table: str | None = None) -> DataFrame:
    """``table, user, user_name, priority, tag``: tables that use a table; see ``dependencies``."""
    if table is None:
        edges, names = cooccurrence(report), None
    else:
        edges = materialize(cooccurrence(rows_with(report, table)).where(F.col("dep") == table.lower()))
        names = _neighbours(edges, "src")
    return _named(
        edges.withColumnRenamed("src", "user"), table_nodes(report, row_id, names), "dep", "user"
    )


def _named(edges: DataFrame, nodes: DataFrame, of: str, other: str) -> DataFrame:
    """Edges as ``table`` and its neighbour with display name and logical order."""
    named = nodes.select(
        F.col("table").alias(other), F.col("name").alias(f"{other}_name"), "priority", "tag"
    )
    sides = edges.select(F.col(of).alias("table"), other)
    return sides.join(named, other).select("table", other, f"{other}_name", "priority", "tag")


def in_logical_order(rows: DataFrame, name: str) -> DataFrame:
    """Rows by table, then warehouse before lake before dependencies, then name."""
    return rows.orderBy("table", "priority", name)


def degrees(report: DataFrame) -> DataFrame:
    """``table, nb_dependencies, nb_users`` of every table, from one pass over the edges."""
    sides = cooccurrence(report).select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("table"), F.lit(1).alias("d"), F.lit(0).alias("u")),
                F.struct(F.col("dep").alias("table"), F.lit(0).alias("d"), F.lit(1).alias("u")),
            )
        )
    )
    counts = sides.groupBy("table").agg(
        F.sum("d").alias("nb_dependencies"), F.sum("u").alias("nb_users")
    )
    names = origins(report).select("table").distinct()
    return names.join(counts, "table", "left").na.fill(0, ["nb_dependencies", "nb_users"])


def facts(report: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``table, kind, attribute, item, seen``: all that the report says of each table, from one scan
    and one aggregate. ``kind`` is name (as written), origin (a column), meta or dep (a later table of
    the row); ``seen`` is the last row and column it comes from."""
    cells = table_columns(report)
    meta = [c for c in P.SERVER_COLUMNS if c in report.columns]

    def fact(table: Column, kind: str, item: Column, attribute: Column | None = None, ord: Column | None = None):
        return F.struct(
            table.alias("table"),
            F.lit(kind).alias("kind"),
            (F.lit("") if attribute is None else attribute).alias("attribute"),
            item.alias("item"),
            (F.lit(0) if ord is None else ord).alias("ord"),
        )

    def cell(number: int, name: str) -> Column:
        filled = _filled(name)
        parts = {"table": F.lower(filled), "name": filled, "origin": F.lit(name), "ord": F.lit(number)}
        return F.when(filled.isNotNull(), F.struct(*[v.alias(k) for k, v in parts.items()]))

    def of_cell(c: Column, i: Column) -> Column:
        later = F.slice("cells", i + 2, F.size("cells"))
        return F.concat(
            F.array(
                fact(c["table"], "name", c["name"], ord=c["ord"]), fact(c["table"], "origin", c["origin"])
            ),
            F.transform("meta", lambda m: fact(c["table"], "meta", m["value"], m["attribute"])),
            F.transform(later, lambda d: fact(c["table"], "dep", d["table"])),
        )

    value = lambda c: F.struct(F.lit(c).alias("attribute"), _filled(c).alias("value"))
    none = F.array().cast("array<struct<attribute:string,value:string>>")
    shown = F.array(*[F.when(_filled(c).isNotNull(), value(c)) for c in meta]) if meta else none
    rows = report.select(
        F.col(row_id).alias("row"),
        F.array_compact(F.array(*[cell(n, c) for n, c in enumerate(cells)])).alias("cells"),
        F.array_compact(shown).alias("meta"),
    )
    told = rows.select("row", F.inline(F.flatten(F.transform("cells", of_cell))))
    return told.groupBy("table", "kind", "attribute", "item").agg(F.max(F.struct("row", "ord")).alias("seen"))


def _nodes_of(known: DataFrame) -> DataFrame:
    """``table_nodes`` from ``facts``."""
    names = known.where("kind = 'name'").groupBy("table").agg(F.max_by("item", "seen").alias("name"))
    origins = known.where("kind = 'origin'").select("table", F.col("item").alias("origin"))
    return names.join(_ranked(origins), "table")


def diagnostic(report: DataFrame, row_id: str = "row_id", table: str | None = None) -> DataFrame:
    """``table, section, item, tag``: origins, dependencies, users and metadata as one table.

    All sections come from the same facts, which are written once. For one table only the rows that
    name it are read beyond the names of its neighbours.
    """
    known = facts(report if table is None else rows_with(report, table), row_id)
    if table is not None:
        name = table.lower()
        known = known.where((F.col("table") == name) | ((F.col("kind") == "dep") & (F.col("item") == name)))
    known = materialize(known)
    edges = known.where("kind = 'dep'").select(F.col("table").alias("src"), F.col("item").alias("dep"))
    if table is None:
        nodes = materialize(_nodes_of(known))
    else:
        nodes = materialize(table_nodes(report, row_id, _neighbours(edges, "src", "dep")))
    blank = F.lit("").alias("tag")

    def section(rows: DataFrame, name: Column, item: str, tag: Column | str) -> DataFrame:
        return rows.select("table", name.alias("section"), F.col(item).alias("item"), tag)

    used = edges.withColumnRenamed("src", "user")
    rows = (
        section(known.where("kind = 'origin'"), F.lit("origin"), "item", blank)
        .unionByName(section(known.where("kind = 'meta'"), F.col("attribute"), "item", blank))
        .unionByName(section(_named(edges, nodes, "src", "dep"), F.lit("dependency"), "dep_name", "tag"))
        .unionByName(section(_named(used, nodes, "dep", "user"), F.lit("user"), "user_name", "tag"))
    )
    return rows if table is None else rows.where(F.col("table") == table.lower())


def dwh_tables(report: DataFrame) -> DataFrame:
    """Distinct warehouse tables of the report."""
    return report.select(X.blank_to_null(X.strip(F.col(P.DWH_COLUMN))).alias(P.DWH_COLUMN)).where(F.col(P.DWH_COLUMN).isNotNull()).distinct()


def external_tables(report: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``Table_RDMS, CDR``: external tables behind each warehouse table, blank when there is none.

    External tables are those whose casing seen last starts with ``CDR.``.
    """
    external = original_names(report, row_id).where(F.startswith("name", F.lit(P.EXTERNAL_PREFIX)))
    hits = (
        cooccurrence(report)
        .join(external, F.col("dep") == F.col("table"))
        .select("src", F.col("name").alias("CDR"))
    )
    tables = dwh_tables(report).withColumn("src", F.lower(P.DWH_COLUMN))
    return left_join(tables, hits, "src").select(
        P.DWH_COLUMN, F.coalesce("CDR", F.lit("")).alias("CDR")
    )


def external_totals(pairs: DataFrame) -> DataFrame:
    """``nb_tables, nb_pairs`` of the external-table report."""
    return pairs.agg(
        F.count_distinct(P.DWH_COLUMN).alias("nb_tables"), F.count("*").alias("nb_pairs")
    )


def parse_table_name(text: str) -> str | None:
    """The ``schema.table`` in typed-in text, lower case; None if there is none."""
    found = re.search(P.REPORT_NAME, text, re.IGNORECASE)
    return found.group(1).lower() if found else None


def is_known(report: DataFrame, table: str) -> bool:
    """Does any report row name the table, whatever its casing?"""
    return not rows_with(report, table).isEmpty()


def similar_tables(
    report: DataFrame, table: str, row_id: str = "row_id", limit: int = 5
) -> DataFrame:
    """``name, priority``: the first names in logical order that contain an unknown table's schema.

    A known table needs no suggestion and gives no row.
    """
    schema = table.lower().split(".")[0]
    found = table_nodes(report, row_id).where(F.contains("table", F.lit(schema)))
    if is_known(report, table):
        found = found.where(F.lit(False))
    return found.select("name", "priority").orderBy("priority", "name").limit(limit)


def _grams(text: str, size: int | Column) -> Column:
    """Distinct runs of ``size`` characters of a text, none if it is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(
        F.length(text) >= size,
        F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text), i, size))),
    ).otherwise(F.array().cast("array<string>"))


def suggestions(
    report: DataFrame, asked: DataFrame, row_id: str = "row_id", limit: int = 5
) -> DataFrame:
    """``asked, name, priority``: ``similar_tables`` for all names in ``asked`` at once.

    Names are indexed by their runs of up to three characters. A schema is looked up by its rarest
    run, and what is found there is compared with the whole schema. Names of one schema share one
    answer, and only the runs of asked schemas are indexed. A name with an empty schema has no row.
    """
    nodes = materialize(table_nodes(report, row_id))
    names = asked.select("asked", F.lower("asked").alias("table")).distinct()
    unknown = names.join(nodes.select("table"), "table", "left_anti").select(
        "asked", F.split_part("table", F.lit("."), F.lit(1)).alias("part")
    )
    unknown = materialize(unknown.where(F.col("part") != ""))
    size = F.least(F.length("part"), F.lit(3))
    runs = materialize(unknown.select("part").distinct().select("part", F.explode(_grams("part", size)).alias("run")))
    own = F.concat(*[_grams("table", n) for n in (1, 2, 3)])
    postings = materialize(
        nodes.withColumn("run", F.explode(own)).join(runs.select("run").distinct(), "run", "left_semi")
    )
    counts = postings.groupBy("run").agg(F.count("*").alias("n"))
    rarest = (
        runs.join(counts, "run", "left")
        .groupBy("part")
        .agg(F.min_by("run", F.struct(F.coalesce("n", F.lit(0)), "run")).alias("run"))
    )
    order = W.partitionBy("part").orderBy("priority", "name")
    first = (
        rarest.join(postings, "run")
        .where(F.contains("table", F.col("part")))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= limit)
    )
    return unknown.join(first, "part").select("asked", "name", "priority")
