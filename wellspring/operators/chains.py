"""Dependency chains: path enumeration over the edge table and the wide reports on it."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X
from wellspring.operators.deps import raw_of_external
from wellspring.operators.joins import left_join
from wellspring.operators.paths import Walk
from wellspring.session import materialize

# Lengths that are known from the enumeration, so that wide reports need not read all paths for them.
_LONGEST: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def chain_id(path: Column) -> Column:
    """Identifier that depends on the path only, hence stable between runs and partitions."""
    return F.md5(F.array_join(path, ">"))


def warehouse_chains(
    pairs: DataFrame,
    edges: DataFrame,
    dwh_tables: DataFrame | list[str] | None = None,
    max_depth: int | None = None,
    through: str | None = None,
) -> DataFrame:
    """``chain_id, dwh_table, lake_table, path``: chains of every (warehouse, lake) pair.

    The pair itself is always a chain. Longer chains end at a table without dependencies; a branch
    that comes back to one of its own lake tables is dropped. ``dwh_tables`` (a list, or a
    DataFrame with ``dwh_table``) restricts the anchors, so other tables are never expanded.
    ``through`` asks for the chains that pass a lake table: anchors that cannot reach it are left
    out, and so are branches that lead elsewhere before it. ``max_depth`` guards against runaway
    graphs by failing, not by cutting results.
    """
    pairs = pairs.select("dwh_table", "lake_table").distinct()
    if isinstance(dwh_tables, DataFrame):
        pairs = pairs.join(dwh_tables.select("dwh_table").distinct(), "dwh_table", "left_semi")
    elif dwh_tables is not None:
        pairs = pairs.where(F.col("dwh_table").isin(dwh_tables))
    walk = Walk(edges, own_from=2, through=through, max_depth=max_depth)
    if through is not None:
        pairs = pairs.join(walk.near.select(F.col("dep").alias("lake_table")), "lake_table", "left_semi")
    pairs = materialize(pairs.select(F.array("dwh_table", "lake_table").alias("path")))
    longer = walk.paths(pairs).where(F.size("path") > 2).select("path")
    if through is not None:
        pairs = pairs.where(F.col("path")[1] == through)
    found = pairs.unionByName(longer).select(
        chain_id(F.col("path")).alias("chain_id"),
        F.col("path")[0].alias("dwh_table"),
        F.col("path")[1].alias("lake_table"),
        "path",
    )
    if walk.longest > 2:
        _LONGEST[found] = walk.longest
    return found


def lake_chains(
    edges: DataFrame,
    targets: DataFrame,
    tables: DataFrame | list[str] | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """``chain_id, root, path, is_cycle``: chains from map tables, cycles kept.

    ``targets`` holds all tables of the map. ``tables`` (a list, or a DataFrame with ``table``)
    picks the roots; a table outside the map gives no chain.
    """
    roots = targets.select(F.col("target").alias("root")).distinct()
    if isinstance(tables, DataFrame):
        asked = tables.select(F.col("table").alias("root")).distinct()
        roots = roots.join(asked, "root", "left_semi")
    elif tables is not None:
        roots = roots.where(F.col("root").isin(tables))
    anchors = roots.select(F.array("root").alias("path"))
    walk = Walk(edges, keep_cycles=True, max_depth=max_depth)
    found = walk.paths(anchors).select(
        chain_id(F.col("path")).alias("chain_id"), F.col("path")[0].alias("root"), "path", "is_cycle"
    )
    _LONGEST[found] = walk.longest
    return found


def display_path(path: Column, is_cycle: Column) -> Column:
    """Path with the closing table of a cycle labelled as such."""
    last = X.cycle_label(F.element_at(path, -1))
    body = F.slice(path, 1, F.size(path) - 1)
    return F.when(is_cycle, F.array_append(body, last)).otherwise(path)


def with_raw(chains: DataFrame, attrs: DataFrame, wins: str = "last") -> DataFrame:
    """Adds ``raw_path, tt_dir`` of the external table a chain ends at."""
    raw = raw_of_external(attrs, wins).select(
        F.col("cdr_name").alias("chain_end"),
        F.col("raw_directory").alias("raw_path"),
        F.col("tt_directory").alias("tt_dir"),
    )
    end = F.element_at("path", -1)
    if "is_cycle" in chains.columns:
        end = F.when(~F.col("is_cycle"), end)
    return chains.withColumn("chain_end", end).join(raw, "chain_end", "left").drop("chain_end")


def longest(chains: DataFrame) -> int:
    """Number of tables in the longest path."""
    if chains in _LONGEST:
        return _LONGEST[chains]
    return chains.select(F.max(F.size("path"))).first()[0] or 0


def widen(
    rows: DataFrame, path: Column, width: int, first: list[str], rest: str, extra: list[str]
) -> DataFrame:
    """One column per path position plus ``extra`` columns.

    ``first`` names the leading positions, the others are ``rest`` numbered from 1. Enumerated
    paths are distinct, and so are the rows as long as ``extra`` adds no duplicates: the widest
    table of all is not shuffled just to find none.
    """
    names = first + [f"{rest}{i + 1}" for i in range(max(width - len(first), 0))]
    cells = [F.try_element_at(path, F.lit(i + 1)).alias(name) for i, name in enumerate(names)]
    return rows.select(*cells, *extra)


def wide_chain_report(chains: DataFrame, attrs: DataFrame) -> DataFrame:
    """Warehouse chains with raw and tt directories, one column per table."""
    named = with_raw(chains, attrs).withColumnsRenamed({"raw_path": "Raw_Path", "tt_dir": "it"})
    first = [P.DWH_COLUMN, P.LAKE_COLUMN]
    return widen(
        named, F.col("path"), longest(chains), first, P.DEPENDENCY_PREFIX, ["Raw_Path", "it"]
    )


def wide_lake_report(
    chains: DataFrame, attrs: DataFrame | None = None, rest: str = P.DEPENDENCY_PREFIX
) -> DataFrame:
    """Lake chains, one column per table; with ``attrs`` also the raw path (first seen wins)."""
    rows = chains if attrs is None else with_raw(chains, attrs, "first")
    path = display_path(F.col("path"), F.col("is_cycle"))
    extra = [] if attrs is None else ["raw_path"]
    return widen(rows, path, longest(chains), ["Table_Principale"], rest, extra)


def chain_steps(chains: DataFrame, table_scripts: DataFrame) -> DataFrame:
    """``chain_id, dwh_table, lake_table, position, table, script_path``.

    Position 0 is the warehouse table and has no script; a step without scripts keeps a NULL.
    """
    steps = chains.select(
        "chain_id", "dwh_table", "lake_table", F.posexplode("path").alias("position", "table")
    ).where(F.col("position") > 0)
    scripts = table_scripts.select("table", F.col("path").alias("script_path"))
    return left_join(steps, scripts, "table").select(
        "chain_id", "dwh_table", "lake_table", "position", "table", "script_path"
    )
