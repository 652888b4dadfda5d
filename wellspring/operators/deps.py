"""Table dependencies: edges, target attributes and the scripts behind each table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.operators.joins import left_join

ATTRIBUTES = ["raw_directory", "cdr_name", "tt_directory", "staging_dwh_table"]


def script_refs(conf_jobs: DataFrame) -> DataFrame:
    """``conf_path, kind, ord, script_path`` plus the conf attributes, one row per reference.

    ``kind`` is 0 for exec and 1 for pre-exec scripts, so (conf_path, kind, ord) is the order in
    which references are considered wherever the first or last one wins.
    """

    def tagged(refs: str, kind: int) -> Column:
        return F.transform(
            F.coalesce(refs, F.array().cast("array<string>")),
            lambda path, i: F.struct(F.lit(kind).alias("kind"), i.alias("ord"), path.alias("path")),
        )

    return conf_jobs.select(
        "conf_path",
        F.explode(F.concat(tagged("exec", 0), tagged("pre_exec", 1))).alias("ref"),
        "raw_directory",
        F.col("cdr_tt").alias("cdr_name"),
        "tt_directory",
        F.col("staging_table_dwh").alias("staging_dwh_table"),
    ).select(
        "conf_path", "ref.kind", "ref.ord", F.col("ref.path").alias("script_path"), *ATTRIBUTES
    )


def job_io(conf_jobs: DataFrame, script_io: DataFrame) -> DataFrame:
    """Every script reference with what the script writes and reads; a missing script gives NULLs."""
    refs = script_refs(conf_jobs).select("conf_path", "kind", "ord", "script_path")
    io = script_io.select(F.col("path").alias("script_path"), "target", "sources")
    return refs.join(io, "script_path", "left").select(
        "conf_path", "kind", "ord", "script_path", "target", "sources"
    )


def _first_refs(conf_jobs: DataFrame) -> DataFrame:
    """The first reference to every script.

    Partial aggregation folds a script that a third of all confs run into one row per task before
    anything is shuffled, so the join with the scripts has no hot key.
    """
    order = F.struct("conf_path", "kind", "ord")
    return (
        script_refs(conf_jobs)
        .groupBy("script_path")
        .agg(F.min_by(F.struct(order.alias("seen"), *ATTRIBUTES), order).alias("first"))
    )


def referenced_io(conf_jobs: DataFrame, script_io: DataFrame) -> DataFrame:
    """``target, sources, first``: scripts that some conf runs and that write a table."""
    io = script_io.where(F.col("target").isNotNull()).select(
        F.col("path").alias("script_path"), "target", "sources"
    )
    return io.join(_first_refs(conf_jobs), "script_path").select("target", "sources", "first")


def table_edges(referenced: DataFrame) -> DataFrame:
    """Distinct ``target, dep`` edges over all scripts of a target."""
    return referenced.select("target", F.explode("sources").alias("dep")).distinct()


def table_deps(conf_jobs: DataFrame, script_io: DataFrame) -> DataFrame:
    return table_edges(referenced_io(conf_jobs, script_io))


def attributes_of(referenced: DataFrame) -> DataFrame:
    """``target``, its attributes and ``seen``: the conf that mentions a target first decides."""
    return (
        referenced.groupBy("target")
        .agg(F.min_by("first", "first.seen").alias("first"))
        .select("target", *[f"first.{a}" for a in ATTRIBUTES], "first.seen")
    )


def table_attrs(conf_jobs: DataFrame, script_io: DataFrame) -> DataFrame:
    return attributes_of(referenced_io(conf_jobs, script_io))


def raw_of_external(attrs: DataFrame, wins: str = "last") -> DataFrame:
    """``cdr_name, raw_directory, tt_directory``: one row per external table name.

    Several targets may name the same external table; ``wins`` picks the first or the last seen.
    """
    pick = {"first": F.min_by, "last": F.max_by}[wins]
    return (
        attrs.where(F.col("cdr_name").isNotNull())
        .groupBy("cdr_name")
        .agg(pick(F.struct("raw_directory", "tt_directory"), F.struct("seen", "target")).alias("v"))
        .select("cdr_name", "v.raw_directory", "v.tt_directory")
    )


def merge_dependencies(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of two ``target, dep`` maps; rows without a target name are dropped."""
    return (
        left.select("target", "dep")
        .unionByName(right.select("target", "dep"))
        .where(F.col("target").isNotNull() & (F.col("target") != ""))
        .distinct()
    )


def table_scripts(dwh_lake: DataFrame, targets: DataFrame) -> DataFrame:
    """``table, path``: scripts that load each table.

    The first lake table of every export conf is listed even when no script loads it (NULL path).
    """
    seeds = dwh_lake.select(F.upper(F.try_element_at("table_data_hive", F.lit(1))).alias("table"))
    loads = targets.select(F.col("target").alias("table"), "path").distinct()
    unloaded = (
        seeds.where(F.col("table").isNotNull())
        .distinct()
        .join(loads.select("table").distinct(), "table", "left_anti")
    )
    return loads.unionByName(unloaded, allowMissingColumns=True)


def scripts_of_tables(tables: DataFrame, table_scripts: DataFrame) -> DataFrame:
    """``table, path`` for the asked tables; unknown ones keep a NULL path."""
    return left_join(tables.select("table").distinct(), table_scripts, "table")


def verified_deps(table_scripts: DataFrame, script_io: DataFrame) -> DataFrame:
    """``target, dep``: dependencies of listed tables from scripts whose main target is that table.

    A listed table without such a script stays in the result with a NULL dep.
    """
    listed = table_scripts.select(F.col("table").alias("target"), "path")
    io = script_io.where(F.col("target").isNotNull()).select(
        "path", "target", F.explode("sources").alias("dep")
    )
    found = listed.join(io, ["path", "target"]).select("target", "dep").distinct()
    return left_join(listed.select("target").distinct(), found, "target")


def lake_table_files(edges: DataFrame, targets: DataFrame, table_scripts: DataFrame) -> DataFrame:
    """``target, table, path``: scripts of every map table and of each of its dependencies.

    ``targets`` holds all tables of the map, including those without a dependency.
    """
    own = targets.select("target", F.col("target").alias("table"))
    deps = edges.select("target", F.col("dep").alias("table"))
    wanted = own.unionByName(deps).distinct()
    return left_join(wanted, table_scripts, "table").select("target", "table", "path")
