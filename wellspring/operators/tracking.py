"""Field tracking: column lineage followed along dependency chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X
from wellspring.operators.projections import tables_text


def lake_fields(chains: DataFrame, ddl: DataFrame) -> DataFrame:
    """``chain_id, lake_table, fields``: declared fields of each chain's lake table.

    When several scripts declare a table the one with the greatest path wins.
    """
    last = (
        ddl.where(F.col("table_name").isNotNull())
        .groupBy(F.col("table_name").alias("lake_table"))
        .agg(F.max_by("fields", "path").alias("fields"))
    )
    return chains.select("chain_id", "lake_table").join(last, "lake_table", "left").select(
        "chain_id", "lake_table", F.coalesce("fields", F.array().cast("array<string>")).alias("fields")
    )


def staging_tables(conf_jobs: DataFrame) -> DataFrame:
    """``dwh_key, staging_table``: staging table of every export target, first conf wins.

    ``dwh_key`` is the upper-case warehouse table.
    """
    return (
        conf_jobs.where(F.col("dwh_table").isNotNull())
        .groupBy(F.upper("dwh_table").alias("dwh_key"))
        .agg(F.min_by(F.struct("staging_table_dwh"), "conf_path").alias("first"))
        .select("dwh_key", F.col("first.staging_table_dwh").alias("staging_table"))
    )


def chain_staging(chains: DataFrame, conf_jobs: DataFrame) -> DataFrame:
    """``chain_id, dwh_table, staging_table``: case-insensitive match of warehouse and export table."""
    keyed = chains.select("chain_id", "dwh_table", F.upper("dwh_table").alias("dwh_key"))
    return keyed.join(staging_tables(conf_jobs), "dwh_key", "left").select(
        "chain_id", "dwh_table", "staging_table"
    )


def field_map(conf_jobs: DataFrame, catalog: DataFrame) -> DataFrame:
    """``dwh_key, staging_field, dwh_field``: staging and warehouse fields paired by ordinal.

    Only tables whose two field lists have the same length are mapped. A staging field listed
    twice keeps its first ordinal.
    """
    fields = catalog.groupBy(F.upper("table_name").alias("key")).agg(
        F.max("fields").alias("fields")
    )
    staged = staging_tables(conf_jobs).withColumn("key", F.upper("staging_table"))
    both = (
        staged.join(fields.withColumnRenamed("fields", "staging"), "key")
        .drop("key")
        .join(fields.select(F.col("key").alias("dwh_key"), F.col("fields").alias("dwh")), "dwh_key")
        .where(F.size("staging") == F.size("dwh"))
    )
    pairs = F.arrays_zip("staging", "dwh")
    return (
        both.select("dwh_key", F.posexplode(pairs).alias("pos", "pair"))
        .groupBy("dwh_key", F.upper("pair.staging").alias("staging_field"))
        .agg(F.min_by("pair.dwh", "pos").alias("dwh_field"))
    )


def _used_columns() -> Column:
    """Lower-case columns of an item, a fixed text when it uses none."""
    none = F.array(F.lit(P.NO_COLUMN))
    return F.when(F.size("columns_used") > 0, F.transform("columns_used", F.lower)).otherwise(none)


def track_columns(projections: DataFrame) -> DataFrame:
    """One row per SELECT item and column it uses: ``path, column, arithmetic_ops, alias,
    formula_sql, tables``."""
    return projections.select(
        "path",
        F.explode(_used_columns()).alias("column"),
        X.joined(F.col("arithmetic_ops")).alias("arithmetic_ops"),
        "alias",
        "formula_sql",
        tables_text().alias("tables"),
    )


def chain_lineage(steps: DataFrame, projections: DataFrame) -> DataFrame:
    """Projections of the scripts of every chain step, with the step's position."""
    keyed = steps.where(F.col("script_path").isNotNull()).select(
        "chain_id", "position", "table", "script_path"
    )
    return keyed.join(projections, keyed.script_path == projections.path).drop("script_path")


def lake_table_paths(lake_table: str, steps: DataFrame, lake_files: DataFrame) -> DataFrame:
    """``path, via, key``: scripts that may track a lake table: those of all chains that pass through
    it (``chain``), and its own and those of its direct dependencies (``direct``).

    ``lake_files`` is ``target, table, path`` of the dependency map.
    """
    name = lake_table.upper()
    through = steps.where(F.upper("table") == name).select("chain_id", F.upper("table").alias("key"))
    of_chains = steps.select("chain_id", F.col("script_path").alias("path")).join(
        through.distinct(), "chain_id"
    )
    direct = lake_files.where(F.upper("target") == name).select("path", F.upper("target").alias("key"))
    rows = of_chains.select("path", F.lit("chain").alias("via"), "key").unionByName(
        direct.select("path", F.lit("direct").alias("via"), "key")
    )
    return rows.where(F.col("path").isNotNull()).distinct()


def lake_table_tracking(paths: DataFrame, projections: DataFrame) -> DataFrame:
    """Field tracking for one lake table, from the scripts in ``paths``.

    Scripts of chains count; only when they track nothing (tracking rows decide, not scripts: a
    chain whose scripts have no SELECT falls back as well), the direct ones do.
    """
    tracked = track_columns(projections).join(paths, "path")
    of_chains = tracked.where("via = 'chain'")
    fallback = tracked.where("via = 'direct'").join(
        of_chains.select("key").distinct(), "key", "left_anti"
    )
    return of_chains.unionByName(fallback).drop("via", "key").distinct()


def warehouse_tracking(
    steps: DataFrame,
    projections: DataFrame,
    fields: DataFrame,
    script_io: DataFrame,
    dwh_tables: DataFrame | list[str] | None = None,
) -> DataFrame:
    """Field tracking for warehouse tables, all of them or ``dwh_tables``.

    ``dwh_table, tables, computed_table, dwh_field, column, alias, step, path, arithmetic_ops,
    formula_sql``, distinct. An item whose alias is a staging field gives a mapping row (warehouse
    field and alias, the rest blank), and a detail row per used column that occurs in the formula
    when the warehouse field has the name of the alias or of the column.

    Chains share most of their steps, so steps are reduced to distinct (warehouse table, position,
    script) before anything is joined to them.
    """
    keyed = steps.where(F.col("script_path").isNotNull())
    if isinstance(dwh_tables, DataFrame):
        asked = dwh_tables.select(F.upper("dwh_table").alias("asked")).distinct()
        keyed = keyed.join(asked, F.upper("dwh_table") == F.col("asked"), "left_semi")
    elif dwh_tables is not None:
        keyed = keyed.where(F.upper("dwh_table").isin([t.upper() for t in dwh_tables]))
    keyed = keyed.select(
        "dwh_table", F.upper("dwh_table").alias("dwh_key"), "position", "script_path"
    ).distinct()
    items = track_columns(projections).withColumn("staging_field", F.upper("alias"))
    computed = script_io.select("path", F.col("target").alias("computed_table"))

    hits = (
        keyed.join(items.join(computed, "path", "left"), keyed.script_path == F.col("path"))
        .join(fields, ["dwh_key", "staging_field"])
    )
    blank = F.lit("")
    detail = F.contains(F.lower("formula_sql"), F.col("column")) & F.lower("dwh_field").isin(
        F.lower("alias"), F.col("column")
    )
    mapping_row = F.struct(
        blank.alias("tables"),
        blank.alias("computed_table"),
        F.col("dwh_field"),
        blank.alias("column"),
        F.col("alias"),
        F.lit(None).cast("int").alias("step"),
        blank.alias("path"),
        blank.alias("arithmetic_ops"),
        blank.alias("formula_sql"),
    )
    detail_row = F.struct(
        F.col("tables"),
        F.coalesce("computed_table", blank).alias("computed_table"),
        F.col("dwh_field"),
        F.col("column"),
        F.col("alias"),
        F.col("position").alias("step"),
        F.col("path"),
        F.col("arithmetic_ops"),
        F.col("formula_sql"),
    )
    rows = F.when(detail, F.array(mapping_row, detail_row)).otherwise(F.array(mapping_row))
    return hits.select("dwh_table", F.inline(rows)).distinct()


def tracking_report(tracking: DataFrame) -> DataFrame:
    """The 7-column tracking report; lake-table tracking has no warehouse fields."""
    dwh_field = F.col("dwh_field") if "dwh_field" in tracking.columns else F.lit("")
    return tracking.select(
        F.col("tables").alias("Tables utilisées"),
        dwh_field.alias("dwh_fields"),
        F.col("column").alias("Champ"),
        F.col("alias").alias("Alias"),
        F.col("path").alias("Chemin du fichier HQL"),
        F.col("arithmetic_ops").alias("Opérations arithmétiques"),
        F.col("formula_sql").alias("Formule SQL"),
    ).distinct()


def staged_tracking_report(tracking: DataFrame) -> DataFrame:
    """The 9-column tracking report with computed table and step, ordered by field and step."""
    return (
        tracking.select(
            F.col("tables").alias("Tables utilisées"),
            F.col("computed_table").alias("Table calculée"),
            F.col("dwh_field").alias("dwh_fields"),
            F.col("column").alias("Champ"),
            F.col("alias").alias("Alias"),
            F.col("step").alias("Etape"),
            F.col("path").alias("Chemin du fichier HQL"),
            F.col("arithmetic_ops").alias("Opérations arithmétiques"),
            F.col("formula_sql").alias("Formule SQL"),
        )
        .distinct()
        .orderBy("dwh_fields", "Etape")
    )
