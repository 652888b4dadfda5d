"""Facts read from job confs. Each operator is a narrow map over ``(path, content)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X


def conf_profile(confs: DataFrame) -> DataFrame:
    """One row per conf: script references, raw and tt directories, external and export tables."""
    content = F.col("content")
    tt_names = F.transform(
        X.all_matches(content, P.CONF_HIVE_EXTRA),
        lambda v: F.upper(F.regexp_extract(v, P.CONF_TT_TABLE, 1)),
    )
    return confs.select(
        F.col("path").alias("conf_path"),
        F.transform(X.all_matches(content, P.CONF_PRE_EXEC), X.strip).alias("pre_exec"),
        F.transform(X.all_matches(content, P.CONF_EXEC), X.strip).alias("exec"),
        X.strip(X.first_match(content, P.CONF_RAW_DIR)).alias("raw_directory"),
        X.strip(X.first_match(content, P.CONF_TT_DIR)).alias("tt_directory"),
        F.try_element_at(F.filter(tt_names, lambda v: v != ""), F.lit(-1)).alias("cdr_tt"),
        X.first_match(content, P.CONF_STAGING_TABLE).alias("staging_table_dwh"),
        X.first_match(content, P.CONF_DEST_TABLE).alias("dwh_table"),
    )


def _rooted(refs: str, root: str) -> Column:
    return F.transform(
        F.filter(refs, X.is_absolute), lambda path: F.concat(F.lit(root.rstrip("/")), path)
    ).alias(refs)


def conf_jobs(confs: DataFrame, scripts_root: str = "") -> DataFrame:
    """Conf profiles keeping only absolute script references, placed under ``scripts_root``."""
    profile = conf_profile(confs)
    return profile.select(
        *[
            _rooted(c, scripts_root) if c in ("pre_exec", "exec") else F.col(c)
            for c in profile.columns
        ]
    )


def exec_paths(confs: DataFrame, root: str) -> DataFrame:
    """``conf_path, queries``: normalised script paths of the exec-queries lines.

    A ``//`` starts a comment. A key line without ``=`` makes the conf unreadable: queries is NULL.
    """
    lines = F.filter(
        F.split("content", r"\r\n|\r|\n"), lambda line: F.contains(line, F.lit(P.CONF_EXEC_KEY))
    )

    def value(line: Column) -> Column:
        text = F.substring(line, F.instr(line, "=") + 1, F.length(line))
        text = X.strip(F.split_part(text, F.lit("//"), F.lit(1)))
        return X.strip(F.regexp_replace(text, r'^"+|"+$', ""))

    values = F.filter(F.transform("lines", value), X.is_absolute)
    under_root = F.transform(
        values,
        lambda p: X.normalize_path(
            F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(p, "^/+", ""))
        ),
    )
    readable = F.forall("lines", lambda line: F.contains(line, F.lit("=")))
    return confs.select(F.col("path").alias("conf_path"), lines.alias("lines")).select(
        "conf_path", F.when(readable, under_root).alias("queries")
    )


def exec_query_map(conf_jobs: DataFrame) -> DataFrame:
    """``conf_path, pre_exec, exec`` with empty lists in place of missing ones."""
    empty = F.array().cast("array<string>")
    return conf_jobs.select(
        "conf_path",
        F.coalesce("pre_exec", empty).alias("pre_exec"),
        F.coalesce("exec", empty).alias("exec"),
    )


def confs_without_external_table(conf_jobs: DataFrame) -> DataFrame:
    """Distinct confs that name no external table."""
    return conf_jobs.where(F.col("cdr_tt").isNull()).select("conf_path").distinct()


def sqoop_confs(confs: DataFrame) -> DataFrame:
    """Warehouse-export confs: ``sqoop*.conf``, cron variants left out, case ignored."""
    name = F.lower(X.file_name(F.col("path")))
    return confs.where(
        F.startswith(name, F.lit("sqoop"))
        & F.endswith(name, F.lit(".conf"))
        & ~F.contains(name, F.lit("cron"))
    )


def dwh_lake(confs: DataFrame) -> DataFrame:
    """``conf_path, table_data_rdms, table_data_hive`` of the export confs.

    The tables of a side are those read by its triple-quoted pre-exec block; no block, empty list.
    """

    def block_tables(pattern: str) -> Column:
        return X.source_tables(F.regexp_extract("content", pattern, 0))

    return sqoop_confs(confs).select(
        F.col("path").alias("conf_path"),
        block_tables(P.CONF_DWH_BLOCK).alias("table_data_rdms"),
        block_tables(P.CONF_LAKE_BLOCK).alias("table_data_hive"),
    )


def dwh_lake_blocks(confs: DataFrame) -> DataFrame:
    """``dwh_table, lake_block``: first warehouse table of a conf and its whole lake block text.

    When several confs name the same table the one with the greatest path wins.
    """
    rows = sqoop_confs(confs).select(
        "path",
        F.try_element_at(
            X.source_tables(F.regexp_extract("content", P.CONF_DWH_BLOCK, 0)), F.lit(1)
        ).alias("dwh_table"),
        X.first_match(F.col("content"), P.CONF_LAKE_BLOCK, 0).alias("lake_block"),
    )
    return (
        rows.where(F.col("dwh_table").isNotNull())
        .groupBy("dwh_table")
        .agg(F.max_by("lake_block", "path").alias("lake_block"))
    )


def dwh_lake_pairs(dwh_lake: DataFrame) -> DataFrame:
    """Distinct ``dwh_table, lake_table``: every pairing within one conf."""
    return (
        dwh_lake.select(F.explode("table_data_rdms").alias("dwh_table"), "table_data_hive")
        .select("dwh_table", F.explode("table_data_hive").alias("lake_table"))
        .distinct()
    )
