"""Which ingestion flow and server feed a raw directory, and hence a chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from wellspring.functions import patterns as P
from wellspring.functions import text as X
from wellspring.operators.chains import longest, widen
from wellspring.operators.joins import left_join

MATCH = [
    "server",
    "nb_processors",
    "nb_disabled_processors",
    "ip_adress",
    "username",
    "port",
    "nb_list_disabled",
    "regex",
]
REPORT_NAMES = {
    "server": "Server",
    "raw_path": "Raw_Path",
    "flux_name": "Flux_Name",
    "nb_processors": "Nb_processor",
    "nb_disabled_processors": "Nb_disabled_processors",
    "ip_adress": "Hostname",
    "port": "Port",
    "username": "username",
}


def viable_groups(groups: DataFrame) -> DataFrame:
    """Groups that name server and flow and have most processors enabled."""
    ratio = F.try_divide("nb_disabled", "nb_processors")
    return groups.where(
        F.col("staging").isNotNull()
        & F.col("flux_name").isNotNull()
        & (F.col("nb_processors") > 0)
        & (ratio < P.MAX_DISABLED_RATIO)
    )


def best_flows(matches: DataFrame) -> DataFrame:
    """One match per (raw_path, flux_name): fewest disabled listings, the lowest ``ord`` on a tie."""
    rest = [c for c in matches.columns if c not in ("raw_path", "flux_name")]
    return (
        matches.groupBy("raw_path", "flux_name")
        .agg(F.min_by(F.struct(*rest), F.struct("nb_list_disabled", "ord")).alias("best"))
        .select("raw_path", "flux_name", "best.*")
    )


def flow_matches(raw_paths: DataFrame, groups: DataFrame) -> DataFrame:
    """``raw_path, flux_name`` and the matched group's server columns.

    A raw path ``/PROD/RAW/x/sub/...`` matches a group whose raw directory is its first four parts
    and whose subdirectories hold its second-last part. A group with another raw directory matches
    when its first subdirectory is that part.

    Only the best group per flow survives, and whether a group matches depends on its raw directory
    and subdirectories alone. So groups are reduced to the best per flow *before* the two equi
    joins, and a subdirectory name shared by very many groups cannot blow them up.
    """
    raws = (
        raw_paths.select(X.first_token(F.col("raw_path")).alias("raw_path"))
        .where(X.is_absolute(F.col("raw_path")))
        .distinct()
        .select(
            "raw_path",
            X.raw_base_dir(F.col("raw_path")).alias("base"),
            X.parent_name(F.col("raw_path")).alias("dir"),
        )
        .where(F.col("base").isNotNull())
    )
    order = F.struct("nb_list_disabled", F.struct("flow_id", "path").alias("ord"))
    record = F.struct(
        F.col("staging").alias("server"),
        "nb_processors",
        F.col("nb_disabled").alias("nb_disabled_processors"),
        "ip_adress",
        "username",
        "port",
        "nb_list_disabled",
        "regex",
        F.struct("flow_id", "path").alias("ord"),
    )
    usable = (
        viable_groups(groups)
        .where(F.col("subdir") != "")
        .select(
            X.blank_to_null(F.col("rep_raw")).alias("rep_raw"),
            F.split("subdir", ";").alias("dirs"),
            "flux_name",
            record.alias("record"),
            order.alias("rank"),
        )
    )

    in_dir = (
        usable.where(F.col("rep_raw").isNotNull())
        .select("rep_raw", F.explode(F.array_distinct("dirs")).alias("dir"), "flux_name", "record", "rank")
        .groupBy("rep_raw", "dir", "flux_name")
        .agg(F.min_by("record", "rank").alias("record"))
    )
    same_dir = raws.join(
        in_dir, (raws.base == in_dir.rep_raw) & (raws.dir == in_dir.dir)
    ).select("raw_path", "flux_name", "record.*")

    # Best of each raw directory, then the two best: when the best one's raw directory is the raw
    # path's own (the case above), the second has another.
    per_raw_dir = (
        usable.select(F.col("dirs")[0].alias("dir"), "flux_name", "rep_raw", "record", "rank")
        .groupBy("dir", "flux_name", "rep_raw")
        .agg(F.min_by("record", "rank").alias("record"), F.min("rank").alias("rank"))
    )
    by_rank = W.partitionBy("dir", "flux_name").orderBy("rank")
    two_best = per_raw_dir.withColumn("n", F.row_number().over(by_rank)).where("n <= 2")
    other_dir = raws.join(
        two_best, (raws.dir == two_best.dir) & ~raws.base.eqNullSafe(two_best.rep_raw)
    ).select("raw_path", "flux_name", "record.*")

    return best_flows(same_dir.unionByName(other_dir)).select("raw_path", "flux_name", *MATCH)


def _servers(matches: DataFrame) -> DataFrame:
    """One row per server when a match lists several."""
    if isinstance(matches.schema["server"].dataType, ArrayType):
        return matches.withColumn("server", F.explode_outer("server"))
    return matches


def external_servers(attrs: DataFrame, matches: DataFrame) -> DataFrame:
    """``cdr_name, raw_path`` and server columns of every external table.

    All raw directories of an external table count, each with its own servers. A table none of
    whose directories is matched keeps one row with the directory seen last.
    """
    raws = attrs.where(F.col("cdr_name").isNotNull()).select(
        "cdr_name",
        X.first_token(F.col("raw_directory")).alias("raw_path"),
        F.struct("seen", "target").alias("ord"),
    )
    matched = raws.select("cdr_name", "raw_path").distinct().join(_servers(matches), "raw_path")
    lone = (
        raws.groupBy("cdr_name")
        .agg(F.max_by("raw_path", "ord").alias("raw_path"))
        .join(matched.select("cdr_name").distinct(), "cdr_name", "left_anti")
    )
    return matched.unionByName(lone, allowMissingColumns=True)


def chain_servers(chains: DataFrame, attrs: DataFrame, matches: DataFrame) -> DataFrame:
    """Chains with the servers and flows that feed them; unmatched chains keep NULLs."""
    ends = chains.withColumn("cdr_name", F.element_at("path", -1))
    return left_join(ends, external_servers(attrs, matches), "cdr_name").drop("cdr_name")


def server_report(chains: DataFrame, attrs: DataFrame, matches: DataFrame) -> DataFrame:
    """The wide dependency report: tables of each chain, then server columns; distinct rows.

    Server rows are made distinct per external table, before they meet the (distinct) chains.
    """
    external = external_servers(attrs, matches).withColumnsRenamed(REPORT_NAMES)
    external = external.select("cdr_name", *P.SERVER_COLUMNS).distinct()
    ends = chains.withColumn("cdr_name", F.element_at("path", -1))
    rows = left_join(ends, external, "cdr_name")
    first = [P.DWH_COLUMN, P.LAKE_COLUMN]
    return widen(
        rows, F.col("path"), longest(chains), first, P.DEPENDENCY_PREFIX, P.SERVER_COLUMNS
    )


def servers_outside_chain(chains_with_raw: DataFrame, matches: DataFrame) -> DataFrame:
    """``chain_id, server``: servers of a chain's raw path that are not tables of the chain.

    A chain without such a server keeps one row with NULL.
    """
    servers = _servers(matches).select("raw_path", "server").where(F.col("server") != "")
    raw = F.when(X.is_absolute(F.col("raw_path")), X.first_token(F.col("raw_path")))
    chains = chains_with_raw.select("chain_id", "path", raw.alias("raw_path"))
    found = chains.join(servers, "raw_path").where(~F.array_contains("path", F.col("server")))
    return left_join(chains.select("chain_id"), found.select("chain_id", "server"), "chain_id")
