"""Table lineage end to end: confs, scripts and flow exports to chains and the server report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wellspring.operators import chains, confs, deps, flows, match, scripts
from wellspring.session import materialize
from wellspring.sources.corpus import read_files, read_flow_exports


@dataclass
class TableLineage:
    """Derived tables shared by the lineage jobs."""

    jobs: DataFrame
    edges: DataFrame
    attrs: DataFrame
    pairs: DataFrame

    @cached_property
    def _all_warehouse_chains(self) -> DataFrame:
        return chains.warehouse_chains(self.pairs, self.edges)

    def warehouse_chains(self, tables: DataFrame | list[str] | None = None) -> DataFrame:
        """Chains of ``tables``, or of all; the latter are enumerated once and then re-read."""
        if tables is None:
            return self._all_warehouse_chains
        return chains.warehouse_chains(self.pairs, self.edges, tables)

    def chains_through(self, lake_table: str) -> DataFrame:
        """Warehouse chains that pass a lake table; no other is enumerated."""
        return chains.warehouse_chains(self.pairs, self.edges, through=lake_table.upper())

    def lake_chains(self, tables: DataFrame | list[str] | None = None) -> DataFrame:
        return chains.lake_chains(self.edges, self.attrs, tables)


def table_lineage(
    conf_files: DataFrame,
    script_files: DataFrame,
    scripts_root: str = "",
    strip_comments: bool = True,
    include_overwrite: bool = False,
) -> TableLineage:
    """Reads the corpora once; what the later steps need is written to the shared folder."""
    jobs = confs.conf_jobs(conf_files, scripts_root)
    io = scripts.script_io(script_files, strip_comments, include_overwrite)
    referenced = materialize(deps.referenced_io(jobs, io))
    return TableLineage(
        jobs=jobs,
        edges=deps.table_edges(referenced),
        attrs=deps.attributes_of(referenced),
        pairs=confs.dwh_lake_pairs(confs.dwh_lake(conf_files)),
    )


def flow_matches(lineage: TableLineage, flow_files: DataFrame) -> DataFrame:
    """Flows and servers behind the raw directories of all external tables."""
    raw_paths = lineage.attrs.selectExpr("raw_directory AS raw_path").where("raw_path IS NOT NULL")
    groups = materialize(flows.process_groups(flow_files))
    return materialize(match.flow_matches(raw_paths, groups))


def server_report(
    conf_files: DataFrame,
    script_files: DataFrame,
    flow_files: DataFrame,
    tables: DataFrame | list[str] | None = None,
    scripts_root: str = "",
) -> DataFrame:
    """Wide report of all warehouse tables, or of ``tables``, down to raw paths and servers."""
    lineage = table_lineage(conf_files, script_files, scripts_root)
    return match.server_report(
        lineage.warehouse_chains(tables), lineage.attrs, flow_matches(lineage, flow_files)
    )


def report_from_folders(
    spark: SparkSession,
    conf_root: str,
    scripts_root: str,
    flows_root: str,
    tables: DataFrame | list[str] | None = None,
    charset: str = "UTF-8",
) -> DataFrame:
    """The wide server report of the files below three folders. Confs name scripts by their paths
    below ``scripts_root``."""
    return server_report(
        read_files(spark, conf_root, charset),
        read_files(spark, scripts_root, charset),
        read_flow_exports(spark, flows_root),
        tables,
        scripts_root,
    )
