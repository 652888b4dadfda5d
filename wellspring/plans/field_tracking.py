"""Column lineage end to end: scripts, confs and catalog to the field-tracking tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.operators import chains, confs, deps, projections, scripts, tracking
from wellspring.plans.table_lineage import TableLineage
from wellspring.session import materialize


@dataclass
class FieldLineage:
    """What the field-tracking jobs share. A question about some tables follows their chains only and
    cuts only the scripts on them into tokens; all chains and the projections of all scripts are
    written when a job asks for everything, once."""

    lineage: TableLineage
    loaders: DataFrame
    ddl: DataFrame
    table_scripts: DataFrame
    lake_files: DataFrame
    script_io: DataFrame
    dwh_tables: DataFrame | list[str] | None = None

    def _steps(self, found: DataFrame) -> DataFrame:
        return materialize(chains.chain_steps(found, self.table_scripts))

    @cached_property
    def steps(self) -> DataFrame:
        return self._steps(self.lineage.warehouse_chains(self.dwh_tables))

    @cached_property
    def projections(self) -> DataFrame:
        return materialize(projections.projections(self.loaders, self.ddl))

    def projections_of(self, paths: DataFrame) -> DataFrame:
        """Projections of the scripts in ``paths`` (``path``); others are not looked into."""
        own = self.loaders.join(paths.select("path").distinct(), "path", "left_semi")
        return projections.projections(own, self.ddl)

    def of_warehouse(
        self, catalog: DataFrame, dwh_tables: DataFrame | list[str] | None = None
    ) -> DataFrame:
        """Field tracking for warehouse tables, all of them or ``dwh_tables`` (a list, or a DataFrame
        with ``dwh_table``; case is ignored). ``catalog`` is ``table_name, fields``."""
        fields = tracking.field_map(self.lineage.jobs, catalog)
        if dwh_tables is None:
            return tracking.warehouse_tracking(self.steps, self.projections, fields, self.script_io)
        key = F.upper("dwh_table").alias("key")
        known = self.lineage.pairs.select("dwh_table", key).distinct()
        if isinstance(dwh_tables, DataFrame):
            known = known.join(dwh_tables.select(key).distinct(), "key", "left_semi")
        else:
            known = known.where(F.col("key").isin([t.upper() for t in dwh_tables]))
        steps = self._steps(self.lineage.warehouse_chains(known))
        paths = steps.select(F.col("script_path").alias("path"))
        found = self.projections_of(paths)
        return tracking.warehouse_tracking(steps, found, fields, self.script_io)

    def of_lake_table(self, table: str) -> DataFrame:
        """Field tracking for a lake table, from the chains that pass it."""
        steps = self._steps(self.lineage.chains_through(table))
        paths = materialize(tracking.lake_table_paths(table, steps, self.lake_files))
        return tracking.lake_table_tracking(paths, materialize(self.projections_of(paths)))


def field_lineage(
    lineage: TableLineage,
    conf_files: DataFrame,
    script_files: DataFrame,
    dwh_tables: DataFrame | list[str] | None = None,
    strip_comments: bool = True,
) -> FieldLineage:
    loaders = scripts.loader_scripts(script_files)
    targets = scripts.script_targets(loaders, strip_comments)
    table_scripts = materialize(deps.table_scripts(confs.dwh_lake(conf_files), targets))
    return FieldLineage(
        lineage=lineage,
        loaders=loaders,
        ddl=scripts.ddl_catalog(script_files),
        table_scripts=table_scripts,
        lake_files=deps.lake_table_files(lineage.edges, lineage.attrs, table_scripts),
        script_io=scripts.script_io(loaders, strip_comments),
        dwh_tables=dwh_tables,
    )
