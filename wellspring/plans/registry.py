"""Every operator as a query over the corpora derived from the shared tables.

List columns are emitted as sorted text, so results compare by value on any engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring import corpora
from wellspring.functions import text as X
from wellspring.operators import (
    catalog,
    chains,
    confs,
    deps,
    flows,
    match,
    projections,
    report,
    scripts,
    tracking,
)
from wellspring.plans import field_tracking, table_lineage
from wellspring.session import work_dir
from wellspring.sources import catalog as catalog_sources
from wellspring.sources import corpus, report_csv, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Inputs:
    """The corpora of one scale factor and what is commonly derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return corpora.load(self.spark, self.sf_dir, getattr(corpora, name.upper()))

    @property
    def io(self) -> DataFrame:
        return scripts.script_io(self.scripts)

    @property
    def jobs(self) -> DataFrame:
        return confs.conf_jobs(self.confs)

    @property
    def lake(self) -> DataFrame:
        return confs.dwh_lake(self.confs)

    @property
    def clean_report(self) -> DataFrame:
        return report_csv.clean_cells(self.report)

    @property
    def fields(self) -> DataFrame:
        return catalog.catalog_fields(self.catalog_rows)

    @property
    def table_scripts(self) -> DataFrame:
        loaders = scripts.loader_scripts(self.scripts)
        return deps.table_scripts(self.lake, scripts.script_targets(loaders))

    def lineage(self) -> table_lineage.TableLineage:
        return table_lineage.table_lineage(self.confs, self.scripts)

    def field_lineage(self) -> field_tracking.FieldLineage:
        return field_tracking.field_lineage(self.lineage(), self.confs, self.scripts)


def query(name: str):
    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        return build

    return register


def listed(col: str | Column) -> Column:
    return F.array_join(F.sort_array(col), ",")


def ordered(col: str | Column) -> Column:
    return F.array_join(col, ",")


def as_cells(wide: DataFrame) -> DataFrame:
    """A report of any width as fixed columns: number and names of its columns, and its cells."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in wide.columns]
    return wide.select(
        F.lit(len(wide.columns)).cast("long").alias("n_columns"),
        F.lit("|".join(wide.columns)).alias("header"),
        F.concat_ws("|", *cells).alias("cells"),
    )


def path_text(col: str | Column = "path") -> Column:
    return F.array_join(col, ">")


# --- sources and sinks -------------------------------------------------------------------------
@query("s07_report_csv")
def _(i: Inputs) -> DataFrame:
    path = work_dir(i.spark)
    report_csv.write_report_csv(i.report.drop("row_id"), path)
    return report_csv.read_report(i.spark, path).drop("row_id")


def _written_out(i: Inputs, charset: str) -> DataFrame:
    """The scripts as files, one each, a thousand a folder, read back with ``charset``."""
    root = work_dir(i.spark)
    k = F.regexp_extract("path", r"(\d+)\.hql$", 1).cast("long")
    name = F.concat(F.floor(k / 1000), F.lit("/"), k, F.lit(".hql"))
    text = F.encode(F.concat("content", F.lit(" é")), charset)
    sinks.write_files(i.scripts.select(name.alias("path"), text.alias("content")), root)
    files = corpus.read_files(i.spark, root, charset, glob="*.hql")
    return files.select(F.regexp_extract("path", r"/(\d+)\.hql$", 1).cast("long").alias("k"), "content")


@query("s01_files")
def _(i: Inputs) -> DataFrame:
    return _written_out(i, "UTF-8")


@query("s02_latin1_files")
def _(i: Inputs) -> DataFrame:
    return _written_out(i, "ISO-8859-1")


@query("s06_field_dictionary")
def _(i: Inputs) -> DataFrame:
    path = work_dir(i.spark)
    sinks.write_field_dictionary(i.fields, path)
    read = catalog_sources.read_field_dictionary(i.spark, path, whole_file=False)
    return read.select("table_name", ordered("fields").alias("fields"))


@query("s05_catalog_snapshot")
def _(i: Inputs) -> DataFrame:
    path = work_dir(i.spark)
    i.catalog_rows.write.parquet(path)
    return catalog_sources.read_catalog_snapshot(i.spark, path, owner="MON")


@query("k01_lineage_sink")
def _(i: Inputs) -> DataFrame:
    path = work_dir(i.spark)
    sinks.write_lineage(i.io.select("target", F.sort_array("sources").alias("sources")), path, fmt="csv")
    return i.spark.read.csv(path, header=True)


@query("k01_replaced_rows")
def _(i: Inputs) -> DataFrame:
    """The sink after three writes: all targets, with the comments' sources too; all targets again;
    and those of one layer."""
    path = work_dir(i.spark)
    loose = scripts.script_io(i.scripts, strip_comments=False)
    for rows in (loose, i.io, i.io.where(F.startswith("target", F.lit("AGG.")))):
        rows = rows.where(F.col("target").isNotNull()).select("target", F.explode("sources").alias("dep"))
        sinks.replace_rows(rows.distinct(), path, "target")
    return sinks.read_rows(i.spark, path)


@query("k04_file_paths")
def _(i: Inputs) -> DataFrame:
    path = work_dir(i.spark)
    sinks.write_paths(i.scripts, path)
    return i.spark.read.text(path).withColumnRenamed("value", "path")


@query("k05_flow_json")
def _(i: Inputs) -> DataFrame:
    path = work_dir(i.spark)
    sinks.write_flow_json(i.flows, path)
    text = i.spark.read.text(path)
    group = "$.flowContents.processGroups[0]"
    return text.select(
        F.get_json_object("value", f"{group}.identifier").alias("identifier"),
        F.get_json_object("value", f"{group}.name").alias("name"),
        F.get_json_object("value", f"{group}.processors[0].bundle.version").alias("version"),
        F.get_json_object("value", f"{group}.variables['flux.name']").alias("flux_name"),
    )


@query("s03_flow_exports")
def _(i: Inputs) -> DataFrame:
    depth = F.max(F.size("path")).cast("long").alias("depth")
    walked = flows.walk(i.odd_flows, "true", "1").groupBy("flow_id").agg(depth)
    docs = flows.parse_flows(i.odd_flows).join(walked, "flow_id", "left")
    lost = flows.flow_rejects(i.odd_flows)
    return docs.select(
        "flow_id", F.lit("parsed").alias("reason"), F.coalesce("depth", F.lit(0)).alias("depth")
    ).unionByName(lost.withColumn("depth", F.lit(0).cast("long")))


# --- scripts -----------------------------------------------------------------------------------
@query("x01_clean_script")
def _(i: Inputs) -> DataFrame:
    return i.scripts.select("path", X.clean_script(F.col("content")).alias("content"))


@query("x03_source_tables")
def _(i: Inputs) -> DataFrame:
    return i.scripts.select("path", listed(X.source_tables(F.col("content"))).alias("tables"))


@query("x04_script_io")
def _(i: Inputs) -> DataFrame:
    return i.io.select(
        "path", "target", ordered("targets").alias("targets"), listed("sources").alias("sources")
    )


@query("x05_script_targets")
def _(i: Inputs) -> DataFrame:
    return scripts.script_targets(i.scripts)


@query("x06_insert_tokens")
def _(i: Inputs) -> DataFrame:
    return scripts.insert_tokens(i.scripts)


@query("x07_quoted_sources")
def _(i: Inputs) -> DataFrame:
    found = scripts.quoted_sources(i.quoted_scripts)
    return found.select("path", listed("tables").alias("tables"))


@query("x16_ddl")
def _(i: Inputs) -> DataFrame:
    return scripts.ddl_profile(i.ddl).withColumn("fields", ordered("fields"))


@query("x17_ddl_catalog")
def _(i: Inputs) -> DataFrame:
    return scripts.ddl_catalog(i.scripts).withColumn("fields", ordered("fields"))


@query("x18_statement_profile")
def _(i: Inputs) -> DataFrame:
    pairs = F.transform("calculated_fields", lambda c: F.concat_ws("=", c["alias"], c["source"]))
    return scripts.statement_profile(i.nested_scripts).select(
        "path",
        F.col("stmt_no").cast("long").alias("stmt_no"),
        F.col("table_no").cast("long").alias("table_no"),
        "table",
        F.array_join("columns", "|").alias("columns"),
        ordered(pairs).alias("calculated_fields"),
    )


@query("f02_loader_scripts")
def _(i: Inputs) -> DataFrame:
    return scripts.loader_scripts(i.scripts).select("path")


# --- confs -------------------------------------------------------------------------------------
@query("x08_conf_jobs")
def _(i: Inputs) -> DataFrame:
    jobs = confs.conf_jobs(i.confs, "/hdfs")
    return jobs.withColumn("pre_exec", ordered("pre_exec")).withColumn("exec", ordered("exec"))


@query("x13_exec_paths")
def _(i: Inputs) -> DataFrame:
    found = confs.exec_paths(i.confs, "/hdfs")
    return found.select("conf_path", ordered("queries").alias("queries"))


@query("x14_dwh_lake")
def _(i: Inputs) -> DataFrame:
    return i.lake.select(
        "conf_path",
        listed("table_data_rdms").alias("table_data_rdms"),
        listed("table_data_hive").alias("table_data_hive"),
    )


@query("x15_dwh_lake_blocks")
def _(i: Inputs) -> DataFrame:
    return confs.dwh_lake_blocks(i.confs)


@query("x19_exec_query_map")
def _(i: Inputs) -> DataFrame:
    mapped = confs.exec_query_map(i.jobs)
    return mapped.withColumn("pre_exec", ordered("pre_exec")).withColumn("exec", ordered("exec"))


@query("f01_sqoop_confs")
def _(i: Inputs) -> DataFrame:
    return confs.sqoop_confs(i.confs).select("path")


@query("f07_confs_without_external_table")
def _(i: Inputs) -> DataFrame:
    return confs.confs_without_external_table(i.jobs)


@query("j02_dwh_lake_pairs")
def _(i: Inputs) -> DataFrame:
    return confs.dwh_lake_pairs(i.lake)


# --- dependencies ------------------------------------------------------------------------------
@query("j01_job_io")
def _(i: Inputs) -> DataFrame:
    return deps.job_io(i.jobs, i.io).select(
        "conf_path",
        F.col("kind").cast("long").alias("kind"),
        "script_path",
        "target",
        listed("sources").alias("sources"),
    )


@query("a01_table_deps")
def _(i: Inputs) -> DataFrame:
    return deps.table_deps(i.jobs, i.io)


@query("a02_table_attrs")
def _(i: Inputs) -> DataFrame:
    return deps.table_attrs(i.jobs, i.io).select(
        "target", *deps.ATTRIBUTES, F.col("seen.conf_path").alias("conf_path")
    )


@query("a03_raw_of_external")
def _(i: Inputs) -> DataFrame:
    return deps.raw_of_external(deps.table_attrs(i.jobs, i.io))


@query("a04_merge_dependencies")
def _(i: Inputs) -> DataFrame:
    with_comments = scripts.script_io(i.scripts, strip_comments=False)
    other = with_comments.select("target", F.explode("sources").alias("dep"))
    return deps.merge_dependencies(deps.table_deps(i.jobs, i.io), other)


@query("j09_lake_table_files")
def _(i: Inputs) -> DataFrame:
    known = deps.referenced_io(i.jobs, i.io)
    return deps.lake_table_files(
        deps.table_edges(known), deps.attributes_of(known), i.table_scripts
    )


@query("j10_table_scripts")
def _(i: Inputs) -> DataFrame:
    return i.table_scripts


@query("j11_scripts_of_tables")
def _(i: Inputs) -> DataFrame:
    asked = i.fields.select("table_name").withColumnRenamed("table_name", "table")
    lake = confs.dwh_lake_pairs(i.lake).select(F.col("lake_table").alias("table"))
    return deps.scripts_of_tables(asked.unionByName(lake), i.table_scripts)


@query("j17_verified_deps")
def _(i: Inputs) -> DataFrame:
    return deps.verified_deps(i.table_scripts, i.io)


# --- chains ------------------------------------------------------------------------------------
@query("g01_warehouse_chains")
def _(i: Inputs) -> DataFrame:
    lineage = i.lineage()
    found = chains.with_raw(lineage.warehouse_chains(), lineage.attrs)
    return found.select(
        "chain_id", "dwh_table", "lake_table", path_text().alias("path"), "raw_path", "tt_dir"
    )


@query("g02_wide_chain_report")
def _(i: Inputs) -> DataFrame:
    lineage = i.lineage()
    return as_cells(chains.wide_chain_report(lineage.warehouse_chains(), lineage.attrs))


@query("g03_server_report_of_tables")
def _(i: Inputs) -> DataFrame:
    tables = report.dwh_tables(i.clean_report).withColumnRenamed("Table_RDMS", "dwh_table")
    return as_cells(table_lineage.server_report(i.confs, i.scripts, i.flows, tables))


@query("g04_server_report")
def _(i: Inputs) -> DataFrame:
    return as_cells(table_lineage.server_report(i.confs, i.scripts, i.flows))


@query("g05a_chains_of_table")
def _(i: Inputs) -> DataFrame:
    found = i.lineage().lake_chains(["MON.SPARK_FT_0"])
    return found.select(
        path_text(chains.display_path(F.col("path"), F.col("is_cycle"))).alias("path")
    )


@query("g05b_wide_lake_report")
def _(i: Inputs) -> DataFrame:
    lineage = i.lineage()
    return as_cells(chains.wide_lake_report(lineage.lake_chains(), lineage.attrs))


@query("g05c_lake_chains")
def _(i: Inputs) -> DataFrame:
    lineage = i.lineage()
    found = chains.with_raw(lineage.lake_chains(), lineage.attrs, "first")
    return found.select("root", path_text().alias("path"), "is_cycle", "raw_path")


@query("j08_chain_steps")
def _(i: Inputs) -> DataFrame:
    steps = chains.chain_steps(i.lineage().warehouse_chains(), i.table_scripts)
    return steps.select(
        "chain_id", F.col("position").cast("long").alias("position"), "table", "script_path"
    )


# --- flows and servers -------------------------------------------------------------------------
@query("n01_values_of_key")
def _(i: Inputs) -> DataFrame:
    return flows.values_of_key(i.flows, "identifier").select(
        "flow_id", F.size("path").cast("long").alias("depth"), "value"
    )


@query("n02_objects_where")
def _(i: Inputs) -> DataFrame:
    found = flows.objects_where(
        i.flows, "scheduledState", "DISABLED", "try_variant_get(node, '$.name', 'string')"
    )
    return found.select("flow_id", F.col("payload").alias("name"))


@query("n03_objects_having")
def _(i: Inputs) -> DataFrame:
    found = flows.objects_having(
        i.flows, "componentType", "try_variant_get(node, '$.name', 'string')"
    )
    return found.select("flow_id", F.col("payload").alias("name"))


@query("n04_schema_paths")
def _(i: Inputs) -> DataFrame:
    return flows.schema_paths(i.flows)


@query("n06_group_index")
def _(i: Inputs) -> DataFrame:
    return flows.group_index(i.flows).select("flow_id", "name", "identifier")


@query("n07_processors")
def _(i: Inputs) -> DataFrame:
    return flows.processors(i.flows)


@query("n08_process_groups")
def _(i: Inputs) -> DataFrame:
    counts = ["nb_processors", "nb_disabled", "nb_enabled", "nb_list_disabled"]
    groups = flows.process_groups(i.flows).drop("path")
    return groups.withColumns({c: F.col(c).cast("long") for c in counts})


@query("n09_group_report")
def _(i: Inputs) -> DataFrame:
    counts = ["nb_processors", "nb_disabled"]
    rows = flows.group_report(flows.process_groups(i.flows))
    return rows.withColumns({c: F.col(c).cast("long") for c in counts})


def _matches(i: Inputs, lineage: table_lineage.TableLineage) -> DataFrame:
    return table_lineage.flow_matches(lineage, i.flows)


@query("n10_flow_matches")
def _(i: Inputs) -> DataFrame:
    counts = ["nb_processors", "nb_disabled_processors", "nb_list_disabled"]
    return _matches(i, i.lineage()).withColumns({c: F.col(c).cast("long") for c in counts})


@query("j04_chain_servers")
def _(i: Inputs) -> DataFrame:
    lineage = i.lineage()
    served = match.chain_servers(
        lineage.warehouse_chains(), lineage.attrs, _matches(i, lineage)
    )
    return served.select(path_text().alias("path"), "raw_path", "flux_name", "server", "port")


@query("j16_servers_outside_chain")
def _(i: Inputs) -> DataFrame:
    lineage = i.lineage()
    raw = chains.with_raw(lineage.warehouse_chains(), lineage.attrs)
    return match.servers_outside_chain(raw, _matches(i, lineage))


# --- column lineage ----------------------------------------------------------------------------
def _flat(rows: DataFrame) -> DataFrame:
    longs = {c: F.col(c).cast("long") for c in ("stmt_no", "select_pos", "item_no")}
    lists = ("columns_used", "aggregations", "arithmetic_ops", "tables")
    return rows.withColumns(longs | {c: ordered(c) for c in lists})


@query("l01_projections")
def _(i: Inputs) -> DataFrame:
    return _flat(projections.projections(i.scripts)).drop("select_pos")


@query("l02_nested_projections")
def _(i: Inputs) -> DataFrame:
    return _flat(projections.projections(i.nested_scripts)).drop("select_pos", "item_sql")


@query("l03_last_wins")
def _(i: Inputs) -> DataFrame:
    rows = projections.last_wins(projections.projections(i.nested_scripts))
    return rows.select("path", "alias", "formula_sql")


@query("l09_script_report")
def _(i: Inputs) -> DataFrame:
    return projections.script_report(projections.projections(i.scripts, i.ddl.transform(scripts.ddl_profile)))


@query("l09_ddl_columns")
def _(i: Inputs) -> DataFrame:
    rows = projections.projections(i.bare_scripts, scripts.ddl_profile(i.ddl))
    tracked = tracking.track_columns(rows)
    return tracked.select("path", "alias", "column", "formula_sql").join(
        rows.select("path", "alias", "formula_sql", ordered("columns_used").alias("columns_used")),
        ["path", "alias", "formula_sql"],
    )


@query("a15_tables_used")
def _(i: Inputs) -> DataFrame:
    return projections.tables_used(projections.projections(i.scripts))


@query("l16_source_fields")
def _(i: Inputs) -> DataFrame:
    return projections.source_fields(i.scripts)


@query("l16_nested_source_fields")
def _(i: Inputs) -> DataFrame:
    return projections.source_fields(i.nested_scripts)


@query("l11_track_columns")
def _(i: Inputs) -> DataFrame:
    return tracking.track_columns(projections.projections(i.scripts))


@query("l10_chain_lineage")
def _(i: Inputs) -> DataFrame:
    fields = i.field_lineage()
    rows = tracking.chain_lineage(fields.steps, fields.projections)
    return rows.select(
        "chain_id", F.col("position").cast("long").alias("position"), "path", "alias", "formula_sql"
    )


@query("l12_lake_table_tracking")
def _(i: Inputs) -> DataFrame:
    return tracking.tracking_report(i.field_lineage().of_lake_table("agg.spark_ft_1"))


@query("l12_fallback")
def _(i: Inputs) -> DataFrame:
    """A lake table that no warehouse chain passes: its own scripts count."""
    return tracking.tracking_report(i.field_lineage().of_lake_table("mon.spark_ft_35"))


@query("l13_warehouse_tracking")
def _(i: Inputs) -> DataFrame:
    rows = i.field_lineage().of_warehouse(i.fields)
    return rows.withColumn("step", F.col("step").cast("long"))


@query("l13_of_tables")
def _(i: Inputs) -> DataFrame:
    """The warehouse tables that the report names; their letters are in another case there."""
    tables = report.dwh_tables(i.clean_report).select(F.lower("Table_RDMS").alias("dwh_table"))
    rows = i.field_lineage().of_warehouse(i.fields, tables)
    return rows.withColumn("step", F.col("step").cast("long"))


@query("l15_staged_tracking_report")
def _(i: Inputs) -> DataFrame:
    rows = tracking.staged_tracking_report(i.field_lineage().of_warehouse(i.fields))
    return rows.withColumn("Etape", F.col("Etape").cast("long"))


@query("j06_lake_fields")
def _(i: Inputs) -> DataFrame:
    rows = tracking.lake_fields(i.lineage().warehouse_chains(), scripts.ddl_profile(i.ddl))
    return rows.withColumn("fields", ordered("fields"))


@query("j07_chain_staging")
def _(i: Inputs) -> DataFrame:
    return tracking.chain_staging(i.lineage().warehouse_chains(), i.jobs)


@query("j12_field_map")
def _(i: Inputs) -> DataFrame:
    return tracking.field_map(i.jobs, i.fields)


@query("a07_catalog_fields")
def _(i: Inputs) -> DataFrame:
    return i.fields.withColumn("fields", ordered("fields"))


# --- dependency report -------------------------------------------------------------------------
@query("g07_cooccurrence")
def _(i: Inputs) -> DataFrame:
    return report.cooccurrence(i.clean_report)


@query("r01_external_tables")
def _(i: Inputs) -> DataFrame:
    return report.external_tables(i.clean_report)


@query("a18_external_totals")
def _(i: Inputs) -> DataFrame:
    return report.external_totals(report.external_tables(i.clean_report))


@query("r02_dependencies")
def _(i: Inputs) -> DataFrame:
    rows = report.dependencies(i.clean_report)
    return rows.withColumn("priority", F.col("priority").cast("long"))


@query("r03_users")
def _(i: Inputs) -> DataFrame:
    rows = report.users(i.clean_report)
    return rows.withColumn("priority", F.col("priority").cast("long"))


@query("r02_of_table")
def _(i: Inputs) -> DataFrame:
    rows = report.dependencies(i.clean_report, table="Agg.T_5")
    rows = report.in_logical_order(rows, "dep_name")
    return rows.withColumn("priority", F.col("priority").cast("long"))


@query("r05_of_table")
def _(i: Inputs) -> DataFrame:
    return report.diagnostic(i.clean_report, table="CDR.tt_3")


@query("r04_server_metadata")
def _(i: Inputs) -> DataFrame:
    return report.server_metadata(i.clean_report)


@query("r05_diagnostic")
def _(i: Inputs) -> DataFrame:
    return report.diagnostic(i.clean_report)


@query("r06_similar_tables")
def _(i: Inputs) -> DataFrame:
    rows = report.similar_tables(i.clean_report, report.parse_table_name("table mon.nowhere ?"))
    return rows.withColumn("priority", F.col("priority").cast("long"))


@query("r06_of_tables")
def _(i: Inputs) -> DataFrame:
    """Suggestions for every catalog table and every table that a script loads."""
    asked = i.fields.select(F.col("table_name").alias("asked")).unionByName(
        i.table_scripts.select(F.col("table").alias("asked"))
    )
    rows = report.suggestions(i.clean_report, asked)
    return rows.withColumn("priority", F.col("priority").cast("long"))


@query("r07_degrees")
def _(i: Inputs) -> DataFrame:
    return report.degrees(i.clean_report)


@query("a13_origins")
def _(i: Inputs) -> DataFrame:
    return report.origins(i.clean_report)


@query("a14_original_names")
def _(i: Inputs) -> DataFrame:
    return report.original_names(i.clean_report)


@query("a16_dwh_tables")
def _(i: Inputs) -> DataFrame:
    return report.dwh_tables(i.clean_report)


@query("o01_priorities")
def _(i: Inputs) -> DataFrame:
    rows = report.priorities(i.clean_report)
    return rows.withColumn("priority", F.col("priority").cast("long"))
