"""Process groups, processors and variables of ingestion-flow exports (nested JSON)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X
from wellspring.session import work_dir

VARIABLES = "try_variant_get(node, '$.variables', 'map<string,string>')"
PROCESSORS = (
    "try_variant_get(node, '$.processors',"
    " 'array<struct<identifier string, name string, scheduledState string>>')"
)


# One string may be longer than the parser allows by default; nesting stays limited to 1000 levels.
PARSER_OPTIONS = {"maxStringLen": str((1 << 31) - 1)}
MOST_LEVELS = 1000
#: Levels that one job descends.
BLOCK_LEVELS = 6


def _parsed(flows: DataFrame, json: str) -> DataFrame:
    doc = F.from_json(F.col(json), "variant", PARSER_OPTIONS)
    return flows.select("flow_id", F.col(json).alias("text"), doc.alias("doc"))


def _over_limit(text: Column) -> Column:
    """Is a text that gave no document well-bracketed, but nested too deep for the parser?"""
    return _nesting(text) > MOST_LEVELS


def parse_flows(flows: DataFrame, json: str = "json") -> DataFrame:
    """``flow_id, doc``: exports as VARIANT. Malformed ones give no row; well-bracketed ones that
    exceed the parser's limits fail the job instead of vanishing."""
    parsed = _parsed(flows, json)
    fail = F.raise_error(F.concat(F.lit("flow export over the parser's limits: "), F.col("flow_id").cast("string")))
    doc = F.when(F.col("doc").isNull() & _over_limit(F.col("text")), fail).otherwise(F.col("doc"))
    return parsed.select("flow_id", doc.alias("doc")).where(F.col("doc").isNotNull())


def flow_rejects(flows: DataFrame, json: str = "json") -> DataFrame:
    """``flow_id, reason`` of exports without a document: no text, not JSON, or over a limit."""
    lost = _parsed(flows, json).where(F.col("doc").isNull())
    reason = (
        F.when(F.col("text").isNull() | (F.trim("text") == ""), "no text")
        .when(_over_limit(F.col("text")), "over a limit")
        .otherwise("not JSON")
    )
    return lost.select("flow_id", reason.alias("reason"))


def _nesting(json: Column) -> Column:
    """Bracket depth of a JSON text, strings left out; 0 if its brackets do not pair up."""
    brackets = F.regexp_replace(
        F.regexp_replace(json, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', ""), r"[^\[\]{}]+", ""
    )
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"), F.lit(0).alias("low"))

    def step(acc: Column, bracket: Column) -> Column:
        now = acc["now"] + F.when(bracket.isin("{", "["), 1).when(bracket == "", 0).otherwise(-1)
        return F.struct(
            now.alias("now"),
            F.greatest(acc["top"], now).alias("top"),
            F.least(acc["low"], now).alias("low"),
        )

    paired = lambda acc: F.when((acc["now"] == 0) & (acc["low"] == 0), acc["top"]).otherwise(0)
    return F.aggregate(F.split(brackets, ""), zero, step, paired)


# Objects and arrays directly inside a node. Array items get a zero-padded index as key, so that
# sorting paths restores document order of siblings.
CHILDREN = """
filter(
  coalesce(
    transform(map_entries(try_variant_get(node, '$', 'map<string,variant>')),
              e -> struct(e.key AS key, e.value AS node)),
    transform(try_variant_get(node, '$', 'array<variant>'),
              (v, i) -> struct('[' || lpad(i, 9, '0') || ']' AS key, v AS node))),
  c -> schema_of_variant(c.node) RLIKE '^(OBJECT|ARRAY)')
"""


def walk(flows: DataFrame, keep: str, payload: str, json: str = "json") -> DataFrame:
    """``flow_id, path, payload`` for every object or array of an export that satisfies ``keep``.

    ``keep`` and ``payload`` are SQL expressions over ``node``; ``path`` is the array of keys from
    the root. One job descends ``BLOCK_LEVELS`` levels by as many generators, whatever the data, and
    writes what it found and the subtrees still open; the next job goes on from those. Documents
    are spread over the cluster again once the top levels are split, as one export may hold most
    groups.
    """
    spark = flows.sparkSession
    root = parse_flows(flows, json).selectExpr(
        "flow_id", "cast(array() AS array<string>) AS path", "doc AS node"
    )
    kind = root.selectExpr(f"{payload} AS p").schema["p"].dataType.simpleString()
    row = f"struct<path:array<string>,node:variant,payload:{kind}>"
    step = f"""
        inline(
          CASE WHEN node IS NULL THEN array(struct(path, node, payload))
          ELSE concat(
            CASE WHEN {keep}
              THEN array(cast(struct(path, cast(NULL AS variant), {payload}) AS {row}))
              ELSE cast(array() AS array<{row}>) END,
            transform(
              coalesce({CHILDREN}, cast(array() AS array<struct<key:string,node:variant>>)),
              c -> cast(struct(array_append(path, c.key), c.node, NULL) AS {row})))
          END)
    """
    base, block, opened = work_dir(spark), 0, root
    while True:
        nodes = opened.withColumn("payload", F.lit(None).cast(kind))
        for level in range(BLOCK_LEVELS):
            if block == 0 and level == 3:
                nodes = nodes.hint("rebalance")
            nodes = nodes.selectExpr("flow_id", step)
        nodes.write.parquet(f"{base}/block={block}")
        stored = spark.read.schema(nodes.schema).parquet(f"{base}/block={block}")
        opened = stored.where("node IS NOT NULL").select("flow_id", "path", "node")
        if opened.isEmpty():
            break
        block += 1
    found = spark.read.schema(nodes.schema).option("basePath", base).parquet(base)
    return found.where("node IS NULL").select("flow_id", "path", "payload")


def _has(key: str) -> str:
    """Does the node hold the key? A JSON null counts as held."""
    return f"try_variant_get(node, '{_json_path(key)}', 'variant') IS NOT NULL"


def _text(key: str) -> str:
    return f"try_variant_get(node, '{_json_path(key)}', 'string')"


def _json_path(key: str) -> str:
    if re.search(r"""['"\\\]]""", key):
        raise ValueError(f"unsupported JSON key {key!r}")
    return f'$["{key}"]'


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_of_key(flows: DataFrame, key: str) -> DataFrame:
    """``flow_id, path, value``: everything stored under a key, at any depth, as JSON text.

    ``path`` leads to the object that holds the key.
    """
    value = f"coalesce(to_json(try_variant_get(node, '{_json_path(key)}', 'variant')), 'null')"
    return walk(flows, _has(key), value).withColumnRenamed("payload", "value")


def objects_where(
    flows: DataFrame, key: str, value: str, payload: str = "to_json(node)"
) -> DataFrame:
    """``flow_id, path, payload``: every object whose ``key`` is ``value``."""
    return walk(flows, f"{_text(key)} = {_sql_text(value)}", payload)


def objects_having(flows: DataFrame, key: str, payload: str = "to_json(node)") -> DataFrame:
    """``flow_id, path, payload``: every object that has the key."""
    return walk(flows, _has(key), payload)


def infer_schema(flows: DataFrame) -> DataFrame:
    """``schema``: one type that fits all exports."""
    return parse_flows(flows).agg(F.schema_of_variant_agg("doc").alias("schema"))


def schema_paths(flows: DataFrame) -> DataFrame:
    """``json_path, type``: every key path (``[*]`` for array items) with the types seen there."""

    def typed(value: str) -> str:
        return f"""
            CASE regexp_extract(schema_of_variant({value}), '^[A-Z]+', 0)
              WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'STRING' THEN 'string'
              WHEN 'BOOLEAN' THEN 'boolean' WHEN 'BIGINT' THEN 'integer' WHEN 'VOID' THEN 'null'
              ELSE 'number' END"""

    entries = f"""
        array_distinct(coalesce(
          transform(map_entries(try_variant_get(node, '$', 'map<string,variant>')),
                    e -> struct('.' || e.key AS step, {typed("e.value")} AS type)),
          transform(try_variant_get(node, '$', 'array<variant>'),
                    v -> struct('[*]' AS step, {typed("v")} AS type))))"""
    above = F.transform(
        "path", lambda k: F.when(k.rlike(r"^\[\d+\]$"), "[*]").otherwise(F.concat(F.lit("."), k))
    )
    return (
        walk(flows, "true", entries)
        .select(F.array_join(above, "").alias("above"), F.inline("payload"))
        .select(F.concat(F.lit("$"), "above", "step").alias("json_path"), "type")
        .distinct()
    )


def group_index(flows: DataFrame) -> DataFrame:
    """``flow_id, path, name, identifier`` of objects that hold process groups."""
    held = walk(
        flows,
        f"{_has('processGroups')} AND {_has('identifier')}",
        f"struct({_text('name')} AS name, {_text('identifier')} AS identifier)",
    )
    return held.select("flow_id", "path", "payload.name", "payload.identifier")


def processors(flows: DataFrame) -> DataFrame:
    """``group_name, processor_name, version``: distinct processors of objects with groups."""
    listed = f"""
        struct({_text("name")} AS group_name,
          transform(
            filter(try_variant_get(node, '$.processors', 'array<variant>'),
                   p -> try_variant_get(p, '$.name', 'variant') IS NOT NULL
                        AND try_variant_get(p, '$.bundle', 'variant') IS NOT NULL),
            p -> struct(try_variant_get(p, '$.name', 'string') AS processor_name,
                        try_variant_get(p, '$.bundle.version', 'string') AS version)) AS items)"""
    return (
        objects_having(flows, "processGroups", listed)
        .select("payload.group_name", F.inline("payload.items"))
        .distinct()
    )


def _group_summary(key: str, value: str) -> str:
    """Processor counts of a node, NULL unless ``key = value`` and it has a processor list.

    ``nb_list_disabled`` counts disabled processors of groups whose first processor lists files.
    """

    def in_state(state: str) -> str:
        return f"size(filter({PROCESSORS}, p -> p.scheduledState = '{state}'))"

    name = f"try_element_at({PROCESSORS}, 1).name"
    return f"""
        CASE WHEN {_text(key)} = {_sql_text(value)} AND {PROCESSORS} IS NOT NULL THEN struct(
          {_text("groupIdentifier")} AS groupIdentifier,
          size({PROCESSORS}) AS nb_processors,
          {in_state(P.DISABLED)} AS nb_disabled,
          {in_state(P.ENABLED)} AS nb_enabled,
          {name} AS name,
          CASE WHEN {name} = '{P.LISTING_PROCESSOR}' THEN {in_state(P.DISABLED)} ELSE 0 END
            AS nb_list_disabled) END"""


def _variables_in_force(v: str, own: Column, owner: Column) -> list[Column]:
    """Aggregates that settle each flow variable of a group.

    Variables of nested objects count for every object above them; a group's own variables beat
    nested ones, and among nested ones the later path wins.
    """
    order = F.struct(own.alias("own"), owner.alias("owner"))

    def last(present: Column, value: Column) -> Column:
        return F.max_by(F.when(present, F.struct(value.alias("x"))), F.when(present, order))["x"]

    def has(name: str) -> Column:
        return F.map_contains_key(v, name)

    def get(name: str) -> Column:
        return F.try_element_at(v, F.lit(name))

    staging = F.when(has(P.VAR_REMOTE_PATH), get(P.VAR_REMOTE_PATH)).otherwise(
        get(P.VAR_STAGING_FINAL)
    )
    raw = F.coalesce(get(P.VAR_FILE_DIR), get(P.VAR_RAW_DIR))
    return [
        last(has(P.VAR_REMOTE_PATH) | has(P.VAR_STAGING_FINAL), staging).alias("staging"),
        last(has(P.VAR_FILE_DIR) | has(P.VAR_RAW_DIR), raw).alias("rep_raw"),
        *[last(has(v_), get(v_)).alias(name) for name, v_ in P.SIMPLE_VARIABLES.items()],
    ]


def process_groups(
    flows: DataFrame, key: str = "componentType", value: str = "PROCESS_GROUP"
) -> DataFrame:
    """One summary row per object with ``key = value`` and a processor list.

    One walk keeps groups and variable sets. A set is handed to the objects above it (as many rows
    as it is deep) and everything is folded by (flow, object) with partial aggregation, so the root
    of a huge export is no hot group.
    """
    nodes = walk(
        flows,
        f"{VARIABLES} IS NOT NULL OR ({_text(key)} = {_sql_text(value)} AND {PROCESSORS} IS NOT NULL)",
        f"struct({_group_summary(key, value)} AS summary, {VARIABLES} AS v)",
    ).select("flow_id", F.col("path").alias("owner"), "payload.*")
    above = F.transform(
        F.sequence(F.lit(0), F.size("owner")), lambda n: F.slice("owner", F.lit(1), n)
    )
    own = F.col("path") == F.col("owner")
    return (
        nodes.withColumn(
            "path", F.explode(F.when(F.col("v").isNull(), F.array("owner")).otherwise(above))
        )
        .groupBy("flow_id", "path")
        .agg(
            F.max(F.when(own, F.col("summary"))).alias("summary"),
            *_variables_in_force("v", own, F.col("owner")),
        )
        .where(F.col("summary").isNotNull())
        .select(
            "flow_id",
            "path",
            "summary.groupIdentifier",
            "summary.nb_processors",
            "summary.nb_disabled",
            "summary.nb_enabled",
            "staging",
            "rep_raw",
            "subdir",
            "port",
            "flux_name",
            "ip_adress",
            "username",
            "summary.name",
            "summary.nb_list_disabled",
            "regex",
        )
    )


def group_report(groups: DataFrame) -> DataFrame:
    """Distinct group rows, one per subdirectory."""
    subdirs = F.split(F.coalesce("subdir", F.lit(P.NO_SUBDIR)), ";")
    return groups.select(
        "groupIdentifier",
        "nb_processors",
        "nb_disabled",
        "staging",
        "rep_raw",
        F.explode(F.transform(subdirs, X.strip)).alias("subdir"),
        "port",
        "flux_name",
    ).distinct()
