"""Golden and property cases for dependencies, chains, flows and matching."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from wellspring.operators import chains, deps, flows, match


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "target string, dep string")


def paths(df):
    return sorted(">".join(r.path) for r in df.collect())


def labelled(df):
    shown = chains.display_path(F.col("path"), F.col("is_cycle"))
    return sorted(">".join(r[0]) for r in df.select(shown).collect())


def targets_of(graph):
    return graph.select("target").distinct()


def test_cycle(spark):
    graph = edges(spark, ("A", "B"), ("B", "C"), ("C", "A"), ("B", "D"))
    pairs = spark.createDataFrame([("W", "A")], "dwh_table string, lake_table string")
    assert paths(chains.warehouse_chains(pairs, graph)) == ["W>A", "W>A>B>D"]
    lake = chains.lake_chains(graph, targets_of(graph), ["A", "UNKNOWN"])
    assert labelled(lake) == ["A>B>C>A (cycle détecté)", "A>B>D"]


def test_leaf_root_and_warehouse_name_in_lake(spark):
    graph = edges(spark, ("H", "W"), ("K", "L"))
    pairs = spark.createDataFrame([("W", "H"), ("W", "Z")], "dwh_table string, lake_table string")
    assert paths(chains.warehouse_chains(pairs, graph)) == ["W>H", "W>H>W", "W>Z"]


def test_only_cycles_leave_the_pair(spark):
    graph = edges(spark, ("A", "B"), ("B", "A"))
    pairs = spark.createDataFrame([("W", "A")], "dwh_table string, lake_table string")
    assert paths(chains.warehouse_chains(pairs, graph)) == ["W>A"]


def test_empty_graph(spark):
    graph = edges(spark, ("A", "B")).where("false")
    pairs = spark.createDataFrame([("W", "A")], "dwh_table string, lake_table string").where("false")
    found = chains.warehouse_chains(pairs, graph)
    assert found.count() == 0
    attrs = spark.createDataFrame(
        [], "target string, raw_directory string, cdr_name string, tt_directory string, seen string"
    )
    assert chains.wide_chain_report(found, attrs).count() == 0


def brute_force(graph, root):
    found, stack = [], [(root,)]
    while stack:
        path = stack.pop()
        nexts = graph.get(path[-1], ())
        if not nexts:
            found.append(path)
        for n in nexts:
            if n in path:
                found.append(path + (n + " (cycle détecté)",))
            else:
                stack.append(path + (n,))
    return found


def test_random_graph_with_hub_against_brute_force(spark):
    rng = random.Random(7)
    nodes = [f"T{n}" for n in range(14)]
    pairs = {(a, "T0") for a in nodes[1:]} | {
        (rng.choice(nodes), rng.choice(nodes)) for _ in range(16)
    }
    pairs = {(a, b) for a, b in pairs if a != b}
    graph = {}
    for a, b in pairs:
        graph.setdefault(a, []).append(b)
    expected = sorted(">".join(p) for root in graph for p in brute_force(graph, root))
    table = edges(spark, *pairs)
    found = chains.lake_chains(table, targets_of(table))
    assert labelled(found) == expected
    reached = {tuple(s) for r in found.collect() for s in itertools.pairwise(r.path)}
    assert reached == pairs


JOBS = (
    "conf_path string, pre_exec array<string>, exec array<string>, raw_directory string, "
    "tt_directory string, cdr_tt string, staging_table_dwh string, dwh_table string"
)


def test_first_conf_decides_attributes(spark):
    jobs = spark.createDataFrame(
        [
            ("/c/b", [], ["/s/1"], "/raw/b", None, "C.X", None, None),
            ("/c/a", ["/s/1"], ["/s/2"], "/raw/a", "/tt/a", "C.X", None, None),
            ("/c/z", [], ["/s/3", "/s/missing"], "/raw/z", None, "C.X", None, None),
        ],
        JOBS,
    )
    io = spark.createDataFrame(
        [("/s/1", "T.A", ["D.A"]), ("/s/2", "T.B", ["D.A", "D.B"]), ("/s/3", "T.C", [])],
        "path string, target string, sources array<string>",
    )
    attrs = {r.target: r.raw_directory for r in deps.table_attrs(jobs, io).collect()}
    assert attrs == {"T.A": "/raw/a", "T.B": "/raw/a", "T.C": "/raw/z"}
    raws = deps.table_attrs(jobs, io)
    assert deps.raw_of_external(raws, "last").first().raw_directory == "/raw/z"
    assert deps.raw_of_external(raws, "first").first().raw_directory == "/raw/a"
    missing = deps.job_io(jobs, io).where("script_path = '/s/missing'").first()
    assert (missing.target, missing.sources) == (None, None)


def flow(spark, *docs):
    rows = [(n, d if isinstance(d, str) else json.dumps(d)) for n, d in enumerate(docs)]
    return spark.createDataFrame(rows, "flow_id int, json string")


def group(name, variables=None, processors=(), groups=(), **extra):
    doc = {"componentType": "PROCESS_GROUP", "name": name, "processGroups": list(groups)}
    doc["processors"] = [
        {"identifier": f"{name}{n}", "name": p, "scheduledState": s, "bundle": {"version": "1"}}
        for n, (p, s) in enumerate(processors)
    ]
    if variables is not None:
        doc["variables"] = variables
    return doc | extra


def test_own_variables_beat_nested_ones(spark):
    inner = group("in", {"flux.name": "y", "flux.sftp.port": "9", "flux.hdfs.raw": "/r"})
    later = group("in2", {"flux.sftp.port": "10"})
    outer = group(
        "out",
        {"flux.name": "x", "flux.stagging.final": "f"},
        [("List Files", "DISABLED"), ("Put", "DISABLED"), ("Put", "ENABLED")],
        [inner, later],
        groupIdentifier="g",
    )
    rows = {tuple(r.path): r for r in flows.process_groups(flow(spark, {"flowContents": outer})).collect()}
    top = rows[("flowContents",)]
    assert (top.flux_name, top.port, top.staging, top.rep_raw) == ("x", "10", "f", "/r")
    assert (top.nb_processors, top.nb_disabled, top.nb_enabled, top.nb_list_disabled) == (3, 2, 1, 2)
    assert rows[("flowContents", "processGroups", "[000000000]")].flux_name == "y"


def test_json_null_counts_as_present(spark):
    doc = group("g", {"flux.sftp.remote-path": None, "flux.stagging.final": "f", "flux.hdfs.filedir": None, "flux.hdfs.raw": "/r"})
    row = flows.process_groups(flow(spark, doc)).first()
    assert (row.staging, row.rep_raw) == (None, "/r")
    assert flows.values_of_key(flow(spark, {"a": [{"k": None}, {"k": [1, {"k": 2}]}]}), "k").count() == 3


def test_malformed_export_gives_no_row(spark):
    assert flows.parse_flows(flow(spark, "{oops", {"a": 1})).count() == 1
    assert flows.schema_paths(flow(spark, "{oops")).count() == 0


def test_bad_exports_are_reported_and_harm_nothing(spark):
    texts = ["[" * 400, "[" * 5000, '{"a": [{"b": 1}]}', "7", "", None, "[" * 300 + "]" * 300]
    exports = spark.createDataFrame(list(enumerate(texts)), "flow_id int, json string")
    found = flows.walk(exports, "true", "1").groupBy("flow_id").count().collect()
    assert {r.flow_id: r["count"] for r in found} == {2: 3, 3: 1, 6: 300}
    lost = {r.flow_id: r.reason for r in flows.flow_rejects(exports).collect()}
    assert lost == {0: "not JSON", 1: "not JSON", 4: "no text", 5: "no text"}


def test_exports_over_a_limit_fail(spark):
    deep = spark.createDataFrame([(1, "[" * 1500 + "]" * 1500)], "flow_id int, json string")
    assert [r.reason for r in flows.flow_rejects(deep).collect()] == ["over a limit"]
    with pytest.raises(Exception, match="over the parser's limits"):
        flows.parse_flows(deep).collect()


def test_long_strings_are_kept(spark):
    text = spark.range(1).selectExpr("1 AS flow_id", "concat('{\"k\":\"', repeat('x', 20 << 20), '\"}') AS json")
    found = flows.values_of_key(text, "k").selectExpr("length(value) AS n").collect()
    assert [r.n for r in found] == [(20 << 20) + 2]


def test_schema_types(spark):
    rows = flows.schema_paths(flow(spark, {"a": [1, "x", {"b": True}], "c": None, "d": 1.5})).collect()
    assert {(r.json_path, r.type) for r in rows} == {
        ("$.a", "array"),
        ("$.a[*]", "integer"),
        ("$.a[*]", "string"),
        ("$.a[*]", "object"),
        ("$.a[*].b", "boolean"),
        ("$.c", "null"),
        ("$.d", "number"),
    }


GROUPS = (
    "flow_id int, path array<string>, staging string, flux_name string, nb_processors int, "
    "nb_disabled int, rep_raw string, subdir string, ip_adress string, username string, "
    "port string, nb_list_disabled int, regex string"
)


def a_group(n, flux="F", rep_raw="/PROD/RAW/D1", subdir="S1", listing=0, disabled=0, port="22"):
    return (n, [str(n)], f"srv{n}", flux, 4, disabled, rep_raw, subdir, "h", "u", port, listing, None)


def matches(spark, raws, groups):
    raw = spark.createDataFrame([(r,) for r in raws], "raw_path string")
    found = match.flow_matches(raw, spark.createDataFrame(groups, GROUPS)).collect()
    return sorted((r.raw_path, r.flux_name, r.server) for r in found)


RAW = "/PROD/RAW/D1/S1/m*"


def test_raw_path_is_cut_at_the_first_blank(spark):
    assert matches(spark, [RAW + " extra"], [a_group(1)]) == [(RAW, "F", "srv1")]


def test_best_match(spark):
    assert matches(spark, [RAW], [a_group(2), a_group(1), a_group(3, listing=1)]) == [(RAW, "F", "srv1")]
    assert matches(spark, [RAW], [a_group(1, listing=2), a_group(3, listing=1)]) == [(RAW, "F", "srv3")]


def test_mostly_disabled_or_subdirless_groups_do_not_match(spark):
    assert matches(spark, [RAW], [a_group(1, disabled=4), a_group(2, subdir=None), a_group(3, subdir="")]) == []


def test_other_raw_dir_needs_the_first_subdir(spark):
    other = "/PROD/RAW/D2"
    assert matches(spark, [RAW], [a_group(1, rep_raw=other, subdir="S2;S1")]) == []
    assert matches(spark, [RAW], [a_group(1, rep_raw=other, subdir="S1;S2")]) == [(RAW, "F", "srv1")]
    assert matches(spark, [RAW], [a_group(1, subdir="S2;S1")]) == [(RAW, "F", "srv1")]


def test_matches_against_brute_force(spark):
    rng = random.Random(3)
    dirs, subs = ["/PROD/RAW/D1", "/PROD/RAW/D2", "/PROD/RAW/D3", None], ["S1", "S2", "S3"]
    groups = [
        a_group(
            n,
            flux=rng.choice("FG"),
            rep_raw=rng.choice(dirs),
            subdir=";".join(rng.sample(subs, rng.randint(1, 3))),
            listing=rng.randint(0, 2),
        )
        for n in range(40)
    ]
    raws = [f"{d}/{s}/x" for d in dirs if d for s in subs]
    best = {}
    for raw in raws:
        for g in groups:
            base, sub, listed = raw.rsplit("/", 2)[0], raw.split("/")[-2], g[7].split(";")
            if sub in listed if g[6] == base else sub == listed[0]:
                key = (raw, g[3])
                best[key] = min(best.get(key, (9, 999)), (g[11], g[0]))
    expected = sorted((raw, flux, f"srv{n}") for (raw, flux), (_, n) in best.items())
    assert matches(spark, raws, groups) == expected


MATCHES = (
    "raw_path string, flux_name string, server string, nb_processors int, "
    "nb_disabled_processors int, ip_adress string, username string, port string, "
    "nb_list_disabled int, regex string"
)
ATTRS = "target string, raw_directory string, cdr_name string, tt_directory string, seen string"


def test_every_server_keeps_its_own_port(spark):
    attrs = spark.createDataFrame([("T", RAW + " x", "C.X", None, "1")], ATTRS)
    found = spark.createDataFrame(
        [(RAW, "F", "s1", 4, 0, "h", "u", "1", 0, None), (RAW, "G", "s2", 4, 0, "h", "u", "2", 0, None)],
        MATCHES,
    )
    rows = spark.createDataFrame([("i", ["W", "H", "C.X"]), ("j", ["W", "H"])], "chain_id string, path array<string>")
    served = match.chain_servers(rows, attrs, found).collect()
    assert sorted((r.chain_id, r.server, r.port) for r in served if r.server) == [("i", "s1", "1"), ("i", "s2", "2")]
    lists = found.where("flux_name = 'F'").withColumn("server", F.array(F.lit("a"), F.lit("b")))
    served = match.chain_servers(rows, attrs, lists).where("server is not null").collect()
    assert sorted(r.server for r in served) == ["a", "b"]


def test_servers_of_all_raw_directories(spark):
    attrs = spark.createDataFrame([("T", "/r/1", "C.X", None, "1"), ("U", "/r/2", "C.X", None, "2"), ("V", "/r/3", "C.Y", None, "3")], ATTRS)
    found = spark.createDataFrame([("/r/1", "F", "s1", 4, 0, "h", "u", "1", 0, None)], MATCHES)
    rows = {(r.cdr_name, r.raw_path, r.server) for r in match.external_servers(attrs, found).collect()}
    assert rows == {("C.X", "/r/1", "s1"), ("C.Y", "/r/3", None)}
