"""Path enumeration against a plain recursion, with segments so short that paths have checkpoints."""

import random

import pytest
from pyspark.sql import functions as F

from wellspring.operators import chains, paths


def walked(edges, path, own_from, keep_cycles):
    deps = sorted({d for t, d in edges if t == path[-1]})
    if not deps:
        return [(path, False)]
    out = []
    for dep in deps:
        if dep in path[own_from - 1 :]:
            out += [([*path, dep], True)] if keep_cycles else []
        else:
            out += walked(edges, [*path, dep], own_from, keep_cycles)
    return out


def found(rows):
    return sorted((">".join(r.path), r.is_cycle) for r in rows.collect())


def graphs():
    draw = random.Random(4)
    names = "ABCDEFGH"
    for size in (3, 9, 13):
        yield [(draw.choice(names), draw.choice(names)) for _ in range(size)]
    line = [f"T{i}" for i in range(12)]
    yield [*zip(line, line[1:]), ("T11", "T2"), ("T5", "X"), ("T9", "T9")]


@pytest.mark.parametrize("number, segment", [(0, 2), (1, 3), (2, 2), (3, 3), (3, 16)])
def test_paths_equal_recursion(spark, monkeypatch, number, segment):
    monkeypatch.setattr(paths, "SEGMENT", segment)
    edges = list(graphs())[number]
    table = spark.createDataFrame(edges, "target string, dep string")
    roots = sorted({t for t, _ in edges})
    for own_from, keep in ((1, True), (2, False)):
        start = [["W", r] if own_from == 2 else [r] for r in roots]
        anchors = spark.createDataFrame([(p,) for p in start], "path array<string>")
        got = found(paths.Walk(table, own_from=own_from, keep_cycles=keep).paths(anchors))
        want = [(">".join(p), c) for s in start for p, c in walked(edges, s, own_from, keep)]
        assert got == sorted(want)


@pytest.mark.parametrize("number", [2, 3])
def test_chains_through_a_table_are_those_that_pass_it(spark, monkeypatch, number):
    monkeypatch.setattr(paths, "SEGMENT", 3)
    edges = list(graphs())[number]
    table = spark.createDataFrame(edges, "target string, dep string")
    names = sorted({n for e in edges for n in e})
    pairs = spark.createDataFrame([("W", n) for n in names[::2]], "dwh_table string, lake_table string")
    every = chains.warehouse_chains(pairs, table).select("path").collect()
    for asked in (names[-1], "NOWHERE"):
        got = chains.warehouse_chains(pairs, table, through=asked).select("path").collect()
        assert sorted(r.path for r in got) == sorted(r.path for r in every if asked in r.path[1:])


def test_only_reaching_tables_are_walked(spark):
    """Of a thousand anchors one leads to the asked table; no row is written for the others."""
    edges = spark.range(1000).select(
        F.concat(F.lit("A"), "id").alias("target"), F.concat(F.lit("B"), "id").alias("dep")
    )
    found_tables = paths.reaching(edges, "B7").collect()
    assert sorted(r.table for r in found_tables) == ["A7", "B7"]
    pairs = edges.select(F.lit("W").alias("dwh_table"), F.col("target").alias("lake_table"))
    got = chains.warehouse_chains(pairs, edges, through="B7")
    assert [r.path for r in got.collect()] == [["W", "A7", "B7"]]


def test_rows_of_a_depth_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(paths, "SEGMENT", 4)
    line = [f"T{i}" for i in range(30)]
    edges = spark.createDataFrame(list(zip(line, line[1:])), "target string, dep string")
    walk = paths.Walk(edges, keep_cycles=True)
    got = walk.paths(spark.createDataFrame([(["T0"],)], "path array<string>"))
    assert [r.path for r in got.collect()] == [line]
    sizes = [walk._read(d).select(F.max(F.size("segment"))).first()[0] for d, _ in walk.levels]
    assert len(sizes) == 30 and max(sizes) == 4


def test_empty_graph_and_no_anchors(spark):
    none = spark.createDataFrame([], "target string, dep string")
    anchors = spark.createDataFrame([(["A"],)], "path array<string>")
    assert found(paths.Walk(none, keep_cycles=True).paths(anchors)) == [("A", False)]
    assert found(paths.Walk(none).paths(anchors.limit(0))) == []
