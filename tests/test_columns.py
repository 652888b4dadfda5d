"""Golden cases for column lineage, field tracking and the plans behind them."""

from pyspark.sql import functions as F

from wellspring.operators import chains, projections, scripts, tokens, tracking


def items(spark, *texts, ddl=None):
    rows = [(f"/s/insert_{n}.hql", t) for n, t in enumerate(texts)]
    corpus = spark.createDataFrame(rows, "path string, content string")
    found = projections.projections(corpus, ddl).collect()
    return sorted(found, key=lambda r: (r.path, r.stmt_no, r.select_pos, r.item_no))


def test_nested_select(spark):
    rows = items(spark, "SELECT a.x, (SELECT MAX(q) FROM d.u) m FROM s.t a")
    assert [(r.alias, r.item_sql) for r in rows] == [
        ("x", "a.x"),
        ("m", "( SELECT MAX ( q ) FROM d.u ) m"),
        ("NO_ALIAS", "MAX ( q )"),
    ]
    assert [r.tables for r in rows] == [["d.u", "s.t"], ["d.u", "s.t"], ["d.u"]]
    assert rows[1].aggregations == ["MAX"]


def test_signs(spark):
    rows = items(spark, "SELECT COUNT(*), -1, a*b, c - -d, (e) % 2, *, t.* FROM s.t t")
    assert [r.arithmetic_ops for r in rows] == [[], [], ["*"], ["-"], ["%"], [], []]
    assert [r.alias for r in rows][-2:] == ["*", "*"]


def test_aliases(spark):
    sql = (
        "SELECT a AS `x y`, b z, CASE WHEN c THEN 1 END k, CAST(d AS string), f(e), DATE_ADD(g, 1) AS h, "
        "'lit' s, row_number() OVER (PARTITION BY i ORDER BY j) rn FROM m.t"
    )
    rows = items(spark, sql)
    assert [r.alias for r in rows] == ["x y", "z", "k", "NO_ALIAS", "NO_ALIAS", "h", "s", "rn"]
    assert [r.columns_used for r in rows] == [["A"], ["B"], ["C"], ["D"], ["E"], ["G"], [], ["I", "J"]]
    assert rows[0].formula_sql == "a"


def test_comments_quotes_and_statements(spark):
    sql = "-- SELECT no FROM no.no\nSELECT ';,(' AS a FROM s.t; /* SELECT x */ SELECT b FROM u.v -- end"
    rows = items(spark, sql)
    assert [(r.stmt_no, r.alias, r.tables) for r in rows] == [(0, "a", ["s.t"]), (1, "b", ["u.v"])]


def test_words_inside_functions_are_no_clauses(spark):
    rows = items(spark, "SELECT EXTRACT(DAY FROM d) x, a IS DISTINCT FROM b y FROM s.t WHERE 1 IN (SELECT 1 FROM u.w)")
    assert [(r.alias, r.columns_used, r.tables) for r in rows[:2]] == [
        ("x", ["D"], ["s.t", "u.w"]),
        ("y", ["A", "B"], ["s.t", "u.w"]),
    ]


def test_from_list_joins_and_lateral_view(spark):
    sql = "SELECT x FROM a.a p, b.b q JOIN c.c r ON p.k = r.k, `d`.`d` LEFT JOIN e.e ON 1=1 LATERAL VIEW explode(p.l) v AS x"
    assert items(spark, sql)[0].tables == ["a.a", "b.b", "c.c", "d.d", "e.e"]


def test_insert_with_cte_and_union(spark):
    sql = "INSERT INTO t.t PARTITION(d) WITH w AS (SELECT a FROM m.n) SELECT a FROM w UNION ALL SELECT b FROM o.p"
    assert [(r.alias, r.tables) for r in items(spark, sql)] == [
        ("a", ["m.n", "w"]),
        ("a", ["m.n"]),
        ("b", ["o.p"]),
    ]


def test_ddl_settles_bare_names(spark):
    ddl = spark.createDataFrame([("M.N", ["DEEP"])], "table_name string, fields array<string>")
    sql = "SELECT x FROM (SELECT deep, other, x FROM m.n) q"
    plain = {c for r in items(spark, sql) for c in r.columns_used}
    known = {c for r in items(spark, sql, ddl=ddl) for c in r.columns_used}
    assert plain == {"X", "deep", "other"}
    assert known == {"X", "DEEP", "other"}


def test_equal_scripts_keep_their_paths(spark):
    rows = items(spark, *["SELECT a FROM s.t"] * 3)
    assert [r.path for r in rows] == ["/s/insert_0.hql", "/s/insert_1.hql", "/s/insert_2.hql"]


def test_long_script(spark):
    sql = "SELECT " + ", ".join(f"f(c{n}) + {n} AS a{n}" for n in range(3000)) + " FROM s.t"
    rows = items(spark, sql)
    assert len(rows) == 3000 and rows[2999].alias == "a2999" and rows[7].columns_used == ["C7"]


def test_source_fields(spark):
    sql = "SELECT p.a, q.b, z FROM s.t p JOIN (SELECT b FROM u.v JOIN u.w ON 1=1) AS q ON p.k = q.k WHERE other.c = 1"
    corpus = spark.createDataFrame([("/s", sql)], "path string, content string")
    rows = {(r.table, r.field) for r in projections.source_fields(corpus).collect()}
    assert rows == {
        ("s.t", "a"),
        ("s.t", "k"),
        ("u.v", "b"),
        ("u.w", "b"),
        ("u.v", "k"),
        ("u.w", "k"),
        ("UNKNOWN_TABLE", "z"),
        ("other", "c"),
    }


def test_projections_shuffle_each_script_once(spark):
    corpus = spark.createDataFrame([("/s", "SELECT a FROM s.t")], "path string, content string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = projections.projections(corpus)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    below_join = plan[plan.index("Window") :]
    assert below_join.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


STEPS = "chain_id string, dwh_table string, lake_table string, position int, table string, script_path string"


def tracking_case(spark):
    corpus = spark.createDataFrame(
        [
            ("/s/insert_h", "INSERT INTO H.H SELECT r0, SUM(v + w) AS r1, 1 AS r2 FROM A.A GROUP BY r0"),
            ("/s/insert_a", "INSERT INTO A.A SELECT R0 FROM B.B"),
        ],
        "path string, content string",
    )
    steps = spark.createDataFrame(
        [
            ("c", "M.FT", "H.H", 1, "H.H", "/s/insert_h"),
            ("c", "M.FT", "H.H", 2, "A.A", "/s/insert_a"),
            ("d", "M.FT", "H.H", 1, "H.H", "/s/insert_h"),
            ("d", "M.FT", "H.H", 2, "B.B", None),
        ],
        STEPS,
    )
    return corpus, steps, projections.projections(corpus)


JOBS = "conf_path string, staging_table_dwh string, dwh_table string"
CATALOG = "table_name string, fields array<string>"


def test_warehouse_tracking(spark):
    corpus, steps, found = tracking_case(spark)
    jobs = spark.createDataFrame([("/c/1", "M.SQ", "m.ft"), ("/c/2", "M.NO", "m.ft")], JOBS)
    catalog = spark.createDataFrame(
        [("M.SQ", ["R0", "R1", "R2"]), ("M.FT", ["R0", "D1", "D2"]), ("M.NO", ["R1"])], CATALOG
    )
    fields = tracking.field_map(jobs, catalog)
    rows = tracking.warehouse_tracking(steps, found, fields, scripts.script_io(corpus)).collect()
    blank = [(r.dwh_field, r.alias) for r in rows if r.step is None]
    assert sorted(blank) == [("D1", "r1"), ("D2", "r2"), ("R0", "R0"), ("R0", "r0")]
    detail = [(r.step, r.path, r.computed_table, r.column, r.dwh_field) for r in rows if r.step is not None]
    assert sorted(detail) == [
        (1, "/s/insert_h", "H.H", "r0", "R0"),
        (2, "/s/insert_a", "A.A", "r0", "R0"),
    ]
    report = tracking.staged_tracking_report(
        tracking.warehouse_tracking(steps, found, fields, scripts.script_io(corpus), ["M.FT"])
    )
    assert [r["dwh_fields"] for r in report.collect()] == ["D1", "D2", "R0", "R0", "R0", "R0"]
    assert tracking.warehouse_tracking(steps, found, fields, scripts.script_io(corpus), ["X.X"]).count() == 0


def test_unequal_field_lists_are_not_mapped(spark):
    jobs = spark.createDataFrame([("/c/1", "M.SQ", "M.FT")], JOBS)
    catalog = spark.createDataFrame([("M.SQ", ["A", "B", "C"]), ("M.FT", ["A", "B"])], CATALOG)
    assert tracking.field_map(jobs, catalog).count() == 0


def test_lake_tracking_and_its_fallback(spark):
    _, steps, found = tracking_case(spark)
    files = spark.createDataFrame([("Z.Z", "Z.Z", None), ("Z.Z", "A.A", "/s/insert_a")], "target string, table string, path string")
    track = lambda name: tracking.lake_table_tracking(tracking.lake_table_paths(name, steps, files), found)
    whole = track("a.a").collect()
    assert {r.path for r in whole} == {"/s/insert_h", "/s/insert_a"}
    assert {r.column for r in whole} == {"r0", "v", "w", "no detected column"}
    direct = track("z.z").collect()
    assert {r.path for r in direct} == {"/s/insert_a"}
    assert track("q.q").count() == 0


def test_last_declaration_of_a_table_wins(spark):
    ddl = spark.createDataFrame([("/s/b", "H.H", ["B"]), ("/s/a", "H.H", ["A"])], "path string, table_name string, fields array<string>")
    rows = spark.createDataFrame([("c", "H.H"), ("d", "Q.Q")], "chain_id string, lake_table string")
    assert {r.chain_id: r.fields for r in tracking.lake_fields(rows, ddl).collect()} == {"c": ["B"], "d": []}


def test_chain_steps_keep_tables_without_script(spark):
    rows = spark.createDataFrame([("c", "W", "H", ["W", "H", "D"])], "chain_id string, dwh_table string, lake_table string, path array<string>")
    files = spark.createDataFrame([("H", "/s/1"), ("H", "/s/2")], "table string, path string")
    steps = chains.chain_steps(rows, files).collect()
    assert sorted((r.position, r.table, r.script_path or "") for r in steps) == [(1, "H", "/s/1"), (1, "H", "/s/2"), (2, "D", "")]


def test_partitions_hold_a_bounded_amount_of_text(spark, monkeypatch):
    monkeypatch.setattr(tokens, "TEXT_CHARS", 2_000)
    text = F.concat(F.lit("INSERT INTO m.t"), "id", F.lit(" SELECT a.x, SUM(a.y) z FROM s.u a GROUP BY a.x"))
    corpus = spark.range(2000).withColumn("id", F.col("id").cast("string"))
    corpus = corpus.select(F.concat(F.lit("/s/"), "id").alias("path"), text.alias("content"))
    placed = tokens.tokens(corpus.unionByName(corpus)).withColumn("part", F.spark_partition_id())
    sizes = placed.groupBy("part").agg(F.sum(F.length("tok")).alias("n")).collect()
    assert max(r.n for r in sizes) < 8_000
    assert placed.select("doc", "part").distinct().count() == 2000
