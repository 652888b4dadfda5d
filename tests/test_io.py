"""Sources, sinks and report questions."""

import gzip
import json
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wellspring.operators import catalog, flows, report
from wellspring.plans import registry
from wellspring.session import materialize, work_dir
from wellspring.sources import catalog as catalogs
from wellspring.sources import corpus, report_csv, sinks


def test_corpus_is_recursive_and_decodes(spark, tmp_path):
    (tmp_path / "a b" / "c+d").mkdir(parents=True)
    (tmp_path / "a b" / "one.hql").write_text("é\nFROM a.b", encoding="utf-8")
    (tmp_path / "a b" / "c+d" / "two.hql").write_bytes("é".encode("latin-1"))
    utf8 = {r.path: r.content for r in corpus.read_files(spark, str(tmp_path)).collect()}
    assert utf8[f"{tmp_path}/a b/one.hql"] == "é\nFROM a.b"
    latin = {r.path: r.content for r in corpus.read_files(spark, str(tmp_path), "ISO-8859-1").collect()}
    assert latin[f"{tmp_path}/a b/c+d/two.hql"] == "é"
    assert corpus.list_files(spark, str(tmp_path)).count() == 2


@pytest.mark.parametrize("charset", ["UTF-8", "ISO-8859-1"])
def test_scripts_are_files_without_folders_of_their_own(spark, tmp_path, monkeypatch, charset):
    monkeypatch.setattr(registry, "work_dir", lambda _: f"file://{tmp_path}/out")
    inputs = registry.Inputs(spark, "/root/testdata/sf0.001")
    read = registry._written_out(inputs, charset).collect()
    files = [f for f in (tmp_path / "out").rglob("*") if f.is_file()]
    assert len(files) == len({r.k for r in read}) == len(read) == inputs.scripts.count()
    assert {f.read_bytes().decode(charset) for f in files} == {r.content for r in read}
    assert sum(f.is_dir() for f in (tmp_path / "out").rglob("*")) <= 1 + len(files) // 1000


ODD_FILES = {
    "a.hql": b"one", "b.txt": b"two \xc3\xa9", "c d+e/1%.hql": b"three\r\n", "c d+e/f/g/h.hql": b"\xe9 four",
    "empty.hql": b"", ".hidden.hql": b"x", "_x.hql": b"x", "_k=1.hql": b"five", "_metadata": b"m", "x._COPYING_": b"x",
    "_folder/i.hql": b"x", ".folder/j.hql": b"x", "_k=2/l.hql": b"six", "B.HQL": b"seven", "bom.hql": b"\xef\xbb\xbfeight",
}


@pytest.mark.parametrize("charset", ["UTF-8", "ISO-8859-1"])
@pytest.mark.parametrize("glob", [None, "*.hql", "{a,b}.[ht]*", "?.hql"])
@pytest.mark.parametrize("listed", [1, 10_000])
def test_files_listed_by_tasks_are_those_of_the_file_source(spark, tmp_path, monkeypatch, charset, glob, listed):
    monkeypatch.setattr(corpus, "LISTED", listed)
    root = tmp_path / "r"
    for name, content in ODD_FILES.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    (root / "no").mkdir()
    (root / "link.hql").symlink_to(root / "a.hql")
    (root / "lost.hql").symlink_to(root / "nothing")
    (root / "linked").symlink_to(root / "c d+e")
    rows = lambda files: sorted((r.path, bytes(r.content)) for r in files.withColumn("content", F.col("content").cast("binary")).collect())
    got = [rows(corpus.read_files(spark, start + str(root), charset, glob)) for start in ("", "file:", "file://")]
    assert got[0] and got[0] == got[1] == got[2]
    monkeypatch.setattr(corpus, "_local_folder", lambda *_: None)
    assert got[0] == rows(corpus.read_files(spark, str(root), charset, glob))


@pytest.mark.parametrize("charset", ["UTF-8", "ISO-8859-1"])
def test_the_driver_lists_no_files(spark, tmp_path, charset):
    (tmp_path / "x").mkdir()
    for i in range(5):
        (tmp_path / "x" / f"{i}.hql").write_bytes(b"x")
    files = corpus.read_files(spark, str(tmp_path), charset, glob="*.hql")
    assert files.count() == 5
    assert not [f for f in files.inputFiles() if f.endswith(".hql")]


def test_compressed_texts_and_odd_roots_are_read_by_the_file_source(spark, tmp_path):
    (tmp_path / "a.hql.gz").write_bytes(gzip.compress(b"FROM a.b"))
    assert [r.content for r in corpus.read_files(spark, str(tmp_path)).collect()] == ["FROM a.b"]
    (tmp_path / "b.hql").write_bytes(b"one")
    assert [r.content for r in corpus.read_files(spark, f"{tmp_path}/*.hql").collect()] == ["one"]
    assert [r.content for r in corpus.read_files(spark, f"{tmp_path}/b.hql", "ISO-8859-1").collect()] == ["one"]
    with pytest.raises(AnalysisException):
        corpus.read_files(spark, f"{tmp_path}/none")
    (tmp_path / "bare").mkdir()
    assert corpus.read_files(spark, f"{tmp_path}/bare").count() == 0


def test_files_of_any_content(spark, tmp_path):
    rows = [("a b/1%.x", bytearray(b"\xe9\r\n")), ("2.x", bytearray(b"")), ("a b/c/3.x", None)]
    out = spark.createDataFrame(rows, "path string, content binary")
    for root in (f"{tmp_path}/o", f"file:{tmp_path}/o", f"file://{tmp_path}/o"):
        assert sinks.write_files(out, root) == 3
    assert (tmp_path / "o/a b/1%.x").read_bytes() == b"\xe9\r\n"
    assert (tmp_path / "o/2.x").read_bytes() == (tmp_path / "o/a b/c/3.x").read_bytes() == b""
    assert sorted(p.name for p in tmp_path.iterdir()) == ["o"]


def test_flow_exports(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"processGroups": [], "identifier": "i", "name": "é", "x": [1, {"a, {": None}]}, indent=4, ensure_ascii=False))
    (tmp_path / "b.json").write_text("{broken")
    exports = corpus.read_flow_exports(spark, str(tmp_path))
    row = flows.group_index(exports).collect()
    assert [(r.flow_id, r.name) for r in row] == [(f"{tmp_path}/a.json", "é")]
    out = str(tmp_path / "json")
    sinks.write_flow_json(exports, out)
    assert json.loads(spark.read.text(out).first().value) == json.loads((tmp_path / "a.json").read_text())


def test_field_dictionary_round_trip(spark, tmp_path):
    rows = [("MON", "B", "Y", 2), ("MON", "B", "X", 1), ("MON", "A", "Z", 1)]
    columns = spark.createDataFrame(rows, "owner string, table_name string, column_name string, column_id int")
    fields = catalog.catalog_fields(columns)
    sinks.write_field_dictionary(fields, str(tmp_path / "d"))
    back = catalogs.read_field_dictionary(spark, str(tmp_path / "d"), whole_file=False).collect()
    assert {r.table_name: r.fields for r in back} == {"MON.A": ["Z"], "MON.B": ["X", "Y"]}
    (tmp_path / "one.json").write_text(json.dumps({"M.T": ["A"], "M.U": []}, indent=4))
    whole = catalogs.read_field_dictionary(spark, str(tmp_path / "one.json")).collect()
    assert {r.table_name: r.fields for r in whole} == {"M.T": ["A"], "M.U": []}


def test_jdbc_slices():
    assert catalogs.jdbc_predicates("M'N", 1) == ["OWNER = 'M''N'"]
    assert catalogs.jdbc_predicates("MON", 2) == [
        "OWNER = 'MON' AND ORA_HASH(TABLE_NAME, 1) = 0",
        "OWNER = 'MON' AND ORA_HASH(TABLE_NAME, 1) = 1",
    ]


def test_lineage_sink(spark, tmp_path):
    rows = spark.createDataFrame([("a", ["x", "y"]), ("a", ["x", "y"])], "t string, l array<string>")
    sinks.write_lineage(rows, str(tmp_path / "c"), fmt="csv")
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()] == [("a", "x, y")]
    sinks.write_lineage(rows, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    with pytest.raises(ValueError):
        sinks.write_lineage(rows, str(tmp_path / "q"), fmt="xlsx")


def test_work_dir_is_fresh(spark):
    first, second = work_dir(spark), work_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert first != second and (not base or first.startswith(base))


CSV = """Table_RDMS;Table_Hive;Dep_datalake1;Dep_datalake2;Server;Port
 mon.a ;mon.h;CDR.x;;s1;1
MON.A;;cdr.x;agg.é; s2 ;
;mon.h;CDR.Y; ;;2
mon.b;mon.a;;;s1;1
"""


@pytest.fixture(scope="module")
def demo(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("report") / "r.csv"
    path.write_bytes(CSV.encode("latin-1"))
    return report_csv.read_report(spark, str(path))


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_report_cells_are_stripped(demo):
    first = demo.orderBy("row_id").first()
    assert (first.Table_RDMS, first.Dep_datalake2) == ("mon.a", None)
    assert "agg.é" in [r.Dep_datalake2 for r in demo.collect()]


def test_cooccurrence(demo):
    assert pairs(report.cooccurrence(demo), "src", "dep") == [
        ("cdr.x", "agg.é"),
        ("mon.a", "agg.é"),
        ("mon.a", "cdr.x"),
        ("mon.a", "mon.h"),
        ("mon.b", "mon.a"),
        ("mon.h", "cdr.x"),
        ("mon.h", "cdr.y"),
    ]


def test_names_and_priorities(demo):
    names = dict(pairs(report.original_names(demo), "table", "name"))
    assert names["mon.a"] == "mon.a" and names["cdr.x"] == "cdr.x"
    ranks = dict(pairs(report.priorities(demo), "table", "priority"))
    assert ranks == {"mon.a": 1, "mon.b": 1, "mon.h": 2, "cdr.x": 3, "cdr.y": 3, "agg.é": 3}


def test_external_tables_go_by_the_last_casing(demo):
    assert pairs(report.external_tables(demo), "Table_RDMS", "CDR") == [
        ("MON.A", ""),
        ("mon.a", ""),
        ("mon.b", ""),
    ]


def test_metadata_and_degrees(demo):
    facts = report.server_metadata(demo).where("table = 'mon.a'")
    assert pairs(facts, "attribute", "value") == [("Port", "1"), ("Server", "s1"), ("Server", "s2")]
    degrees = {r.table: (r.nb_dependencies, r.nb_users) for r in report.degrees(demo).collect()}
    assert degrees["mon.a"] == (3, 1) and degrees["cdr.y"] == (0, 1)


def test_questions_on_one_table(demo):
    deps = report.in_logical_order(report.dependencies(demo, table="Mon.A"), "dep_name")
    assert [(r.dep, r.tag) for r in deps.collect()] == [("mon.h", "Hive"), ("agg.é", "Datalake"), ("cdr.x", "Datalake")]
    assert pairs(report.users(demo, table="mon.a"), "user") == [("mon.b",)]
    sections = report.diagnostic(demo, table="mon.a").groupBy("section").count()
    assert dict(pairs(sections, "section", "count")) == {"origin": 2, "dependency": 3, "user": 1, "Server": 2, "Port": 1}
    assert report.parse_table_name("show MON.nope please") == "mon.nope"
    assert report.parse_table_name("nothing") is None
    similar = report.similar_tables(demo, "mon.nope", limit=2)
    assert [r.name for r in similar.collect()] == ["mon.a", "mon.b"]
    assert report.similar_tables(demo, "mon.a").count() == 0


def test_report_round_trip(demo, spark, tmp_path):
    report_csv.write_report_csv(demo.drop("row_id"), str(tmp_path / "r"))
    assert report_csv.read_report(spark, str(tmp_path / "r")).count() == 4


def test_report_from_folders(spark, tmp_path):
    from wellspring import corpora
    from wellspring.plans import table_lineage

    sf = "/root/testdata/sf0.001"
    load = lambda sql: corpora.load(spark, sf, sql).collect()
    scripts, confs, exports = load(corpora.SCRIPTS), load(corpora.CONFS), load(corpora.FLOWS)
    roots = {}
    for name, rows in (("scripts", scripts), ("confs", confs)):
        roots[name] = tmp_path / name
        for row in rows:
            path = roots[name] / row.path.lstrip("/")
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(row.content)
    roots["flows"] = tmp_path / "flows"
    roots["flows"].mkdir()
    for row in exports:
        (roots["flows"] / f"{row.flow_id}.json").write_text(row.json)
    (roots["flows"] / "broken.json").write_text("{")
    found = table_lineage.report_from_folders(
        spark, str(roots["confs"]), str(roots["scripts"]), str(roots["flows"])
    )
    frames = [corpora.load(spark, sf, sql) for sql in (corpora.CONFS, corpora.SCRIPTS, corpora.FLOWS)]
    want = table_lineage.server_report(*frames)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_wide_reports_give_short_plans(spark):
    """Co-occurrence of 200 columns: the plan grows with columns, not with pairs of them."""

    def wide(n):
        names = ["Table_RDMS", "Table_Hive", *(f"Dep_datalake{i}" for i in range(1, n - 1))]
        row = tuple(f"T{i}" if i % 3 else None for i in range(n))
        return spark.createDataFrame([row, row], ", ".join(f"{c} string" for c in names))

    def size(n):
        return len(report.cooccurrence(wide(n))._jdf.queryExecution().optimizedPlan().toString())

    assert size(200) < 3 * size(100)
    filled = [f"t{i}" for i in range(200) if i % 3]
    want = sorted((a, b) for k, a in enumerate(filled) for b in filled[k + 1 :])
    assert pairs(report.cooccurrence(wide(200)), "src", "dep") == want


def test_replaced_rows_and_an_interrupted_write(spark, tmp_path):
    path = str(tmp_path / "sink")
    with pytest.raises(ValueError):
        sinks.read_rows(spark, path)

    def write(*rows):
        sinks.replace_rows(spark.createDataFrame(list(rows), "target string, dep string"), path, "target")

    def stored():
        return pairs(sinks.read_rows(spark, path), "target", "dep")

    write(("a", "x"), ("a", "y"), ("b", "x"))
    write(("a", "z"))
    assert stored() == [("a", "z"), ("b", "x")]
    write(("a", "z"))  # a second run
    assert stored() == [("a", "z"), ("b", "x")]
    broken = spark.range(4).select(
        F.lit("b").alias("target"),
        F.when(F.col("id") < 3, F.lit("new")).otherwise(F.raise_error(F.lit("lost"))).alias("dep"),
    )
    with pytest.raises(Exception, match="lost"):
        sinks.replace_rows(broken, path, "target")
    assert stored() == [("a", "z"), ("b", "x")]
    write(("b", "new"), ("c", "new"))
    assert stored() == [("a", "z"), ("b", "new"), ("c", "new")]


def test_suggestions_for_many_names(spark, demo):
    names = ["MON.nope", "mon.a", "o.x", "zzz.q", ".x", "agg.k", "cdr.none"]
    asked = spark.createDataFrame([(n,) for n in names * 2], "asked string")
    got = pairs(report.suggestions(demo, asked, limit=2), "asked", "name")
    want = [
        (name, r.name)
        for name in names
        if name not in (".x",)
        for r in report.similar_tables(demo, name, limit=2).collect()
    ]
    assert got == sorted(want) and ("o.x", "mon.a") in got


def test_a_written_step_leaves_no_shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {f.name for d in dirs for f in Path(d).rglob("shuffle_*")}

    before = shuffles()
    rows = spark.range(200_000).groupBy((F.col("id") * 7 % 100_003).alias("k")).count()
    written = materialize(rows)
    until = time.time() + 5
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert written.count() == 100_003
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
