"""Golden cases for script and conf text."""

import pytest
from pyspark.sql import functions as F

from wellspring.functions import text as X
from wellspring.operators import confs, scripts


def corpus(spark, *texts):
    rows = [(f"/s/insert_{n}.hql", t) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "path string, content string")


def io(spark, sql, **options):
    row = scripts.script_io(corpus(spark, sql), **options).first()
    return row.target, row.sources


def test_commented_source(spark):
    sql = "-- FROM a.b\nINSERT INTO x.y SELECT 1 FROM c.d"
    assert io(spark, sql) == ("X.Y", ["C.D"])
    assert io(spark, sql, strip_comments=False) == ("X.Y", ["A.B", "C.D"])


def test_block_comment_over_lines(spark):
    assert io(spark, "INSERT INTO x.y SELECT 1 /* FROM a.b\n JOIN e.f */ FROM c.d") == ("X.Y", ["C.D"])


def test_insert_into_table(spark):
    sql = "INSERT INTO TABLE x.y PARTITION(d) SELECT 1 FROM a.b"
    assert scripts.insert_tokens(corpus(spark, sql)).first().token == "TABLE"
    assert io(spark, sql) == ("X.Y", ["A.B"])


def test_two_part_names_only(spark):
    assert io(spark, "SELECT 1 FROM a.b.c") == (None, ["A.B"])
    assert io(spark, "SELECT 1 FROM a.b, c.d") == (None, ["A.B"])
    assert io(spark, "INSERT OVERWRITE TABLE x.y SELECT 1 FROM a.b") == (None, ["A.B"])
    assert io(spark, "INSERT OVERWRITE TABLE x.y SELECT 1 FROM a.b", include_overwrite=True) == (
        "X.Y",
        ["A.B"],
    )


def test_own_table_is_no_source(spark):
    assert io(spark, "INSERT INTO x.y SELECT * FROM x.y JOIN z.w ON 1=1") == ("X.Y", ["Z.W"])


def test_no_break_space_separates(spark):
    sql = "INSERT INTO x.y SELECT 1 FROM" + chr(0xA0) + "a.b"
    assert io(spark, sql) == ("X.Y", ["A.B"])


def test_several_targets(spark):
    sql = "INSERT INTO a.b SELECT 1; insert into table c.d select 2; INSERT INTO a.b SELECT 3"
    rows = scripts.script_targets(corpus(spark, sql)).collect()
    assert sorted(r.target for r in rows) == ["A.B", "C.D"]


def test_empty_trim(spark):
    row = corpus(spark, "SELECT TRIM ( ) FROM a.b").select(X.clean_script(F.col("content"))).first()
    assert row[0] == "SELECT '' FROM a.b"


@pytest.mark.parametrize(
    "sql, expected",
    [
        (
            "CREATE TABLE IF NOT EXISTS m.t (a DECIMAL(10,2) COMMENT 'x, y', b MAP<STRING,INT>) "
            "PARTITIONED BY (d DATE) STORED AS ORC",
            ("M.T", ["A", "B"], "PARTITIONED BY (D DATE)", True),
        ),
        ("create table m.t (a int, b string) stored as parquet", ("M.T", ["A", "B"], None, False)),
        (
            "CREATE EXTERNAL TABLE IF NOT EXISTS c.t (a STRING) COMMENT 'q' ROW FORMAT DELIMITED "
            "FIELDS TERMINATED BY ';' LOCATION '/x'",
            ("C.T", ["A"], None, True),
        ),
        ("DROP TABLE m.t", (None, [], None, False)),
    ],
)
def test_ddl(spark, sql, expected):
    row = scripts.ddl_profile(corpus(spark, sql)).first()
    assert (row.table_name, row.fields, row.partitioned_by, row.if_not_exists) == expected


def test_statements_split_outside_quotes(spark):
    sql = "SELECT 'a;b' AS x FROM s.t; SELECT \"c;d\" FROM u.v;"
    rows = scripts.statement_profile(corpus(spark, sql)).orderBy("stmt_no").collect()
    assert [(r.stmt_no, r.table) for r in rows] == [(0, "s.t"), (1, "u.v")]


def test_long_script_does_not_exhaust_the_stack(spark):
    sql = "SELECT " + ", ".join(f"'v;{n}' AS c{n}" for n in range(20000)) + " FROM s.t"
    rows = scripts.statement_profile(corpus(spark, sql)).collect()
    assert len(rows) == 1 and len(rows[0].calculated_fields) == 0
    assert scripts.script_io(corpus(spark, sql)).first().sources == ["S.T"]


CONF = """
flux.pre-exec-queries += " /q/create.hql "
flux.pre-exec-queries += "select 1"
flux.exec-queries += "/q/a.hql" // first
flux.exec-queries += "/q/../r//b.hql"
flux.hdfs.src-temp-tt-dir-regex = " /PROD/RAW/D1/S1/m* extra "
flux.hdfs.src-temp-tt-dir-regex = "/second"
flux.hdfs.dest-temp-tt-dir = "/PROD/TT/1"
flux.hive.extra-conf += "--hivevar tt_table_name=cdr.tt_1"
flux.hive.extra-conf += "--hivevar other=1"
flux.hive.extra-conf += "--hivevar tt_table_name = cdr.tt_2 --x"
flux.sqoop.export-rdms.staging-table = "MON.SQ"
flux.sqoop.export-rdms.dest-table = "MON.FT"
"""


def test_conf_job(spark):
    conf = spark.createDataFrame([("/c/x.conf", CONF)], "path string, content string")
    row = confs.conf_jobs(conf, "/hdfs/").first()
    assert row.pre_exec == ["/hdfs/q/create.hql"]
    assert row.exec == ["/hdfs/q/a.hql", "/hdfs/q/../r//b.hql"]
    assert row.raw_directory == "/PROD/RAW/D1/S1/m* extra"
    assert (row.tt_directory, row.cdr_tt) == ("/PROD/TT/1", "CDR.TT_2")
    assert (row.staging_table_dwh, row.dwh_table) == ("MON.SQ", "MON.FT")
    assert confs.exec_paths(conf, "/hdfs").first().queries == ["/hdfs/q/a.hql", "/hdfs/r"]


def test_unreadable_exec_line(spark):
    conf = spark.createDataFrame([("/c/x.conf", "flux.exec-queries\n")], "path string, content string")
    assert confs.exec_paths(conf, "/hdfs").first().queries is None


def test_sqoop_confs(spark):
    names = ["Sqoop-a.conf", "sqoop-CRON.conf", "x-sqoop.conf", "sqoop.txt"]
    rows = spark.createDataFrame([(f"/c/{n}", "") for n in names], "path string, content string")
    assert [r.path for r in confs.sqoop_confs(rows).collect()] == ["/c/Sqoop-a.conf"]


def test_missing_lake_block(spark):
    text = 'flux.rdms.pre-exec-queries += """SELECT 1 FROM m.f JOIN m.g WHERE 1"""'
    rows = spark.createDataFrame([("/c/sqoop.conf", text)], "path string, content string")
    row = confs.dwh_lake(rows).first()
    assert (sorted(row.table_data_rdms), row.table_data_hive) == ([], [])
    text = 'flux.rdms.pre-exec-queries += """SELECT 1 FROM m.f WHERE 1"""'
    rows = spark.createDataFrame([("/c/sqoop.conf", text)], "path string, content string")
    row = confs.dwh_lake(rows).first()
    assert (row.table_data_rdms, row.table_data_hive) == (["M.F"], [])


def test_raw_base_dir(spark):
    paths = ["/PROD/RAW/OM" + chr(0x200B) + "/X/f", "/PROD/RAW", "/PROD/RAW/OM" + chr(0xA0)]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in rows.select(X.raw_base_dir(F.col("p"))).collect()]
    assert got == ["/PROD/RAW/OM", None, "/PROD/RAW/OM"]
