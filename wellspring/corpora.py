"""Lineage corpora derived from the shared tables.

The SQL runs unchanged on Spark and DuckDB, so the oracle sees the same scripts, confs, flow
exports, catalog and report. Every ``part`` row becomes a table in a five-layer warehouse
(``k % 5``: 0 feeds the warehouse, 1-3 are intermediate, 4 is an external table).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wellspring.session import spread

SCRIPTS = """
select case when k % 5 = 4 then concat('/PROD/SCRIPTS/create_', cast(k as string), '.hql')
  else concat('/PROD/SCRIPTS/', case when k % 5 = 3 then 'compute_' else 'insert_into_' end, cast(k as string), '.hql') end as path,
 case when k % 5 = 4 then concat('CREATE EXTERNAL TABLE CDR.TT_', cast(k as string), ' (id STRING, v STRING) ROW FORMAT DELIMITED FIELDS TERMINATED BY '';'' LOCATION ''/PROD/TT/', cast(k as string), '''')
  else concat('-- load FROM old.t', chr(10), 'INSERT INTO TABLE ', tgt, ' SELECT a.id, SUM(a.v + b.w) AS r', cast(k % 3 as string), ' FROM ', d1, ' a JOIN ', d2, ' b ON a.k=b.k', case when k % 5 = 3 and k % 31 = 0 then concat(' JOIN MON.SPARK_FT_', cast(k-3 as string), ' c ON a.k=c.k') else '' end) end as content
from (select k, concat(case when k % 5 = 0 then 'MON.SPARK_FT_' else 'AGG.SPARK_FT_' end, cast(k as string)) as tgt,
  concat(case when k % 5 = 3 then 'cdr.tt_' else 'agg.spark_ft_' end, cast(k + 1 as string)) as d1,
  concat(case when k % 5 = 3 then 'CDR.TT_' else 'AGG.SPARK_FT_' end, cast(((k - k % 5) * 7) % 195 + k % 5 + 1 as string)) as d2
  from (select p_partkey as k from part) x) y
"""

CONFS = '''
select concat('/PROD/CONF/load-it-', cast(k as string), '.conf') as path,
 concat('flux.name = "L', cast(k as string), '"', chr(10),
  case when k % 5 = 4 then '' else concat('flux.exec-queries += "/PROD/SCRIPTS/', case when k % 5 = 3 then 'compute_' else 'insert_into_' end, cast(k as string), '.hql"', chr(10)) end,
  case when k % 4 = 0 or k % 5 = 4 then concat('flux.pre-exec-queries += "/PROD/SCRIPTS/create_', cast(k as string), '.hql"', chr(10)) else '' end,
  case when k % 6 = 0 then concat('flux.exec-queries += "inline select 1"', chr(10)) else '' end,
  case when k % 5 = 3 then concat('flux.hdfs.src-temp-tt-dir-regex = "/PROD/RAW/D', cast(k % 6 as string), '/S', cast(k % 4 as string), '/merged_*', case when k % 7 = 0 then ' extra' else '' end, '"', chr(10), 'flux.hdfs.dest-temp-tt-dir = "/PROD/TT/', cast(k as string), '"', chr(10), 'flux.hive.extra-conf += "--hivevar tt_table_name=cdr.tt_', cast(k + 1 as string), '"', chr(10)) else '' end) as content
from (select p_partkey as k from part) x
union all
select concat('/PROD/CONF/', case when k % 50 = 0 then 'SQOOP-cron-' else 'sqoop-export-' end, cast(k as string), '.conf') as path,
 concat('flux.rdms.pre-exec-queries += """SELECT COUNT(*)', chr(10), 'FROM mon.ft_', cast(k as string), ' WHERE d=1"""', chr(10),
  case when k % 35 = 0 then '' else concat('flux.hive.pre-exec-queries += """SELECT COUNT(*) FROM MON.SPARK_FT_', cast(k as string), chr(10), 'WHERE d=1"""', chr(10)) end,
  'flux.sqoop.export-rdms.staging-table = "MON.SQ_TMP_', cast(k as string), '"', chr(10), 'flux.sqoop.export-rdms.dest-table = "MON.FT_', cast(k as string), '"', chr(10)) as content
from (select p_partkey as k from part) x where k % 5 = 0
'''

FLOWS = """
select s_suppkey as flow_id, concat('{"flowContents":{"name":"root","componentType":"PROCESS_GROUP","processGroups":[{"identifier":"g', cast(s_suppkey as string), '","name":"grp', cast(s_suppkey % 7 as string), '","componentType":"PROCESS_GROUP","groupIdentifier":"root","processGroups":[],"processors":[{"identifier":"p1","name":"', case when s_suppkey % 3 = 0 then 'List Files' else 'Put' end, '","scheduledState":"', case when s_suppkey % 4 = 0 then 'DISABLED' else 'ENABLED' end, '","bundle":{"version":"1.', cast(s_suppkey % 2 as string), '"}},{"identifier":"p2","name":"Fetch","scheduledState":"', case when s_suppkey % 8 = 0 then 'DISABLED' else 'ENABLED' end, '","bundle":{"version":"1.0"}}],"variables":{"flux.name":"FLUX_', cast(s_suppkey % 11 as string), '","flux.sftp.remote-path":"srv', cast(s_suppkey % 5 as string), '","flux.hdfs.filedir":"/PROD/RAW/D', cast(s_suppkey % 6 as string), '","flux.hdfs.subdir-names":"S', cast(s_suppkey % 4 as string), ';S', cast((s_suppkey + 1) % 4 as string), '","flux.sftp.port":"22"}}]}}') as json from supplier
"""

# malformed, deeply nested, scalar and absent exports among plain ones
ODD_FLOWS = """
select s_suppkey as flow_id, case s_suppkey % 8
 when 0 then repeat('[', 3000)
 when 1 then concat('{"a":', cast(s_suppkey as string))
 when 2 then cast(s_suppkey as string)
 when 3 then concat(repeat('[', cast(1 + s_suppkey % 40 as int)), repeat(']', cast(1 + s_suppkey % 40 as int)))
 when 4 then ''
 when 5 then null
 when 6 then 'not json'
 else '{"a":1}' end as json from supplier
"""

DDL = """
select concat('/PROD/SCRIPTS/create_', cast(k as string), '.hql') as path,
 case when k % 3 = 0 then concat('CREATE TABLE IF NOT EXISTS MON.SPARK_FT_', cast(k as string), ' (id BIGINT, ', case when k % 2 = 0 then '' else 'deep map<string,struct<a:array<map<string,struct<b:decimal(10,2),c:int>>>,d:int>>, ' end, 'r', cast(k % 3 as string), ' DOUBLE) PARTITIONED BY (event_date DATE) STORED AS ORC')
      when k % 3 = 1 then concat('create table mon.spark_ft_', cast(k as string), ' (id bigint, r1 double) stored as parquet')
      else concat('CREATE EXTERNAL TABLE CDR.TT_', cast(k as string), ' (id STRING, v STRING) ROW FORMAT DELIMITED FIELDS TERMINATED BY '';'' LOCATION ''/PROD/TT/', cast(k as string), '''') end as content
from (select p_partkey as k from part) x
"""

# staging fields are R0, R1, R2 and warehouse fields R0, DWH_R1, DWH_R2; they pair by ordinal
CATALOG_ROWS = " union all ".join(
    f"select 'MON' as owner, concat('{table}_', cast(p_partkey as string)) as table_name, "
    f"'{column}' as column_name, {i} as column_id from part"
    for table, columns in [("FT", ["R0", "DWH_R1", "DWH_R2"]), ("SQ_TMP", ["R0", "R1", "R2"])]
    for i, column in enumerate(columns)
)

REPORT = """
select o_orderkey as row_id, concat('MON.FT_', cast(o_custkey as string)) as Table_RDMS,
 case when o_orderkey % 9 = 0 then '' else concat('mon.spark_ft_', cast(o_custkey as string)) end as Table_Hive,
 concat('AGG.T_', cast(o_orderkey % 53 as string)) as Dep_datalake1,
 case when o_orderkey % 4 = 0 then null else concat(case when o_orderkey % 2 = 0 then 'CDR.TT_' else 'cdr.tt_' end, cast(o_orderkey % 17 as string)) end as Dep_datalake2,
 concat(' srv', cast(o_orderkey % 5 as string), ' ') as Server, concat('/PROD/RAW/D', cast(o_orderkey % 6 as string)) as Raw_Path,
 concat('FLUX_', cast(o_orderkey % 11 as string)) as Flux_Name, '2' as Nb_processor, cast(o_orderkey % 3 as string) as Nb_disabled_processors,
 concat('host', cast(o_orderkey % 7 as string)) as Hostname, '22' as Port, 'svc' as username
from orders
"""


QUOTED_SCRIPTS = """
select concat('/PROD/SCRIPTS/quoted_', cast(p_partkey as string), '.hql') as path,
 concat('SELECT "a"."id" FROM "mon"."ft_', cast(p_partkey as string), '" AS "a" WHERE "a"."k" IN (SELECT "b"."k" from "agg"."t_', cast(p_partkey % 7 as string), '"', chr(10), 'as "b") OR EXISTS (SELECT 1 FROM "mon"."ft_', cast(p_partkey as string), '" AS "c")') as content
from part
"""

# scalar sub-query, UNION ALL with CASE, CTE over a sub-query, DISTINCT with a window function
NESTED_SCRIPTS = """
select concat('/PROD/SCRIPTS/compute_nested_', cast(k as string), '.hql') as path,
 concat('INSERT INTO MON.N_', s, ' ', case k % 4
  when 0 then concat('SELECT a.x, (SELECT MAX(q) FROM d.u_', s, ') m FROM s.t_', s, ' a')
  when 1 then concat('SELECT CASE WHEN a.f > 1 THEN a.g ELSE -1 END AS c, COUNT(*) n FROM s.t_', s, ' a GROUP BY a.f, a.g UNION ALL SELECT b.h * 2, b.i % 3 FROM s.v_', s, ' b')
  when 2 then concat('WITH w AS (SELECT p, r FROM m.n_', s, ') SELECT w.p, concat(''x,('', w.r) AS `two words` FROM w JOIN (SELECT z FROM h.i_', s, ') y ON w.p = y.z')
  else concat('SELECT DISTINCT t.*, SUM(t.v) OVER (PARTITION BY t.k, t.j ORDER BY t.d DESC) total, CAST(t.e AS decimal(10,2)) FROM s.t_', s, ' t, s.o_', s, ' o WHERE t.k = o.k; SELECT 1 FROM last.one') end) as content
from (select p_partkey as k, cast(p_partkey as string) as s from part) x
"""


# bare columns in a sub-query: only a table's DDL says whose they are; block comments, empty trims
BARE_SCRIPTS = """
select concat('/PROD/SCRIPTS/compute_bare_', s, '.hql') as path,
 concat('/* FROM old.', s, chr(10), ' */ INSERT INTO MON.B_', s, ' SELECT a.x, (SELECT MAX(id + qq) FROM cdr.tt_', s, ') m, COUNT(*) n', case when k % 2 = 0 then ', TRIM() AS t' else '' end, ' FROM s.t_', s, ' a') as content
from (select p_partkey as k, cast(p_partkey as string) as s from part) x
"""


def load(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A corpus as a DataFrame; the tables are read under names of their own."""
    source = re.compile(r"\bfrom (part|supplier|orders)\b")
    for table in sorted(set(source.findall(sql))):
        rows = spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        rows.createOrReplaceTempView(f"corpus_{table}")
    return spark.sql(source.sub(r"from corpus_\1", sql))
