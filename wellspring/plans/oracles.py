"""DuckDB SQL for the registered queries, over the same corpora."""

from __future__ import annotations

from wellspring import corpora
from wellspring.functions import patterns as P

ID = "[A-Za-z_][A-Za-z0-9_]*"
TABLE = rf"{ID}\.{ID}"


def cte(name: str, sql: str) -> str:
    return f"{name} AS ({sql.strip()})"


def with_(*parts: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + select


# --- corpora and text --------------------------------------------------------------------------
SCRIPTS = cte("scripts", corpora.SCRIPTS)
CONFS = cte("confs", corpora.CONFS)
FLOWS = cte("flows", corpora.FLOWS)
DDL = cte("ddl", corpora.DDL)
CATALOG = cte("catalog_rows", corpora.CATALOG_ROWS)
NESTED = cte("nested", corpora.NESTED_SCRIPTS)
QUOTED = cte("quoted", corpora.QUOTED_SCRIPTS)

NO_COMMENT = (
    r"regexp_replace(regexp_replace({c}, '--+.*?(\r\n|\r|\n)', chr(10), 'g'), '(?s)/\*.*?\*/', '', 'g')"
)
SOURCES = (
    "list_distinct(list_transform(regexp_extract_all({c}, "
    rf"'(?i)\b(?:FROM|JOIN)\s+({TABLE})\b', 1), lambda x: upper(x)))"
)
TARGETS = (
    "list_transform(regexp_extract_all({c}, "
    rf"'(?i)\bINSERT\s+INTO\s+(?:TABLE\s+)?({TABLE})', 1), lambda x: upper(x))"
)
CLEAN = cte("clean", f"SELECT path, {NO_COMMENT.format(c='content')} AS c FROM scripts")
IO = cte(
    "io",
    f"""SELECT path, targets[1] AS target, targets,
          CASE WHEN targets[1] IS NULL THEN found ELSE list_filter(found, lambda x: x <> targets[1]) END AS sources
        FROM (SELECT path, {TARGETS.format(c='c')} AS targets, {SOURCES.format(c='c')} AS found FROM clean)""",
)
SORTED = "array_to_string(list_sort({0}), ',')"
ORDERED = "array_to_string({0}, ',')"


def first(pattern: str) -> str:
    return f"nullif(regexp_extract(content, '{pattern}', 1), '')"


JOBS = cte(
    "jobs",
    rf"""SELECT path AS conf_path,
      regexp_extract_all(content, 'flux\.pre-exec-queries\s*\+=\s*"([^"]+)"', 1) AS pre_all,
      regexp_extract_all(content, 'flux\.exec-queries\s*\+=\s*"([^"]+)"', 1) AS exec_all,
      list_filter(pre_all, lambda x: x[1] = '/') AS pre_exec, list_filter(exec_all, lambda x: x[1] = '/') AS exec,
      {first('flux.hdfs.src-temp-tt-dir-regex = "([^"]+)"')} AS raw_directory,
      {first('flux.hdfs.dest-temp-tt-dir = "([^"]+)"')} AS tt_directory,
      upper({first('flux.hive.extra-conf .= "--hivevar tt_table_name=([^" ]+)')}) AS cdr_tt,
      {first('export-rdms.staging-table = "([^"]+)"')} AS staging_table_dwh,
      {first('export-rdms.dest-table = "([^"]+)"')} AS dwh_table
    FROM confs""",
)
LAKE = cte(
    "lake",
    rf"""SELECT path AS conf_path, regexp_extract(content, '(?is)flux\.rdms\.pre-exec-queries.*?FROM\s+\S+\s+WHERE') AS rdms_block,
      nullif(regexp_extract(content, '(?is)flux\.hive\.pre-exec-queries.*?FROM\s+\S+\s+WHERE'), '') AS hive_block,
      {SOURCES.format(c='rdms_block')} AS rdms, {SOURCES.format(c="coalesce(hive_block, '')")} AS hive
    FROM confs WHERE lower(path) LIKE '%/sqoop%.conf' AND lower(path) NOT LIKE '%cron%'""",
)
PAIRS = cte(
    "pairs",
    "SELECT DISTINCT d AS dwh_table, unnest(hive) AS lake_table FROM (SELECT unnest(rdms) AS d, hive FROM lake)",
)
REFS = cte(
    "refs",
    """SELECT conf_path, 0 AS kind, unnest(exec) AS script_path, raw_directory, cdr_tt, tt_directory, staging_table_dwh FROM jobs
       UNION ALL SELECT conf_path, 1, unnest(pre_exec), raw_directory, cdr_tt, tt_directory, staging_table_dwh FROM jobs""",
)
EDGES = cte(
    "edges",
    "SELECT DISTINCT target, unnest(sources) AS dep FROM io WHERE target IS NOT NULL AND path IN (SELECT script_path FROM refs)",
)
ATTRS = cte(
    "attrs",
    """SELECT target, s.raw_directory AS raw_directory, s.cdr_tt AS cdr_name, s.tt_directory AS tt_directory,
         s.staging_table_dwh AS staging_dwh_table, s.conf_path AS conf_path
       FROM (SELECT io.target, arg_min(refs, (conf_path, kind)) AS s FROM io JOIN refs ON io.path = refs.script_path
             WHERE io.target IS NOT NULL GROUP BY io.target)""",
)
RAWS = cte(
    "raws",
    "SELECT cdr_name, arg_max({'r': raw_directory, 't': tt_directory}, (conf_path, target)) AS v FROM attrs WHERE cdr_name IS NOT NULL GROUP BY cdr_name",
)
LINEAGE = [SCRIPTS, CONFS, CLEAN, IO, JOBS, REFS, EDGES, ATTRS, LAKE, PAIRS, RAWS]
WALK = cte(
    "walk",
    """SELECT [dwh_table, lake_table] AS path, lake_table AS tip FROM pairs
       UNION ALL SELECT list_append(path, dep), dep FROM walk JOIN edges ON tip = target WHERE NOT list_contains(path[2:], dep)""",
)
CHAINS = cte(
    "chains",
    """SELECT path, array_to_string(path, '>') AS text, md5(text) AS chain_id, path[1] AS dwh_table, path[2] AS lake_table
       FROM (SELECT [dwh_table, lake_table] AS path FROM pairs UNION
             SELECT path FROM walk WHERE len(path) > 2 AND tip NOT IN (SELECT target FROM edges))""",
)
WAREHOUSE = [*LINEAGE, WALK, CHAINS]
LAKE_WALK = cte(
    "lake_walk",
    """SELECT [target] AS path, target AS tip, false AS is_cycle FROM (SELECT DISTINCT target FROM attrs)
       UNION ALL SELECT list_append(path, dep), dep, list_contains(path, dep) FROM lake_walk JOIN edges ON tip = target WHERE NOT is_cycle""",
)
LAKE_CHAINS = cte(
    "lake_chains",
    "SELECT path, path[1] AS root, is_cycle, tip FROM lake_walk WHERE is_cycle OR tip NOT IN (SELECT target FROM edges)",
)
TABLE_SCRIPTS = cte(
    "table_scripts",
    """SELECT coalesce(s.t, l.t) AS "table", l.path FROM (SELECT DISTINCT upper(hive[1]) AS t FROM lake WHERE hive[1] IS NOT NULL) s
       FULL JOIN (SELECT DISTINCT target AS t, path FROM (SELECT path, unnest(targets) AS target FROM io WHERE lower(path) LIKE '%insert%' OR lower(path) LIKE '%compute%')) l ON s.t = l.t""",
)

# --- flows -------------------------------------------------------------------------------------
GROUP = "'$.flowContents.processGroups[0].{0}'"


def var(name: str) -> str:
    return f"""(json ->> '$.flowContents.processGroups[0].variables."{name}"')"""


GROUPS = cte(
    "groups",
    f"""SELECT *, CASE WHEN name = 'List Files' THEN nb_disabled ELSE 0 END AS nb_list_disabled FROM (SELECT flow_id, json ->> '$.flowContents.processGroups[0].groupIdentifier' AS "groupIdentifier",
      (SELECT count(*) FROM json_each(json, '$.flowContents.processGroups[0].processors')) AS nb_processors,
      (SELECT count(*) FROM json_each(json, '$.flowContents.processGroups[0].processors') p WHERE p.value ->> 'scheduledState' = 'DISABLED') AS nb_disabled,
      (SELECT count(*) FROM json_each(json, '$.flowContents.processGroups[0].processors') p WHERE p.value ->> 'scheduledState' = 'ENABLED') AS nb_enabled,
      {var('flux.sftp.remote-path')} AS staging, {var('flux.hdfs.filedir')} AS rep_raw, {var('flux.hdfs.subdir-names')} AS subdir,
      {var('flux.sftp.port')} AS port, {var('flux.name')} AS flux_name, {var('flux.sftp.hostname')} AS ip_adress,
      {var('flux.sftp.username')} AS username, json ->> '$.flowContents.processGroups[0].processors[0].name' AS name,
      {var('flux.filenames-regex')} AS regex
    FROM flows)""",
)
MATCHES = [
    cte(
        "usable",
        "SELECT *, str_split(subdir, ';') AS dirs FROM groups WHERE staging IS NOT NULL AND flux_name IS NOT NULL AND nb_processors > 0 AND nb_disabled / nb_processors < 0.8",
    ),
    cte(
        "raw_paths",
        """SELECT raw_path, array_to_string(str_split(raw_path, '/')[1:4], '/') AS base, str_split(raw_path, '/')[-2] AS dir
           FROM (SELECT DISTINCT split_part(raw_directory, ' ', 1) AS raw_path FROM attrs WHERE raw_directory LIKE '/%')""",
    ),
    cte(
        "all_matches",
        """SELECT r.raw_path, g.* FROM raw_paths r JOIN usable g ON
             CASE WHEN g.rep_raw = r.base THEN list_contains(g.dirs, r.dir) ELSE g.dirs[1] = r.dir END""",
    ),
    cte(
        "matches",
        """SELECT raw_path, flux_name, staging AS server, nb_processors, nb_disabled AS nb_disabled_processors, ip_adress, username, port, nb_list_disabled, regex
           FROM all_matches QUALIFY row_number() OVER (PARTITION BY raw_path, flux_name ORDER BY nb_list_disabled, flow_id) = 1""",
    ),
]
SERVED = cte(
    "served",
    """SELECT c.path, c.chain_id, c.dwh_table, split_part(r.v.r, ' ', 1) AS raw_path, m.* EXCLUDE (raw_path)
       FROM chains c LEFT JOIN raws r ON r.cdr_name = c.path[-1] LEFT JOIN matches m ON m.raw_path = split_part(r.v.r, ' ', 1)""",
)
ALL_SERVED = [*WAREHOUSE, FLOWS, GROUPS, *MATCHES, SERVED]


def wide(source: str, names: str, extra: dict[str, str]) -> str:
    """Cells by path position, then ``extra`` (name: expression); the longest path decides how many."""
    columns = "".join(f", {value} AS e{k}" for k, value in enumerate(extra.values()))
    cells = ", ".join(f"coalesce(CAST(e{k} AS VARCHAR), '~')" for k in range(len(extra)))
    header = ", ".join(f"'{name}'" for name in extra)
    return (
        f"SELECT n + {len(extra)} AS n_columns, array_to_string(list_transform(range(1, n + 1), lambda i: {names}) || [{header}], '|') AS header, "
        f"array_to_string(list_transform(list_resize(path, n), lambda x: coalesce(x, '~')) || [{cells}], '|') AS cells "
        f"FROM (SELECT DISTINCT path{columns} FROM {source}), (SELECT max(len(path)) AS n FROM {source})"
    )


CHAIN_NAMES = "CASE i WHEN 1 THEN 'Table_RDMS' WHEN 2 THEN 'Table_Hive' ELSE 'Dep_datalake' || (i - 2) END"
LAKE_NAMES = "CASE i WHEN 1 THEN 'Table_Principale' ELSE 'Dep_datalake' || (i - 1) END"
SERVER_NAMES = {
    "Server": "server", "Raw_Path": "raw_path", "Flux_Name": "flux_name", "Nb_processor": "nb_processors",
    "Nb_disabled_processors": "nb_disabled_processors", "Hostname": "ip_adress", "Port": "port", "username": "username",
}

# --- column lineage ----------------------------------------------------------------------------
# A flat script is INSERT INTO TABLE t SELECT a.id, SUM(a.v + b.w) AS r<n> FROM d1 a JOIN d2 b ...
FLAT = cte(
    "flat",
    r"""SELECT path, target, alias, item_no, formula, used, agg, ops, item_sql, tables FROM (
          SELECT path, upper(regexp_extract(c, 'INTO TABLE (\S+)', 1)) AS target, regexp_extract(c, ' AS (r\d)', 1) AS r,
            list_sort(list_distinct(regexp_extract_all(c, '(?:FROM|JOIN) (\S+)', 1))) AS tables FROM clean WHERE c LIKE '%SELECT%') s,
        LATERAL (SELECT 'id' AS alias, 0 AS item_no, 'a.id' AS formula, ['id'] AS used, '' AS agg, '' AS ops, 'a.id' AS item_sql
                 UNION ALL SELECT r, 1, 'SUM ( a.v + b.w )', ['v', 'w'], 'SUM', '+', 'SUM ( a.v + b.w ) AS ' || r)""",
)
FLAT_SCRIPTS = [SCRIPTS, CLEAN, FLAT]
NESTED_ITEMS = r"""
  SELECT concat('/PROD/SCRIPTS/compute_nested_', s, '.hql') AS path, v.* FROM (SELECT p_partkey AS k, cast(p_partkey AS string) AS s FROM part) x,
  LATERAL (
    SELECT 0 AS stmt_no, 0 AS item_no, 'x' AS alias, 'a.x' AS formula_sql, 'x' AS columns_used, '' AS aggregations, '' AS arithmetic_ops, concat('d.u_', s, ',s.t_', s) AS tables WHERE k % 4 = 0
    UNION ALL SELECT 0, 1, 'm', concat('( SELECT MAX ( q ) FROM d.u_', s, ' )'), 'q', 'MAX', '', concat('d.u_', s, ',s.t_', s) WHERE k % 4 = 0
    UNION ALL SELECT 0, 0, 'NO_ALIAS', 'MAX ( q )', 'q', 'MAX', '', concat('d.u_', s) WHERE k % 4 = 0
    UNION ALL SELECT 0, 0, 'c', 'CASE WHEN a.f > 1 THEN a.g ELSE - 1 END', 'f,g', '', '', concat('s.t_', s) WHERE k % 4 = 1
    UNION ALL SELECT 0, 1, 'n', 'COUNT ( * )', '', 'COUNT', '', concat('s.t_', s) WHERE k % 4 = 1
    UNION ALL SELECT 0, 0, 'NO_ALIAS', 'b.h * 2', 'h', '', '*', concat('s.v_', s) WHERE k % 4 = 1
    UNION ALL SELECT 0, 1, 'NO_ALIAS', 'b.i % 3', 'i', '', '%', concat('s.v_', s) WHERE k % 4 = 1
    UNION ALL SELECT 0, 0, 'p', 'p', 'P', '', '', concat('m.n_', s) WHERE k % 4 = 2
    UNION ALL SELECT 0, 1, 'r', 'r', 'R', '', '', concat('m.n_', s) WHERE k % 4 = 2
    UNION ALL SELECT 0, 0, 'p', 'w.p', 'p', '', '', concat('h.i_', s, ',m.n_', s, ',w') WHERE k % 4 = 2
    UNION ALL SELECT 0, 1, 'two words', 'concat ( ''x,('' , w.r )', 'r', '', '', concat('h.i_', s, ',m.n_', s, ',w') WHERE k % 4 = 2
    UNION ALL SELECT 0, 0, 'z', 'z', 'Z', '', '', concat('h.i_', s) WHERE k % 4 = 2
    UNION ALL SELECT 0, 0, '*', 't.*', '*', '', '', concat('s.o_', s, ',s.t_', s) WHERE k % 4 = 3
    UNION ALL SELECT 0, 1, 'total', 'SUM ( t.v ) OVER ( PARTITION BY t.k , t.j ORDER BY t.d DESC )', 'v,k,j,d', 'SUM', '', concat('s.o_', s, ',s.t_', s) WHERE k % 4 = 3
    UNION ALL SELECT 0, 2, 'NO_ALIAS', 'CAST ( t.e AS decimal ( 10 , 2 ) )', 'e', '', '', concat('s.o_', s, ',s.t_', s) WHERE k % 4 = 3
    UNION ALL SELECT 1, 0, 'NO_ALIAS', '1', '', '', '', 'last.one' WHERE k % 4 = 3) v
"""
STEPS = cte(
    "steps",
    """SELECT c.chain_id, c.dwh_table, c.i - 1 AS position, c.t AS "table", s.path AS script_path
       FROM (SELECT *, path[i] AS t FROM (SELECT *, unnest(range(2, len(path) + 1)) AS i FROM chains)) c
       LEFT JOIN table_scripts s ON s."table" = c.t""",
)
FIELDS = cte(
    "fields",
    "SELECT concat(owner, '.', table_name) AS table_name, list(column_name ORDER BY column_id) AS fields FROM catalog_rows GROUP BY owner, table_name",
)
FIELD_MAP = cte(
    "field_map",
    """SELECT upper(j.dwh_table) AS dwh_key, s.column_name AS staging_field, d.column_name AS dwh_field FROM jobs j
       JOIN catalog_rows s ON concat(s.owner, '.', s.table_name) = upper(j.staging_table_dwh)
       JOIN catalog_rows d ON concat(d.owner, '.', d.table_name) = upper(j.dwh_table) AND d.column_id = s.column_id""",
)
TRACKED = cte(
    "tracked",
    """SELECT path, target, lower(unnest(used)) AS "column", ops AS arithmetic_ops, alias, formula AS formula_sql, array_to_string(tables, ', ') AS tables FROM flat""",
)
DWH_TRACKING = [
    *WAREHOUSE,
    FLAT,
    TABLE_SCRIPTS,
    STEPS,
    CATALOG,
    FIELD_MAP,
    TRACKED,
    cte(
        "hits",
        """SELECT DISTINCT s.dwh_table, s.position, m.dwh_field, t.* FROM steps s JOIN tracked t ON t.path = s.script_path
           JOIN field_map m ON m.dwh_key = upper(s.dwh_table) AND m.staging_field = upper(t.alias)""",
    ),
    cte(
        "tracking",
        """SELECT DISTINCT dwh_table, '' AS tables, '' AS computed_table, dwh_field, '' AS "column", alias, CAST(NULL AS BIGINT) AS step, '' AS path, '' AS arithmetic_ops, '' AS formula_sql FROM hits
           UNION ALL SELECT DISTINCT dwh_table, tables, target, dwh_field, "column", alias, position, path, arithmetic_ops, formula_sql FROM hits
           WHERE contains(lower(formula_sql), "column") AND lower(dwh_field) IN (lower(alias), "column")""",
    ),
]

# --- report ------------------------------------------------------------------------------------
TEXT_COLUMNS = [P.DWH_COLUMN, P.LAKE_COLUMN, "Dep_datalake1", "Dep_datalake2", *P.SERVER_COLUMNS]
REPORT = [
    cte("dirty", corpora.REPORT),
    cte(
        "report",
        "SELECT row_id, " + ", ".join(f"nullif(trim({c}), '') AS {c}" for c in TEXT_COLUMNS) + " FROM dirty",
    ),
    cte(
        "cells",
        " UNION ALL ".join(
            f"SELECT row_id, {n} AS ord, '{c}' AS origin, {c} AS name, lower({c}) AS t FROM report WHERE {c} IS NOT NULL"
            for n, c in enumerate(TEXT_COLUMNS[:4])
        ),
    ),
    cte(
        "meta",
        " UNION ALL ".join(
            f"SELECT row_id, '{c}' AS attribute, {c} AS value FROM report WHERE {c} IS NOT NULL"
            for c in P.SERVER_COLUMNS
        ),
    ),
    cte(
        "pairs",
        "SELECT DISTINCT a.t AS src, b.t AS dep FROM cells a JOIN cells b ON a.row_id = b.row_id AND a.ord < b.ord",
    ),
    cte("names", 'SELECT t AS "table", arg_max(name, (row_id, ord)) AS name FROM cells GROUP BY t'),
    cte(
        "ranks",
        """SELECT t AS "table", min(CASE origin WHEN 'Table_RDMS' THEN 1 WHEN 'Table_Hive' THEN 2 ELSE 3 END) AS priority,
             CASE priority WHEN 1 THEN 'RDMS' WHEN 2 THEN 'Hive' ELSE 'Datalake' END AS tag FROM cells GROUP BY t""",
    ),
    cte(
        "deps",
        """SELECT p.src AS "table", p.dep, n.name AS dep_name, r.priority, r.tag FROM pairs p JOIN names n ON n."table" = p.dep JOIN ranks r ON r."table" = p.dep""",
    ),
    cte(
        "users",
        """SELECT p.dep AS "table", p.src AS "user", n.name AS user_name, r.priority, r.tag FROM pairs p JOIN names n ON n."table" = p.src JOIN ranks r ON r."table" = p.src""",
    ),
    cte(
        "external",
        """SELECT t.d AS "Table_RDMS", coalesce(x.name, '') AS "CDR" FROM (SELECT DISTINCT Table_RDMS AS d FROM report WHERE Table_RDMS IS NOT NULL) t
           LEFT JOIN (SELECT src, name FROM pairs JOIN names ON "table" = dep WHERE name LIKE 'CDR.%') x ON x.src = lower(t.d)""",
    ),
]


def report(select: str) -> str:
    return with_(*REPORT, select=select)


def lineage(select: str) -> str:
    return with_(*LINEAGE, select=select)


def warehouse(select: str, *more: str) -> str:
    return with_(*WAREHOUSE, *more, select=select, recursive=True)


def lake_tracking(table: str) -> str:
    """Scripts of all chains through the table; if there are none, its own and its dependencies'."""
    return warehouse(
        f"""SELECT DISTINCT tables AS "Tables utilisées", '' AS dwh_fields, "column" AS "Champ", alias AS "Alias", path AS "Chemin du fichier HQL", arithmetic_ops AS "Opérations arithmétiques", formula_sql AS "Formule SQL"
          FROM tracked WHERE CASE WHEN EXISTS (SELECT 1 FROM tracked WHERE path IN (FROM through)) THEN path IN (FROM through) ELSE path IN (FROM direct) END""",
        TABLE_SCRIPTS,
        STEPS,
        FLAT,
        TRACKED,
        cte("through", f"""SELECT script_path FROM steps WHERE chain_id IN (SELECT chain_id FROM steps WHERE "table" = '{table}')"""),
        cte(
            "direct",
            f"""SELECT path FROM table_scripts WHERE "table" = '{table}' OR "table" IN (SELECT dep FROM edges WHERE target = '{table}')""",
        ),
    )


DIAGNOSTIC = """SELECT DISTINCT t AS "table", 'origin' AS section, origin AS item, '' AS tag FROM cells
           UNION ALL SELECT "table", 'dependency', dep_name, tag FROM deps UNION ALL SELECT "table", 'user', user_name, tag FROM users
           UNION ALL SELECT DISTINCT t, attribute, value, '' FROM cells JOIN meta USING (row_id)"""

ORACLES = {
    # sources and sinks
    "s07_report_csv": with_(*REPORT[:2], select=f"SELECT {', '.join(TEXT_COLUMNS)} FROM report"),
    **dict.fromkeys(
        ["s01_files", "s02_latin1_files"],
        with_(SCRIPTS, select=r"SELECT CAST(regexp_extract(path, '(\d+)\.hql$', 1) AS BIGINT) AS k, content || ' é' AS content FROM scripts"),
    ),
    "s06_field_dictionary": with_(CATALOG, FIELDS, select=f"SELECT table_name, {ORDERED.format('fields')} AS fields FROM fields"),
    "s05_catalog_snapshot": with_(CATALOG, select="SELECT * FROM catalog_rows"),
    "k01_lineage_sink": with_(SCRIPTS, CLEAN, IO, select="SELECT DISTINCT target, nullif(array_to_string(list_sort(sources), ', '), '') AS sources FROM io"),
    "k04_file_paths": with_(SCRIPTS, select="SELECT path FROM scripts"),
    "k05_flow_json": with_(
        FLOWS,
        select="""SELECT json_extract_string(json, '$.flowContents.processGroups[0].identifier') AS identifier,
                    json_extract_string(json, '$.flowContents.processGroups[0].name') AS name,
                    json_extract_string(json, '$.flowContents.processGroups[0].processors[0].bundle.version') AS version,
                    json_extract_string(json, '$.flowContents.processGroups[0].variables."flux.name"') AS flux_name FROM flows""",
    ),
    "s03_flow_exports": with_(
        cte("odd", corpora.ODD_FLOWS),
        select=r"""SELECT flow_id, CASE WHEN trim(coalesce(json, '')) = '' THEN 'no text' WHEN NOT json_valid(json) THEN 'not JSON' ELSE 'parsed' END AS reason,
                    CASE WHEN json_valid(json) AND json LIKE '[%' THEN len(regexp_extract_all(json, '\[')) - 1 ELSE 0 END AS depth FROM odd""",
    ),
    # scripts
    "x01_clean_script": with_(SCRIPTS, CLEAN, select="SELECT path, c AS content FROM clean"),
    "x03_source_tables": with_(SCRIPTS, select=f"SELECT path, {SORTED.format(SOURCES.format(c='content'))} AS tables FROM scripts"),
    "x04_script_io": with_(SCRIPTS, CLEAN, IO, select=f"SELECT path, target, {ORDERED.format('targets')} AS targets, {SORTED.format('sources')} AS sources FROM io"),
    "x05_script_targets": with_(SCRIPTS, CLEAN, IO, select="SELECT path, unnest(list_distinct(targets)) AS target FROM io"),
    "x06_insert_tokens": with_(SCRIPTS, select=r"SELECT path, nullif(regexp_extract(content, '(?i)INSERT\s+INTO\s+([^\s()]+)', 1), '') AS token FROM scripts"),
    "x07_quoted_sources": with_(
        QUOTED,
        select=r"""SELECT path, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(content, '(?i)FROM\s+"[^"]+"\."[^"]+"\s+AS\s+"[^"]+"'),
          lambda m: regexp_extract(m, '"([^"]+)"', 1) || '.' || regexp_extract(m, '\."([^"]+)"', 1)))), ',') AS tables FROM quoted""",
    ),
    "x16_ddl": with_(
        DDL,
        select=r"""SELECT path, upper(regexp_extract(content, '(?i)TABLE (?:IF NOT EXISTS )?(\S+)', 1)) AS table_name,
          array_to_string(list_transform(str_split(regexp_extract(regexp_replace(content, 'deep map<\S+', 'deep map,'), '\((.*?)\)', 1), ', '), lambda f: upper(split_part(f, ' ', 1))), ',') AS fields,
          nullif(upper(regexp_extract(content, 'PARTITIONED BY \(.*?\)')), '') AS partitioned_by, content LIKE '%IF NOT EXISTS%' AS if_not_exists FROM ddl""",
    ),
    "x17_ddl_catalog": with_(
        SCRIPTS,
        select=r"""SELECT path, upper(regexp_extract(content, 'TABLE (\S+)', 1)) AS table_name, 'ID,V' AS fields, CAST(NULL AS VARCHAR) AS partitioned_by, false AS if_not_exists
          FROM scripts WHERE path LIKE '%create%.hql'""",
    ),
    "x18_statement_profile": with_(
        NESTED,
        cte("stmts", "SELECT path, unnest(str_split(content, '; ')) AS s, unnest(range(len(str_split(content, '; ')))) AS stmt_no FROM nested"),
        cte(
            "facts",
            r"""SELECT path, stmt_no, regexp_extract_all(s, '(?i)\bFROM\s+([a-zA-Z0-9_.]+)', 1) AS ts, array_to_string(regexp_extract_all(s, '(?is)\bSELECT\s+(.*?)\bFROM', 1), '|') AS columns,
              array_to_string(list_transform(regexp_extract_all(s, '(?i)\b[\w.]+\s+AS\s+\w+'), lambda m: regexp_extract(m, '(?i)\s+AS\s+(\w+)$', 1) || '=' || regexp_extract(m, '^[\w.]+')), ',') AS calculated_fields FROM stmts""",
        ),
        select='SELECT path, stmt_no, unnest(range(len(ts))) AS table_no, unnest(ts) AS "table", columns, calculated_fields FROM facts',
    ),
    "f02_loader_scripts": with_(SCRIPTS, select="SELECT path FROM scripts WHERE regexp_matches(lower(path), 'insert|compute')"),
    # confs
    "x08_conf_jobs": with_(
        CONFS,
        JOBS,
        select="""SELECT conf_path, array_to_string(list_transform(pre_exec, lambda x: '/hdfs' || x), ',') AS pre_exec,
          array_to_string(list_transform(exec, lambda x: '/hdfs' || x), ',') AS exec, raw_directory, tt_directory, cdr_tt, staging_table_dwh, dwh_table FROM jobs""",
    ),
    "x13_exec_paths": with_(CONFS, JOBS, select="SELECT conf_path, array_to_string(list_transform(exec, lambda x: '/hdfs' || x), ',') AS queries FROM jobs"),
    "x14_dwh_lake": with_(CONFS, LAKE, select=f"SELECT conf_path, {SORTED.format('rdms')} AS table_data_rdms, {SORTED.format('hive')} AS table_data_hive FROM lake"),
    "x15_dwh_lake_blocks": with_(CONFS, LAKE, select="SELECT rdms[1] AS dwh_table, arg_max({'b': hive_block}, conf_path).b AS lake_block FROM lake WHERE rdms[1] IS NOT NULL GROUP BY rdms[1]"),
    "x19_exec_query_map": with_(CONFS, JOBS, select=f"SELECT conf_path, {ORDERED.format('pre_exec')} AS pre_exec, {ORDERED.format('exec')} AS exec FROM jobs"),
    "f01_sqoop_confs": with_(CONFS, LAKE, select="SELECT conf_path AS path FROM lake"),
    "f07_confs_without_external_table": with_(CONFS, JOBS, select="SELECT DISTINCT conf_path FROM jobs WHERE cdr_tt IS NULL"),
    "j02_dwh_lake_pairs": with_(CONFS, LAKE, PAIRS, select="SELECT * FROM pairs"),
    # dependencies
    "j01_job_io": lineage(f"SELECT conf_path, kind, script_path, target, {SORTED.format('sources')} AS sources FROM refs LEFT JOIN io ON io.path = refs.script_path"),
    "k01_replaced_rows": with_(SCRIPTS, CLEAN, IO, select="SELECT DISTINCT target, unnest(sources) AS dep FROM io WHERE target IS NOT NULL"),
    "a01_table_deps": lineage("SELECT target, dep FROM edges"),
    "a02_table_attrs": lineage("SELECT * FROM attrs"),
    "a03_raw_of_external": lineage("SELECT cdr_name, v.r AS raw_directory, v.t AS tt_directory FROM raws"),
    "a04_merge_dependencies": lineage(f"SELECT target, dep FROM edges UNION SELECT * FROM (SELECT io.target, unnest({SOURCES.format(c='content')}) AS dep FROM scripts JOIN io USING (path) WHERE target IS NOT NULL) WHERE dep <> target"),
    "j09_lake_table_files": with_(
        *LINEAGE,
        TABLE_SCRIPTS,
        select='SELECT t.target, t.dep AS "table", s.path FROM (SELECT target, target AS dep FROM attrs UNION SELECT target, dep FROM edges) t LEFT JOIN table_scripts s ON s."table" = t.dep',
    ),
    "j10_table_scripts": with_(*LINEAGE, TABLE_SCRIPTS, select="SELECT * FROM table_scripts"),
    "j11_scripts_of_tables": with_(
        *LINEAGE,
        TABLE_SCRIPTS,
        CATALOG,
        select="""SELECT t."table", s.path FROM (SELECT concat(owner, '.', table_name) AS "table" FROM catalog_rows UNION SELECT lake_table FROM pairs) t LEFT JOIN table_scripts s ON s."table" = t."table" """,
    ),
    "j17_verified_deps": with_(
        *LINEAGE,
        TABLE_SCRIPTS,
        select="""SELECT t."table" AS target, d.dep FROM (SELECT DISTINCT "table" FROM table_scripts) t
          LEFT JOIN (SELECT DISTINCT s."table", unnest(io.sources) AS dep FROM table_scripts s JOIN io ON io.path = s.path AND io.target = s."table") d ON d."table" = t."table" """,
    ),
    # chains
    "g01_warehouse_chains": warehouse("SELECT chain_id, dwh_table, lake_table, text AS path, v.r AS raw_path, v.t AS tt_dir FROM chains LEFT JOIN raws ON cdr_name = path[-1]"),
    "g02_wide_chain_report": warehouse(
        wide("raw_chains", CHAIN_NAMES, {"Raw_Path": '"Raw_Path"', "it": "it"}),
        cte("raw_chains", 'SELECT path, v.r AS "Raw_Path", v.t AS it FROM chains LEFT JOIN raws ON cdr_name = path[-1]'),
    ),
    "g03_server_report_of_tables": with_(
        *ALL_SERVED,
        cte("asked", "SELECT * FROM served WHERE dwh_table IN (SELECT concat('MON.FT_', cast(o_custkey AS string)) FROM orders)"),
        select=wide("asked", CHAIN_NAMES, SERVER_NAMES),
        recursive=True,
    ),
    "g04_server_report": with_(*ALL_SERVED, select=wide("served", CHAIN_NAMES, SERVER_NAMES), recursive=True),
    "g05a_chains_of_table": with_(
        *LINEAGE, LAKE_WALK, LAKE_CHAINS,
        select="SELECT array_to_string(path, '>') || CASE WHEN is_cycle THEN ' (cycle détecté)' ELSE '' END AS path FROM lake_chains WHERE root = 'MON.SPARK_FT_0'",
        recursive=True,
    ),
    "g05b_wide_lake_report": with_(
        *LINEAGE, LAKE_WALK, LAKE_CHAINS,
        cte("labelled", "SELECT CASE WHEN is_cycle THEN list_append(path[:-2], path[-1] || ' (cycle détecté)') ELSE path END AS path, CASE WHEN NOT is_cycle THEN v.r END AS raw_path FROM lake_chains LEFT JOIN raws ON cdr_name = tip"),
        select=wide("labelled", LAKE_NAMES, {"raw_path": "raw_path"}),
        recursive=True,
    ),
    "g05c_lake_chains": with_(
        *LINEAGE, LAKE_WALK, LAKE_CHAINS,
        select="SELECT root, array_to_string(path, '>') AS path, is_cycle, CASE WHEN NOT is_cycle THEN v.r END AS raw_path FROM lake_chains LEFT JOIN raws ON cdr_name = tip",
        recursive=True,
    ),
    "j08_chain_steps": warehouse('SELECT chain_id, position, "table", script_path FROM steps', TABLE_SCRIPTS, STEPS),
    # flows and servers
    "n01_values_of_key": with_(FLOWS, select="SELECT flow_id, len(regexp_extract_all(t.path, '\\.|\\[')) AS depth, CAST(t.value AS VARCHAR) AS value FROM flows, json_tree(json) t WHERE t.key = 'identifier'"),
    "n02_objects_where": with_(FLOWS, select="SELECT flow_id, t.value ->> 'name' AS name FROM flows, json_tree(json) t WHERE t.type = 'OBJECT' AND t.value ->> 'scheduledState' = 'DISABLED'"),
    "n03_objects_having": with_(FLOWS, select="SELECT flow_id, t.value ->> 'name' AS name FROM flows, json_tree(json) t WHERE t.type = 'OBJECT' AND json_exists(t.value, '$.componentType')"),
    "n04_schema_paths": with_(
        FLOWS,
        select=r"""SELECT DISTINCT replace(regexp_replace(t.fullkey, '\[\d+\]', '[*]', 'g'), '"', '') AS json_path,
          CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE lower(t.type) END AS type
          FROM flows, json_tree(json) t WHERE t.fullkey <> '$'""",
    ),
    "n06_group_index": with_(FLOWS, select="SELECT flow_id, t.value ->> 'name' AS name, t.value ->> 'identifier' AS identifier FROM flows, json_tree(json) t WHERE t.type = 'OBJECT' AND json_exists(t.value, '$.processGroups') AND json_exists(t.value, '$.identifier')"),
    "n07_processors": with_(
        FLOWS,
        select="""SELECT DISTINCT t.value ->> 'name' AS group_name, p.value ->> 'name' AS processor_name, p.value ->> '$.bundle.version' AS version
          FROM flows, json_tree(json) t, json_each(t.value, '$.processors') p WHERE t.type = 'OBJECT' AND json_exists(t.value, '$.processGroups')""",
    ),
    "n08_process_groups": with_(FLOWS, GROUPS, select="SELECT * FROM groups"),
    "n09_group_report": with_(FLOWS, GROUPS, select="""SELECT DISTINCT "groupIdentifier", nb_processors, nb_disabled, staging, rep_raw, trim(unnest(str_split(subdir, ';'))) AS subdir, port, flux_name FROM groups"""),
    "n10_flow_matches": with_(*LINEAGE, FLOWS, GROUPS, *MATCHES, select="SELECT * FROM matches"),
    "j04_chain_servers": with_(*ALL_SERVED, select="SELECT array_to_string(path, '>') AS path, raw_path, flux_name, server, port FROM served", recursive=True),
    "j16_servers_outside_chain": with_(*ALL_SERVED, select="SELECT chain_id, server FROM served", recursive=True),
    # column lineage
    "l01_projections": with_(
        *FLAT_SCRIPTS,
        select=f"SELECT path, 0 AS stmt_no, item_no, alias, item_sql, formula AS formula_sql, {ORDERED.format('used')} AS columns_used, agg AS aggregations, ops AS arithmetic_ops, {ORDERED.format('tables')} AS tables FROM flat",
    ),
    "l02_nested_projections": NESTED_ITEMS,
    "l03_last_wins": with_(
        cte("items", NESTED_ITEMS),
        select="""SELECT path, alias, formula_sql FROM items WHERE NOT (alias = 'p' AND formula_sql = 'w.p')
          AND NOT (alias = 'NO_ALIAS' AND (formula_sql LIKE 'b.h%' OR formula_sql LIKE 'CAST%'))""",
    ),
    "l09_script_report": with_(
        *FLAT_SCRIPTS,
        select="""SELECT path AS "Nom du Fichier", alias AS "Alias/Projection", array_to_string(used, ', ') AS "Colonnes détectées", agg, ops AS "Opérations arithmétiques",
          formula AS "Formule SQL", array_to_string(tables, ', ') AS "Tables utilisées" FROM flat""",
    ),
    "l09_ddl_columns": with_(
        DDL,
        cte("bare", corpora.BARE_SCRIPTS),
        cte("owned", r"SELECT DISTINCT regexp_extract(content, 'TABLE CDR\.TT_(\d+) \(', 1) AS k, list_transform(str_split(regexp_extract(content, '\((.*?)\)', 1), ', '), lambda x: upper(split_part(x, ' ', 1))) AS fields FROM ddl WHERE content LIKE '%TABLE CDR.TT_%'"),
        cte("inner_query", r"SELECT path, content, regexp_extract(content, 'cdr\.tt_\d+') AS t, ['id', 'qq'] AS bare FROM bare"),
        cte(
            "used",
            """SELECT path, content, t, bare, array_to_string(list_transform(bare, lambda c: CASE WHEN list_contains(coalesce(fields, []), upper(c)) THEN upper(c) ELSE c END), ',') AS columns_used
               FROM inner_query LEFT JOIN owned ON t = 'cdr.tt_' || k""",
        ),
        select="""SELECT path, alias, unnest(bare) AS "column", formula_sql, columns_used FROM used,
                    LATERAL (SELECT 'NO_ALIAS' AS alias, 'MAX ( id + qq )' AS formula_sql UNION ALL SELECT 'm', '( SELECT MAX ( id + qq ) FROM ' || t || ' )') v
                  UNION ALL SELECT path, 'x', 'x', 'a.x', 'x' FROM bare
                  UNION ALL SELECT path, 'n', 'no detected column', 'COUNT ( * )', '' FROM bare
                  UNION ALL SELECT path, 't', 'no detected column', chr(39) || chr(39), '' FROM bare WHERE content LIKE '%TRIM()%'""",
    ),
    "a15_tables_used": with_(*FLAT_SCRIPTS, select="SELECT DISTINCT upper(array_to_string(tables, ', ')) AS tables FROM flat"),
    "l16_source_fields": with_(
        SCRIPTS,
        CLEAN,
        select=r"""SELECT DISTINCT path, regexp_extract(c, '(?:FROM|JOIN) (\S+) ' || f[1] || '\b', 1) AS "table", f[3:] AS field
          FROM (SELECT path, c, unnest(regexp_extract_all(c, '\b[abc]\.\w+')) AS f FROM clean WHERE c LIKE '%SELECT%')""",
    ),
    "l16_nested_source_fields": r"""
      SELECT concat('/PROD/SCRIPTS/compute_nested_', s, '.hql') AS path, v.* FROM (SELECT p_partkey AS k, cast(p_partkey AS string) AS s FROM part) x,
      LATERAL (SELECT concat('s.t_', s) AS "table", unnest(['x']) AS field WHERE k % 4 = 0
        UNION ALL SELECT concat('s.t_', s), unnest(['f', 'g']) WHERE k % 4 = 1
        UNION ALL SELECT concat('s.v_', s), unnest(['h', 'i']) WHERE k % 4 = 1
        UNION ALL SELECT concat('m.n_', s), unnest(['p', 'r']) WHERE k % 4 = 2
        UNION ALL SELECT concat('h.i_', s), 'z' WHERE k % 4 = 2
        UNION ALL SELECT concat('s.t_', s), unnest(['*', 'v', 'k', 'j', 'd', 'e']) WHERE k % 4 = 3
        UNION ALL SELECT concat('s.o_', s), 'k' WHERE k % 4 = 3) v""",
    "l11_track_columns": with_(*FLAT_SCRIPTS, TRACKED, select='SELECT * EXCLUDE (target) FROM tracked'),
    "l10_chain_lineage": warehouse(
        "SELECT s.chain_id, s.position, f.path, f.alias, f.formula AS formula_sql FROM steps s JOIN flat f ON f.path = s.script_path",
        TABLE_SCRIPTS,
        STEPS,
        FLAT,
    ),
    "l12_lake_table_tracking": lake_tracking("AGG.SPARK_FT_1"),
    "l12_fallback": lake_tracking("MON.SPARK_FT_35"),
    "l13_warehouse_tracking": with_(*DWH_TRACKING, select="SELECT * FROM tracking", recursive=True),
    "l13_of_tables": with_(
        *DWH_TRACKING,
        *REPORT[:2],
        select="SELECT * FROM tracking WHERE upper(dwh_table) IN (SELECT upper(Table_RDMS) FROM report)",
        recursive=True,
    ),
    "l15_staged_tracking_report": with_(
        *DWH_TRACKING,
        select="""SELECT DISTINCT tables AS "Tables utilisées", computed_table AS "Table calculée", dwh_field AS dwh_fields, "column" AS "Champ", alias AS "Alias", step AS "Etape",
          path AS "Chemin du fichier HQL", arithmetic_ops AS "Opérations arithmétiques", formula_sql AS "Formule SQL" FROM tracking""",
        recursive=True,
    ),
    "j06_lake_fields": warehouse(
        r"""SELECT chain_id, lake_table, coalesce(f.fields, '') AS fields FROM chains LEFT JOIN (
          SELECT upper(regexp_extract(content, '(?i)TABLE (?:IF NOT EXISTS )?(\S+)', 1)) AS t,
            array_to_string(list_transform(str_split(regexp_extract(regexp_replace(content, 'deep map<\S+', 'deep map,'), '\((.*?)\)', 1), ', '), lambda x: upper(split_part(x, ' ', 1))), ',') AS fields FROM ddl) f ON f.t = lake_table""",
        DDL,
    ),
    "j07_chain_staging": warehouse("SELECT chain_id, chains.dwh_table, j.s AS staging_table FROM chains LEFT JOIN (SELECT upper(dwh_table) AS t, arg_min(staging_table_dwh, conf_path) AS s FROM jobs WHERE dwh_table IS NOT NULL GROUP BY upper(dwh_table)) j ON j.t = chains.dwh_table"),
    "j12_field_map": with_(CONFS, JOBS, CATALOG, FIELD_MAP, select="SELECT * FROM field_map"),
    "a07_catalog_fields": with_(CATALOG, FIELDS, select=f"SELECT table_name, {ORDERED.format('fields')} AS fields FROM fields"),
    # dependency report
    "g07_cooccurrence": report("SELECT * FROM pairs"),
    "r01_external_tables": report("SELECT * FROM external"),
    "a18_external_totals": report('SELECT count(DISTINCT "Table_RDMS") AS nb_tables, count(*) AS nb_pairs FROM external'),
    "r02_dependencies": report("SELECT * FROM deps"),
    "r03_users": report("SELECT * FROM users"),
    "r04_server_metadata": report('SELECT DISTINCT t AS "table", attribute, value FROM cells JOIN meta USING (row_id)'),
    "r05_diagnostic": report(DIAGNOSTIC),
    "r05_of_table": report(f"""SELECT * FROM ({DIAGNOSTIC}) WHERE "table" = 'cdr.tt_3'"""),
    "r02_of_table": report("""SELECT * FROM deps WHERE "table" = 'agg.t_5'"""),
    "r06_similar_tables": report("""SELECT name, priority FROM names JOIN ranks USING ("table") WHERE contains("table", 'mon') ORDER BY priority, name LIMIT 5"""),
    "r06_of_tables": with_(
        SCRIPTS,
        CONFS,
        CLEAN,
        IO,
        LAKE,
        TABLE_SCRIPTS,
        CATALOG,
        *[part for part in REPORT if not part.startswith("pairs ")][:6],
        cte("asked", """SELECT DISTINCT asked, lower(asked) AS t FROM (SELECT concat(owner, '.', table_name) AS asked FROM catalog_rows UNION SELECT "table" FROM table_scripts)"""),
        select="""SELECT asked, name, priority FROM asked JOIN names ON contains("table", split_part(t, '.', 1)) JOIN ranks USING ("table")
          WHERE t NOT IN (SELECT "table" FROM names) QUALIFY row_number() OVER (PARTITION BY asked ORDER BY priority, name) <= 5""",
    ),
    "r07_degrees": report(
        """SELECT t AS "table", (SELECT count(*) FROM pairs WHERE src = t) AS nb_dependencies, (SELECT count(*) FROM pairs WHERE dep = t) AS nb_users
           FROM (SELECT DISTINCT t FROM cells)"""
    ),
    "a13_origins": report('SELECT DISTINCT t AS "table", origin FROM cells'),
    "a14_original_names": report("SELECT * FROM names"),
    "a16_dwh_tables": report('SELECT DISTINCT Table_RDMS FROM report WHERE Table_RDMS IS NOT NULL'),
    "o01_priorities": report("SELECT * FROM ranks"),
}
