"""Regular expressions and word lists of the input formats.

Fixed values: they describe HiveQL text, job-conf keys and flow-export variables, and must stay as
they are for results to be right. All expressions are Java regexes; ``(?U)`` makes ``\\s`` and
``\\b`` cover Unicode blanks such as U+00A0, which do occur in hand-edited confs.
"""

# --- HiveQL text -------------------------------------------------------------------------------
TABLE_NAME = r"[A-Za-z_][A-Za-z0-9_]*\.[A-Za-z_][A-Za-z0-9_]*"
LINE_COMMENT = r"(?d)--+.*?(?:\r\n|\r|\n)"
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
EMPTY_TRIM = r"(?iU)trim\s*\(\s*\)"
SOURCE_TABLE = rf"(?iU)\b(?:FROM|JOIN)\s+({TABLE_NAME})\b"
INSERT_TARGET = rf"(?iU)\bINSERT\s+INTO\s+(?:TABLE\s+)?({TABLE_NAME})"
INSERT_OR_OVERWRITE_TARGET = rf"(?iU)\bINSERT\s+(?:INTO|OVERWRITE)\s+(?:TABLE\s+)?({TABLE_NAME})"
INSERT_TOKEN = r"(?iU)INSERT\s+INTO\s+([^\s()]+)"
QUOTED_SOURCE = r'(?iU)FROM\s+"([^"]+)"\."([^"]+)"\s+AS\s+"[^"]+"'

DDL_MANAGED_GUARDED = (
    r"(?isU)CREATE\s+TABLE\s+IF\s+NOT\s+EXISTS\s+(\S+)\s*\((.*?)\)"
    r"\s*(PARTITIONED\s+BY\s*\(.*?\))?\s*STORED\s+AS\s+\w+"
)
DDL_MANAGED = (
    r"(?isU)CREATE\s+TABLE\s+(\S+)\s*\((.*?)\)"
    r"\s*(PARTITIONED\s+BY\s*\(.*?\))?\s*STORED\s+AS\s+\w+"
)
DDL_EXTERNAL = (
    r"(?isU)CREATE\s+EXTERNAL\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(\S+)\s*\((.*?)\)"
    r"\s*(?:COMMENT\s+'.*?')?\s*ROW\s+FORMAT\s+DELIMITED\s+FIELDS\s+TERMINATED\s+BY\s+'.*?'"
    r"\s*LOCATION\s+'(?:.*?)'"
)

STATEMENT_SEGMENT = (
    r"'[^'\\]*+(?:\\.[^'\\]*+)*+'?"
    r'|"[^"\\]*+(?:\\.[^"\\]*+)*+"?'
    r"|;|[^;'\"]++"
)
STATEMENT_TABLE = r"(?iU)\bFROM\s+([a-zA-Z0-9_.]+)"
STATEMENT_COLUMNS = r"(?isU)\bSELECT\s+(.*?)\bFROM"
STATEMENT_RENAME = r"(?iU)\b([\w.]+)\s+AS\s+(\w+)"

# --- job confs ---------------------------------------------------------------------------------
CONF_PRE_EXEC = r'(?U)flux\.pre-exec-queries\s*\+=\s*"([^"]+)"'
CONF_EXEC = r'(?U)flux\.exec-queries\s*\+=\s*"([^"]+)"'
CONF_RAW_DIR = r'(?U)flux\.hdfs\.src-temp-tt-dir-regex\s*=\s*"([^"]+)"'
CONF_TT_DIR = r'(?U)flux\.hdfs\.dest-temp-tt-dir\s*=\s*"([^"]+)"'
CONF_HIVE_EXTRA = r'(?U)flux\.hive\.extra-conf\s*\+=\s*"([^"]+)"'
CONF_TT_TABLE = r"(?U)--hivevar\s+tt_table_name\s*=\s*(\S+)"
CONF_STAGING_TABLE = r'(?U)flux\.sqoop\.export-rdms\.staging-table\s*=\s*"([^"\n]+)"'
CONF_DEST_TABLE = r'(?U)flux\.sqoop\.export-rdms\.dest-table\s*=\s*"([^"\n]+)"'
CONF_DWH_BLOCK = r'(?isU)flux\.rdms\.pre-exec-queries\s*\+=\s*""".*?FROM\s+\S+\s+WHERE'
CONF_LAKE_BLOCK = r'(?isU)flux\.hive\.pre-exec-queries\s*\+=\s*""".*?FROM\s+\S+\s+WHERE'
CONF_EXEC_KEY = "flux.exec-queries"

# --- flow exports ------------------------------------------------------------------------------
VAR_REMOTE_PATH = "flux.sftp.remote-path"
VAR_STAGING_FINAL = "flux.stagging.final"
VAR_FILE_DIR = "flux.hdfs.filedir"
VAR_RAW_DIR = "flux.hdfs.raw"
# output column -> variable that sets it
SIMPLE_VARIABLES = {
    "subdir": "flux.hdfs.subdir-names",
    "port": "flux.sftp.port",
    "flux_name": "flux.name",
    "ip_adress": "flux.sftp.hostname",
    "username": "flux.sftp.username",
    "regex": "flux.filenames-regex",
}
LISTING_PROCESSOR = "List Files"
DISABLED = "DISABLED"
ENABLED = "ENABLED"
MAX_DISABLED_RATIO = 0.8
NO_SUBDIR = "Aucun subdir"
UNWANTED_PATH_CHARS = r"[\u200b\u00a0\r\n]"

# --- HiveQL tokens -----------------------------------------------------------------------------
# comment, string, backquoted or plain (dotted) name, number, two-character operator, other sign
NAME_PART = r"(?:`[^`]++`|(?:[A-Za-z_]|\$\{[^}]*+\})(?:\w|\$\{[^}]*+\})*+)"
TOKEN = (
    r"--[^\r\n]*+"
    r"|'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    r'|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    rf"|{NAME_PART}(?:\.(?:{NAME_PART}|\*))*+"
    r"|\d++(?:\.\d*+)?(?:[eE][+-]?\d++)?[A-Za-z]*+"
    r"|<=>|<>|!=|>=|<=|==|\|\||&&|::"
    r"|\S"
)
NAME_TOKEN = r"^[A-Za-z_`]"
LITERAL_TOKEN = r"^['\"0-9]"
SET_OPERATORS = ["EXCEPT", "INTERSECT", "MINUS", "UNION"]
# words that open a clause of a query
CLAUSES = [
    "FROM",
    "HAVING",
    "INSERT",
    "JOIN",
    "LATERAL",
    "LIMIT",
    "ON",
    "SELECT",
    "USING",
    "WHERE",
    "WINDOW",
    "WITH",
    *SET_OPERATORS,
]
# words that do so when BY follows
CLAUSES_WITH_BY = ["CLUSTER", "DISTRIBUTE", "GROUP", "ORDER", "SORT"]
RESERVED = [
    "ALL",
    "AND",
    "ANTI",
    "AS",
    "ASC",
    "BETWEEN",
    "BOTH",
    "BY",
    "CASE",
    "CROSS",
    "CURRENT",
    "CURRENT_DATE",
    "CURRENT_TIMESTAMP",
    "DESC",
    "DISTINCT",
    "DIV",
    "ELSE",
    "END",
    "ESCAPE",
    "EXISTS",
    "FALSE",
    "FOLLOWING",
    "FULL",
    "IN",
    "INNER",
    "INTERVAL",
    "INTO",
    "IS",
    "LEADING",
    "LEFT",
    "LIKE",
    "NATURAL",
    "NOT",
    "NULL",
    "NULLS",
    "OR",
    "OUTER",
    "OVER",
    "OVERWRITE",
    "PARTITION",
    "PRECEDING",
    "RANGE",
    "REGEXP",
    "RIGHT",
    "RLIKE",
    "ROWS",
    "SEMI",
    "TABLE",
    "TABLESAMPLE",
    "THEN",
    "TRAILING",
    "TRUE",
    "UNBOUNDED",
    "WHEN",
    *CLAUSES,
    *CLAUSES_WITH_BY,
]
ARITHMETIC = ["+", "-", "*", "/", "%"]

# --- column lineage ----------------------------------------------------------------------------
NO_ALIAS = "NO_ALIAS"
NO_TABLE = "Aucune table"
NO_COLUMN = "no detected column"
UNKNOWN_TABLE = "UNKNOWN_TABLE"
CYCLE_SUFFIX = " (cycle détecté)"
# Hive function -> label in the reports
AGGREGATE_LABELS = {
    "approx_count_distinct": "APPROXDISTINCT",
    "avg": "AVG",
    "collect_list": "ARRAYAGG",
    "collect_set": "ARRAYUNIQUEAGG",
    "corr": "CORR",
    "count": "COUNT",
    "covar_pop": "COVARPOP",
    "covar_samp": "COVARSAMP",
    "first_value": "FIRSTVALUE",
    "lag": "LAG",
    "last_value": "LASTVALUE",
    "lead": "LEAD",
    "max": "MAX",
    "min": "MIN",
    "percentile": "QUANTILE",
    "percentile_approx": "APPROXQUANTILE",
    "stddev": "STDDEV",
    "stddev_pop": "STDDEVPOP",
    "stddev_samp": "STDDEVSAMP",
    "sum": "SUM",
    "var_pop": "VARIANCEPOP",
    "var_samp": "VARIANCE",
    "variance": "VARIANCE",
}

# --- dependency report -------------------------------------------------------------------------
DWH_COLUMN = "Table_RDMS"
LAKE_COLUMN = "Table_Hive"
DEPENDENCY_PREFIX = "Dep_datalake"
SERVER_COLUMNS = [
    "Server",
    "Raw_Path",
    "Flux_Name",
    "Nb_processor",
    "Nb_disabled_processors",
    "Hostname",
    "Port",
    "username",
]
EXTERNAL_PREFIX = "CDR."

# Fixed value: a two-part table name in a typed-in question.
REPORT_NAME = r"([a-z0-9_]+\.[a-z0-9_]+)"
