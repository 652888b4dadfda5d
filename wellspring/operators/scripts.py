"""Facts read from script text. Each operator is a narrow map over ``(path, content)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X


def loader_scripts(scripts: DataFrame) -> DataFrame:
    """Scripts whose path says they load a table."""
    return scripts.where(F.lower("path").rlike("insert|compute"))


def ddl_scripts(scripts: DataFrame) -> DataFrame:
    return scripts.where(
        F.endswith(F.lower("path"), F.lit(".hql")) & F.contains(F.lower("path"), F.lit("create"))
    )


def insert_targets(sql: Column, include_overwrite: bool = False) -> Column:
    pattern = P.INSERT_OR_OVERWRITE_TARGET if include_overwrite else P.INSERT_TARGET
    return F.transform(X.all_matches(sql, pattern), F.upper)


def script_io(
    scripts: DataFrame, strip_comments: bool = True, include_overwrite: bool = False
) -> DataFrame:
    """``path, target, targets, sources``: what each script writes and reads.

    ``target`` is the first table inserted into, and it is never among its own sources.
    """
    sql = X.remove_comments(F.col("content")) if strip_comments else F.col("content")
    return (
        scripts.select("path", sql.alias("sql"))
        .select(
            "path",
            insert_targets(F.col("sql"), include_overwrite).alias("targets"),
            X.source_tables(F.col("sql")).alias("found"),
        )
        .withColumn("target", F.try_element_at("targets", F.lit(1)))
        .select(
            "path",
            "target",
            "targets",
            F.when(F.col("target").isNull(), F.col("found"))
            .otherwise(F.array_remove("found", F.col("target")))
            .alias("sources"),
        )
    )


def script_targets(
    scripts: DataFrame, strip_comments: bool = True, include_overwrite: bool = False
) -> DataFrame:
    """``path, target`` for every distinct table a script inserts into."""
    io = script_io(scripts, strip_comments, include_overwrite)
    return io.select("path", F.explode(F.array_distinct("targets")).alias("target"))


def insert_tokens(scripts: DataFrame) -> DataFrame:
    """``path, token``: the raw word after the first INSERT INTO (``TABLE`` when that is next)."""
    return scripts.select("path", X.first_match(F.col("content"), P.INSERT_TOKEN).alias("token"))


def quoted_sources(scripts: DataFrame) -> DataFrame:
    """``path, tables``: distinct ``s.t`` of ``FROM "s"."t" AS "a"`` clauses."""
    schema = X.all_matches(F.col("content"), P.QUOTED_SOURCE, 1)
    table = X.all_matches(F.col("content"), P.QUOTED_SOURCE, 2)
    names = F.zip_with(schema, table, lambda s, t: F.concat_ws(".", s, t))
    return scripts.select("path", F.array_distinct(names).alias("tables"))


def _column_names(body: Column) -> Column:
    """First word of every top-level item of a DDL column list.

    Types with arguments (``decimal(10,2)``, ``map<string,int>``) hold commas of their own, so only
    what stands outside all brackets is split.
    """
    flat = F.regexp_replace(body, r"(?is)\bCOMMENT\s+'[^'\\]*+(?:\\.[^'\\]*+)*+'", "")
    flat = X.remove_comments(F.concat(flat, F.lit("\n")))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("outside"))

    def step(acc: Column, part: Column) -> Column:
        opens, closes = part.isin("<", "("), part.isin(">", ")")
        plain = (acc["depth"] == 0) & ~opens & ~closes
        depth = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        return F.struct(
            F.greatest(depth, F.lit(0)).alias("depth"),
            F.when(plain, F.array_append(acc["outside"], part)).otherwise(acc["outside"]).alias("outside"),
        )

    parts = X.all_matches(flat, r"[<>()]|[^<>()]++", 0)
    flat = F.array_join(F.aggregate(parts, start, step)["outside"], "")
    words = F.transform(
        F.split(flat, ","), lambda item: F.regexp_extract(item, r"(?U)^\s*`?(\w+)`?\s+\w", 1)
    )
    return F.transform(F.filter(words, lambda w: w != ""), F.upper)


def ddl_profile(scripts: DataFrame) -> DataFrame:
    """``path, table_name, fields, partitioned_by, if_not_exists`` of CREATE TABLE scripts.

    Three shapes are tried in order: managed with IF NOT EXISTS, managed, external delimited.
    """
    content = F.col("content")

    def shape(pattern: str, partitioned: bool) -> Column:
        parts = F.struct(
            F.regexp_extract(content, pattern, 1).alias("name"),
            F.regexp_extract(content, pattern, 2).alias("body"),
            (F.regexp_extract(content, pattern, 3) if partitioned else F.lit("")).alias("part"),
        )
        return F.when(content.rlike(pattern), parts)

    hit = F.coalesce(
        shape(P.DDL_MANAGED_GUARDED, True), shape(P.DDL_MANAGED, True), shape(P.DDL_EXTERNAL, False)
    )
    found = F.col("hit").isNotNull()
    return scripts.select("path", "content", hit.alias("hit")).select(
        "path",
        F.upper("hit.name").alias("table_name"),
        F.when(found, _column_names(F.col("hit.body")))
        .otherwise(F.array().cast("array<string>"))
        .alias("fields"),
        X.blank_to_null(F.upper("hit.part")).alias("partitioned_by"),
        (found & F.contains(F.upper("content"), F.lit("IF NOT EXISTS"))).alias("if_not_exists"),
    )


def ddl_catalog(scripts: DataFrame) -> DataFrame:
    return ddl_profile(ddl_scripts(scripts))


def statements(scripts: DataFrame) -> DataFrame:
    """``path, stmt_no, statement``: scripts cut at ``;`` outside quotes, blank statements dropped."""
    mark = "\u0001"
    segments = X.all_matches(F.col("content"), P.STATEMENT_SEGMENT, 0)
    cut = F.array_join(F.transform(segments, lambda s: F.when(s == ";", mark).otherwise(s)), "")
    return (
        scripts.select("path", F.posexplode(F.split(cut, mark)).alias("stmt_no", "statement"))
        .withColumn("statement", X.strip(F.col("statement")))
        .where(F.col("statement") != "")
    )


def statement_profile(scripts: DataFrame) -> DataFrame:
    """``path, stmt_no, table_no, table, columns, calculated_fields``: one row per FROM table."""
    sql = F.col("statement")
    renames = F.zip_with(
        X.all_matches(sql, P.STATEMENT_RENAME, 2),
        X.all_matches(sql, P.STATEMENT_RENAME, 1),
        lambda alias, source: F.struct(alias.alias("alias"), source.alias("source")),
    )
    return (
        statements(scripts)
        .select(
            "path",
            "stmt_no",
            X.all_matches(sql, P.STATEMENT_TABLE).alias("tables"),
            X.all_matches(sql, P.STATEMENT_COLUMNS).alias("columns"),
            renames.alias("calculated_fields"),
        )
        .select(
            "path",
            "stmt_no",
            F.posexplode("tables").alias("table_no", "table"),
            "columns",
            "calculated_fields",
        )
    )
