"""Column lineage of scripts: SELECT items with the columns, functions and tables behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X
from wellspring.operators import tokens as T
from wellspring.session import materialize


def select_items(outline: DataFrame) -> DataFrame:
    """``doc, stmt, select_pos, item_no`` and what is in every SELECT item.

    A statement's tokens are gathered once, within the partition that already holds the script;
    items and queries are slices of them.
    """
    name = F.upper(T.column_name())
    outer = F.col("is_column") & (F.col("outer_query") >= 0) & ~F.col("nested")
    # symbol table of a script: is this name a column of one of its outermost queries?
    known = F.max(outer).over(W.partitionBy("doc", name))
    word = F.struct(
        "pos", "tok", "depth", "is_table", "is_column", "is_alias", "known", "label", "operator"
    )
    item = F.struct("level", "query", "item_start", "item_end")
    query = F.struct("level", "query", "query_end")
    statements = (
        outline.withColumn("known", F.col("is_column") & known)
        .groupBy("doc", "stmt")
        .agg(
            F.sort_array(F.collect_list(F.when(~F.col("edge"), word))).alias("tokens"),
            F.sort_array(
                F.collect_list(F.when((F.col("item_start") >= 0) & (F.col("query") >= 0), item))
            ).alias("items"),
            F.collect_list(F.when(F.col("query_end").isNotNull(), query)).alias("queries"),
        )
    )

    def between(begin: Column, end: Column) -> Column:
        """Tokens from one position to before another."""
        return F.slice("tokens", begin + 1, F.least(end, F.size("tokens")) - begin)

    def tables(q: Column) -> Column:
        inside = F.filter(between(q["query"], q["query_end"]), lambda t: t["is_table"])
        return F.array_sort(F.array_distinct(F.transform(inside, lambda t: T.table_name(t["tok"]))))

    tables_of = F.map_from_entries(
        F.transform("queries", lambda q: F.struct(q["query"], tables(q).alias("tables")))
    )

    def filled(i: Column) -> Column:
        return F.struct(
            i["level"].alias("level"),
            i["query"].alias("select_pos"),
            i["item_start"].alias("item"),
            between(i["item_start"] + 1, i["item_end"]).alias("words"),
            F.try_element_at("tables_of", i["query"]).alias("tables"),
        )

    order = W.partitionBy("doc", "stmt", "level", "select_pos").orderBy("item")
    items = (
        statements.select("doc", "stmt", "tokens", "items", tables_of.alias("tables_of"))
        .select("doc", "stmt", F.inline(F.transform("items", filled)))
        .where(F.size("words") > 0)
        .withColumn("item_no", F.row_number().over(order) - 1)
    )

    words = F.col("words")
    last, before = F.try_element_at(words, F.lit(-1)), F.try_element_at(words, F.lit(-2))
    named = F.when(
        (last["depth"] == F.col("level")) & last["is_alias"],
        F.when(F.upper(before["tok"]) == "AS", F.lit(2)).otherwise(F.lit(1)),
    ).otherwise(F.lit(0))
    single = F.when(
        F.size("words") == 1,
        F.when(last["is_column"], F.element_at(F.split(F.translate(last["tok"], "`", ""), r"\."), -1)).when(
            last["tok"] == "*", last["tok"]
        ),
    )
    alias = F.when(F.col("named") > 0, F.translate(last["tok"], "`", "")).otherwise(single)
    items = (
        items.withColumn("named", named)
        .select(
            "doc",
            "stmt",
            "level",
            "select_pos",
            "item_no",
            F.coalesce(alias, F.lit(P.NO_ALIAS)).alias("alias"),
            F.array_join(F.transform(words, lambda w: w["tok"]), " ").alias("item_sql"),
            F.slice(words, F.lit(1), F.size(words) - F.col("named")).alias("words"),
            "tables",
        )
    )

    def labels(field: str):
        found = F.transform("words", lambda w: w[field])
        return F.sort_array(F.array_distinct(F.filter(found, lambda v: v.isNotNull())))

    def bare(tok):
        return F.size(F.split(tok, r"\.")) == 1

    def name(tok):
        return F.element_at(F.split(F.translate(tok, "`", ""), r"\."), -1)

    used = F.transform(
        F.filter("words", lambda w: w["is_column"]),
        lambda w: F.struct(
            name(w["tok"]).alias("name"),
            bare(w["tok"]).alias("bare"),
            w["known"].alias("known"),
        ),
    )
    return items.select(
        "doc",
        "stmt",
        "level",
        "select_pos",
        "item_no",
        "alias",
        "item_sql",
        F.array_join(F.transform("words", lambda w: w["tok"]), " ").alias("formula_sql"),
        used.alias("used"),
        labels("label").alias("aggregations"),
        labels("operator").alias("arithmetic_ops"),
        "tables",
    )


def _settle(items: DataFrame) -> DataFrame:
    """Columns as they are reported: a bare name known to the script in upper case."""
    columns = F.transform(
        "used", lambda u: F.when(u["bare"] & u["known"], F.upper(u["name"])).otherwise(u["name"])
    )
    return items.withColumn("columns_used", columns).drop("used")


def _with_ddl(items: DataFrame, ddl: DataFrame) -> DataFrame:
    """Marks bare names as known that the DDL of a table read by the script declares.

    The items are written once, as the names still unknown are picked from them before the marks
    are put on them. Names are looked up one by one, distinct per script; an item gets back those of
    its own names only.
    """
    items = materialize(items)
    key = ["doc", "stmt", "select_pos", "item_no"]
    unknown = (
        items.select(*key, F.explode("used").alias("u"))
        .where(F.col("u.bare") & ~F.col("u.known"))
        .select(*key, F.upper("u.name").alias("name"))
        .distinct()
    )
    sources = (
        items.where(F.col("level") == 0)
        .select("doc", F.explode(F.transform("tables", F.upper)).alias("table"))
        .distinct()
    )
    fields = ddl.select(F.upper("table_name").alias("table"), F.explode("fields").alias("name"))
    symbols = (
        unknown.select("doc", "name")
        .distinct()
        .join(sources, "doc")
        .join(fields.distinct(), ["table", "name"])
        .select("doc", "name")
        .distinct()
    )
    declared = (
        unknown.join(symbols, ["doc", "name"]).groupBy(*key).agg(F.collect_set("name").alias("declared"))
    )
    known = F.transform(
        "used",
        lambda u: u.withField(
            "known",
            u["known"] | F.coalesce(F.array_contains("declared", F.upper(u["name"])), F.lit(False)),
        ),
    )
    return items.join(declared, key, "left").withColumn("used", known).drop("declared")


def projections(scripts: DataFrame, ddl: DataFrame | None = None) -> DataFrame:
    """One row per SELECT item of every script.

    ``path, stmt_no, select_pos, item_no, alias, formula_sql, columns_used, aggregations,
    arithmetic_ops, tables``. ``ddl`` (``table_name, fields``) helps to recognise bare columns.
    """
    items = select_items(T.outline(T.clauses(T.tokens(scripts))))
    if ddl is not None:
        items = _with_ddl(items, ddl)
    paths = scripts.select("path", T.doc_key(F.col("content")).alias("doc"))
    return paths.join(_settle(items), "doc").select(
        "path",
        F.col("stmt").alias("stmt_no"),
        "select_pos",
        "item_no",
        "alias",
        "item_sql",
        "formula_sql",
        "columns_used",
        "aggregations",
        "arithmetic_ops",
        "tables",
    )


def last_wins(projections: DataFrame) -> DataFrame:
    """One row per script and alias: the last item that uses the alias."""
    order = F.struct("stmt_no", "select_pos", "item_no")
    rest = [c for c in projections.columns if c not in ("path", "alias")]
    return (
        projections.groupBy("path", "alias")
        .agg(F.max_by(F.struct(*rest), order).alias("v"))
        .select("path", "alias", "v.*")
    )


def tables_text(tables: str = "tables"):
    return F.when(F.size(tables) == 0, P.NO_TABLE).otherwise(X.joined(F.col(tables)))


def script_report(projections: DataFrame) -> DataFrame:
    """The script lineage report, lists as text."""
    return projections.select(
        F.col("path").alias("Nom du Fichier"),
        F.col("alias").alias("Alias/Projection"),
        X.joined(F.col("columns_used")).alias("Colonnes détectées"),
        X.joined(F.col("aggregations")).alias("agg"),
        X.joined(F.col("arithmetic_ops")).alias("Opérations arithmétiques"),
        F.col("formula_sql").alias("Formule SQL"),
        tables_text().alias("Tables utilisées"),
    )


def tables_used(projections: DataFrame) -> DataFrame:
    """``tables``: distinct upper-case "tables used" texts."""
    return projections.select(F.upper(tables_text()).alias("tables")).distinct()


def _source_fields(outline: DataFrame) -> DataFrame:
    """``doc, table, field`` of the outermost queries, distinct."""
    top = outline.where((F.col("outer_query") >= 0) & ~F.col("edge"))
    own, from_clause = F.col("depth") == 0, F.col("outer_clause").isin("FROM", "ON")
    base = F.split(F.translate("tok", "`", ""), r"\.")

    # FROM t [AS] a: the alias follows its table; a derived table's or CTE's tables are found by
    # the number of the parenthesis they stand in.
    direct = F.when(
        own & F.col("is_table"),
        F.struct("pos", F.element_at(base, -1).alias("name"), T.table_name().alias("table")),
    )
    renamed = F.when(
        own & from_clause & F.col("is_alias"),
        F.struct("pos", "tok", "group", F.when(F.col("prev") == "AS", F.col("prev2")).otherwise(F.col("prev")).alias("of")),
    )
    inner = F.when(~own & F.col("is_table"), F.struct("group", T.table_name().alias("table")))
    cte = F.when(
        own & (F.col("outer_clause") == "WITH") & (F.col("next") == "AS"),
        F.struct((F.col("group") + 1).alias("group"), F.col("tok").alias("name")),
    )
    used = F.when(
        F.col("is_column") & ~F.col("nested"),
        F.struct(T.qualifier().alias("qualifier"), T.column_name().alias("field")),
    )
    queries = top.groupBy("doc", "stmt", "outer_query").agg(
        F.sort_array(F.collect_list(direct)).alias("direct"),
        F.sort_array(F.collect_list(renamed)).alias("renamed"),
        F.collect_set(inner).alias("inner"),
        F.collect_set(cte).alias("ctes"),
        F.collect_set(used).alias("used"),
    )

    def tables_in(group):
        return F.transform(F.filter("inner", lambda i: i["group"] == group), lambda i: i["table"])

    def source(names, tables):
        return F.struct(names.alias("names"), tables.alias("tables"))

    # An alias belongs to the nearest table before it unless it follows a closing parenthesis.
    def of_table(t):
        after = F.filter(
            "renamed",
            lambda r: (r["of"] != ")") & (r["pos"] > t["pos"]) & (r["pos"] <= t["pos"] + 2),
        )
        ctes = F.filter("ctes", lambda c: F.lower(c["name"]) == F.lower(t["table"]))
        tables = F.when(F.size(ctes) > 0, tables_in(F.try_element_at(ctes, F.lit(1))["group"])).otherwise(
            F.array(t["table"])
        )
        alias = F.try_element_at(after, F.lit(1))["tok"]
        return source(
            F.filter(F.array(F.translate(F.coalesce(alias, t["name"]), "`", "")), lambda n: n.isNotNull()),
            tables,
        )

    derived = F.transform(
        F.filter("renamed", lambda r: r["of"] == ")"),
        lambda r: source(F.array(F.translate(r["tok"], "`", "")), tables_in(r["group"])),
    )
    sources = F.concat(F.transform("direct", of_table), derived)

    def owners(u):
        hits = F.filter(
            "sources",
            lambda s: F.array_contains(F.transform(s["names"], F.lower), F.lower(u["qualifier"])),
        )
        known = F.flatten(F.transform(hits, lambda s: s["tables"]))
        only = F.try_element_at("sources", F.lit(1))["tables"]
        return (
            F.when(
                u["qualifier"].isNull(),
                F.when(F.size("sources") == 1, only).otherwise(F.array(F.lit(P.UNKNOWN_TABLE))),
            )
            .when(F.size(hits) > 0, known)
            .otherwise(F.array(u["qualifier"]))
        )

    pairs = F.transform("used", lambda u: F.struct(owners(u).alias("tables"), u["field"].alias("field")))
    return (
        queries.withColumn("sources", sources)
        .select("doc", F.inline(pairs))
        .select("doc", F.explode("tables").alias("table"), "field")
        .distinct()
    )


def source_fields(scripts: DataFrame) -> DataFrame:
    """``path, table, field``: fields each script's outermost query uses, per source table.

    Derived tables and CTEs stand for the tables inside them. A bare column belongs to the only
    source, or to ``UNKNOWN_TABLE`` when there are several.
    """
    fields = _source_fields(T.outline(T.clauses(T.tokens(scripts))))
    paths = scripts.select("path", T.doc_key(F.col("content")).alias("doc"))
    return paths.join(fields, "doc").select("path", "table", "field")
