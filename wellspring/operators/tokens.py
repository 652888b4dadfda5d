"""Token table of a script corpus, the basis of column lineage.

Scripts are cut into tokens with one regular expression and understood with window functions: no
parser. Everything is keyed by ``doc``, the hash of a script's text. Equal scripts are analysed
once and dealt out by their text's size: all tokens of a script are in one partition, so the windows
that follow sort but do not shuffle again, and a partition holds a bounded amount of text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wellspring.functions import patterns as P
from wellspring.functions import text as X
from wellspring.operators.scripts import statements
from wellspring.session import materialize

#: Characters of script text in a partition. As tokens they take several hundred times as much in
#: the sorts of one task, and partitions cannot be split any more when that is seen.
TEXT_CHARS = 512 * 1024


def doc_key(content: Column) -> Column:
    return F.sha2(content, 256)


def unique_scripts(scripts: DataFrame) -> DataFrame:
    """``doc, content``: every distinct script text once."""
    return scripts.groupBy(doc_key(F.col("content")).alias("doc")).agg(
        F.first("content").alias("content")
    )


def _dealt(docs: DataFrame) -> DataFrame:
    """``docs`` by ``doc`` in as many partitions as their text asks for, however large the corpus.

    They are written once, and the write tells the size.
    """
    seen = Observation()
    chars = F.sum(F.length("content")).alias("chars")
    docs = materialize(docs.observe(seen, chars))
    parts = (seen.get.get("chars") or 0) // TEXT_CHARS + 1
    return docs.repartition(max(parts, docs.sparkSession.sparkContext.defaultParallelism), "doc")


def tokens(scripts: DataFrame) -> DataFrame:
    """``doc, stmt, pos, tok`` with neighbours and depth, of the cleaned distinct scripts.

    ``depth`` counts the parentheses around a token; a parenthesis itself lies at the outer depth.
    ``after_operand`` says that the token before may end an expression: a name is then an alias, a
    sign a binary operator.
    """
    docs = _dealt(unique_scripts(scripts)).select(
        F.col("doc").alias("path"), X.clean_script(F.col("content")).alias("content")
    )
    words = F.filter(
        X.all_matches(F.col("statement"), P.TOKEN, 0), lambda t: ~F.startswith(t, F.lit("--"))
    )
    flat = statements(docs).select(
        F.col("path").alias("doc"),
        F.col("stmt_no").alias("stmt"),
        F.posexplode(words).alias("pos", "tok"),
    )
    word = F.col("word")
    nesting = F.when(F.col("tok") == "(", 1).when(F.col("tok") == ")", -1).otherwise(0)
    kinds = flat.withColumn("word", F.upper("tok")).select(
        "*",
        (word.rlike(P.NAME_TOKEN) & ~word.isin(P.RESERVED)).alias("is_name"),
        nesting.alias("nesting"),
    )
    ends = F.col("is_name") | word.rlike(P.LITERAL_TOKEN) | word.isin(")", "END", "NULL")
    order = W.partitionBy("doc", "stmt").orderBy("pos")
    level = F.sum("nesting").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return kinds.withColumn("ends", ends).select(
        "doc",
        "stmt",
        "pos",
        "tok",
        "word",
        "is_name",
        F.lag("word").over(order).alias("prev"),
        F.lag("word", 2).over(order).alias("prev2"),
        F.lead("word", 1, "").over(order).alias("next"),
        F.lag("ends", 1, False).over(order).alias("after_operand"),
        F.greatest(level - (F.col("tok") == "(").cast("int"), F.lit(0)).cast("int").alias("depth"),
    )


#: Position beyond any statement.
END = 2**31 - 1


def _next(event: str) -> Column:
    """Position of the next row at the same depth for which ``event`` holds."""
    return F.expr(
        f"lead(CASE WHEN {event} THEN pos END) IGNORE NULLS "
        "OVER (PARTITION BY doc, stmt, level ORDER BY pos, edge)"
    )


def clauses(tokens: DataFrame) -> DataFrame:
    """Tokens with the clause and query they stand in, and the part they play there.

    Adds ``clause``, ``query`` (position that identifies the SELECT), ``item_start`` (position
    when a SELECT item starts after the token, -1 when one ends, NULL otherwise), ``is_table``,
    ``is_column``, ``is_alias``, ``label`` (aggregate), ``operator`` (binary arithmetic).

    A parenthesis also gets a row at the inner depth, which resets clause and query there; those
    rows have ``edge`` true.

    Queries and items are intervals of positions: the row that opens one has its end, the position
    of the next such row at its depth (NULL if the statement ends first), in ``item_end`` or
    ``query_end``. What lies inside, however deep, is found by positions alone.
    """
    both = F.when(F.col("tok").isin("(", ")"), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    rows = tokens.withColumn("edge", F.explode(both)).withColumn(
        "level", F.col("depth") + F.col("edge").cast("int")
    )
    order = W.partitionBy("doc", "stmt", "level").orderBy("pos", "edge")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    word, pos = F.col("word"), F.col("pos")

    opens = (
        word.isin(P.CLAUSES) & ~((word == "FROM") & F.coalesce(F.col("prev") == "DISTINCT", F.lit(False)))
    ) | (word.isin(P.CLAUSES_WITH_BY) & (F.col("next") == "BY"))
    keyword = F.when(F.col("edge"), "(").when(opens, F.when(word == "JOIN", "FROM").otherwise(word))
    rows = rows.withColumn("keyword", keyword).select(
        "*",
        F.last("keyword", True).over(so_far).alias("clause"),
        F.last("keyword", True).over(before).alias("last_clause"),
    )

    # A SELECT right after its WITH clause belongs to the query that WITH opened.
    query = (
        F.when(F.col("edge") | word.isin(*P.SET_OPERATORS, "INSERT"), -1)
        .when((F.col("keyword") == "SELECT") & (F.col("last_clause") == "WITH"), F.lit(None))
        .when(F.col("keyword").isin("SELECT", "WITH"), pos)
    )
    item_start = (
        F.when(F.col("keyword") == "SELECT", pos)
        .when(F.col("keyword").isNotNull(), -1)
        .when((F.col("clause") == "SELECT") & (word == ","), pos)
        .when(word.isin("DISTINCT", "ALL") & (F.col("prev") == "SELECT"), pos)
    )
    rows = rows.select(
        "*",
        item_start.alias("item_start"),
        query.alias("turn"),
    ).select(
        "*",
        F.last("turn", True).over(so_far).alias("query"),
        F.last("turn", True).over(before).alias("last_query"),
        _next("item_start IS NOT NULL OR turn IS NOT NULL").alias("item_end"),
        _next("turn IS NOT NULL").alias("query_end"),
    )
    in_query = F.coalesce(F.col("query") >= 0, F.lit(False))

    name, call = F.col("is_name"), F.col("next") == "("
    table = (
        name
        & ~call
        & in_query
        & (
            ((F.col("clause") == "FROM") & F.col("prev").isin("FROM", "JOIN"))
            | (F.col("clause").isin("FROM", "ON") & (F.col("prev") == ","))
        )
    )
    alias = name & ~call & ((F.col("prev") == "AS") | F.col("after_operand"))
    # Names in these clauses are tables and aliases. EXTRACT(DAY FROM x) has a FROM but no query.
    listed = in_query & F.col("clause").isin("FROM", "LATERAL", "INSERT", "WITH")
    unit = ~in_query & (F.col("prev") == "(") & (F.col("next") == "FROM")
    column = (
        name & ~call & ~alias & ~table & ~F.coalesce(listed, F.lit(False)) & ~F.coalesce(unit, F.lit(False))
    )
    labels = F.create_map(*[F.lit(x) for pair in P.AGGREGATE_LABELS.items() for x in pair])

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)) & ~F.col("edge")

    return rows.select(
        "doc",
        "stmt",
        "pos",
        "tok",
        "prev",
        "prev2",
        "next",
        "depth",
        "level",
        "edge",
        "clause",
        "query",
        "item_start",
        F.when(F.col("item_start") >= 0, F.coalesce("item_end", F.lit(END))).alias("item_end"),
        F.when(F.col("turn") >= 0, F.coalesce("query_end", F.lit(END))).alias("query_end"),
        (in_query.cast("int") - F.coalesce(F.col("last_query") >= 0, F.lit(False)).cast("int")).alias(
            "opened"
        ),
        flag(table).alias("is_table"),
        flag(column).alias("is_column"),
        flag(alias).alias("is_alias"),
        F.when(flag(name & call), F.try_element_at(labels, F.lower("tok"))).alias("label"),
        F.when(flag(F.col("tok").isin(P.ARITHMETIC) & F.col("after_operand")), F.col("tok")).alias(
            "operator"
        ),
    )


def outline(clauses: DataFrame) -> DataFrame:
    """Tokens with what surrounds them: ``clause``, ``query`` and ``group`` at the outermost depth,
    and ``nested``, whether a query below the outermost one encloses the token.

    ``group`` counts the outermost parentheses opened so far. Queries open and close along the
    statement, so a running sum tells how many are open; there is one row a token, at any depth.
    """
    order = W.partitionBy("doc", "stmt").orderBy("pos", "edge")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    outer = (F.col("level") == 0) & ~F.col("edge")
    below = F.when(F.col("level") > 0, F.col("opened")).otherwise(0)
    rows = clauses.select(
        "*",
        F.last(F.when(outer, F.col("clause")), True).over(so_far).alias("outer_clause"),
        F.last(F.when(outer, F.coalesce("query", F.lit(-1))), True).over(so_far).alias("outer_query"),
        F.sum((outer & (F.col("tok") == "(")).cast("int")).over(so_far).alias("group"),
        (F.sum(below).over(so_far) > 0).alias("nested"),
    )
    return rows


def table_name(tok: str | Column = "tok") -> Column:
    """Database and table of a name token, backquotes and further parts removed."""
    parts = F.split(F.translate(tok, "`", ""), r"\.")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), ".")


def column_name(tok: str = "tok") -> Column:
    return F.element_at(F.split(F.translate(tok, "`", ""), r"\."), -1)


def qualifier(tok: str = "tok") -> Column:
    """Name before the column name, NULL for a bare column."""
    return F.try_element_at(F.split(F.translate(tok, "`", ""), r"\."), F.lit(-2))
