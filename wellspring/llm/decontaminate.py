"""Benchmark decontamination as a prefix-filtered set join, with built-in functions only.

A window is ``window`` consecutive words of an item, or all words of a shorter item. A window is a
set of overlapping shingles; a text that contains the window contains every one of them, so it is
enough to look each window up by one: its rarest (the necessary prefix for full containment). The
order of shingles is their number of occurrences in the benchmark, ties by hash, so neighbouring
windows mostly share their prefix. Documents are exploded into shingle hashes and joined with the
prefix tokens only. A match fixes where the item would have to lie in the document; the
length bound drops places where no window fits, equal places are merged, and the surviving ones
are verified word by word, window by window.

Defined results: null texts have no words; items without words, without id, and repeated items add
nothing; a null ``doc_id`` is a document; repeated documents are judged each; an empty benchmark
or table of documents is fine; other columns are ignored by ``scan`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.session import materialize

WINDOW = 10
#: Words in a shingle; shorter items are one shingle.
SHINGLE = 5
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of ASCII letters (in lower case), digits and all non-ASCII characters."""
    lower = F.translate(F.coalesce(text, F.lit("")), *_LOWER)
    return F.filter(F.split(lower, _GAP), lambda w: w != "")


def _shingles(own: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    n = F.size(own) - size + 1
    if size == 1:
        hashes = F.transform(own, lambda w: F.xxhash64(w))
    else:
        hashes = F.transform(
            F.sequence(F.lit(1), n), lambda i: F.xxhash64(*[F.get(own, i - 1 + k) for k in range(size)])
        )
    return F.when(n >= 1, hashes)


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    items = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("item_words"))
    items = items.where(F.col("item_id").isNotNull() & (F.size("item_words") > 0))
    return items.dropDuplicates(["item_id", "item_words"])


def prefix_tokens(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``item_id, item_words, at, size, token``: for each window its rarest shingle, which starts at
    word ``at`` of the item. Windows of an item that share it give one row."""
    per_size = []
    for size in range(1, shingle + 1):
        fits = F.size("item_words") == size if size < shingle else F.size("item_words") >= size
        per_size.append(items.where(fits).select("*", F.lit(size).alias("size"), _shingles("item_words", size).alias("hashes")))
    every = per_size[0]
    for other in per_size[1:]:
        every = every.unionByName(other)
    tokens = every.select("item_id", "item_words", "size", "hashes", F.posexplode_outer("hashes").alias("at", "token"))
    tokens = tokens.where(F.col("token").isNotNull())
    counts = tokens.groupBy("size", "token").agg(F.count(F.lit(1)).alias("n"))
    ranked = tokens.drop("hashes").join(counts, ["size", "token"])
    own = ranked.groupBy("item_id", "item_words", "size").agg(
        F.sort_array(F.collect_list(F.struct("at", "n", "token"))).alias("tokens")
    )
    # windows start at 0 .. n - window; each has the shingles that lie in it
    last = F.greatest(F.size("item_words") - window, F.lit(0))
    span = F.greatest(F.least(F.lit(window), F.size("item_words")) - F.col("size") + 1, F.lit(1))
    rarest = F.transform(
        F.sequence(F.lit(0), last),
        lambda s: F.array_min(
            F.transform(
                F.slice("tokens", s + 1, span),
                lambda t: F.struct(t["n"].alias("n"), t["token"].alias("token"), t["at"].alias("at")),
            )
        ),
    )
    chosen = own.select("item_id", "item_words", "size", F.explode(F.array_distinct(rarest)).alias("t"))
    return chosen.select("item_id", "item_words", "size", F.col("t.at").alias("at"), F.col("t.token").alias("token"))


def candidates(
    docs: DataFrame, tokens: DataFrame, sizes: list[int], window: int = WINDOW
) -> DataFrame:
    """Distinct ``doc_id, item_no, begin``: items that may lie in a document, beginning at that word
    (below 0 if the document has only a later part)."""
    own = docs.select("doc_id", words(F.col("text")).alias("words"))
    sets = F.array(
        *[F.struct(F.lit(k).alias("size"), _shingles("words", k).alias("hashes")) for k in sizes]
    )
    own = own.select("doc_id", F.size("words").alias("n"), sets.alias("sets"))
    own = own.select("doc_id", "n", F.inline_outer("sets"))
    # the plain form would have Spark test hashes for emptiness below, computing them once more
    rows = own.select("doc_id", "n", "size", F.posexplode_outer("hashes").alias("pos", "token"))
    narrow = tokens.select("size", "token", "at", "item_id", "item_no", "n_item")
    hits = rows.join(narrow, ["size", "token"])
    begin = F.col("pos") - F.col("at")
    fits = F.least(F.lit(window), F.col("n_item"))
    # the part of the item that the document can hold must hold a window
    held = F.least(begin + F.col("n_item"), F.col("n")) - F.greatest(begin, F.lit(0))
    hits = hits.where(held >= fits)
    places = hits.select("doc_id", "item_no", begin.cast("int").alias("begin")).dropDuplicates()
    return places


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _judged(narrow, benchmark, window, shingle).drop("text")


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with their own columns, that hold no window of the benchmark."""
    boxed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct("*").alias("doc")
    )
    judged = _judged(boxed, benchmark, window, shingle)
    # a plain filter would be pushed below the projections, which would cut every word list anew
    # in every comparison
    rows = judged.select(F.explode_outer(F.when(~F.col("contaminated"), F.array("doc"))).alias("doc"))
    return rows.where(F.col("doc").isNotNull()).select("doc.*")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    items = materialize(
        benchmark_items(benchmark).withColumn("item_no", F.monotonically_increasing_id())
    )
    tokens = prefix_tokens(items.drop("item_no"), window, shingle)
    tokens = materialize(
        tokens.join(items, ["item_id", "item_words"]).select(
            "size", "token", "at", "item_id", "item_no", F.size("item_words").alias("n_item")
        )
    )
    # at most ``shingle`` numbers
    sizes = sorted(r[0] for r in tokens.select("size").distinct().collect()) or [shingle]
    places = candidates(docs.select("doc_id", "text"), tokens, sizes, window)
    found = places.join(items, "item_no").select(
        "doc_id", F.struct("item_id", "item_words", "begin").alias("place")
    )
    found = materialize(found.groupBy("doc_id").agg(F.collect_list("place").alias("places")))
    # one way at every size: the list of places grows with the documents, so it is never broadcast
    found = found.withColumnRenamed("doc_id", "found_id").hint("merge")
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    joined = joined.withColumn("words", words(F.col("text")))

    def windows(place: Column) -> Column:
        own, begin = place["item_words"], place["begin"]
        size = F.least(F.lit(window), F.size(own))
        low = F.greatest(F.lit(0), -begin)
        high = F.least(F.size(own), F.size("words") - begin) - size
        starts = F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        equal = F.filter(
            starts,
            lambda j: F.slice("words", begin + j + 1, size) == F.slice(own, j + 1, size),
        )
        hit = F.flatten(F.transform(equal, lambda j: F.sequence(begin + j, begin + j + size - 1)))
        return F.struct(place["item_id"].cast("string").alias("item_id"), F.array_distinct(hit).alias("hit"))

    checked = F.filter(F.transform("places", windows), lambda p: F.size(p["hit"]) > 0)
    checked = F.coalesce(checked, F.array().cast("array<struct<item_id:string,hit:array<int>>>"))
    joined = joined.withColumn("verified", checked)
    ids = F.sort_array(F.array_distinct(F.transform("verified", lambda p: p["item_id"])))
    hit = F.array_distinct(F.flatten(F.transform("verified", lambda p: p["hit"])))
    return joined.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_hit": F.size(hit).cast("long"),
            "n_items": F.size(ids).cast("long"),
            "items_sha256": F.sha2(F.array_join(ids, ","), 256),
            "contaminated": F.size("verified") > 0,
        }
    ).drop("words", "places", "verified")
