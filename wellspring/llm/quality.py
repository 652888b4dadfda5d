"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Features are counted over whole texts (lengths, symbols, stop words, lines, repeated 3-word
windows); each rule compares a ratio of two of them with a threshold, as integers or decimals
without division, so an empty denominator needs no special case.

Defined results: a null or empty text has no words and fails; a null ``doc_id`` is kept; repeated
rows give repeated rows; an empty table gives an empty table; other columns of the input are kept
by ``with_features`` unless they have a feature's name, and ignored by ``judge``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with is in it for on was as are "
    "der die das und ist von den mit ein eine zu im nicht auf für "
    "le la les de des et est un une que qui dans pour du en "
    "el los las y del por con una se al lo como más su"
).split()


@dataclass(frozen=True)
class Rule:
    """``part`` must be at least ``low`` and at most ``high`` times ``whole`` (1: a plain count)."""

    name: str
    part: str
    whole: str = "1"
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        part, whole = F.col(self.part), F.expr(self.whole)
        checks = [part >= F.lit(self.low) * whole] if self.low is not None else []
        checks += [part <= F.lit(self.high) * whole] if self.high is not None else []
        return reduce(Column.__and__, checks)


#: Rules that every text must pass.
BASE_RULES = (
    Rule("words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
)
#: The method's own thresholds.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=2, high=15),
    Rule("symbols", "n_symbols", "n_words", high=0.3),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("list_lines", "n_list_lines", "n_lines", high=0.9),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=0.3),
    Rule("longest_word", "longest_word", high=1000),
)


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the features that rules can name."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_replace(line, BLANK, "") != "")
    out = docs.withColumns({"q_words": words, "q_lines": lines})
    out = out.withColumn(
        "q_windows",
        F.when(
            F.size("q_words") >= 3,
            F.zip_with(
                F.zip_with(
                    F.slice("q_words", F.lit(1), F.size("q_words") - 2),
                    F.slice("q_words", F.lit(2), F.size("q_words") - 2),
                    lambda a, b: F.concat(a, F.lit(" "), b),
                ),
                F.slice("q_words", F.lit(3), F.size("q_words") - 2),
                lambda a, b: F.concat(a, F.lit(" "), b),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )
    # few texts repeat a window: only those sort theirs
    repeats = F.size(F.array_distinct("q_windows")) < F.size("q_windows")
    keyed = F.sort_array(
        F.transform("q_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    )
    out = out.withColumn("q_keyed", F.when(repeats, keyed))
    same = lambda j, k: F.get("q_keyed", j)["w"] == F.get("q_keyed", k)["w"]
    marked = F.filter(
        F.transform(
            "q_keyed",
            lambda x, j: F.when(
                F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
                x["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    out = out.withColumn("q_marked", F.sort_array(marked))
    covered = F.aggregate(
        F.transform(
            "q_marked",
            lambda i, k: F.least(F.lit(3), F.coalesce(F.get("q_marked", k + 1) - i, F.lit(3))),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    joined = F.length(F.regexp_replace(text, BLANK, ""))
    strip = lambda line: F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    count = lambda flags: F.size(flags).cast("long")
    stop = F.array(*map(F.lit, STOP_WORDS))
    out = out.withColumns(
        {
            "n_words": count("q_words"),
            "word_chars": joined.cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
            "n_lines": count("q_lines"),
            "n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "n_stop_words": F.size(F.array_intersect(F.transform("q_words", F.lower), stop)).cast("long"),
            "n_list_lines": count(F.filter("q_lines", lambda x: strip(x).rlike(r"^[-*•·]"))),
            "n_cut_lines": count(F.filter("q_lines", lambda x: strip(x).rlike(r"(\.\.\.|…)$"))),
            "longest_word": F.coalesce(
                F.array_max(F.transform("q_words", F.length)), F.lit(0)
            ).cast("long"),
        }
    )
    return out.drop("q_words", "q_lines", "q_windows", "q_keyed", "q_marked")


def verdict(rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> dict[str, Column]:
    passed = lambda own: reduce(Column.__and__, [r.passes() for r in own], F.lit(True))
    return {"base_failed": ~passed(base), "kept": passed(base) & passed(rules)}


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, all features, ``base_failed`` and ``kept`` of every document.

    The rows come out of a generator, so that a filter on them is not pushed below the features.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    judged = with_features(narrow).withColumns(verdict(rules)).drop("text")
    return judged.select(F.inline(F.array(F.struct("*"))))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their own columns, that pass all rules."""
    boxed = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    judged = with_features(boxed).withColumns(verdict(rules))
    return only(judged, F.col("kept"))


def only(judged: DataFrame, passed: Column) -> DataFrame:
    """The columns of ``doc`` where ``passed`` holds. A plain filter would be pushed below the
    projections, with all features written out anew in every place that names them."""
    rows = judged.select(F.explode_outer(F.when(passed, F.array("doc"))).alias("doc"))
    return rows.where(F.col("doc").isNotNull()).select("doc.*")
