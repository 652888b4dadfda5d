"""Column helpers over text: normalisation, path parts and regex captures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wellspring.functions import patterns as P


# Every character that counts as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Trim every Unicode blank, not only spaces as ``trim`` does."""
    return F.btrim(col, F.lit(BLANKS))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Capture of the first match, NULL when there is none."""
    return blank_to_null(F.regexp_extract(text, pattern, group))


def all_matches(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def remove_comments(sql: Column) -> Column:
    """Drop ``--`` comments that end with a newline, then block comments."""
    return F.regexp_replace(F.regexp_replace(sql, P.LINE_COMMENT, "\n"), P.BLOCK_COMMENT, "")


def fill_empty_trim(sql: Column) -> Column:
    return F.regexp_replace(sql, P.EMPTY_TRIM, "''")


def clean_script(sql: Column) -> Column:
    return fill_empty_trim(remove_comments(sql))


def source_tables(sql: Column) -> Column:
    """Distinct upper-case two-part names after FROM or JOIN, in text order."""
    return F.array_distinct(F.transform(all_matches(sql, P.SOURCE_TABLE), F.upper))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_absolute(path: Column) -> Column:
    return F.startswith(path, F.lit("/"))


def normalize_path(path: Column) -> Column:
    """Resolve ``.``, ``..`` and repeated slashes of an absolute path."""
    parts = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, part)),
    )
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def raw_base_dir(path: Column) -> Column:
    """First four ``/`` parts of a raw path without invisible characters; NULL for shorter paths."""
    parts = F.split(path, "/")
    base = F.regexp_replace(strip(F.array_join(F.slice(parts, 1, 4), "/")), P.UNWANTED_PATH_CHARS, "")
    return F.when(F.size(parts) > 3, base)


def parent_name(path: Column) -> Column:
    """Second-last path part."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def first_token(raw: Column) -> Column:
    return F.split_part(raw, F.lit(" "), F.lit(1))


def joined(values: Column) -> Column:
    """List column as one report cell."""
    return F.array_join(values, ", ")


def cycle_label(table: Column) -> Column:
    return F.concat(table, F.lit(P.CYCLE_SUFFIX))
