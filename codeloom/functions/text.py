"""Text expressions shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as whitespace at the ends of a cell.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Marker and tokens of an empty level.
NULL_MARK = "__null__"
NULL_TOKENS = ("", "none", "nan", "null", "n/a")
# Placeholder texts.
NO_DESCRIPTION = "(no description)"
UNKNOWN = "(unknown)"
MAX_DESCRIPTION = 200


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove whitespace of every kind from both ends; plain ``trim`` removes spaces only."""
    return F.btrim(as_col(value), F.lit(WHITESPACE))


def squeeze(value: Column | str) -> Column:
    """Runs of whitespace become one space, ends are stripped."""
    return strip(F.regexp_replace(as_col(value), r"(?U)[\s\x1c-\x1f]+", " "))


def nullify(value: Column | str, tokens: Iterable[str] = ("None", "nan", "")) -> Column:
    """Case-sensitive null tokens become null."""
    col = as_col(value)
    return F.when(~col.isin(*tokens), col)


def canon(value: Column | str) -> Column:
    """Comparable form of a level value: stripped lower case, one marker for every kind of empty."""
    text = F.lower(strip(value))
    return F.when(text.isNull() | text.isin(*NULL_TOKENS), F.lit(NULL_MARK)).otherwise(text)


def code_key(value: Column | str) -> Column:
    """Join key of a code: stripped upper case."""
    return F.upper(strip(as_col(value).cast("string")))


def surrogate_id(code: Column | str) -> Column:
    return F.substring(F.sha2(code_key(code), 256), 1, 32)


def sanitize_description(value: Column | str, limit: int | None = None) -> Column:
    """Drop control characters, double backslashes; with a ``limit``, cut last."""
    clean = F.regexp_replace(as_col(value), r"[\x00-\x1f\x7f-\x9f]", "")
    doubled = F.replace(clean, F.lit("\\"), F.lit("\\\\"))
    return doubled if limit is None else F.substring(doubled, 1, limit)


def sanitize_name(value: Column | str) -> Column:
    return F.regexp_replace(as_col(value), r"[^a-zA-Z0-9_.-]", "_")


def describe_or_placeholder(value: Column | str, blanks: Iterable[str] = ("", "nan", "None")) -> Column:
    text = strip(value)
    return F.when(text.isNull() | text.isin(*blanks), F.lit(NO_DESCRIPTION)).otherwise(text)


def path_label(*levels: Column | str) -> Column:
    """``L1 > L2 > L3``; an empty level prints as ``None``."""
    return F.concat_ws(" > ", *[F.coalesce(as_col(c), F.lit("None")) for c in levels])


def estimate_tokens(text: Column | str) -> Column:
    """About four characters per token."""
    return F.floor(F.length(as_col(text)) / 4).cast("bigint")


def thousands(value: Column | str) -> Column:
    return F.format_number(as_col(value), 0)


def code_line(fields: Iterable[tuple[str, Column, bool]]) -> Column:
    """``name=value`` parts joined by a comma; ``quoted`` parts get double quotes, null parts vanish."""
    parts = []
    for name, value, quoted in fields:
        text = value.cast("string")
        body = F.concat(F.lit('"'), text, F.lit('"')) if quoted else text
        parts.append(F.concat(F.lit(f"{name}="), body))
    return F.concat_ws(", ", *parts)
