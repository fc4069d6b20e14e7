"""Text scalar functions (B5, B7, B8, B12). All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import col

# Markup tags and any character outside printable ASCII
# (0x20-0x7E) are each replaced by one space.
STRIP_PATTERN = r"<[^>]*>|[^\x20-\x7E]"


def clean(text) -> Column:
    """Strip markup and non-printable / non-ASCII characters."""
    return F.regexp_replace(col(text), STRIP_PATTERN, " ")


def java_split(s, sep: str = " ") -> Column:
    """Split on a single-character separator with Java ``String.split``
    rules: inner and leading empty strings kept, trailing ones dropped,
    ``""`` gives ``[""]`` and a string of only separators gives ``[]``."""
    s = col(s)
    empty = F.array().cast("array<string>")
    if sep == " ":
        # rtrim strips only U+0020 here: linear, no regex backtracking
        trimmed = F.rtrim(s)
        return F.when((s != "") & (trimmed == ""), empty).otherwise(F.split(trimmed, " ", -1))
    q = _re_quote(sep)
    return (F.when(s.rlike(f"^(?:{q})+$"), empty)
            .otherwise(F.split(F.regexp_replace(s, f"(?:{q})++$", ""), q, -1)))


def _re_quote(sep: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != " " else c for c in sep)


def lower_split(s) -> Column:
    """Lower-case then Java-split on one space."""
    return java_split(F.lower(col(s)), " ")


def vocab_word(phrase) -> Column:
    """The embedding-vocabulary form of a phrase (lower case, spaces to
    underscores), e.g. ``Alpha Corp.`` -> ``alpha_corp.``."""
    return F.replace(F.lower(col(phrase)), F.lit(" "), F.lit("_"))
