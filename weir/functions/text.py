"""String helpers (Column -> Column), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def suffix(col: Column | str, n: int) -> Column:
    """Last ``n`` characters; shorter strings come back unchanged (STR-1)."""
    return F.right(F.col(col) if isinstance(col, str) else col, F.lit(n))


def prefix(col: Column | str, n: int) -> Column:
    """First ``n`` characters (STR-2)."""
    return F.left(F.col(col) if isinstance(col, str) else col, F.lit(n))


def last_token_int(col: Column | str, delimiter: str = "_") -> Column:
    """Integer after the last ``delimiter``; NULL when it is not a number (STR-3)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.element_at(F.split(c, _regex_literal(delimiter)), -1).try_cast("bigint")


def normalise_name(name: str, strip: bool = True) -> str:
    """Column-name normalisation: (strip,) lower case, space and slash to ``_`` (PRJ-1)."""
    out = name.strip() if strip else name
    return out.lower().replace(" ", "_").replace("/", "_")


def xml_escape(col: Column | str) -> Column:
    """Escape text for an XML element or attribute value."""
    c = F.col(col) if isinstance(col, str) else col
    for raw, esc in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(esc))
    return c


def _regex_literal(text: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in text)
