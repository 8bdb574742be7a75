"""String column functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters stripped from both ends, ASCII and Unicode white
# space (no-break, ideographic and other wide spaces) and the separators
# U+001C to U+001F.  ``trim`` alone removes only spaces.
WHITESPACE = (" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
              "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove all leading/trailing whitespace (X2).  NULL stays NULL.

    ``btrim`` with an explicit character set: no regular expression per
    value, stays in generated code."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def to_text(c: Column | str) -> Column:
    """Cast to string keeping NULL as NULL (X5, decision Z1)."""
    return _col(c).cast("string")


def clean_email(c: Column | str) -> Column:
    """Lower-case and strip an e-mail value (P4: X5 → X1 → X2)."""
    return strip_ws(F.lower(to_text(c)))


def default_if_null(c: Column | str, default: str = "unknown") -> Column:
    """Fill a missing value with a default."""
    return F.coalesce(_col(c), F.lit(default))


def path_predicate(
    path: Column | str,
    prefix: str | None = None,
    suffix: str | None = None,
    contains_any: list[str] | tuple[str, ...] | None = None,
    ignore_case: bool = True,
) -> Column:
    """Prefix / suffix / any-of-substrings test on a path column.

    ``contains_any`` is an OR of substrings; with ``ignore_case`` the path is
    lower-cased first, as the channel discovery rules do.
    """
    p = _col(path)
    cond = F.lit(True)
    if prefix:
        cond = cond & p.startswith(prefix)
    if suffix:
        target = F.lower(p) if ignore_case else p
        cond = cond & target.endswith(suffix.lower() if ignore_case else suffix)
    if contains_any:
        target = F.lower(p) if ignore_case else p
        any_hit = F.lit(False)
        for s in contains_any:
            any_hit = any_hit | target.contains(s.lower() if ignore_case else s)
        cond = cond & any_hit
    return cond


def bytes_to_mb(c: Column | str) -> Column:
    """Bytes to mebibytes."""
    return _col(c) / F.lit(1024 * 1024)
