"""Column -> Column expressions of the warehouse.

Everything here is a built-in Spark expression (JVM side, whole-stage
codegen); nothing is a Python UDF.  Each function takes and returns
``Column`` so models compose them inside one ``select``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's codes and labels)
# ---------------------------------------------------------------------------
# chamber codes -> labels
CHAMBER_LABELS = {"House": "House of Representatives", "Senate": "Senate"}
# party codes -> labels (anything else, independents included, is UNKNOWN)
PARTY_LABELS = {"R": "Republican", "D": "Democrat"}
# transaction type codes -> labels
TRADE_TYPE_LABELS = {"P": "Purchase", "S": "Sale", "S (Partial)": "Partial Sale"}
# codes counted as a purchase / as a sale
PURCHASE_CODES = ("P",)
SALE_CODES = ("S", "S (Partial)")
# default for an unmatched code or lookup
UNKNOWN = "UNKNOWN"
# a dollar figure inside an amount bucket such as "$1,001 - $15,000"
DOLLAR_PATTERN = r"\$[0-9,]+"
# source freshness thresholds (days since the last load)
FRESHNESS_WARN_DAYS = 1
FRESHNESS_ERROR_DAYS = 2
# window of recent market rows whose exact duplicates are collapsed
DEDUP_WINDOW_DAYS = 70


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col) -> Column:
    """'' becomes NULL; whitespace-only strings and NULL pass through unchanged."""
    return F.nullif(_c(col), F.lit(""))


def non_empty(col) -> Column:
    """Predicate ``c != '' AND length(c) > 0`` (NULL is dropped too)."""
    c = _c(col)
    return (c != F.lit("")) & (F.length(c) > 0)


def decode(col, labels: dict, default: str = UNKNOWN) -> Column:
    """Searched CASE over a code column; unmatched codes and NULL give ``default``."""
    c = _c(col)
    out = None
    for code, label in labels.items():
        out = (F.when(c == F.lit(code), F.lit(label)) if out is None
               else out.when(c == F.lit(code), F.lit(label)))
    return out.otherwise(F.lit(default))


def decode_chamber(col) -> Column:
    return decode(col, CHAMBER_LABELS)


def decode_party(col) -> Column:
    return decode(col, PARTY_LABELS)


def decode_trade_type(col) -> Column:
    return decode(col, TRADE_TYPE_LABELS)


def flag_in(col, codes) -> Column:
    """1 when the code is one of ``codes``, else 0 (NULL gives 0); bigint."""
    return F.when(_c(col).isin(*codes), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def is_purchase(col) -> Column:
    return flag_in(col, PURCHASE_CODES)


def is_sale(col) -> Column:
    return flag_in(col, SALE_CODES)


def dollar_bound(col, occurrence: int) -> Column:
    """The ``occurrence``-th (1-based) ``$n,nnn`` figure of a bucket as bigint, else NULL.

    ``get`` returns NULL past the end of the match array (``[]`` would raise under
    ANSI), and ``try_cast`` turns an empty remainder into NULL instead of failing.
    """
    matches = F.regexp_extract_all(_c(col), F.lit(DOLLAR_PATTERN), 0)
    figure = F.get(matches, occurrence - 1)
    digits = F.replace(F.replace(figure, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    return digits.try_cast("bigint")


def range_midpoint(lo, hi) -> Column:
    """ROUND((hi + lo) / 2) half away from zero, as bigint; NULL if a bound is NULL.

    The sum is taken as an exact decimal so ``/ 2`` is not a double division.
    """
    total = (_c(hi).cast("decimal(20,0)") + _c(lo).cast("decimal(20,0)"))
    return F.round(total / F.lit(2), 0).cast("bigint")


def price_midpoint(high, low) -> Column:
    """ROUND((high + low) / 2) on DECIMAL prices, kept as a whole-number decimal."""
    return F.round((_c(high) + _c(low)) / F.lit(2), 0).cast("decimal(21,0)")


def epoch_to_ts(col) -> Column:
    """Epoch seconds to a UTC timestamp (1734012102 -> 2024-12-12 14:01:42)."""
    return F.timestamp_seconds(_c(col))


def closest_past_monday(col) -> Column:
    """The Monday on or before a date (a Monday maps to itself)."""
    return F.to_date(F.date_trunc("week", F.to_date(_c(col))))


def row_hash_hex(*cols) -> Column:
    """Lower-case hex SHA-256 of the plain concatenation of the columns as text.

    NULL counts as ''.  There is no separator, so ('ab','c') and ('a','bc') hash
    alike -- the documented behaviour of the source system's row hash.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat(*parts), 256)


def row_hash(*cols) -> Column:
    """The same hash as 32 raw bytes (BINARY)."""
    return F.unhex(row_hash_hex(*cols))


def to_whole_long(col) -> Column:
    """Round a JSON number half away from zero before the cast (7079.6 -> 7080)."""
    return F.round(_c(col).cast("decimal(38,6)"), 0).cast("bigint")
