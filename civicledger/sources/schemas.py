"""Declared schemas of the landed JSON feeds and the seed.

JSON is read schema-on-read with these StructTypes (no inference).  The two
schemaless fields of the trades feed (``committees``, ``leadership_positions``)
are declared as STRING: Spark's JSON reader then keeps the raw JSON text of
the object / array, which can be grouped, hashed and compared, and parsed
later with ``parse_json`` or ``from_json`` where needed.
"""

from pyspark.sql import types as T

S, D, L, B, I = T.StringType(), T.DateType(), T.LongType(), T.BooleanType(), T.IntegerType()
PRICE = T.DecimalType(20, 4)


def _f(name, t):
    return T.StructField(name, t, True)


FILER_INFO = T.StructType([
    _f("committees", S), _f("display_name", S), _f("district", S), _f("headshot", S),
    _f("id", S), _f("leadership_positions", S), _f("member_id", S), _f("member_name", S),
    _f("party", S), _f("state", S), _f("updated", L), _f("website", S),
])
SECURITY = T.StructType([_f("name", S), _f("ticker", S), _f("type", S)])

GOVERNMENT_TRADES = T.StructType([
    _f("amendment_number", I), _f("amount", S), _f("chamber", S), _f("disclosure_url", S),
    _f("filer_info", FILER_INFO), _f("id", S), _f("notification_date", D), _f("ownership", S),
    _f("report_date", D), _f("report_id", S), _f("security", SECURITY), _f("transaction_date", D),
    _f("transaction_id", S), _f("transaction_type", S), _f("updated", L),
])

# The extended-hours fields of the market-close feed arrive in two spellings that
# differ only in case (``afterHours`` / ``afterhours``).  MARKET_CLOSE holds both
# and is read by a session whose column names are case-sensitive
# (``landing.case_sensitive``); the paths below read the same fields from records
# held as VARIANT.  volume may arrive as a JSON float: read DOUBLE, round, then
# cast (7079.6 -> 7080).
MARKET_CLOSE = T.StructType([
    _f("status", S), _f("from", D), _f("symbol", S), _f("open", PRICE), _f("high", PRICE), _f("low", PRICE),
    _f("close", PRICE), _f("volume", T.DoubleType()), _f("afterHours", PRICE), _f("preMarket", PRICE),
    _f("afterhours", PRICE), _f("premarket", PRICE),
])
MARKET_PATHS = [  # (column, JSON path, type)
    ("status", "$.status", "string"),
    ("date_recorded", "$.from", "date"),
    ("symbol", "$.symbol", "string"),
    ("open", "$.open", "decimal(20,4)"),
    ("high", "$.high", "decimal(20,4)"),
    ("low", "$.low", "decimal(20,4)"),
    ("close", "$.close", "decimal(20,4)"),
    ("volume", "$.volume", "double"),
    ("after_hours_camel", "$.afterHours", "decimal(20,4)"),
    ("pre_market_camel", "$.preMarket", "decimal(20,4)"),
    ("after_hours_lower", "$.afterhours", "decimal(20,4)"),
    ("pre_market_lower", "$.premarket", "decimal(20,4)"),
]

# the source table the price feed is loaded into (market_close_by_day)
MARKET_SOURCE = T.StructType([
    _f("status", S), _f("date_recorded", D), _f("symbol", S), _f("open", PRICE), _f("high", PRICE),
    _f("low", PRICE), _f("close", PRICE), _f("stock_volume", L), _f("after_hours", PRICE),
    _f("pre_market", PRICE),
])

TICKERS = T.StructType([
    _f("active", B), _f("base_currency_name", S), _f("base_currency_symbol", S),
    _f("currency_name", S), _f("currency_symbol", S), _f("last_updated_utc", T.TimestampType()),
    _f("locale", S), _f("market", S), _f("name", S), _f("ticker", S),
])

STATES = T.StructType([_f("state_abbrev", S), _f("state_name", S), _f("state_iso_format", S)])


def leaf_paths(schema: T.StructType, prefix: str = "$") -> list[tuple[str, str, str]]:
    """(column, JSON path, type) of every leaf of a nested schema, e.g. ``$.filer_info.id``."""
    out = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}"
        if isinstance(f.dataType, T.StructType):
            out.extend(leaf_paths(f.dataType, path))
        else:
            out.append((path[2:].replace(".", "__"), path, f.dataType.simpleString()))
    return out
