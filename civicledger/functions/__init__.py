from .exprs import *  # noqa: F401,F403
from .exprs import (  # noqa: F401
    blank_to_null, closest_past_monday, decode, decode_chamber, decode_party,
    decode_trade_type, dollar_bound, epoch_to_ts, is_purchase, is_sale, non_empty,
    price_midpoint, range_midpoint, row_hash, row_hash_hex, to_whole_long,
)
