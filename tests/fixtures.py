"""Hand-written landing fixtures: invented officials, tickers and trades.

Three run dates of government trades, prices and ticker listings, written
as gzip JSON arrays the way the feeds land (one file per feed and date).
"""

import gzip
import json
import os

EPOCH_D1 = 1717200000      # 2024-06-01 00:00:00 UTC


CHAMBERS = {"M001": "House", "M002": "Senate", "M003": "House"}


def official(mid, name, party, state, updated=EPOCH_D1, district="3"):
    return {"committees": {"Committee on Lighthouses": ["Fog Signals"]}, "display_name": name,
            "district": district, "headshot": f"{mid}.jpg", "id": f"rec-{mid}",
            "leadership_positions": ["Deputy Whip"] if mid == "M001" else [],
            "member_id": mid, "member_name": name, "party": party, "state": state,
            "updated": updated, "website": f"https://example.invalid/{mid}"}


def trade(tid, off, ticker, ttype, amount, tdate, rdate, updated=EPOCH_D1, sec_type="Stock"):
    return {"amendment_number": 0, "amount": amount, "chamber": CHAMBERS[off["member_id"]],
            "disclosure_url": f"https://example.invalid/d/{tid}", "filer_info": off,
            "id": f"rec-{tid}", "notification_date": rdate, "ownership": "Self",
            "report_date": rdate, "report_id": f"rep-{rdate}",
            "security": {"name": f"{ticker or 'none'} Holdings", "ticker": ticker, "type": sec_type},
            "transaction_date": tdate, "transaction_id": tid, "transaction_type": ttype,
            "updated": updated}


def price(sym, day, o, h, lo, c, vol, upper=True):
    rec = {"status": "OK", "from": day, "symbol": sym, "open": o, "high": h, "low": lo,
           "close": c, "volume": vol}
    if upper:
        rec.update({"afterHours": c + 0.1, "preMarket": o - 0.1})
    else:
        rec.update({"afterhours": c + 0.1, "premarket": o - 0.1})
    return rec


def ticker(sym, name, updated, active=True):
    return {"active": active, "base_currency_name": None, "base_currency_symbol": None,
            "currency_name": "usd", "currency_symbol": None, "last_updated_utc": updated,
            "locale": "us", "market": "stocks", "name": name, "ticker": sym}


def write_array(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        json.dump(records, f)


OFF_A = official("M001", "Ada Quill", "D", "NE")
OFF_B = official("M002", "Bo Rensel", "R", "DC", updated=EPOCH_D1 + 86400)
OFF_C = official("M003", "Cy Marrow", "I", "CT")

DAYS = ["2024-06-10", "2024-06-11", "2024-06-12"]


def trades_for(day):
    if day == "2024-06-10":
        return [trade("T1", OFF_A, "LUMN", "P", "$1,001 - $15,000", "2024-06-03", day),
                trade("T2", OFF_B, "QRTZ", "S", "$15,001 - $50,000", "2024-06-04", day),
                trade("T3", OFF_C, "", "S (Partial)", "$1,001 - $15,000", "2024-06-04", day)]
    if day == "2024-06-11":
        newer_a = dict(OFF_A, member_name="Ada Quill-Sterne", updated=EPOCH_D1 + 3 * 86400)
        return [trade("T4", newer_a, "LUMN", "S", "$50,001 - $100,000", "2024-06-05", day),
                trade("T5", OFF_C, "VRDA", "P", "$1,001 - $15,000", "2024-06-05", day)]
    return []          # 2024-06-12: no trades reported -> run skipped


def prices_for(day):
    rows = {"2024-06-10": [price("LUMN", "2024-06-03", 10.0, 11.0, 9.5, 10.5, 7079.6),
                           price("QRTZ", "2024-06-04", 20.0, 22.0, 19.0, 21.0, 1200, upper=False),
                           price("QRTZ", "2024-06-04", 20.0, 22.0, 19.0, 21.0, 1200, upper=False)],
            "2024-06-11": [price("LUMN", "2024-06-05", 10.5, 12.0, 10.0, 11.0, 900),
                           price("VRDA", "2024-06-05", 5.0, 5.5, 4.5, 5.25, 300)]}
    return rows.get(day, [])


def tickers_for(day):
    base = [ticker("LUMN", "Lumen Lamps", "2024-06-01T00:00:00Z"),
            ticker("QRTZ", "Quartz Clocks", "2024-06-01T00:00:00Z"),
            ticker("OLDX", "Old Exchange", "2024-06-01T00:00:00Z")]
    if day == "2024-06-11":
        base = [ticker("LUMN", "Lumen Lamps Intl", "2024-06-11T08:00:00Z"),
                ticker("QRTZ", "Quartz Clocks", "2024-06-01T00:00:00Z"),
                ticker("VRDA", "Veranda Homes", "2024-06-11T08:00:00Z")]
    return base


def land_day(landing, day):
    """Write one run date's three feeds under ``landing``."""
    tr = trades_for(day)
    write_array(f"{landing}/government_trades/{day}_government_trades.json.gz", tr)
    pr = prices_for(day)
    if pr:
        write_array(f"{landing}/market_close/{day}_market_close.json.gz", pr)
    write_array(f"{landing}/stock_tickers/{day}_tickers.json.gz", tickers_for(day))
