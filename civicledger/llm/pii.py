"""Format-preserving pseudonyms for personal data, as column expressions only.

Values are found by one pattern, validated by kind (Luhn, mod 97, calendar,
number plans), and permuted by a keyed Feistel network within their format: a
card number becomes another valid card number, a date another date of the same
layout. The permutation depends on the key, the kind and the value alone, so
equal values stay linked across documents and different values stay different.

A value is a list of symbols, each with the size of its alphabet. A round adds
a keyed hash of one half to the other half, symbol by symbol modulo the
alphabet; symbols of alphabet 1 (separators) never change.

Defined cases: a null text stays null, an empty one empty; a value that fails
its validation stays as it is; the other columns of a row are returned as they
were; repeated rows are treated alike; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Formats, in the order in which they are tried at a place. Fixed values.
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
DENSE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{DENSE}]]"
MONTH = "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
PATTERNS = {
    "credential": r"""(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?i:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[=:][ ]?(?:["'][^\s"']{6,}["']|["']?[A-Za-z0-9_+/.-]{6,})|(?:gh[opsu]_|github_pat_)[A-Za-z0-9_]{20,}|sk-[A-Za-z0-9_-]{20,})""",
    # letters of any script; of scripts without spaces only a run of their own, as prose may stand right before a value
    "email": rf"(?:(?<![{WORD}._%+-])[{WORD}_%+-][{WORD}._%+-]*+|(?:(?<![{WORD}._%+-])[{WORD}_%+-][{WORD}._%+-]{{0,31}})?[{DENSE}]{{1,16}}(?:[._%+-][0-9]{{1,16}})?)@(?:[{WORD}][{WORD}-]{{0,62}}\.){{1,8}}[A-Za-z]{{2,24}}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "iso_date": r"(?<![0-9-])(?:19|20)[0-9]{2}(?<ymd>[-/.])[01][0-9]\k<ymd>[0-3][0-9](?![0-9]|[-/.][0-9])",
    "day_date": r"(?<![0-9/.-])[0-3]?[0-9](?<dmy>[-/.])[0-3]?[0-9]\k<dmy>(?:19|20)[0-9]{2}(?![0-9])",
    "named_date": rf"(?<![0-9A-Za-z])(?:[0-3]?[0-9] {MONTH},? |{MONTH} [0-3]?[0-9],? )(?:19|20)[0-9]{{2}}(?![0-9A-Za-z])",
    # eight groups, or fewer around a double colon with a digit in them
    "ipv6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    # any three digits are an area or exchange where the layout is unmistakable: +1, or parentheses and a separator
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|(?:1[ .-]?)?\([2-9][0-9]{2}\)[ .-]?[2-9][0-9]{6}|(?:1[ .-])?[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4})(?![0-9A-Za-z])",
    "intl_phone": r"(?<![0-9A-Za-z+])\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,5}\)?){2,6}(?![0-9A-Za-z])",
}
#: Kinds whose greedy pattern may take in what stands beside a value: their valid parts are found first.
CHECKED = ("iban", "card")
#: Marks around such a part while a text is scanned again; their first character is escaped where a text holds it.
MARK = "\ue000"
OPEN, SHUT, OWN = MARK + "<", MARK + ">", MARK + "!"
#: Layouts in which a card may also begin behind other digits.
CARD_LAYOUT = "^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
                22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
                26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR PS QA UA", 30: "JO KW MU",
                31: "MT SC", 32: "LC"}
#: Characters without which no pattern can match.
NEEDED = "[0-9@=:]"
ROUNDS = 8
#: Symbols that a network permutes together; longer values are permuted block by block.
BLOCK = 128
FIRST_DAY, DAYS = "1900-01-01", 73049          # 1900-01-01 to 2099-12-31
SIDE = 271                                      # 271 * 271 >= DAYS


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shift(key: str, kind: str, rnd: Column, half: Column, i: Column) -> Column:
    """Sixteen keyed pseudo-random bits for the symbol ``i`` of a round."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), rnd.cast("string"), i.cast("string"),
                       F.array_join(half.cast("array<string>"), ","))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def feistel(values: Column, sizes: Column, key: str, kind: str) -> Column:
    """Permutes ``values`` (array of int) within ``sizes`` (alphabet of each)."""
    def step(s, rnd):
        moved = F.transform(s["a"], lambda v, i: F.pmod(
            v + _shift(key, kind, rnd, s["b"], i), F.get(s["am"], i).cast("long")).cast("int"))
        return F.struct(s["b"].alias("a"), s["bm"].alias("am"), moved.alias("b"), s["am"].alias("bm"))

    def permute(x):
        half = F.floor(F.size(x["v"]) / 2).cast("int")
        rest = F.size(x["v"]) - half
        start = F.struct(F.slice(x["v"], F.lit(1), half).alias("a"), F.slice(x["m"], F.lit(1), half).alias("am"),
                         F.slice(x["v"], half + 1, rest).alias("b"), F.slice(x["m"], half + 1, rest).alias("bm"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step,
                           lambda end: F.concat(end["a"], end["b"]))

    return let(F.struct(values.alias("v"), sizes.alias("m")), permute)


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))


def _code(c: Column) -> Column:
    return F.ascii(c)


def _is(c: Column, low: str, high: str) -> Column:
    return (_code(c) >= ord(low)) & (_code(c) <= ord(high)) & (F.octet_length(c) == 1)


#: Ranges of letters beyond ASCII (first, number) that are permuted as one class; other letters within 16 code points.
LETTERS = ((0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8), (0x100, 432), (0x390, 64), (0x400, 128), (0x1E00, 256),
           (0x3400, 6592), (0x4E00, 20992), (0xAC00, 11168), (0x20000, 42720))


def _range(c: Column, of) -> Column:
    """``of`` (first, number) of the letters that ``c`` (beyond ASCII) is permuted within."""
    code, out = _code(c), None
    for low, n in LETTERS:
        out = (F if out is None else out).when((code >= low) & (code < low + n), of(F.lit(low), F.lit(n)))
    return out.otherwise(of(code - F.pmod(code, F.lit(16)), F.lit(16)))


def _far(c: Column) -> Column:
    return c.rlike(r"^[\p{L}\p{M}\p{N}&&[^\x00-\x7f]]$")


def _size(c: Column) -> Column:
    return (F.when(_is(c, "0", "9"), 10).when(_is(c, "a", "z") | _is(c, "A", "Z"), 26)
            .when(_far(c), _range(c, lambda low, n: n)).otherwise(1))


def _value(c: Column) -> Column:
    return (F.when(_is(c, "0", "9"), _code(c) - 48).when(_is(c, "a", "z"), _code(c) - 97)
            .when(_is(c, "A", "Z"), _code(c) - 65).when(_far(c), _code(c) - _range(c, lambda low, n: low)).otherwise(0))


def _char(c: Column, v: Column) -> Column:
    """The character of ``c``'s class with value ``v``."""
    far = F.decode(F.unhex(F.lpad(F.hex((_range(c, lambda low, n: low) + v).cast("long")), 8, "0")), "UTF-32")
    return (F.when(_is(c, "0", "9"), F.char(v + 48)).when(_is(c, "a", "z"), F.char(v + 97))
            .when(_is(c, "A", "Z"), F.char(v + 65)).when(_far(c), far).otherwise(c))


def by_class(text: Column, key: str, kind: str) -> Column:
    """Digits become digits, small letters small letters, capitals capitals; the rest stays. Of any length."""
    def block(part):
        return let(_chars(part), lambda chars: F.array_join(F.zip_with(
            chars, feistel(F.transform(chars, _value), F.transform(chars, _size), key, kind), _char), ""))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), block), "")


def _fill(layout: Column, symbols: Column, own) -> Column:
    """The characters of ``symbols`` (a string) at the places of the layout for which ``own`` holds, in order."""
    def place(given):
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
        return F.aggregate(_chars(layout), start, lambda s, c: F.when(own(c), F.struct(
            F.concat(s["out"], F.substring(given, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")))
            .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))), lambda end: end["out"])
    return let(symbols, place)


def _refill(layout: Column, digits: Column) -> Column:
    return _fill(layout, digits, lambda c: _is(c, "0", "9"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _ints(digits: Column) -> Column:
    return F.transform(_chars(digits), lambda c: c.cast("int"))


def luhn_sum(digits: Column, last_weight: int) -> Column:
    """Sum of a digit string by the Luhn rule; ``last_weight`` is that of its last digit."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.pmod(n - i + F.lit(last_weight - 1), F.lit(2)) == 1
        return total + F.when(doubled, F.pmod(d * 2, F.lit(10)) + F.floor(d / 5).cast("int")).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def card(text: Column, key: str) -> Column:
    """First digit (the network) and Luhn validity stay."""
    def permuted(digits):
        ints = _ints(F.substring(digits, F.lit(2), F.length(digits) - 2))
        new = feistel(ints, F.transform(ints, lambda _: F.lit(10)), key, "card")
        return F.concat(F.substring(digits, 1, 1), F.array_join(new.cast("array<string>"), ""))

    def checked(payload):
        return F.concat(payload, F.pmod(10 - F.pmod(luhn_sum(payload, 2), F.lit(10)), F.lit(10)).cast("string"))

    return let(_digits(text), lambda digits: F.when(
        F.pmod(luhn_sum(digits, 1), F.lit(10)) == 0, _refill(text, let(permuted(digits), checked))).otherwise(text))


def mod97(text: Column) -> Column:
    """Remainder of an alphanumeric string, letters as 10 to 35."""
    return F.aggregate(_chars(text), F.lit(0), lambda r, c: F.when(
        _is(c, "0", "9"), F.pmod(r * 10 + _value(c), F.lit(97))).otherwise(
        F.pmod(r * 100 + _value(c) + 10, F.lit(97))))


def iban(text: Column, key: str) -> Column:
    """Country, classes of the account's characters and mod-97 validity stay."""
    def whole(x):
        check = F.lpad((98 - mod97(F.concat(x["new"], x["country"], F.lit("00")))).cast("string"), 2, "0")
        return F.concat(x["country"], check, x["new"])

    def change(flat):
        country, account = F.substring(flat, 1, 2), F.substring(flat, F.lit(5), F.length(flat) - 4)
        valid = mod97(F.concat(account, F.substring(flat, 1, 4))) == 1
        new = F.struct(country.alias("country"), by_class(account, key, "iban").alias("new"))
        return F.when(valid, _fill(text, let(new, whole), lambda c: c != " ")).otherwise(text)

    return let(F.replace(text, F.lit(" "), F.lit("")), change)


def ssn(text: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group and serial not zero."""
    area, group, serial = (F.substring(text, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    new = feistel(F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1),
                  F.array(F.lit(898), F.lit(99), F.lit(9999)), key, "ssn")

    def write(n):
        a = F.get(n, F.lit(0)) + 1
        return F.concat_ws("-", F.lpad(F.when(a >= 666, a + 1).otherwise(a).cast("string"), 3, "0"),
                           F.lpad((F.get(n, F.lit(1)) + 1).cast("string"), 2, "0"),
                           F.lpad((F.get(n, F.lit(2)) + 1).cast("string"), 4, "0"))

    return F.when(valid, let(new, write)).otherwise(text)


def ip(text: Column, key: str) -> Column:
    parts = F.split(text, r"\.").cast("array<int>")
    return F.array_join(feistel(parts, F.transform(parts, lambda _: F.lit(256)), key, "ip").cast("array<string>"), ".")


def phone(text: Column, key: str) -> Column:
    """North American numbers: a first digit of area or exchange stays within 2 to 9, or 0 to 1; a country code stays."""
    first = lambda i: (i == 0) | (i == 3)

    def change(x):
        ten = x["ten"]
        ints = F.transform(ten, lambda d, i: F.when(first(i) & (d > 1), d - 2).otherwise(d))
        new = feistel(ints, F.transform(ten, lambda d, i: F.when(~first(i), 10).when(d > 1, 8).otherwise(2)), key, "phone")
        out = F.array_join(F.transform(new, lambda d, i: F.when(first(i) & (F.get(ten, i) > 1), d + 2).otherwise(d))
                           .cast("array<string>"), "")
        return _refill(text, F.concat(F.substring(x["digits"], F.lit(1), F.length(x["digits"]) - 10), out))

    return let(_digits(text), lambda digits: let(F.struct(
        digits.alias("digits"), _ints(F.substring(digits, F.length(digits) - 9, F.lit(10))).alias("ten")), change))


def intl_phone(text: Column, key: str) -> Column:
    """Eight to fifteen digits; the first two (of the country code) stay."""
    def change(digits):
        ints = _ints(F.substring(digits, F.lit(3), F.length(digits) - 2))
        new = feistel(ints, F.transform(ints, lambda _: F.lit(10)), key, "intl_phone")
        return F.when(F.length(digits).between(8, 15), _refill(text, F.concat(
            F.substring(digits, 1, 2), F.array_join(new.cast("array<string>"), "")))).otherwise(text)

    return let(_digits(text), change)


def day_number(number: Column, key: str) -> Column:
    """Another day of 1900 to 2099: the network on two symbols, repeated until the day is in range."""
    def step(s):
        pair = feistel(F.array(F.floor(s / SIDE).cast("int"), F.pmod(s, F.lit(SIDE)).cast("int")),
                       F.array(F.lit(SIDE), F.lit(SIDE)), key, "date")
        return let(pair, lambda p: F.get(p, F.lit(0)) * SIDE + F.get(p, F.lit(1)))

    # a step leaves the range with a chance of 0.006: 16 steps end outside about never, and then the day stays
    return let(number, lambda n: F.aggregate(
        F.sequence(F.lit(1), F.lit(16)), n, lambda s, i: F.when((i > 1) & (s < DAYS), s).otherwise(step(s)),
        lambda end: F.when(end < DAYS, end).otherwise(n)))


def _date(value: Column, key: str) -> Column:
    day = F.unix_date(value) - F.unix_date(F.lit(FIRST_DAY).cast("date"))
    return F.date_from_unix_date(day_number(day, key) + F.unix_date(F.lit(FIRST_DAY).cast("date")))


def iso_date(text: Column, key: str) -> Column:
    """Year first; the separator stays."""
    value = F.try_to_timestamp(F.translate(text, "/.", "--"), F.lit("yyyy-MM-dd")).cast("date")
    new = F.replace(F.date_format(_date(value, key), "yyyy-MM-dd"), F.lit("-"), F.substring(text, 5, 1))
    return F.when(value.isNotNull(), new).otherwise(text)


def day_date(text: Column, key: str) -> Column:
    """Day first where that is a date, else month first; separator stays, as does whether a day or month may be short."""
    def write(x):
        day_first, short = x["first"].isNotNull(), x["flat"].rlike("^[0-9]/|/[0-9]/")
        styles = {(True, True): "d/M/yyyy", (True, False): "dd/MM/yyyy", (False, True): "M/d/yyyy",
                  (False, False): "MM/dd/yyyy"}
        out = F.lit(None).cast("string")
        for (d, s), style in styles.items():
            out = F.when((day_first == d) & (short == s), F.date_format(x["new"], style)).otherwise(out)
        return F.replace(out, F.lit("/"), F.regexp_extract(text, "[-/.]", 0))

    flat = F.translate(text, ".-", "//")
    first = F.try_to_timestamp(flat, F.lit("d/M/yyyy")).cast("date")
    second = F.try_to_timestamp(flat, F.lit("M/d/yyyy")).cast("date")
    value = F.coalesce(first, second)
    return F.when(value.isNotNull(), let(F.struct(flat.alias("flat"), first.alias("first"),
                                                  _date(value, key).alias("new")), write)).otherwise(text)


def named_date(text: Column, key: str) -> Column:
    """Order, commas and the length of the month's name stay; a day below 10 is written with a zero where one stood."""
    day, month = F.regexp_extract(text, "[0-9]+", 0), F.regexp_extract(text, "[A-Za-z]+", 0)
    gap = F.regexp_extract(text, "(,? )[0-9]{4}$", 1)
    value = F.try_to_timestamp(F.concat_ws("-", day, F.substring(month, 1, 3), F.right(text, F.lit(4))),
                               F.lit("d-MMM-yyyy")).cast("date")

    def write(new):
        d = F.date_format(new, "d")
        d = F.when(day.startswith("0"), F.lpad(d, 2, "0")).otherwise(d)
        m = F.when((F.length(month) > 3) | (month == "May"), F.date_format(new, "MMMM")).otherwise(F.date_format(new, "MMM"))
        pair = F.when(text.rlike("^[0-9]"), F.concat_ws(" ", d, m)).otherwise(F.concat_ws(" ", m, d))
        return F.concat(pair, gap, F.date_format(new, "yyyy"))

    return F.when(value.isNotNull(), let(_date(value, key), write)).otherwise(text)


def ipv6(text: Column, key: str) -> Column:
    """Hexadecimal digits are permuted, groups keep their lengths; addresses are linked as they are written."""
    def change(chars):
        new = feistel(F.transform(chars, lambda c: F.when(c == ":", 0).otherwise(F.conv(c, 16, 10).cast("int"))),
                      F.transform(chars, lambda c: F.when(c == ":", 1).otherwise(16)), key, "ipv6")
        return F.array_join(F.zip_with(chars, new, lambda c, v: F.when(c == ":", c).otherwise(F.hex(v.cast("long")))), "")

    return let(let(_chars(text), change), lambda new: F.when(text.rlike("[A-F]"), new).otherwise(F.lower(new)))


def email(text: Column, key: str) -> Column:
    """Local part and host by class; the top-level domain stays."""
    name = F.regexp_extract(text, r"^(.*)\.[A-Za-z]+$", 1)
    return F.concat(by_class(name, key, "email"), F.substring(text, F.length(name) + 1, F.length(text)))


def credential(text: Column, key: str) -> Column:
    """The name of the setting stays, its value is permuted by class."""
    name = F.regexp_extract(text, r"""^(AKIA|gh[opsu]_|github_pat_|sk-|[A-Za-z_-]+[ ]?[=:][ ]?["']?)""", 1)
    end = F.regexp_extract(text, """["']$""", 0)
    value = F.substring(text, F.length(name) + 1, F.length(text) - F.length(name) - F.length(end))
    return F.concat(name, by_class(value, key, "credential"), end)


KINDS = {"credential": credential, "email": email, "iban": iban, "ssn": ssn, "iso_date": iso_date,
         "day_date": day_date, "named_date": named_date, "ipv6": ipv6, "ip": ip, "card": card, "phone": phone, "intl_phone": intl_phone}


def card_end(m: Column, i: Column) -> Column:
    """Last place of a valid card that begins at place ``i`` of a match: of the network's usual length, or the longest."""
    part = lambda e: F.substring(m, i, e - i + 1)
    usual = F.when(F.substring(m, i, F.lit(2)).rlike("^3[47]"), 15).when(
        F.substring(m, i, F.lit(2)).rlike("^3[068]"), 14).otherwise(16)
    ends = F.filter(F.sequence(F.lit(1), F.length(m)), lambda e: (e >= i + 12) & F.substring(m, e, F.lit(2)).rlike(
        "^[0-9](?:[ -]|$)") & F.length(_digits(part(e))).between(13, 19) & (
        (i == 1) | part(e).rlike(CARD_LAYOUT)) & (F.pmod(luhn_sum(_digits(part(e)), 1), F.lit(10)) == 0))
    return let(ends, lambda x: F.coalesce(F.get(F.filter(
        x, lambda e: F.length(_digits(part(e))) == usual), F.lit(0)), F.array_max(x)))


def iban_end(m: Column, i: Column) -> Column:
    """Last place of a valid IBAN that begins at place ``i`` of a match: of its country's length, or the longest."""
    part = lambda e: F.substring(m, i, e - i + 1)
    flat = lambda e: F.replace(part(e), F.lit(" "), F.lit(""))
    usual = F.lit(0)
    for n, countries in IBAN_LENGTHS.items():
        usual = F.when(F.upper(F.substring(m, i, F.lit(2))).isin(countries.split()), n).otherwise(usual)
    ends = F.filter(F.sequence(F.lit(1), F.length(m)), lambda e: (e >= i + 11) & F.substring(m, e, F.lit(2)).rlike(
        "^[A-Za-z0-9](?: |$)") & part(e).rlike(f"^{PATTERNS['iban']}$") & (
        mod97(F.concat(F.substring(flat(e), F.lit(5), F.length(flat(e))), F.substring(flat(e), 1, 4))) == 1))
    return let(ends, lambda x: F.coalesce(F.get(F.filter(
        x, lambda e: F.length(flat(e)) == usual), F.lit(0)), F.array_max(x)))


ENDS = {"iban": iban_end, "card": card_end}


def mark_match(m: Column, kind: str) -> Column:
    """A match of a checked kind with marks around its valid parts, from left to right."""
    places = F.filter(F.sequence(F.lit(1), F.length(m)), lambda i: (
        (i == 1) | F.substring(m, i - 1, F.lit(1)).isin(" ", "-")) & (F.substring(m, i, F.lit(1)) != " "))

    def step(s, i):
        def put(e):
            return F.when(e.isNull(), s).otherwise(F.struct(
                F.concat(s["out"], F.substring(m, s["at"], i - s["at"]), F.lit(OPEN), F.substring(m, i, e - i + 1),
                         F.lit(SHUT)).alias("out"), (e + 1).alias("at")))
        return F.when(i < s["at"], s).otherwise(let(ENDS[kind](m, i), put))

    return F.aggregate(places, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step,
                       lambda s: F.concat(s["out"], F.substring(m, s["at"], F.length(m))))


def _scan(text: Column, pattern: str, new) -> Column:
    """``text`` with ``new`` of every match of ``pattern`` in its place."""
    parts = F.zip_with(F.split(text, pattern, -1), F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), new),
                       lambda gap, n: F.concat(gap, F.coalesce(n, F.lit(""))))
    return F.array_join(parts, "")


def mark(text: Column, kind: str) -> Column:
    """Marks the valid values of a checked kind. The second scan starts from other places, as parts are marked then."""
    raw, done = PATTERNS[kind], CHECKED[:CHECKED.index(kind)]
    pattern = _any({k: _marked(k) for k in done} | {kind: f"{_marked(kind)}|{raw}"})

    def scan(t):
        return F.when(t.rlike(raw), _scan(t, pattern, lambda m: F.when(
            m.rlike(f"^(?:{raw})$"), mark_match(m, kind)).otherwise(m))).otherwise(t)

    return let(scan(text), scan)


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one found value, by the first kind whose whole pattern it has."""
    out = F
    for kind, make in KINDS.items():
        if kind in CHECKED:
            inner = F.substring(match, F.lit(len(OPEN) + 1), F.length(match) - len(OPEN) - len(SHUT))
            out = out.when(match.rlike(f"^{_marked(kind)}$"), let(inner, lambda v: make(v, key)))  # noqa: B023
        else:
            out = out.when(match.rlike(f"^(?:{PATTERNS[kind]})$"), make(match, key))
    return out.otherwise(match)


def _marked(kind: str) -> str:
    return f"{OPEN}{PATTERNS[kind]}{SHUT}"


def _any(other: dict[str, str] | None = None) -> str:
    return "|".join((PATTERNS | (other or {})).values())


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every found value of ``text_col`` replaced; all columns and rows stay."""
    text = F.col(text_col)
    pattern = _any({k: _marked(k) for k in CHECKED})
    new = F.replace(text, F.lit(MARK), F.lit(OWN))
    for kind in CHECKED:
        new = let(new, lambda t: mark(t, kind))  # noqa: B023
    new = let(new, lambda t: _scan(t, pattern, lambda m: pseudonym(m, key)))
    for shown, hidden in ((OPEN, ""), (SHUT, ""), (OWN, MARK)):
        new = F.replace(new, F.lit(shown), F.lit(hidden))
    return docs.withColumn(text_col, F.when(text.rlike(NEEDED), new).otherwise(text))


def values_found(text: Column) -> Column:
    """Number of places in ``text`` that look like a value of any kind."""
    return F.when(text.rlike(NEEDED), F.regexp_count(text, F.lit(_any()))).otherwise(F.lit(0))
