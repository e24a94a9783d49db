"""Format-preserving Feistel pseudonyms of personal numbers and dates; DataFrame functions only.

A validated value is numbered within all values of its format, the number is split into two digits of a mixed radix, and
keyed rounds add a hash of the one to the other. Each round can be undone, so the map is a permutation of the format's
values: equal values get equal pseudonyms in every document, different ones stay different.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.llm.common import spare

ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 73_049  # to 2099-12-31; 17 * 4297

EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
IPV4 = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
DATE = r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
PHONE = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
CARD = r"\d(?:[ -]?\d){12,18}"
#: a number starts and ends here, not inside a longer run of letters or digits
FROM, TO = r"(?<![A-Za-z0-9.+/-])", r"(?![A-Za-z0-9]|[./-]\d)"
#: usual layouts of card numbers, the most common first
LAYOUTS = tuple(rf"\d{{{g[0]}}}" + "".join(rf"{mark}\d{{{n}}}" for n in g[1:]) for g in ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 5, 6), (4, 3, 3, 3), (4, 4, 4, "1,3"), (4, 4, 4, 4, "1,3")) for mark in " -")
LAYOUTS = (r"\d{13,19}", *LAYOUTS)

_MONTH_DAY = r"(?:0[13578]|1[02]){0}(?:0[1-9]|[12]\d|3[01])|(?:0[469]|11){0}(?:0[1-9]|[12]\d|30)|02{0}(?:0[1-9]|1\d|2[0-8])"
_DAY_MONTH = r"(?:0[1-9]|[12]\d|3[01]){0}(?:0[13578]|1[02])|(?:0[1-9]|[12]\d|30){0}(?:0[469]|11)|(?:0[1-9]|1\d|2[0-8]){0}02"
_YEAR, _LEAP = r"(?:19|20)\d\d", r"(?:19(?:0[48]|[2468][048]|[13579][26])|20(?:[02468][048]|[13579][26]))"


def _days(mark: str) -> str:
    """Days of 1900 to 2099 with the year last, day or month first."""
    either = "|".join(x.replace("{0}", mark) for x in (_DAY_MONTH, _MONTH_DAY))
    return rf"(?:{either}){mark}{_YEAR}|(?:29{mark}02|02{mark}29){mark}{_LEAP}"


#: what is sure to hold what its format asks, so that a match never hides another format
DAY = rf"{_YEAR}-(?:{_MONTH_DAY.replace('{0}', '-')})|{_LEAP}-02-29|{_days('/')}|{_days('[.]')}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"{OCTET}(?:\.{OCTET}){{3}}"
PERSON = r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}"
CALL = r"(?:\+?1[ .-]?(?:\(\d{3}\) ?|\d{3}[ .-])|\(\d{3}\) ?)\d{3}[ .-]\d{4}|[2-9]\d{2}[ .-]\d{3}[ .-]\d{4}"
#: one value that is no card
VALUE = rf"(?<![A-Za-z0-9._%+-]){EMAIL}(?![A-Za-z0-9-])|{FROM}(?:{DAY}|{PERSON}|{CALL}|{ADDRESS}){TO}"
LOOSE_CARD = FROM + CARD + TO
#: every value without an @ has three digits this close
NEAR_DIGITS = r"\d[ ./()-]{0,2}\d[ ./()-]{0,2}\d"


def _round(tag: str, key: str, r: Column, other: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), r.cast("string"), other.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute(n: Column, low: int, high: int, tag: str, key: str) -> Column:
    """Keyed permutation of 0 .. low * high - 1."""

    def step(acc: Column, r: Column) -> Column:
        even = r % 2 == 0
        x, y = acc["x"], acc["y"]
        hashed = _round(tag, key, r, F.when(even, y).otherwise(x))
        return F.struct(F.when(even, (x + hashed) % low).otherwise(x).alias("x"), F.when(even, y).otherwise((y + hashed) % high).alias("y"))

    pair = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct((n % low).cast("long").alias("x"), F.floor(n / F.lit(low).cast("decimal(20,0)")).cast("long").alias("y")), step)
    return F.aggregate(F.array(pair), F.lit(0).cast("long"), lambda _, p: p["y"] * low + p["x"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, r"\D", "")


def _luhn_sum(digits: Column) -> Column:
    """Over digits whose last one is not doubled."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, 1, 32).substr(n - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _refill(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced in order."""
    places = F.sequence(F.lit(1), F.length(shape))

    def one(i: Column) -> Column:
        c = shape.substr(i, F.lit(1))
        return F.when(c.rlike(r"\d"), digits.substr(F.length(_digits(shape.substr(F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(places, one), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def is_card(v: Column) -> Column:
    return v.rlike(f"^(?:{CARD})$") & (_luhn_sum(_digits(v)) % 10 == 0)


def card(v: Column, key: str) -> Column:
    """All digits but the last are permuted within their number of digits; the last is the check digit."""

    def body(d: Column) -> Column:
        out = F.lit(None).cast("string")
        for size in range(13, 20):
            low, high = (size - 1) // 2, (size - 1) - (size - 1) // 2
            payload = permute(d.substr(1, size - 1).cast("long"), 10**low, 10**high, f"card{size}", key)
            out = F.when(F.length(d) == size, F.lpad(payload.cast("string"), size - 1, "0")).otherwise(out)
        return _let(out, lambda p: F.concat(p, ((F.lit(10) - _luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))

    return _refill(v, _let(_digits(v), body))


def is_phone(v: Column) -> Column:
    """Any codes with a country code or parentheses; bare numbers need an area code of 200 or more."""
    d = F.substring(F.concat(F.lit("0000000000"), _digits(v)), -10, 10)
    marked = v.contains("(") | (F.length(_digits(v)) == 11)
    return v.rlike(f"^(?:{PHONE})$") & (marked | (d.substr(1, 1) >= "2"))


def phone(v: Column, key: str) -> Column:
    """All ten-digit numbers; a country code stays.

    Numbers with an area code from 200 on and the other ones are permuted apart, so that no number gets the digits of a
    bare one that stays.
    """
    low = 2_000_000_000

    def body(d: Column) -> Column:
        n = d.cast("long")
        out = F.when(n >= low, permute(n - low, 80_000, 100_000, "phone", key) + low).otherwise(permute(n, 40_000, 50_000, "phone low", key))
        return F.lpad(out.cast("string"), 10, "0")

    head = F.regexp_extract(v, r"^(\+?1[ .-]?)?", 0)
    rest = v.substr(F.length(head) + 1, F.length(v))
    return F.concat(head, _refill(rest, _let(_digits(rest), body)))


def is_ssn(v: Column) -> Column:
    return v.rlike(f"^{PERSON}$")


def ssn(v: Column, key: str) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    area = v.substr(1, 3).cast("long")
    n = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + v.substr(5, 2).cast("long") - 1) * 9_999 + v.substr(8, 4).cast("long") - 1

    def body(m: Column) -> Column:
        a = F.floor(m / (99 * 9_999)) + 1
        return F.concat(F.lpad((a + F.when(a > 665, 1).otherwise(0)).cast("string"), 3, "0"), F.lit("-"), F.lpad((F.floor(m / 9_999) % 99 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((m % 9_999 + 1).cast("string"), 4, "0"))

    return _let(permute(n, 9_999, 898 * 99, "ssn", key), body)


def is_ipv4(v: Column) -> Column:
    return v.rlike(f"^{ADDRESS}$")


def ipv4(v: Column, key: str) -> Column:
    """All 2**32 addresses."""
    n = F.aggregate(F.split(v, r"\."), F.lit(0).cast("long"), lambda a, o: a * 256 + o.cast("long"))
    return _let(permute(n, 65_536, 65_536, "ipv4", key), lambda m: F.concat_ws(".", *[(F.floor(m / 256**i) % 256).cast("long").cast("string") for i in (3, 2, 1, 0)]))


def _day(v: Column) -> Column:
    """Days from 1900-01-01, day first where that is a date, else month first; null if there is no such day or it lies
    outside the range."""
    day_first = F.concat_ws("-", v.substr(7, 4), v.substr(4, 2), v.substr(1, 2))
    month_first = F.concat_ws("-", v.substr(7, 4), v.substr(1, 2), v.substr(4, 2))
    iso = v.rlike(r"^\d{4}-")
    as_date = lambda text: F.try_to_date(text, "yyyy-MM-dd")
    n = F.date_diff(F.when(iso, as_date(v)).otherwise(F.coalesce(as_date(day_first), as_date(month_first))), F.lit(FIRST_DAY).cast("date"))
    return F.when(v.rlike(f"^(?:{DATE})$") & (n >= 0) & (n < DAYS), n)


def date(v: Column, key: str) -> Column:
    """Days of 1900 to 2099; year first or day first as in `v`.

    A month-first value is written month first only where its new day is over 12, so that it reads as the same day.
    """
    m = permute(_day(v).cast("long"), 17, 4_297, "date", key)

    def body(d: Column) -> Column:
        mark = v.substr(3, 1)
        day, month = F.date_format(d, "dd"), F.date_format(d, "MM")
        swap = (v.substr(4, 2) > "12") & (day > "12")
        year_last = F.concat(F.when(swap, month).otherwise(day), mark, F.when(swap, day).otherwise(month), mark, F.date_format(d, "yyyy"))
        return F.when(v.rlike(r"^\d{4}-"), F.date_format(d, "yyyy-MM-dd")).otherwise(year_last)

    return _let(F.date_add(F.lit(FIRST_DAY).cast("date"), m.cast("int")), body)


def email(v: Column, key: str) -> Column:
    """Letters and digits before the @ are permuted within their kind (a-z, A-Z, 0-9), halves keying each other."""
    local, domain = F.substring_index(v, "@", 1), F.substring_index(v, "@", -1)
    half = F.floor((F.length(local) + 1) / 2).cast("int")

    def shift(part: Column, other: Column, r: Column) -> Column:
        def one(i: Column) -> Column:
            c = part.substr(i, F.lit(1))
            by = _round("email", key, r, F.concat_ws("|", i.cast("string"), F.length(part).cast("string"), other))
            moved = lambda first, n: F.char((F.ascii(c) - first + by % n) % n + first)
            return F.when(c.rlike("[0-9]"), moved(48, 10)).when(c.rlike("[a-z]"), moved(97, 26)).when(c.rlike("[A-Z]"), moved(65, 26)).otherwise(c)

        return F.when(F.length(part) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(part), F.lit(1))), one), "")).otherwise(part)

    def step(acc: Column, r: Column) -> Column:
        even = r % 2 == 0
        return F.struct(F.when(even, shift(acc["a"], acc["b"], r)).otherwise(acc["a"]).alias("a"), F.when(even, acc["b"]).otherwise(shift(acc["b"], acc["a"], r)).alias("b"))

    start = F.struct(local.substr(F.lit(1), half).alias("a"), local.substr(half + 1, F.length(local)).alias("b"))
    whole = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda acc: F.concat(acc["a"], acc["b"]))
    return F.concat(whole, F.lit("@"), domain)


def kind_of(v: Column) -> Column:
    """Kind of a validated value, null if it does not hold what its format asks."""
    return (
        F.when(v.contains("@"), F.lit("email"))
        .when(_day(v).isNotNull(), F.lit("date"))
        .when(is_ipv4(v), F.lit("ipv4"))
        .when(is_ssn(v), F.lit("ssn"))
        .when(is_phone(v), F.lit("phone"))
        .when(is_card(v), F.lit("card"))
    )


def pseudonym(v: Column, kind: Column, key: str) -> Column:
    out = v
    for name, f in (("email", email), ("date", date), ("ipv4", ipv4), ("ssn", ssn), ("phone", phone), ("card", card)):
        out = F.when(kind == name, f(v, key)).otherwise(out)
    return out


def _cut(t: Column, pattern: Column) -> Column:
    """Pieces (kind, text) of `t` in order: matches with their kind, and what lies between."""
    piece = lambda kind, text: F.struct(kind.alias("kind"), F.coalesce(text, F.lit("")).alias("text"))
    none = F.lit(None).cast("string")
    pairs = F.zip_with(F.split(t, pattern, -1), F.regexp_extract_all(t, pattern, 0), lambda gap, v: F.array(piece(none, gap), piece(kind_of(v), v)))
    return F.filter(F.flatten(pairs), lambda p: p["text"] != "")


def pieces(t: Column) -> Column:
    """Pieces (kind, text) of a text: first values that are no card and cards in a usual layout, wherever they start, then
    what else passes as a card between these."""
    cards = F.flatten(F.array(*[F.regexp_extract_all(t, F.lit(rf"{FROM}(?=({c}){TO})"), 1) for c in LAYOUTS]))
    cards = F.array_distinct(F.filter(cards, is_card))
    sure = _let(cards, lambda c: F.when(F.size(c) > 0, F.concat(F.lit(f"{VALUE}|{FROM}(?:"), F.array_join(c, "|"), F.lit(f"){TO}"))).otherwise(F.lit(VALUE)))

    def rest(p: Column) -> Column:
        return F.when(p["kind"].isNull() & p["text"].rlike(LOOSE_CARD), _cut(p["text"], F.lit(LOOSE_CARD))).otherwise(F.array(p))

    return F.flatten(F.transform(_let(sure, lambda pattern: _cut(t, pattern)), rest))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str | None = None) -> DataFrame:
    """All columns of `docs`, `text` with each validated value replaced under the secret `key`; `found` names a further column of the kinds in
    order of place, in the stead of a column that has the name already.

    Values that fail their check (sum, day of the calendar, octet, area code of a bare phone number) stay as they are. Null texts stay null (no
    kinds), empty texts empty; long texts are worked on whole; repeated rows each keep a row; other columns, whatever their names, are passed on; an empty
    table gives an empty result.
    """
    if not key:
        raise ValueError("a secret key is needed: whoever knows it can undo the map")
    t = F.col(text)
    hit = (t.contains("@") | t.rlike(NEAR_DIGITS)) & (t.rlike(VALUE) | t.rlike(LOOSE_CARD))
    cut = spare(docs, "_pieces")
    new = spare(docs, "_text")
    marked = docs.withColumn(cut, F.when(hit, pieces(t)))
    joined = F.array_join(F.transform(cut, lambda p: F.when(p["kind"].isNull(), p["text"]).otherwise(pseudonym(p["text"], p["kind"], key))), "")
    out = marked.withColumn(new, F.when(F.col(cut).isNotNull(), joined).otherwise(t))
    kinds = F.coalesce(F.filter(F.col(f"{cut}.kind"), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    return out.select(*[(F.col(new).alias(text) if c == text else F.col(f"`{c}`")) for c in docs.columns if c != found], *([kinds.alias(found)] if found else []))
