"""Column helpers of the tape: clocks, exact numbers, hex words, identities, distribution tails."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000


def date_of(micros: Column) -> Column:
    """UTC date of epoch micros, the day before for negative remainders."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / F.lit(DAY_US)).cast("int"))


def midnight_of(date: Column) -> Column:
    """Epoch micros of the midnight that begins a strict yyyy-mm-dd date; null for anything else."""
    d = F.when(date.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(date, "yyyy-MM-dd"))
    return F.datediff(d, F.lit("1970-01-01").cast("date")).cast("long") * DAY_US


def width_micros(width: Column) -> Column:
    """Micros of a bar width such as 1m, 4h, 1d, 1w; null unless a positive number and a known unit."""
    n = F.regexp_extract(width, "^([0-9]{1,9})([smhdw])$", 1)
    unit = F.regexp_extract(width, "^([0-9]{1,9})([smhdw])$", 2)
    of = F.when(unit == "s", 1).when(unit == "m", 60).when(unit == "h", 3600).when(unit == "d", 86400).when(unit == "w", 604800)
    out = F.when(n != "", n.cast("long")) * of.cast("long") * 1_000_000
    return F.when(out > 0, out)


def millis_to_micros(ms: Column) -> Column:
    return ms.cast("long") * 1000


def exact_decimal(text: Column) -> Column:
    """decimal(38,18) of a plain number; null if it isn't one or has over 18 places (never rounded)."""
    places = F.length(F.regexp_extract(text, r"\.([0-9]*)$", 1))
    whole = F.length(F.regexp_extract(text, r"^-?0*([0-9]*)", 1))
    ok = text.rlike(r"^-?[0-9]+(\.[0-9]+)?$") & (places <= 18) & (whole <= 20)
    return F.when(ok, text).cast("decimal(38,18)")


def hex_word(word: Column) -> Column:
    """Unsigned value of a 0x hex word of at most 30 significant digits as decimal(38,0), from halves of 15 digits; null past that."""
    digits = F.regexp_replace(F.lower(word), "^0x0*", "")
    high, low = F.substring(F.lpad(digits, 30, "0"), 1, 15), F.substring(F.lpad(digits, 30, "0"), 16, 15)
    value = F.conv(high, 16, 10).cast("decimal(19,0)").cast("decimal(38,0)") * F.lit(1 << 60).cast("decimal(19,0)") + F.conv(low, 16, 10).cast("decimal(19,0)")
    return F.when(word.rlike("^0x[0-9a-fA-F]+$") & (F.length(digits) <= 30), value.cast("decimal(38,0)"))


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of ``value``, which is evaluated once however often ``fn`` names it (Spark would write it out each time)."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def shifted_decimal(whole: Column, places: Column) -> Column:
    """``whole`` (decimal(38,0)) over 10^places as decimal(38,18), exactly; null where it doesn't fit."""

    def text(w: Column) -> Column:
        digits = F.lpad(w, F.greatest(F.length(w), places + 1), F.lit("0"))
        cut = F.length(digits) - places
        pointed = F.concat(F.substr(digits, F.lit(1), cut), F.lit("."), F.substr(digits, cut + 1))
        # zeros at the end are no places
        return F.regexp_replace(F.regexp_replace(pointed, "0+$", ""), r"\.$", "")

    return bound(whole.cast("string"), lambda w: bound(text(w), exact_decimal))


def address_of(topic: Column) -> Column:
    """The last 20 bytes of a 32-byte topic as a lower-case address."""
    return F.when(topic.rlike("^0x[0-9a-fA-F]{64}$"), F.concat(F.lit("0x"), F.lower(F.substring(topic, 27, 40))))


def fisher_z(rho: Column) -> Column:
    limit = 1 - 1e-12
    return F.atanh(F.greatest(F.lit(-limit), F.least(F.lit(limit), rho)))


def pseudonym(key: str, address: Column) -> Column:
    """First 16 hex digits of HMAC-SHA256 of the trimmed, lower-cased address."""
    raw = key.encode()
    if len(raw) > 64:
        import hashlib

        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(64, b"\0")
    pad = lambda x: F.unhex(F.lit(bytes(b ^ x for b in raw).hex()))
    inner = F.unhex(F.sha2(F.concat(pad(0x36), F.encode(F.lower(F.trim(address)), "UTF-8")), 256))
    return F.substring(F.sha2(F.concat(pad(0x5C), inner), 256), 1, 16)


def valid_token(token: Column) -> Column:
    """1 to 64 characters of letters, digits and ``_ - . : / @``."""
    return F.coalesce(token.rlike(r"^[A-Za-z0-9_.:/@-]{1,64}$"), F.lit(False))


def season(asof_us: Column) -> tuple[Column, Column]:
    """Hour of day and weekend flag of the hour that ends at ``asof_us`` (its start decides)."""
    start = asof_us - HOUR_US
    hour = F.floor(F.pmod(start, F.lit(DAY_US)) / HOUR_US).cast("int")
    day = F.pmod(F.floor(start / DAY_US) + 3, F.lit(7))  # Monday is 0
    return hour, day >= 5


def normal_cdf(x: Column) -> Column:
    """By a rational approximation of the error function (absolute error under 1.5e-7)."""
    z = F.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = 0.5 * poly * F.exp(-z * z)
    return F.when(x >= 0, 1 - tail).otherwise(tail)


def chi2_tail(x: Column, df: int) -> Column:
    """P(chi-square with ``df`` degrees > x), a finite sum (and the normal tail for odd df)."""
    h = x / 2
    if df % 2 == 0:
        total, term = F.lit(1.0), F.lit(1.0)
        for k in range(1, df // 2):
            term = term * h / k
            total = total + term
        return F.exp(-h) * total
    total, term = 2 * (1 - normal_cdf(F.sqrt(x))), F.sqrt(2 * x / math.pi) * F.exp(-h)
    for k in range(1, df // 2 + 1):
        total = total + term
        term = term * x / (2 * k + 1)
    return total


def params(**values: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))


def param(text: Column, name: str) -> Column:
    return F.get_json_object(text, f"$.{name}")
