"""Column helpers: flags in arrays, lookups, null-safe truth, text keys."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def truth(c: str | Column) -> Column:
    """The boolean, null being false."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(False))


def lookup(key: Column, table: dict, default=None) -> Column:
    """Value of a small fixed table; the default on a miss and for null."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def with_flag(flags: Column, condition: Column, flag: str) -> Column:
    """The flag appended where the condition holds and it isn't there yet; order is kept."""
    have = F.coalesce(flags, F.array().cast("array<string>"))
    return F.when(truth(condition) & ~F.array_contains(have, flag), F.array_append(have, F.lit(flag))).otherwise(have)


def flags_of(conditions: dict[str, Column]) -> Column:
    """Sorted, distinct flags whose conditions hold."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(truth(c), F.lit(k)) for k, c in conditions.items()]))))


def has_any(flags: Column, wanted: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(flags, F.array(*map(F.lit, wanted))), F.lit(False))


def first_of(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, else null."""
    out = None
    for name, condition in rules:
        out = F.when(truth(condition), name) if out is None else out.when(truth(condition), name)
    return out


def slug(code: Column, prefix: str = "vn-") -> Column:
    """Lower case, other characters than a-z0-9 as single hyphens, none at the ends."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.regexp_replace(F.lower(code), "[^a-z0-9]+", "-"), "^-+|-+$", ""))


def province_code(code: Column) -> Column:
    """Letters between ``C.`` at the start and the first digit, else empty."""
    return F.coalesce(F.regexp_extract(code, r"^C\.([A-Z]+)\d", 1), F.lit(""))


def valid_code(code: Column) -> Column:
    return truth(code.rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"))


def split_flags(text: Column, pattern: str = "[;|]") -> Column:
    """Non-empty parts; null gives an empty array."""
    return F.coalesce(F.filter(F.split(text, pattern), lambda x: x != ""), F.array().cast("array<string>"))


def number_in(text: Column, low: float, high: float) -> Column:
    """First of a ``;``-list as a number within bounds, else null."""
    v = F.trim(F.element_at(F.split(text, ";"), 1)).try_cast("double")
    return F.when(v.between(low, high), v)


def power_label(current: Column, kw: Column) -> Column:
    """``DC-120kW``: up to three decimals, without trailing zeros."""
    return F.concat(current, F.lit("-"), F.regexp_replace(F.format_string("%.3f", kw), r"\.?0+$", ""), F.lit("kW"))


def local_time(ms: Column, offset_hours: int = 7) -> Column:
    """Milliseconds as ``yyyy-MM-dd HH:mm:ss`` at a fixed offset, whatever the session's zone; null is empty.

    Days and seconds are counted, no zone has a part in it; a year of over four digits has all of them and no sign.
    """
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    at = ms.cast("long") + F.lit(offset_hours * 3_600_000)
    of_day = F.pmod(at, F.lit(86_400_000))
    day = F.date_from_unix_date(F.round((at - of_day) / 86_400_000).cast("int"))
    second = F.floor(of_day / 1000)
    year = F.year(day)
    years = F.when(year.between(0, 9999), F.lpad(year.cast("string"), 4, "0")).otherwise(year.cast("string"))
    date = F.concat_ws("-", years, two(F.month(day)), two(F.dayofmonth(day)))
    time = F.concat_ws(":", two(F.floor(second / 3600)), two(F.floor(second / 60) % 60), two(second % 60))
    return F.when(ms.isNotNull(), F.concat_ws(" ", date, time)).otherwise(F.lit(""))


@lru_cache(1)
def _unaccented() -> tuple[str, str]:
    """Characters and what they become, in order; those beyond the second text's length are dropped.

    By rule: compatibility decomposition without combining marks, in lower case, where that is one letter or digit; the
    letter d with stroke, which doesn't decompose, is a d; combining marks are dropped.
    """
    import sys
    import unicodedata

    pairs, marks = [("đ", "d"), ("Đ", "d")], []
    for point in range(0x80, sys.maxunicode + 1):
        c = chr(point)
        if unicodedata.combining(c):
            marks.append(c)
        elif len(plain := "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()) == 1 and plain.isascii() and plain.isalnum():
            pairs.append((c, plain))
    return "".join(a for a, _ in pairs) + "".join(marks), "".join(b for _, b in pairs)


def plain_text(text: Column) -> Column:
    """Lower case without accents, whether composed or decomposed; other characters than letters and digits as single
    spaces. A character that decomposes into several, such as a ligature, is such another one."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, *_unaccented())), "[^a-z0-9]+", " "))


# Prefixes of administrative units, in the order in which they are tried.
UNITS = ("phuong", "xa", "dac khu", "thi tran", "quan", "huyen", "thanh pho", "tinh", "tp")


def bare_name(text: Column) -> Column:
    """Plain text without its first unit prefix."""
    return F.regexp_replace(plain_text(text), rf"^({'|'.join(UNITS)}) ", "")


def identity(name: Column, address: Column, least: int = 8) -> Column:
    """Plain name without the first place where the plain address stands in it, if that has ``least`` characters."""
    n, a = plain_text(name), plain_text(address)
    at = F.instr(n, a)
    return F.trim(F.regexp_replace(F.when((F.length(a) >= least) & (at > 0), F.concat(F.substring(n, F.lit(1), at - 1), F.lit(" "), F.substring(n, at + F.length(a), F.length(n)))).otherwise(n), " +", " "))


def same_identity(a: Column, b: Column, least: int = 2) -> Column:
    """The words of one are all words of the other, with ``least`` at the least, and words with digits agree."""
    x, y = (F.array_distinct(F.filter(F.split(t, " "), lambda w: w != "")) for t in (a, b))
    serial = lambda t: F.filter(t, lambda w: w.rlike(r"\d"))
    sx, sy = serial(x), serial(y)
    inside = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    alike = (F.size(sx) == 0) | (F.size(sy) == 0) | ((F.size(F.array_except(sx, sy)) == 0) & (F.size(F.array_except(sy, sx)) == 0))
    return truth(inside & alike & (F.least(F.size(x), F.size(y)) >= least))


# First words of a commune's name and what they stand for.
KINDS = [("Phường", "PHUONG"), ("Xã", "XA"), ("Đặc khu", "DAC_KHU")]


def commune_kind(name: Column) -> Column:
    return F.coalesce(first_of([(kind, name.startswith(prefix + " ")) for prefix, kind in KINDS]), F.lit("UNKNOWN"))


def any_keyword(keywords: list[str], *texts: Column) -> Column:
    """One of the patterns stands in the texts, joined by spaces, in lower case; null texts are empty."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts])).rlike("|".join(keywords))


def corroborated(name: Column, *texts: Column, least: int = 4) -> Column:
    """The bare name, if it has ``least`` characters, stands in one of the plain texts."""
    bare = bare_name(name)
    found = None
    for t in texts:
        hit = F.coalesce(F.instr(plain_text(t), bare) > 0, F.lit(False))
        found = hit if found is None else found | hit
    return truth((F.length(bare) >= least) & found)
