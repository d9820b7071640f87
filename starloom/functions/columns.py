"""Column expressions shared by cleansing, dimensions, facts and marts.

Everything here is a built-in expression, so it stays inside whole-stage
code generation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def change_hash(cols: Sequence[Column | str], algo: str = "sha256", sep: str = "||") -> Column:
    """Digest over ``cols``; NULL counts as the empty string."""
    joined = F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])
    if algo == "md5":
        return F.md5(joined)
    if algo == "sha256":
        return F.sha2(joined, 256)
    raise ValueError(f"unknown digest {algo!r}")


def is_blank(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def canonical(c: Column | str, aliases: Mapping[str, Sequence[str]], default: Column) -> Column:
    """Replace any known alias (case and outer blanks ignored) by its canonical code."""
    key = F.upper(F.trim(_col(c)))
    out = None
    for code, names in aliases.items():
        hit = key.isin(*names)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise(default)


def std_state(c: Column | str) -> Column:
    return canonical(c, K.STATE_ALIASES, F.lit("UNKNOWN"))


def std_category(c: Column | str) -> Column:
    return canonical(c, K.CATEGORY_ALIASES, F.lit("NEW"))


def std_channel(name: Column | str, channel_id: Column | str) -> Column:
    return F.coalesce(canonical(name, K.CHANNEL_ALIASES, _col(channel_id)), F.lit("UNKNOWN"))


def std_segment(c: Column | str) -> Column:
    return F.coalesce(F.upper(F.trim(_col(c))), F.lit("CONSUMER"))


def family_of(code: Column | str, families: Mapping[str, str], otherwise: str) -> Column:
    """The family whose code beginning ``code`` has; the longest beginning wins.

    One pattern finds the beginning and a literal map names its family.
    """
    known = "|".join(re.escape(k) for k in sorted(families, key=len, reverse=True))
    begins = F.regexp_extract(_col(code), f"^({known})", 1)
    names = F.create_map(*(F.lit(x) for pair in families.items() for x in pair))
    return F.coalesce(F.element_at(names, begins), F.lit(otherwise))


def mask_contact(c: Column | str) -> Column:
    """Hide the middle digits of a mobile number and the local part of an e-mail."""
    c = _col(c)

    def keep(start: int, head: int, tail: int) -> Column:
        return F.concat(F.substring(c, start, head), F.lit("-XXX-X"), F.substring(c, tail, 3))

    return (
        F.when(c.rlike(K.MOBILE_LOCAL), keep(1, 3, 9))
        .when(c.rlike(K.MOBILE_INTL), keep(1, 6, 12))
        .when(c.rlike(K.MOBILE_PLUS), keep(1, 7, 13))
        .when(c.rlike(K.EMAIL), F.concat(F.substring(c, 1, 1), F.lit("***@"), F.substring_index(c, "@", -1)))
        .otherwise(c)
    )


def id_digest(c: Column | str) -> Column:
    """SHA-256 of a personal identifier, NULL when there is none."""
    return F.when(~is_blank(c), F.sha2(F.trim(_col(c)), 256))


def money(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Text to decimal; malformed text becomes NULL instead of failing the job."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def without_vat(total: Column) -> Column:
    return (total / F.lit(K.VAT_DIVISOR).cast("decimal(3,2)")).cast("decimal(18,2)")


def vat_share(total: Column) -> Column:
    """VAT contained in a VAT-inclusive total, rounded to two places."""
    base = total / F.lit(K.VAT_DIVISOR).cast("decimal(3,2)")
    return (base * F.lit(K.VAT_RATE).cast("decimal(3,2)")).cast("decimal(18,2)")


def date_key(c: Column | str) -> Column:
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def time_key(c: Column | str) -> Column:
    c = _col(c)
    return (F.hour(c) * 100 + F.minute(c)).cast("int")


def key_to_date(c: Column | str) -> Column:
    """yyyymmdd integer back to a date."""
    c = _col(c)
    return F.make_date((c / 10000).cast("int"), ((c / 100).cast("int") % 100), c % 100)


def whole_hours(start: Column | str, end: Column | str) -> Column:
    """Complete hours between two timestamps; a started hour does not count."""
    return F.timestamp_diff("HOUR", _col(start), _col(end))


def exact_hours(start: Column | str, end: Column | str) -> Column:
    seconds = F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))
    return seconds / F.lit(3600.0)


def parse_ts(c: Column | str) -> Column:
    return _col(c).try_cast("timestamp_ntz")


def parse_date(c: Column | str) -> Column:
    """The day of a date or timestamp text; anything after that makes the whole text invalid."""
    return _col(c).try_cast("timestamp_ntz").cast("date")


def flag(cond: Column) -> Column:
    """Y/N flag; an unknown condition is N."""
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))


def count_when(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def sum_when(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0).cast("decimal(1,0)")))


def dbl(c: Column) -> Column:
    return c.cast("double")


def ratio(num: Column, den: Column, scale: float = 100.0) -> Column:
    """num / den * scale in DOUBLE, NULL for a zero denominator.

    DOUBLE rather than a narrow decimal: counts above a million must not overflow.
    """
    den = dbl(den)
    return F.when(den != 0.0, dbl(num) / den * F.lit(scale))


def mean_of(total: Column, n: Column) -> Column:
    """Average from an exact sum and a count, so re-runs give identical bits."""
    return ratio(total, n, 1.0)
