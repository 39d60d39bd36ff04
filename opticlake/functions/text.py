"""Text to value: native column expressions, no Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opticlake import constants as C

_DIGITS = r"\d++(?:_\d++)*+"
_DECIMAL = rf"[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_NOT_FINITE = r"(?i)(?:[+-]?inf(?:inity)?|nan)"
_INTEGER = rf"[+-]?{_DIGITS}"
_WHOLE, _FIRST_WORD = r"\s*$", r"(?:\s|$)"
#: Most numbers: digits and a point, which a cast reads in the same way.
_PLAIN = r"^[+-]?\d++(?:\.\d*+)?$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: str | Column) -> Column:
    """The text, or NULL where it is empty."""
    return F.nullif(_col(c), F.lit(""))


def _number(c: Column, end: str) -> Column:
    """The number at the start of the text, if `end` follows. One pattern both finds and checks it:
    Java's `2f` and `1.0d` are no numbers, `1_000` is one."""
    digits = F.replace(F.regexp_extract(c, rf"^\s*({_DECIMAL}){end}", 1), F.lit("_"), F.lit(""))
    other = F.regexp_extract(c, rf"^\s*({_NOT_FINITE}){end}", 1)
    # An empty text is no number either, but costs the cast an exception.
    return F.coalesce(filled(digits).try_cast("double"), filled(other).try_cast("double"))


def _plain_or(c: Column, first: Column, end: str) -> Column:
    """`_number`, with a short way for a plain `first`, the whole text or what stands before a blank in it."""
    return F.when(F.rlike(first, F.lit(_PLAIN)), first.try_cast("double")).otherwise(_number(c, end))


def parse_number(c: str | Column) -> Column:
    """A whole text as double, blanks around it ignored."""
    return _plain_or(_col(c), _col(c), _WHOLE)


def parse_int(c: str | Column) -> Column:
    """A whole text as int, NULL where it is not one."""
    digits = F.regexp_extract(_col(c), rf"^\s*({_INTEGER}){_WHOLE}", 1)
    return F.replace(digits, F.lit("_"), F.lit("")).try_cast("int")


def parse_numeric_units(c: str | Column, default: float | None = None) -> Column:
    """First blank-separated word as double: `3.25 V` is 3.25, `- Inf` is NULL."""
    number = _plain_or(_col(c), F.substring_index(_col(c), " ", 1), _FIRST_WORD)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def parse_numeric_commas(c: str | Column) -> Column:
    """Whole text as double with thousands commas removed; a unit makes it NULL."""
    return parse_number(F.replace(_col(c), F.lit(","), F.lit("")))


def parse_speed_bps(c: str | Column) -> Column:
    """`400Gbps` in bits per second, fractions cut off."""
    c = F.lower(F.trim(_col(c)))
    units = "|".join(C.SPEED_UNITS)
    number = parse_number(F.regexp_extract(c, rf"^(.*?)({units})$", 1))
    unit = F.regexp_extract(c, rf"^(.*?)({units})$", 2)
    factor = F.lit(None).cast("long")
    for name, value in C.SPEED_UNITS.items():
        factor = F.when(unit == name, F.lit(value).cast("long")).otherwise(factor)
    return (number * factor).try_cast("long")


def cleanse_placeholders(c: str | Column, extra: tuple[str, ...] | list[str] = ()) -> Column:
    """The text unless it stands for `no value`; blanks are not trimmed."""
    c = _col(c)
    return F.when(~F.lower(c).isin(*C.PLACEHOLDERS, *extra), c)


def map_fiber_mode(c: str | Column) -> Column:
    mode = F.lower(cleanse_placeholders(c))
    return (
        F.when(mode.contains("multi") | mode.contains("mm"), C.MULTI_MODE)
        .when(mode.contains("single") | mode.contains("sm"), C.SINGLE_MODE)
    )


def classify_fiber_type(media_type: str | Column, description: str | Column, wavelength_nm: str | Column) -> Column:
    """Fibre type from wavelength, else media type, else description."""
    wave = _col(wavelength_nm)

    def by_words(c: Column, multi: list[str], single: list[str]) -> Column:
        text = F.regexp_replace(F.upper(c), "[- ]", "")
        return F.when(text.rlike("|".join(multi)), C.MULTI_MODE).when(text.rlike("|".join(single)), C.SINGLE_MODE)

    by_wave = F.when(wave == C.MULTI_MODE_WAVELENGTH, C.MULTI_MODE).when(
        wave.between(*C.SINGLE_MODE_WAVELENGTHS), C.SINGLE_MODE
    )
    return F.coalesce(
        by_wave,
        by_words(_col(media_type), C.MULTI_MODE_WORDS, C.SINGLE_MODE_WORDS),
        by_words(_col(description), C.MULTI_MODE_DESCRIPTION_WORDS, C.SINGLE_MODE_DESCRIPTION_WORDS),
    )


def device_profile(model: str | Column) -> Column:
    return F.upper(F.concat(F.lit(C.PROFILE_PREFIX), filled(model)))


def status_to_gauge(c: str | Column) -> Column:
    """1 for exactly `up`, 0 for any other status, NULL for none."""
    return (_col(c) == "up").cast("int")
