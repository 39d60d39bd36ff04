"""Interface names and chassis slots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake.functions.text import _col, parse_int


def normalize_if_name(c: str | Column) -> Column:
    """Base name: no channel, and `xe-` spelled `et-`."""
    return F.regexp_replace(F.split_part(_col(c), F.lit(":"), F.lit(1)), "^xe-", "et-")


def extract_channel(c: str | Column) -> Column:
    return parse_int(F.get(F.split(_col(c), ":"), F.lit(1)))


def parse_module_slot(c: str | Column) -> Column:
    """struct(type, number) for names such as `FPC 0`, `PIC 1`, `Xcvr 6`."""
    c = _col(c)

    def number(word: str) -> Column:
        return F.nullif(F.regexp_extract(c, rf"(?i){word}\s+(\d+)", 1), F.lit(""))

    def slot(kind: str, word: str) -> Column:
        return F.when(number(word).isNotNull(), F.struct(F.lit(kind).alias("type"), number(word).alias("number")))

    return F.coalesce(slot("fpc", "FPC"), slot("pic", "PIC"), slot("port", "Xcvr"))


def build_if_name(fpc: str | Column, pic: str | Column, port: str | Column, platform: str | Column) -> Column:
    """`et-0/1/2`; the prefix follows the platform, first listed match first."""
    hint = F.lower(_col(platform))
    matches = [F.when(hint.contains(key), F.lit(prefix)) for key, prefix in C.PLATFORM_PREFIXES.items()]
    prefix = F.coalesce(*matches, F.lit(C.DEFAULT_PREFIX))
    fpc, pic, port = (_col(p).cast("string") for p in (fpc, pic, port))
    return F.concat(prefix, F.lit("-"), fpc, F.lit("/"), pic, F.lit("/"), port)
