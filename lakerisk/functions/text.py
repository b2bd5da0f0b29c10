"""String, id, time and formatting expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of RFC 4122, as 32 hex digits.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"

# to_json() cuts timestamps to milliseconds unless told otherwise.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def norm_text(col: Column) -> Column:
    return F.lower(F.trim(F.coalesce(col.cast("string"), F.lit(""))))


def search_text(names: Sequence[str]) -> Column:
    """Lower-cased fields joined by spaces; NULL fields read as empty."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]))


def split_ids(col: Column) -> Column:
    """'a, b,,c' -> ['a', 'b', 'c']"""
    parts = F.transform(F.split(col, ","), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def _pad(col: Column, width: int) -> Column:
    # lpad would cut longer text, so the target width grows with the text.
    return F.lpad(col, F.greatest(F.lit(width), F.length(col)), F.lit("0"))


def unit_id(kecamatan: Column, kelurahan: Column, rw: Column, rt: Column) -> Column:
    """SBY-{first 5 of kecamatan}-{first 5 of kelurahan}-{rw, 2 wide}-{rt, 3 wide}."""

    def short(col: Column) -> Column:
        return F.substring(F.regexp_replace(F.upper(F.coalesce(col, F.lit(""))), r"\s+", "-"), 1, 5)

    kec, kel = short(kecamatan), short(kelurahan)
    built = F.concat_ws(
        "-", F.lit("SBY"), kec, kel, _pad(F.coalesce(rw, F.lit("")), 2), _pad(F.coalesce(rt, F.lit("")), 3)
    )
    # Padding fills a blank rw/rt with zeros, so only the names can be blank.
    return F.when((kec == "") | (kel == ""), F.lit("--")).otherwise(built)


def uuid5(namespace_hex: str, name: Column) -> Column:
    """RFC 4122 version-5 UUID of ``name``, without leaving the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def parse_ts(col: Column) -> Column:
    return F.try_to_timestamp(col)


def epoch(col: Column) -> Column:
    """Whole seconds since 1970, as the forecast's time axis uses them."""
    return F.unix_timestamp(col)


def from_epoch(col: Column) -> Column:
    return F.timestamp_seconds(col)


def plus_days(col: Column, days: int) -> Column:
    return col + F.make_dt_interval(F.lit(days))


def version_string(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd_HHmmss")


def clamp(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))


def fmt_score(col: Column) -> Column:
    return F.format_string("%.1f", F.coalesce(col.cast("double"), F.lit(0.0)))


def fmt_pct(col: Column) -> Column:
    """0.734 -> '73.4%', NULL -> ''"""
    # format_string() would print a NULL.
    shown = F.concat(F.format_string("%.1f", col.cast("double") * 100.0), F.lit("%"))
    return F.when(col.isNotNull(), shown).otherwise(F.lit(""))


def fmt_ts(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
