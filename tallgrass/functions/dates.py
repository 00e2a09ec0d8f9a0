"""Dates from text and calendar arithmetic; what can't be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def compact_date(text: Column) -> Column:
    """YYYYMMDD, with or without / - . between."""
    digits = F.regexp_replace(F.trim(text), "[-/.]", "")
    return F.when(digits.rlike(r"^\d{8}$"), _ymd(F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)))


def date_range(text: Column) -> Column:
    """A struct (start, end) of "a ~ b"; without a tilde both are the one date."""
    parts = F.split(text, r"\s*[~∼～]\s*")
    start = compact_date(parts[0])
    return F.struct(start.alias("start"), F.when(F.size(parts) > 1, compact_date(F.try_element_at(parts, F.lit(2)))).otherwise(start).alias("end"))


def worded_date(text: Column) -> Column:
    """Dates with the Korean words for year, month and day."""
    p = r"(\d{4})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일"
    return F.when(text.rlike(p), _ymd(*(F.regexp_extract(text, p, i) for i in (1, 2, 3))))


_MAIL = r"^(?:[A-Za-z]{3},\s*)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+(\d{2}:\d{2})(:\d{2})?\s*(?:(GMT|UTC|UT|Z)|([+-]\d{4}))?$"
_ISO = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2})?(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?$"
_DOTTED = r"^(\d{4})\.(\d{1,2})\.(\d{1,2})\. (\d{1,2}:\d{1,2})(:\d{1,2})?$"


def published_at(text: Column) -> Column:
    """RFC 2822, ISO with T or a space, with or without seconds, fractions and zone, and a dotted form; times without a zone are of Seoul. A TIMESTAMP."""
    text = F.trim(text)
    part = lambda p, i, default="": F.when(F.regexp_extract(text, p, i) == "", default).otherwise(F.regexp_extract(text, p, i))
    zone = F.when(F.regexp_extract(text, _MAIL, 6) != "", "+0000").otherwise(part(_MAIL, 7, "+0900"))
    mail = F.concat_ws(" ", part(_MAIL, 1), F.initcap(part(_MAIL, 2)), part(_MAIL, 3), F.concat(part(_MAIL, 4), part(_MAIL, 5, ":00")), zone)
    iso = F.concat(part(_ISO, 1), F.lit(" "), part(_ISO, 2, "00:00"), part(_ISO, 3, ":00"), part(_ISO, 4), F.regexp_replace(part(_ISO, 5, "+09:00"), r"^([+-]\d{2})(\d{2})$", "$1:$2"))
    dotted = F.concat(F.concat_ws("-", part(_DOTTED, 1), F.lpad(part(_DOTTED, 2), 2, "0"), F.lpad(part(_DOTTED, 3), 2, "0")), F.lit(" "), part(_DOTTED, 4), part(_DOTTED, 5, ":00"), F.lit("+09:00"))
    read = lambda x: x.try_cast("timestamp")
    return F.when(text.rlike(_MAIL), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z"))).when(text.rlike(_ISO), read(iso)).when(text.rlike(_DOTTED), read(dotted))


def month_shift(yyyymm: Column, n: int) -> Column:
    months = F.floor(yyyymm / 100) * 12 + yyyymm % 100 - 1 + n
    return F.floor(months / 12) * 100 + months % 12 + 1


def month_windows(start: Column, end: Column) -> Column:
    """An array of (start, end) that cuts the range at months' ends."""
    firsts = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))
    return F.transform(firsts, lambda m: F.struct(F.greatest(m, start).alias("start"), F.least(F.last_day(m), end).alias("end")))


def gap_hours(a: Column, b: Column) -> Column:
    return (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) / 3_600_000_000


def effective_at(published: Column, collected: Column, now: Column) -> Column:
    """The time that counts: of publication, else of collection, else now."""
    return F.coalesce(published, collected, now)
