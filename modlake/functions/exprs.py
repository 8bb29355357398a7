"""Column helpers for webhook documents: paths, lenient times, keys, durations."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a surrogate key holds in place of a null (fixed by the key format).
NULL_KEY = "_dbt_utils_surrogate_key_null_"
TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"


def at(doc: Column | str, path: str, kind: str = "string") -> Column:
    """The value at a path of a VARIANT; null where it is missing, JSON null or of another kind."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, f"$.{path}", kind)


def read_as(doc: Column | str, kind: str) -> Column:
    """A VARIANT as a typed value, in one walk over it; what is missing or of another kind is null by itself, as at() gives it."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, "$", kind)


def event_time(doc: Column | str, path: str) -> Column:
    """The time at a path, as an instant; null for anything that does not look like a time. Without an offset it is UTC."""
    return instant(at(doc, path))


def instant(text: Column) -> Column:
    """The instant that a time text tells."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(TIME_SHAPE), F.try_to_timestamp(zoned))


def utc_offset_seconds(text: Column) -> Column:
    """The offset that a time text carries, which an instant forgets; null without one."""
    sign = F.when(F.regexp_extract(text, r"([+-])\d{2}:?\d{2}$", 1) == "-", -1).otherwise(1)
    hours, minutes = (F.regexp_extract(text, r"[+-](\d{2}):?(\d{2})$", k).try_cast("int") for k in (1, 2))
    return F.when(text.endswith("Z"), 0).when(text.rlike(TIME_SHAPE), sign * (hours * 3600 + minutes * 60)).cast("long")


def local_time(text: Column) -> Column:
    """The time on the sender's own clock and calendar, without zone, so that no session's zone moves it."""
    clock = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)", 1)
    return F.when(text.rlike(TIME_SHAPE), clock.try_cast("timestamp_ntz"))


def event_times(text: Column, name: str) -> dict[str, Column]:
    """<name>_at as an instant, <name>_local on the sender's clock, and the offset between them, of a time text."""
    return {f"{name}_at": instant(text), f"{name}_local": local_time(text), f"{name}_utc_offset_seconds": utc_offset_seconds(text)}


def utc(text: str) -> Column:
    """A given time, read as UTC."""
    return F.lit(text if text.endswith("Z") else f"{text}Z").cast("timestamp")


def without_zone(c: Column) -> Column:
    """An instant as the time in UTC, whatever the session's zone."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(c) / F.lit(1000000).cast("decimal(18,6)")).cast("decimal(18,6)"))


def elements(doc: Column) -> Column:
    """A VARIANT array as ARRAY<VARIANT>; null for anything else."""
    return F.try_variant_get(doc, "$", "array<variant>")


def length_of(doc: Column) -> Column:
    # elements are counted without a copy of each: read as truth values, they are mostly null
    return F.coalesce(F.size(read_as(doc, "array<boolean>")), F.lit(0)).cast("long")


def any_flag(doc: Column, path: str, wanted: bool) -> Column:
    """Whether any element has the boolean at path equal to wanted; false for no array."""
    return F.coalesce(F.exists(elements(doc), lambda p: F.coalesce(F.try_variant_get(p, f"$.{path}", "boolean") == wanted, F.lit(False))), F.lit(False))


def event_sk(event: Column, payload: Column) -> Column:
    """Identity of a delivery: its type and canonical document, not when it came."""
    return F.md5(F.concat(F.coalesce(event, F.lit("<null_event>")), F.lit("|"), F.coalesce(F.to_json(payload), F.lit("<null_payload>"))).cast("binary"))


def surrogate_key(*cols: Column | str) -> Column:
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *texts).cast("binary"))


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Second boundaries passed from a to b; null if either is."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.unix_seconds(b.cast("timestamp")) - F.unix_seconds(a.cast("timestamp"))


def minutes_between(a: Column | str, b: Column | str) -> Column:
    """Minute boundaries passed from a to b."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    minute = lambda x: F.floor(F.unix_seconds(x.cast("timestamp")) / 60)
    return (minute(b) - minute(a)).cast("long")


def hours(seconds: Column | str) -> Column:
    return (F.col(seconds) if isinstance(seconds, str) else seconds).cast("double") / 3600.0


def has_text(c: Column | str) -> Column:
    return F.coalesce(F.length(F.trim(F.col(c) if isinstance(c, str) else c)) > 0, F.lit(False))


def calendar(c: str, prefix: str, parts: tuple[str, ...]) -> dict[str, Column]:
    """Calendar columns <prefix>_<part> of a time without zone: give the local time for the sender's own days and hours."""
    made = {
        "date": F.to_date(c), "week": F.to_date(F.date_trunc("week", F.col(c))), "month": F.to_date(F.date_trunc("month", F.col(c))),
        "day_of_week": F.dayname(F.to_date(c)), "hour_of_day": F.hour(c).cast("long"),
    }
    return {f"{prefix}_{p}": made[p] for p in parts}


def email_key(c: Column | str) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def title(c: Column | str, separator: str) -> Column:
    return F.initcap(F.replace(F.col(c) if isinstance(c, str) else c, F.lit(separator), F.lit(" ")))


def on_or_after(c: str, unit: str, limit: Column) -> Column:
    """date_trunc(unit, c) >= limit, written so that the scan can skip row groups.

    The truncated time reaches the limit exactly when the time reaches the limit rounded up to a
    boundary of the unit; that is a comparison of the bare column, which is pushed down.
    """
    floor = F.date_trunc(unit, limit)
    step = F.expr({"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month", "hour": "interval 1 hour", "year": "interval 1 year"}[unit])
    return F.col(c) >= F.when(floor == limit, floor).otherwise(floor + step)

