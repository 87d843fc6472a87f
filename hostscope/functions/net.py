"""Column functions on addresses, times and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_SEGMENT = "SEG_UNKNOWN"
_IPV4 = r"^(\d+)\.(\d+)\.(\d+)\.(\d+)$"


def segment_id(ip: Column, prefix: int = 24) -> Column:
    """The /16 or (any other length) /24 segment of an IPv4 address; leading zeros go; SEG_UNKNOWN where it does not parse."""
    octet = lambda i: F.regexp_extract(ip, _IPV4, i).cast("decimal(38,0)").cast("string")
    net = F.concat(octet(1), F.lit("."), octet(2), F.lit(".0.0/16")) if prefix == 16 else F.concat(octet(1), F.lit("."), octet(2), F.lit("."), octet(3), F.lit(".0/24"))
    return F.when(ip.rlike(_IPV4), net).otherwise(F.lit(UNKNOWN_SEGMENT))


def is_ipv4(ip: Column) -> Column:
    """Whether an address is four octets of 0 to 255."""
    octet = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return F.coalesce(ip.rlike(rf"^{octet}(\.{octet}){{3}}$"), F.lit(False))


def time_context(ts: Column, zone: str = "UTC", work: tuple[int, int] = (7, 17), off: tuple[int, int] = (17, 22), weekend: tuple[int, ...] = (6, 7)) -> list[Column]:
    """Local hour and weekday with working, off and night hours and weekend flags (1 = Sunday; Friday and Saturday by default)."""
    local = F.from_utc_timestamp(ts, zone)
    hour, day = F.hour(local), F.dayofweek(local)
    is_work, is_off = (hour >= work[0]) & (hour < work[1]), (hour >= off[0]) & (hour < off[1])
    return [
        hour.alias("hour_of_day"), F.date_format(local, "E").alias("day_name"), is_work.cast("int").alias("is_working_hours"),
        is_off.cast("int").alias("is_off_hours"), (~is_work & ~is_off).cast("int").alias("is_night_hours"), day.isin(*weekend).cast("int").alias("is_weekend"),
    ]


def time_band(ts: Column, zone: str = "UTC", existing: Column | None = None, working: Column | None = None, hour: Column | None = None) -> Column:
    """The band of a row: its own, else by its working-hours flag, else by its hour, else by its time."""
    by_hour = lambda h: F.when((h >= 7) & (h < 17), "work").when((h >= 17) & (h < 22), "off").when(h.isNotNull(), "night")
    options = [existing] if existing is not None else []
    if working is not None:
        options.append(F.when(working == 1, "work"))
    if hour is not None:
        options.append(by_hour(hour))
    return F.coalesce(*options, by_hour(F.hour(F.from_utc_timestamp(ts, zone))))


def window_floor(ts: Column, minutes: Column) -> Column:
    """The latest minute of a set at or before a time, in the hour before where there is none in its hour."""
    at = F.array_max(F.filter(minutes, lambda m: m <= F.minute(ts)))
    hour = F.date_trunc("hour", ts)
    return F.when(at.isNotNull(), F.timestamp_add("MINUTE", at, hour)).otherwise(F.timestamp_add("MINUTE", F.array_max(minutes), F.timestamp_add("HOUR", F.lit(-1), hour)))


def quarter(ts: Column) -> Column:
    """The quarter of the hour, 1 to 4."""
    return (F.floor(F.minute(ts) / 15) + 1).cast("int")


def record_id(*columns: Column | str) -> Column:
    """Columns joined by |; nulls are skipped."""
    return F.concat_ws("|", *columns)


def prediction_id(*columns: Column | str) -> Column:
    """SHA-256 of the columns as text joined by |; a null is written as an empty field."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")) for c in columns]), 256)


def extract_prediction(raw: Column, paths: tuple[str, ...] = ("$.score", "$.prediction", "$.predictions[0]", "$[0]", "$")) -> Column:
    """The first number at any of these places of a JSON model output; a score of 0 counts."""
    return F.coalesce(*[F.get_json_object(raw, p).try_cast("double") for p in paths], raw.try_cast("double"))


def as_text(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
