"""Epoch text, date text and their patterns, always at GMT+8 and whatever the session zone."""

from __future__ import annotations

import re
from datetime import timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabloom.functions.expr import Expr, Operand, Scope

ZONE = "GMT+08:00"
_OFFSET = " +08:00"
_OFFSET_MS = 8 * 3600 * 1000
_QUOTED = re.compile(r"'[^']*'")


def _has_zone_field(pattern: str) -> bool:
    return bool(re.search("[VzOXxZ]", _QUOTED.sub("", pattern)))


def _fixed_offset(zone: str) -> timedelta | None:
    """Offset of a zone without daylight saving; None for region names."""
    if zone in ("UTC", "GMT", "Z", "Etc/UTC", "Etc/GMT"):
        return timedelta(0)
    m = re.fullmatch(r"(?:GMT|UTC)?([+-])(\d{1,2})(?::?(\d{2}))?", zone)
    if not m:
        return None
    delta = timedelta(hours=int(m[2]), minutes=int(m[3] or 0))
    return timezone(delta if m[1] == "+" else -delta).utcoffset(None)


def _session_shift(scope: Scope, pattern: str) -> int | None:
    """Milliseconds from session time to GMT+8.

    None if that is not one number, or if the pattern shows the zone itself.
    """
    offset = _fixed_offset(scope.source.sparkSession.conf.get("spark.sql.session.timeZone"))
    if offset is None or _has_zone_field(pattern):
        return None
    return _OFFSET_MS - int(offset.total_seconds() * 1000)


def _format_millis(scope: Scope, millis: Column, pattern: str) -> Column:
    """Text of an instant at GMT+8.

    ``date_format`` prints in the session zone. With a fixed session offset the instant is
    shifted by the difference; otherwise ``to_json`` formats, as it takes a zone of its own.
    """
    shift = _session_shift(scope, pattern)
    if shift is not None:
        return F.date_format(F.timestamp_millis(millis + F.lit(shift)), pattern)
    options = {"timestampFormat": pattern, "timeZone": ZONE}
    as_json = F.to_json(F.struct(F.timestamp_millis(millis).alias("v")), options)
    return F.get_json_object(as_json, "$.v")


def _parse_millis(scope: Scope, text: Column, pattern: str) -> Column:
    """Epoch milliseconds of date text read at GMT+8; null when it does not match."""
    if _has_zone_field(pattern):
        return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern)))
    shift = _session_shift(scope, pattern)
    if shift is not None:
        return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern))) - F.lit(shift)
    instant = F.try_to_timestamp(F.concat(text, F.lit(_OFFSET)), F.lit(pattern + " XXX"))
    return F.unix_millis(instant)


def _or_fail(result: Column, text: Column, on_error: str, what: str) -> Column:
    if on_error == "null":
        return result
    if on_error != "raise":
        raise ValueError(f"on_error is 'raise' or 'null', got {on_error!r}")
    failure = F.raise_error(F.concat(F.lit(f"not {what}: "), text)).cast("bigint")
    return F.when(text.isNotNull(), F.coalesce(result, failure))


def strftime(x: Operand, pattern: str, on_error: str = "raise") -> Expr:
    """Epoch text to date text. Exactly 10 characters are seconds, any other length milliseconds."""

    def build(scope: Scope) -> Column:
        text = scope.text(x, "strftime", several_times=True)
        number = F.when(text.rlike(r"\A[+-]?\d+\z"), text.try_cast("bigint"))
        number = scope.bound(_or_fail(number, text, on_error, "an epoch"))
        millis = F.when(F.length(text) == 10, number * F.lit(1000)).otherwise(number)
        return _format_millis(scope, millis, pattern)

    return Expr(build)


def strptime(x: Operand, pattern: str, on_error: str = "raise") -> Expr:
    """Date text to epoch milliseconds, as text."""

    def build(scope: Scope) -> Column:
        text = scope.text(x, "strptime", several_times=True)
        return _or_fail(_parse_millis(scope, text, pattern), text, on_error, f"a date like {pattern}").cast("string")

    return Expr(build)


def reformat_date(x: Operand, from_pattern: str, to_pattern: str) -> Expr:
    """Date text from one pattern to another; text that does not match gives ``""``."""

    def build(scope: Scope) -> Column:
        text = scope.text(x, "reformat_date", several_times=True)
        changed = _format_millis(scope, _parse_millis(scope, text, from_pattern), to_pattern)
        return F.when(text.isNotNull(), F.coalesce(changed, F.lit("")))

    return Expr(build)
