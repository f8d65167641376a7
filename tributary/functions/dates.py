"""ISO-8601 texts to local wall time, UTC wall time and month keys.

All results are zone-less and do not depend on the session time zone.
"""

from __future__ import annotations

from . import bound, literal

# The shape of nearly every document: seconds, optional whole-minute offset.
_USUAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:Z|[+-]\d{2}:\d{2})?$"
# Any other accepted shape: basic or extended, partial date or time, fractions.
_GENERAL = (
    r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?|(\d{2})(\d{2}))?"
    r"(?:[^0-9](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(Z|z|[+-]\d{2}(?::?\d{2})?)?)?$"
)


def _canonical(text: str) -> str:
    """``YYYY-MM-DDTHH:MM:SS.fff`` plus ``Z``, ``+HH:MM`` or nothing; NULL for other shapes."""

    def part(n: int) -> str:
        return f"regexp_extract({text}, {literal(_GENERAL)}, {n})"

    def filled(default: str, *parts: int) -> str:
        return f"coalesce({', '.join(f'''nullif({part(n)}, '')''' for n in parts)}, '{default}')"

    zone = f"replace(upper({part(10)}), ':', '')"
    general = (
        f"concat({part(1)}, '-', {filled('01', 2, 4)}, '-', {filled('01', 3, 5)}, 'T', "
        f"{filled('00', 6)}, ':', {filled('00', 7)}, ':', {filled('00', 8)}, '.', "
        f"rpad(substring({part(9)}, 1, 3), 3, '0'), "
        f"if({zone} in ('', 'Z'), {zone}, "
        f"concat(substring({zone}, 1, 3), ':', rpad(substring({zone}, 4, 2), 2, '0'))))"
    )
    return (
        f"case when {text} rlike {literal(_USUAL)} "
        f"then concat(substring({text}, 1, 19), '.000', substring({text}, 20, 6)) "
        f"when {text} rlike {literal(_GENERAL)} then {general} end"
    )


def _local_and_offset(canonical: str) -> str:
    stamp, zone = f"substring({canonical}, 1, 23)", f"substring({canonical}, 24, 6)"
    local = (
        f"case when substring({stamp}, 1, 4) = '0000' then null "
        f"when substring({stamp}, 12, 12) = '24:00:00.000' "
        f"then timestampadd(DAY, 1, try_cast(substring({stamp}, 1, 10) as timestamp_ntz)) "
        f"else try_cast({stamp} as timestamp_ntz) end"
    )
    hours = f"try_cast(substring({zone}, 2, 2) as int)"
    minutes = f"try_cast(substring({zone}, 5, 2) as int)"
    offset = (
        f"case when {zone} in ('', 'Z') then 0 when {hours} <= 23 and {minutes} <= 59 "
        f"then if(startswith({zone}, '-'), -1, 1) * ({hours} * 60 + {minutes}) end"
    )
    return f"named_struct('local', {local}, 'offset', {offset})"


def iso_instant(text: str) -> str:
    """Struct ``(local, utc)`` of zone-less timestamps cut to milliseconds; NULL when unreadable.

    ``local`` is the wall time as written, which decides year and month. ``utc`` is the same
    instant in UTC when an offset is given, else equal to ``local``.
    """

    def shifted(pair: str) -> str:
        return (
            f"if({pair}.local is null or {pair}.offset is null, null, named_struct("
            f"'local', {pair}.local, 'utc', timestampadd(MINUTE, -{pair}.offset, {pair}.local)))"
        )

    canonical = bound(text, _canonical, "iso")
    return bound(bound(canonical, _local_and_offset, "canonical"), shifted, "pair")


def iso_date(text: str) -> str:
    """Calendar date of an ISO text, NULL when unreadable."""
    plain = literal(r"^(?!0000)\d{4}-\d{2}-\d{2}$")
    return (
        f"case when {text} rlike {plain} then try_cast({text} as date) "
        f"when {text} is not null then cast({iso_instant(text)}.local as date) end"
    )


def month_key(local: str) -> str:
    """Month as ``YYYYMM`` text."""
    return f"lpad(cast(year({local}) * 100 + month({local}) as string), 6, '0')"


def utc_wall_time(instant: str) -> str:
    """Zone-less UTC wall time, in milliseconds, of a zoned timestamp."""
    epoch = "timestamp_ntz'1970-01-01 00:00:00'"
    return f"timestampadd(MILLISECOND, unix_millis({instant}), {epoch})"
