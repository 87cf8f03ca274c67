"""Time range texts to two literal bounds.

``now`` is always given by the caller, so one request means one range.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from dateutil.parser import parse as parse_date
from dateutil.relativedelta import relativedelta

NO_FILTER = "No filter"
_UNITS = "second|minute|hour|day|week|month|quarter|year"


class TimeRangeError(ValueError):
    """The text does not describe a range."""


def step(amount: int, unit: str) -> relativedelta:
    unit = unit.lower().rstrip("s")
    if unit == "quarter":
        return relativedelta(months=3 * amount)
    if unit not in _UNITS.split("|"):
        raise TimeRangeError(f"unknown unit {unit}")
    return relativedelta(**{unit + "s": amount})


def midnight(at: datetime) -> datetime:
    return at.replace(hour=0, minute=0, second=0, microsecond=0)


def truncate(at: datetime, unit: str) -> datetime:
    unit = unit.lower()
    if unit == "second":
        return at.replace(microsecond=0)
    if unit == "minute":
        return at.replace(second=0, microsecond=0)
    if unit == "hour":
        return at.replace(minute=0, second=0, microsecond=0)
    day = midnight(at)
    if unit == "day":
        return day
    if unit == "week":
        return day - timedelta(days=day.weekday())
    if unit == "month":
        return day.replace(day=1)
    if unit == "quarter":
        return day.replace(month=3 * ((day.month - 1) // 3) + 1, day=1)
    if unit == "year":
        return day.replace(month=1, day=1)
    raise TimeRangeError(f"unknown unit {unit}")


def last_day(at: datetime, unit: str) -> datetime:
    unit = unit.lower()
    if unit == "week":
        return truncate(at, "week") + timedelta(days=6)
    if unit in ("month", "quarter", "year"):
        return truncate(at, unit) + step(1, unit) - timedelta(days=1)
    raise TimeRangeError(f"no last day of {unit}")


def delta_text(text: str) -> tuple[int, str]:
    """``28 days ago`` to (-28, day); ``1 year later`` to (1, year)."""
    found = re.fullmatch(rf"\s*(\d+)?\s*({_UNITS})s?(?:\s+(ago|later|from now))?\s*", text, re.IGNORECASE)
    if not found:
        raise TimeRangeError(f"not a time shift: {text}")
    amount = int(found[1] or 1)
    ahead = (found[3] or "ago").lower() != "ago"
    return (amount if ahead else -amount), found[2].lower()


def moment(text: str, now: datetime) -> datetime:
    """One point in time: a word, a shift from today, or a date."""
    word = text.strip().strip("'\"").lower()
    today = midnight(now)
    if word in ("now", ""):
        return now
    if word == "today":
        return today
    if word == "yesterday":
        return today - timedelta(days=1)
    if word == "tomorrow":
        return today + timedelta(days=1)
    try:
        amount, unit = delta_text(word)
        return today + step(amount, unit)
    except TimeRangeError:
        pass
    try:
        return parse_date(word, default=today)
    except (ValueError, OverflowError) as error:
        raise TimeRangeError(f"cannot read the date {text!r}") from error


def _arguments(body: str) -> list[str]:
    """Split at the commas that are outside brackets."""
    parts, depth, current = [], 0, ""
    for ch in body:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    return [*parts, current.strip()]


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> datetime:
    first = datetime(year, month, 1)
    day = first + timedelta(days=(weekday - first.weekday()) % 7)
    return day + timedelta(weeks=n - 1)


def holiday(name: str, year: int) -> datetime:
    """US federal holidays by rule (case-insensitive, part of the name is enough)."""
    memorial = last_day(datetime(year, 5, 1), "month")
    days = {
        "new year's day": datetime(year, 1, 1),
        "martin luther king jr. day": _nth_weekday(year, 1, 0, 3),
        "washington's birthday": _nth_weekday(year, 2, 0, 3),
        "memorial day": memorial - timedelta(days=memorial.weekday()),
        "juneteenth national independence day": datetime(year, 6, 19),
        "independence day": datetime(year, 7, 4),
        "labor day": _nth_weekday(year, 9, 0, 1),
        "columbus day": _nth_weekday(year, 10, 0, 2),
        "veterans day": datetime(year, 11, 11),
        "thanksgiving": _nth_weekday(year, 11, 3, 4),
        "christmas day": datetime(year, 12, 25),
    }
    wanted = name.strip().strip("'\"").lower()
    for known, day in days.items():
        if known.startswith(wanted) or wanted == known:
            return day
    matches = [day for known, day in days.items() if wanted in known]
    if not matches:
        raise TimeRangeError(f"unknown holiday {name}")
    return matches[0]


def evaluate(text: str, now: datetime) -> datetime:
    """A point given by nested DATETIME / DATEADD / DATETRUNC / LASTDAY / HOLIDAY calls."""
    call = re.fullmatch(r"\s*(DATETIME|DATEADD|DATETRUNC|LASTDAY|HOLIDAY)\s*\((.*)\)\s*", text, re.I | re.S)
    if not call:
        return moment(text, now)
    name, args = call[1].upper(), _arguments(call[2])
    if name == "DATETIME":
        return moment(args[0], now)
    if name == "DATEADD":
        return evaluate(args[0], now) + step(int(args[1]), args[2])
    if name == "DATETRUNC":
        return truncate(evaluate(args[0], now), args[1])
    if name == "LASTDAY":
        return midnight(last_day(evaluate(args[0], now), args[1]))
    year = evaluate(args[1], now).year if len(args) > 1 else now.year
    return holiday(args[0], year)


def resolve(
    text: str | None,
    now: datetime,
    time_shift: str | None = None,
    relative_start: str = "today",
    relative_end: str = "today",
) -> tuple[datetime | None, datetime | None]:
    """Bounds of a half-open range; either may be None."""
    if text and text.strip().lower() == NO_FILTER.lower():
        return None, None
    start, end = moment(relative_start, now), moment(relative_end, now)
    since: datetime | None
    until: datetime | None
    if not text:
        since, until = None, end
    elif " : " not in text and text.lower().startswith("previous calendar"):
        unit = text.split()[-1]
        until = truncate(end, unit)
        since = until - step(1, unit)
    else:
        if " : " in text:
            left, right = (p.strip() for p in text.split(" : ", 1))
        elif text.lower().startswith("next"):
            left, right = relative_start, text
        elif text.lower().startswith("last"):
            left, right = text, relative_end
        else:
            left, right = text, relative_end

        def side(part: str) -> datetime | None:
            if not part:
                return None
            found = re.fullmatch(rf"(last|next)\s+(?:(\d+)\s+)?({_UNITS})s?", part, re.IGNORECASE)
            if found:
                amount = int(found[2] or 1)
                if found[1].lower() == "last":
                    return start - step(amount, found[3])
                return end + step(amount, found[3])
            return evaluate(part, now)

        since, until = side(left), side(right)
    if time_shift:
        amount, unit = delta_text(time_shift)
        move = step(-abs(amount), unit)
        since = since + move if since else None
        until = until + move if until else None
    if since and until and since > until:
        raise TimeRangeError("the range ends before it starts")
    return since, until
