"""Written dates and clock readings in many forms, to one form.

``parse_written(value, zone, month_first)`` is the single rule set; the operators
run it over batches of distinct values.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Month names of English, German, French and Spanish.
_MONTH_NAMES = {
    1: "january jan januar jänner janvier janv enero ene",
    2: "february feb februar février fevrier févr fevr febrero",
    3: "march mar märz maerz mars marzo mär",
    4: "april apr avril avr abril abr",
    5: "may mai mayo",
    6: "june jun juni juin junio",
    7: "july jul juli juillet juil julio",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre",
    10: "october oct oktober okt octobre octubre",
    11: "november nov novembre noviembre",
    12: "december dec dezember dez décembre decembre déc diciembre dic",
}
MONTHS = {name: n for n, names in _MONTH_NAMES.items() for name in names.split()}

# Offsets in minutes of zone abbreviations.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "JST": 540, "KST": 540, "SGT": 480, "HKT": 480, "AWST": 480,
    "AEST": 600, "AEDT": 660, "ACST": 570, "ACDT": 630, "NZST": 720, "NZDT": 780, "EST": -300, "EDT": -240, "CST": -360,
    "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "BRT": -180,
}

_CLOCK = r"(?P<H>\d{1,2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?:[.,]\d+)?)?(?:\s*(?P<ap>[AaPp])\.?[Mm]\.?)?"
_ZONE = r"(?:\s*(?P<zone>Z|z|[+\-−]\d{2}:?\d{2}|[+\-−]\d{2}|\[[A-Za-z_+\-/0-9]+\]|[A-Z]{1,5}(?:[+\-−]\d{2}:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+))?"
_WORD = r"[^\W\d_]+"

_INSTANTS = [
    re.compile(rf"(?P<y>\d{{4}})[-/](?P<m>\d{{1,2}})[-/](?P<d>\d{{1,2}})(?:[Tt]|\s+){_CLOCK}{_ZONE}"),
    re.compile(rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})[Tt ]?(?P<H>\d{{2}}):?(?P<M>\d{{2}}):?(?P<S>\d{{2}})(?:[.,]\d+)?(?P<ap>)(?P<zone>Z|z|[+\-]\d{{2}}:?\d{{2}})?"),
    re.compile(rf"(?P<a>\d{{1,2}})/(?P<b>\d{{1,2}})/(?P<y>\d{{4}}),?\s+{_CLOCK}{_ZONE}"),
    re.compile(rf"(?P<d>\d{{1,2}})\.(?P<m>\d{{1,2}})\.(?P<y>\d{{4}}),?\s+{_CLOCK}{_ZONE}"),
    re.compile(rf"(?:{_WORD}\.?,?\s+)?(?P<d>\d{{1,2}})\s+(?P<mon>{_WORD})\.?\s+(?P<y>\d{{4}}),?\s+{_CLOCK}{_ZONE}"),
    re.compile(rf"(?:{_WORD},\s+)?(?P<mon>{_WORD})\.?\s+(?P<d>\d{{1,2}}),?\s+(?P<y>\d{{4}}),?\s+{_CLOCK}{_ZONE}"),
]
_DAYS = [
    re.compile(r"(?P<y>\d{4})[-/.](?P<m>\d{1,2})[-/.](?P<d>\d{1,2})"),
    re.compile(r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})"),
    re.compile(r"(?P<a>\d{1,2})/(?P<b>\d{1,2})/(?P<y>\d{4})"),
    re.compile(r"(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?P<y>\d{4})"),
    re.compile(rf"(?P<d>\d{{1,2}})(?:st|nd|rd|th|er|\.|º)?(?:\s+|-)(?:de\s+)?(?P<mon>{_WORD})\.?(?:\s+|-|,\s*)(?:de\s+)?(?P<y>\d{{4}})"),
    re.compile(rf"(?P<mon>{_WORD})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})"),
    re.compile(rf"(?P<y>\d{{4}})[\s-]+(?P<mon>{_WORD})\.?[\s-]+(?P<d>\d{{1,2}})"),
]
_ORDINAL = re.compile(r"(\d{4})-(\d{3})")
_WEEK = re.compile(r"(\d{4})-?W(\d{2})-?(\d)", re.I)
_MONTH_FORMS = [
    re.compile(r"(?P<y>\d{4})[-/.](?P<m>\d{1,2})"),
    re.compile(r"(?P<m>\d{1,2})[-/.](?P<y>\d{4})"),
    re.compile(rf"(?P<mon>{_WORD})\.?(?:\s+|-|,\s*|\s+de\s+)(?P<y>\d{{4}})"),
    re.compile(rf"(?P<y>\d{{4}})(?:\s+|-)(?P<mon>{_WORD})\.?"),
]
_YEAR = re.compile(r"(?:c|ca\.?|©)?\s*(\d{4})\.?")
_LEAD = re.compile(r"^(?:first\s+)?(?:published|publié|veröffentlicht|publicado|available|accepted|received|posted|submitted)(?:\s+(?:online|on|am|le|en\s+línea|el))*:?\s+", re.I)
_INVISIBLE = re.compile("[​‌‍⁠﻿]")
#: Years outside this span name no publication or clock reading.
FIRST_YEAR, LAST_YEAR = 1000, 2999
#: Epoch counts are read as seconds, milliseconds, microseconds or nanoseconds by their length.
_EPOCH = {10: 1, 13: 1_000, 16: 1_000_000, 19: 1_000_000_000}


@lru_cache(maxsize=512)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:
        return None


def _year_ok(y: int) -> bool:
    return FIRST_YEAR <= y <= LAST_YEAR


def _month(g: dict) -> int | None:
    return MONTHS.get(g["mon"].lower()) if g.get("mon") else int(g["m"])


def _ymd(g: dict, month_first: bool) -> date | None:
    if g.get("a"):
        m, d = (int(g["a"]), int(g["b"])) if month_first else (int(g["b"]), int(g["a"]))
    else:
        m, d = _month(g), int(g["d"])
    y = int(g["y"])
    if m is None or not _year_ok(y):
        return None
    try:
        return date(y, m, d)
    except ValueError:
        return None


def _offset(text: str | None, local: datetime, home: str | None) -> timedelta | None:
    """The UTC offset of a clock reading; None where its zone cannot be known."""
    if text:
        t = text.strip("[]").replace("−", "-")
        m = re.fullmatch(r"([A-Za-z]*)([+-])(\d{2}):?(\d{2})?", t)
        if m and (not m[1] or m[1].upper() in ABBREVIATIONS):
            minutes = int(m[3]) * 60 + int(m[4] or 0)
            return timedelta(minutes=-minutes if m[2] == "-" else minutes) if minutes <= 14 * 60 else None
        if t.upper() in ABBREVIATIONS:
            return timedelta(minutes=ABBREVIATIONS[t.upper()])
        home = t
    zone = _zone(home) if home else None
    return local.replace(tzinfo=zone).utcoffset() if zone else None


def clock_reading(value: str, month_first: bool = False) -> datetime | None:
    """The local reading of a value that states no zone, else None (for zone estimation)."""
    s = _bare(value)
    if s is None:
        return None
    for p in _INSTANTS:
        if m := p.fullmatch(s):
            g = m.groupdict()
            if g.get("zone"):
                return None
            day = _ymd(g, month_first)
            return _at(day, g) if day else None
    return None


def _bare(value) -> str | None:
    """The written time itself, without invisible characters, brackets and lead-in words."""
    s = _INVISIBLE.sub("", str(value)).strip()
    if not s or len(s) > 80:
        return None
    if s[0] in "([" and s[-1] in ")]":
        s = s[1:-1].strip()
    return _LEAD.sub("", s).strip()


def _at(day: date, g: dict) -> datetime | None:
    h, mi, s = int(g["H"]), int(g["M"]), int(g["S"] or 0)
    if g.get("ap"):
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if g["ap"].lower() == "p" else 0)
    if h > 23 or mi > 59 or s > 59:
        return None
    return datetime(day.year, day.month, day.day, h, mi, s)


def parse_written(value, zone: str | None, month_first: bool) -> tuple[str, str] | None:
    """``(grain, norm)`` of a written date, or None where it names no possible one.

    ``zone`` is the IANA zone of clock readings that state none, ``month_first``
    the reading of all-numeric dates with slashes. A reading in a fold takes the
    earlier offset, one in a gap the offset before the change.
    """
    if value is None:
        return None
    s = _bare(value)
    if s is None:
        return None
    digits = s.lstrip("-")
    if digits.isascii() and digits.isdigit() and len(digits) in _EPOCH and len(s) - len(digits) <= 1:
        try:
            t = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=int(s) // _EPOCH[len(digits)])
        except OverflowError:
            return None
        return "instant", t.strftime("%Y-%m-%dT%H:%M:%SZ")
    for p in _INSTANTS:
        if m := p.fullmatch(s):
            g = m.groupdict()
            day = _ymd(g, month_first)
            local = _at(day, g) if day else None
            if local is None:
                return None
            off = _offset(g.get("zone"), local, zone)
            if off is None:
                return None
            return "instant", (local - off).strftime("%Y-%m-%dT%H:%M:%SZ")
    if m := _ORDINAL.fullmatch(s):
        y, n = int(m[1]), int(m[2])
        if not _year_ok(y) or not 1 <= n <= (date(y, 12, 31) - date(y, 1, 1)).days + 1:
            return None
        return "day", (date(y, 1, 1) + timedelta(days=n - 1)).isoformat()
    if m := _WEEK.fullmatch(s):
        try:
            return "day", date.fromisocalendar(int(m[1]), int(m[2]), int(m[3])).isoformat()
        except ValueError:
            return None
    for p in _DAYS:
        if m := p.fullmatch(s):
            day = _ymd(m.groupdict(), month_first)
            if day:
                return "day", day.isoformat()
            return None
    for p in _MONTH_FORMS:
        if m := p.fullmatch(s):
            g = m.groupdict()
            mo, y = _month(g), int(g["y"])
            if mo is not None and 1 <= mo <= 12 and _year_ok(y):
                return "month", f"{y:04d}-{mo:02d}"
            return None
    if (m := _YEAR.fullmatch(s)) and _year_ok(int(m[1])):
        return "year", f"{int(m[1]):04d}"
    return None
