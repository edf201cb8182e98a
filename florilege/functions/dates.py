"""Exhaustive reader of dates and times as typed in several languages, precisions and zones."""

from __future__ import annotations

import re
import unicodedata
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Month names by language (English, German, French, Spanish), without accents and in lower case.
MONTHS = (
    "january januar janvier enero",
    "february februar fevrier febrero",
    "march marz maerz mars marzo",
    "april avril abril",
    "may mai mayo",
    "june juni juin junio",
    "july juli juillet julio",
    "august aout agosto",
    "september septembre septiembre setiembre",
    "october oktober octobre octubre",
    "november novembre noviembre",
    "december dezember decembre diciembre",
)
# Abbreviations that aren't the first three or four letters of a name above.
SHORT = {"mrz": 3, "juil": 7, "sept": 9, "fevr": 2, "janv": 1, "feber": 2, "janner": 1}
# Zone abbreviations and their offsets in minutes.
ZONES = {
    "utc": 0, "gmt": 0, "z": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120,
    "eet": 120, "eest": 180, "msk": 180, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420,
    "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600, "jst": 540, "aest": 600,
    "aedt": 660, "acst": 570, "acdt": 630, "awst": 480, "nzst": 720, "nzdt": 780,
}

_names = {n: i for i, row in enumerate(MONTHS, 1) for n in row.split()}


def _month_table() -> dict[str, int]:
    found: dict[str, set[int]] = {}
    for name, number in _names.items():
        for size in range(3, len(name) + 1):
            found.setdefault(name[:size], set()).add(number)
    # a beginning that fits several months counts only where it is a whole name
    clear = {k: next(iter(v)) for k, v in found.items() if len(v) == 1}
    return clear | {k: v for k, v in SHORT.items()} | _names


_MONTH = _month_table()
_DAY = r"(?P<d>\d{1,2})(?:st|nd|rd|th|er|\.|º|ª)?"
_MON = r"(?P<mon>[^\W\d_]{3,})\.?"
_WEEKDAY = r"(?:[^\W\d_]{2,}\.?,?\s+)?"
_AMPM = r"[ap]\.?\s?m\.?"
_TIME = rf"(?P<H>\d{{1,2}})(?:[:h.](?P<M>\d{{2}})(?::(?P<S>\d{{2}})(?:[.,]\d+)?)?\s*(?P<ap>{_AMPM})?|\s?(?P<ap2>{_AMPM}))(?:\s*(?:uhr|hrs?|hours)\b)?"
_ZONE = r"(?:\s*\(?\s*(?:(?P<iana>[a-z]+(?:/[a-z_]+){1,2})|(?P<z>[a-z]{1,5}(?![a-z]))?\s*(?P<off>[+-]\d{1,2}:?(?:\d{2})?)?)\s*\)?)"
_CLOCK = rf"(?:(?:\s*,|\s+at|\s+um|\s+a las|\s+à|t)?\s*{_TIME}{_ZONE})?"
_FORMS = [
    re.compile(p, re.IGNORECASE)
    for p in (
        rf"(?P<y>\d{{4}})(?P<sep>[-/.])(?P<m>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}}){_CLOCK}",
        rf"{_WEEKDAY}(?:(?:on|am|le|el|the|den|vom)\s+)?{_DAY}[\s-]+(?:(?:de|of)\s+)?{_MON}[\s,-]+(?:(?:de|del|of)\s+)?(?P<y>\d{{4}}){_CLOCK}",
        rf"{_WEEKDAY}(?:on\s+)?{_MON}\s+{_DAY}\s*,?\s+(?P<y>\d{{4}}){_CLOCK}",
        rf"{_TIME}{_ZONE}\s*,?\s+{_DAY}\s+{_MON}\s+(?P<y>\d{{4}})(?:\s*\(?(?P<z2>[a-z]{{1,5}})?(?P<off2>[+-]\d{{1,2}}:?(?:\d{{2}})?)?\)?)",
        rf"(?P<a>\d{{1,2}})(?P<sep>[-/.])(?P<b>\d{{1,2}})(?P=sep)(?P<y>\d{{4}}){_CLOCK}",
        rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}}) (?P<H>\d{{2}})(?P<M>\d{{2}})(?P<S>\d{{2}})?(?:[.,]\d+)?{_ZONE}",
    )
]
_LEAD = r"(?:(?:in|en|im|from|the|year|anno|since|the year)\s+)?"
_CIRCA = r"(?:(?:circa|ca?\.?|about|approx\.?|approximately|around|um|vers|hacia|environ)\s*)"
_YM = re.compile(r"(?P<y>\d{4})[-/](?P<m>\d{1,2})")
_MY = re.compile(r"(?P<m>\d{1,2})[/.-](?P<y>\d{4})")
_MONY = re.compile(rf"(?:(?:in|en|im)\s+)?{_MON}\s*,?\s+(?:(?:de|del|of)\s+)?(?P<y>\d{{4}})", re.IGNORECASE)
_YEAR = re.compile(rf"{_LEAD}{_CIRCA}?(?P<y>\d{{4}})", re.IGNORECASE)
_DECADE = re.compile(r"(?:(?:the|in the|in|die|les|los|annees)\s+)?(?P<y>\d{3}0)\s*['’´`]?\s*(?:s|er)", re.IGNORECASE)
_SPAN = re.compile(r"(?:(?:from|between|de|von|entre)\s+)?(?P<y>\d{4})\s*(?:-|–|—|/|to|until|and|bis|a|à|et|y|und)\s*(?P<y2>\d{4}|\d{2})", re.IGNORECASE)
_BCE = re.compile(rf"{_LEAD}{_CIRCA}?(?P<y>\d{{1,4}})\s*(?:b\.?\s?c\.?(?:\s?e\.?)?|v\.\s?chr\.?|av\.\s?j\.?-?c\.?|a\.\s?c\.?)", re.IGNORECASE)
_AD = re.compile(r"(?:a\.?d\.?\s*(?P<y>\d{1,4})|(?P<y2>\d{1,4})\s*(?:a\.?d\.?|c\.?e\.?))", re.IGNORECASE)
_ISO_BCE = re.compile(r"-(?P<y>\d{4})")
_SPACE = re.compile(r"\s+")
_ISO_T = re.compile(r"(?<=\d)T(?=\d)")


def month_number(word: str) -> int | None:
    w = "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not unicodedata.combining(c)).rstrip(".")
    return _MONTH.get(w)


@lru_cache(maxsize=1024)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError, OSError):
        return None


def _instant(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ") if moment.year > 999 else f"{moment.year:04d}" + moment.strftime("-%m-%dT%H:%M:%SZ")


def local_to_utc(moment: datetime, zone: str | None) -> str | None:
    """UTC instant of a wall-clock time: the first of two, none for one that the clocks skip; UTC without a zone."""
    if zone is None or not zone.strip():
        return _instant(moment)
    z = _zone(zone.strip())
    if z is None:
        return None
    utc = moment.replace(tzinfo=z, fold=0).astimezone(timezone.utc)
    if utc.astimezone(z).replace(tzinfo=None) != moment:
        return None
    return _instant(utc.replace(tzinfo=None))


def _offset(text: str | None) -> int | None:
    if not text:
        return None
    digits = text[1:].replace(":", "")
    hours, minutes = (int(digits[:-2]), int(digits[-2:])) if len(digits) > 2 else (int(digits), 0)
    if hours > 18 or minutes > 59:
        return None
    return (-1 if text[0] == "-" else 1) * (60 * hours + minutes)


def _with_clock(day: date, g: dict[str, str | None], zone: str | None) -> str | None:
    hour, minute, second = int(g["H"]), int(g["M"] or 0), int(g["S"] or 0)
    if ap := g.get("ap") or g.get("ap2"):
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if ap[0] in "pP" else 0)
    carry = timedelta(0)
    if hour == 24 and minute == second == 0:
        hour, carry = 0, timedelta(days=1)
    if second == 60:  # a leap second counts as the first second after it
        second, carry = 59, carry + timedelta(seconds=1)
    if hour > 23 or minute > 59 or second > 59:
        return None
    try:
        moment = datetime(day.year, day.month, day.day, hour, minute, second) + carry
        name, off = g.get("z") or g.get("z2"), g.get("off") or g.get("off2")
        minutes = _offset(off)
        if off and minutes is None:
            return None
        if name:
            known = ZONES.get(name.lower())
            if known is None:
                return None
            minutes = known + (minutes or 0)
        if minutes is not None:
            return _instant(moment - timedelta(minutes=minutes))
        return local_to_utc(moment, g.get("iana") or zone)
    except OverflowError:
        return None


def _epoch(seconds: int) -> str:
    return _instant(datetime(1970, 1, 1) + timedelta(seconds=seconds))


def _digits(t: str) -> str | None:
    if len(t) == 8:
        return _day(int(t[:4]), int(t[4:6]), int(t[6:]))
    if len(t) == 14:
        try:
            return _instant(datetime(*(int(t[a:b]) for a, b in ((0, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 14)))))
        except ValueError:
            return None
    if len(t) == 10:
        return _epoch(int(t))
    if len(t) == 13:
        return _epoch(int(t) // 1000)
    return _year(int(t)) if len(t) in (3, 4) else None


def _year(y: int) -> str | None:
    return f"{y:04d}" if y > 0 else None


def _month(y: int, m: int) -> str | None:
    return f"{y:04d}-{m:02d}" if 1 <= m <= 12 and y > 0 else None


def _day(y: int, m: int, d: int) -> str | None:
    try:
        return date(y, m, d).isoformat()
    except ValueError:
        return None


def normal_date(text: str | None, month_first: bool = False, zone: str | None = None) -> str | None:
    """The one form of a date text, or None where it names no real date.

    A clock time gives the UTC instant ``YYYY-MM-DDTHH:MM:SSZ``; anything else ``YYYY-MM-DD``, ``YYYY-MM``, ``YYYY``
    or ``-YYYY``. ``month_first`` tells how all-numeric dates are meant, ``zone`` (IANA name) where a wall-clock time
    without zone or offset was; a name that isn't known gives None for such times.
    """
    if text is None:
        return None
    t = _SPACE.sub(" ", text.replace("−", "-").replace("‐", "-").replace("‑", "-")).strip().strip(";")
    t = "".join(c for c in t if unicodedata.category(c) != "Cf").strip()
    while len(t) > 2 and (t[0], t[-1]) in (("(", ")"), ("[", "]")) and not any(c in t[1:-1] for c in "()[]"):
        t = t[1:-1].strip()
    t = t.rstrip(",").strip()
    if not t:
        return None
    if t.isascii() and t.isdigit():
        return _digits(t)
    if t.endswith(".") and t[:-1].isascii() and t[:-1].isdigit():
        return _digits(t[:-1])
    t = _ISO_T.sub(" ", t)
    for k, form in enumerate(_FORMS):
        if not (m := form.fullmatch(t)):
            continue
        g = m.groupdict()
        y = int(g["y"])
        if k == 4:
            a, b = int(g["a"]), int(g["b"])
            month, dom = (a, b) if month_first else (b, a)
        else:
            month, dom = (int(g["m"]) if g.get("m") else month_number(g["mon"])), int(g["d"])
        if month is None:
            return None
        day = _day(y, month, dom)
        if day is None:
            return None
        return _with_clock(date(y, month, dom), g, zone) if g.get("H") else day
    t = t.rstrip(".") if not re.search(r"[A-Za-z]\.$", t) else t
    if m := _YM.fullmatch(t):
        return _month(int(m["y"]), int(m["m"]))
    if m := _MY.fullmatch(t):
        return _month(int(m["y"]), int(m["m"]))
    if m := _YEAR.fullmatch(t) or _DECADE.fullmatch(t):
        return _year(int(m["y"]))
    if m := _MONY.fullmatch(t):
        number = month_number(m["mon"])
        return _month(int(m["y"]), number) if number else None
    if m := _SPAN.fullmatch(t):
        first, last = int(m["y"]), int(m["y2"])
        if len(m["y2"]) == 2:
            last += first // 100 * 100
        return _year(first) if first <= last else None
    if m := _BCE.fullmatch(t) or _ISO_BCE.fullmatch(t):
        return f"-{int(m['y']):04d}" if int(m["y"]) else None
    if m := _AD.fullmatch(t):
        return _year(int(m["y"] or m["y2"]))
    return None
