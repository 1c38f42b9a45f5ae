"""Column expressions over cell text."""

from __future__ import annotations

import calendar
import datetime

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.constants import KEY_SEPARATOR, NULL_MARK, TRIM_CHARS

# Common file extensions and their registered media types.
MEDIA_TYPES = {
    "aac": "audio/aac",
    "avi": "video/x-msvideo",
    "bin": "application/octet-stream",
    "bmp": "image/bmp",
    "csv": "text/csv",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "epub": "application/epub+zip",
    "flac": "audio/flac",
    "gif": "image/gif",
    "gz": "application/gzip",
    "htm": "text/html",
    "html": "text/html",
    "jp2": "image/jp2",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "json": "application/json",
    "md": "text/markdown",
    "mov": "video/quicktime",
    "mp3": "audio/mpeg",
    "mp4": "video/mp4",
    "mpeg": "video/mpeg",
    "odt": "application/vnd.oasis.opendocument.text",
    "ogg": "audio/ogg",
    "pdf": "application/pdf",
    "png": "image/png",
    "ppt": "application/vnd.ms-powerpoint",
    "rtf": "application/rtf",
    "svg": "image/svg+xml",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "txt": "text/plain",
    "wav": "audio/wav",
    "webm": "video/webm",
    "webp": "image/webp",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xml": "application/xml",
    "zip": "application/zip",
}
UNKNOWN_MEDIA_TYPE = "application/octet-stream"

# English names, whatever the driver's locale.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
]


def date_letters(at: datetime.datetime) -> dict[str, str]:
    """What each letter of a date format prints for a moment; a moment without a zone is taken as UTC."""
    at = at if at.tzinfo else at.replace(tzinfo=datetime.timezone.utc)
    day, month, shift = DAYS[at.weekday()], MONTHS[at.month - 1], at.utcoffset() or datetime.timedelta()
    minutes = int(shift.total_seconds()) // 60
    zone = f"{'-' if minutes < 0 else '+'}{abs(minutes) // 60:02}:{abs(minutes) % 60:02}"
    year, week, weekday = at.isocalendar()
    hour, leap = at.hour % 12 or 12, calendar.isleap(at.year)
    name = at.tzname() or zone
    name = zone if name.startswith("UTC") and name != "UTC" else name
    suffix = "th" if 11 <= at.day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(at.day % 10, "th")
    # The day in thousandths, counted an hour east of Greenwich.
    middle = (at.astimezone(datetime.timezone.utc) + datetime.timedelta(hours=1)).time()
    beat = int((middle.hour * 3600 + middle.minute * 60 + middle.second) / 86.4)
    letters = {
        "d": f"{at.day:02}", "D": day[:3], "j": str(at.day), "l": day, "N": str(weekday), "S": suffix,
        "w": str(weekday % 7), "z": str(at.timetuple().tm_yday - 1), "W": f"{week:02}", "F": month, "m": f"{at.month:02}",
        "M": month[:3], "n": str(at.month), "t": str(calendar.monthrange(at.year, at.month)[1]), "L": str(int(leap)),
        "o": str(year), "Y": f"{at.year:04}", "y": f"{at.year % 100:02}", "a": "pm" if at.hour > 11 else "am",
        "A": "PM" if at.hour > 11 else "AM", "B": f"{beat:03}", "g": str(hour), "G": str(at.hour), "h": f"{hour:02}",
        "H": f"{at.hour:02}", "i": f"{at.minute:02}", "s": f"{at.second:02}", "u": f"{at.microsecond:06}",
        "v": f"{at.microsecond // 1000:03}", "e": name, "I": str(int(bool(at.dst()))), "O": zone.replace(":", ""),
        "P": zone, "p": "Z" if minutes == 0 else zone, "T": name, "Z": str(minutes * 60), "U": str(int(at.timestamp())),
    }
    letters["c"] = f"{at.year:04}-{at.month:02}-{at.day:02}T{at.hour:02}:{at.minute:02}:{at.second:02}{zone}"
    letters["r"] = f"{day[:3]}, {at.day:02} {month[:3]} {at.year:04} {at.hour:02}:{at.minute:02}:{at.second:02} {letters['O']}"
    return letters


def source_col(name: str) -> Column:
    """A top-level column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def bound(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)``, with the value written once in the plan however often ``build`` uses it."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def is_empty(value: Column, dtype: T.DataType) -> Column:
    """The one meaning of empty: NULL, '' or a list without elements."""
    if isinstance(dtype, T.StringType):
        return value.isNull() | (value == "")
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull()


def literal_pattern(text: str) -> str:
    """A regular expression for ``text`` itself.

    One-character delimiters get the short form that Java splits without a regular expression.
    """
    if len(text) == 1:
        return text if text.isalnum() or text.isspace() else "\\" + text
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_limited(value: Column, delimiter: str, limit: int | None = None) -> Column:
    """Split on a literal delimiter; ``limit`` n>0 keeps the rest in the last part, n<0 drops |n| parts."""
    pattern = literal_pattern(delimiter)
    if limit is None:
        return F.split(value, pattern, -1)
    if limit >= 0:
        return F.split(value, pattern, max(limit, 1))
    parts = F.split(value, pattern, -1)
    return F.slice(parts, F.lit(1), F.greatest(F.size(parts) + F.lit(limit), F.lit(0)))


def trimmed(value: Column) -> Column:
    return F.btrim(value, F.lit(TRIM_CHARS))


def _part_name(keys: Sequence[str | None]):
    """The name of a part by its position."""
    if not keys:
        return lambda i: i.cast("string")
    known = F.array(*[F.lit(k).cast("string") for k in keys])
    return lambda i: F.coalesce(F.get(known, i), i.cast("string"))


def _next_same_name(keys: Sequence[str | None]) -> list[int]:
    """For each named position the nearest later position with the same name, or a huge number."""
    names = [k if k is not None else str(i) for i, k in enumerate(keys)]
    found = []
    for i, name in enumerate(names):
        later = [j for j in range(i + 1, len(names)) if names[j] == name]
        if name.isdecimal() and str(int(name)) == name and int(name) >= len(names):
            later.append(int(name))
        found.append(min(later, default=2**31 - 1))
    return found


def two_level_split(
    value: Column,
    delimiter: str,
    subdelimiter: str,
    limit: int | None = None,
    sublimit: int | None = None,
    keys: Sequence[str | None] = (),
    trim: bool = True,
    subtrim: bool = True,
) -> Column:
    """A cell as a list of maps: elements by ``delimiter``, their parts by ``subdelimiter``.

    Part i is named ``keys[i]``, or by its index beyond the list; of equal names the last part wins.
    """
    if not delimiter or not subdelimiter:
        raise ValueError("subdelimited_explode needs both a delimiter and a subdelimiter")
    if isinstance(keys, (str, bytes)) or not isinstance(keys, Sequence):
        raise ValueError("the keys of subdelimited_explode must be a list")
    following = _next_same_name(keys)
    clash = any(j < 2**31 - 1 for j in following)

    name = _part_name(keys)

    def element(text: Column) -> Column:
        # Each element is split once: one pass trims and names its parts.
        parts = split_limited(text, subdelimiter, sublimit)
        named = F.transform(parts, lambda p, i: F.struct(name(i), trimmed(p) if subtrim else p))
        if clash:
            nearest = F.array(*[F.lit(j) for j in following])
            count = F.size(parts)
            named = F.filter(named, lambda _, i: F.coalesce(F.get(nearest, i) >= count, F.lit(True)))
        return F.map_from_entries(named)

    elements = split_limited(value, delimiter, limit)
    if trim and not subtrim:
        elements = F.transform(elements, trimmed)
    maps = F.transform(elements, element)
    nothing = F.array().cast("array<map<string,string>>")
    return F.when(value == "", nothing).when(value.isNotNull(), maps)


def encode_path(value: Column) -> Column:
    """Percent-encode each path segment; the scheme and the slashes stay."""

    def segment(text: Column) -> Column:
        text = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
        text = F.replace(text, F.lit("*"), F.lit("%2A"))
        return F.replace(text, F.lit("%7E"), F.lit("~"))

    def encoded(path: Column) -> Column:
        scheme = F.regexp_extract(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?=/)", 0)
        rest = F.substring(path, F.length(scheme) + F.lit(1), F.length(path))
        return F.concat(scheme, F.array_join(F.transform(F.split(rest, "/", -1), segment), "/"))

    return bound(value, encoded)


def basename(value: Column) -> Column:
    return F.substring_index(F.rtrim(value, F.lit("/")), "/", -1)


def extension(value: Column) -> Column:
    """Lower-case extension of the last path segment, '' without one."""
    return F.lower(F.regexp_extract(basename(value), r"\.([^.]+)$", 1))


def media_type(value: Column) -> Column:
    pairs = [F.lit(x) for kv in MEDIA_TYPES.items() for x in kv]
    known = F.try_element_at(F.create_map(*pairs), extension(value))
    return F.when(value.isNotNull(), F.coalesce(known, F.lit(UNKNOWN_MEDIA_TYPE)))


def run_date(fmt: Column, run_ts: datetime.datetime) -> Column:
    """Print the run's moment by a letter format; the moment is an argument so that runs repeat.

    A backslash keeps the character behind it as it is; so do characters that are no letters of a format.
    """
    letters = F.create_map(*[F.lit(x) for pair in date_letters(run_ts).items() for x in pair])
    parts = F.regexp_extract_all(fmt, F.lit(r"(?s)\\.|\\$|[^\\]"), F.lit(0))
    kept = F.transform(
        parts,
        lambda p: F.when(F.char_length(p) == 2, F.substring(p, 2, 1)).otherwise(F.coalesce(F.try_element_at(letters, p), p)),
    )
    return F.array_join(kept, "")


def scheme_of(value: Column) -> Column:
    """The part before '://', '' without one."""
    return F.regexp_extract(value, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)


def path_allowed(value: Column, paths: Sequence[str], schemes: Sequence[str], strict: bool = False) -> Column:
    """Does the value start with an allowed directory, or is its scheme allowed?

    ``strict`` asks for a segment boundary after the directory. A '..' segment is never allowed as a path.
    """
    climbs = value.rlike(r"(^|/)\.\.(/|$)")
    allowed = F.lit(False)
    for path in paths:
        if strict:
            folder = path.rstrip("/")
            allowed = allowed | (value == folder) | value.startswith(folder + "/")
        else:
            allowed = allowed | value.startswith(path)
    allowed = allowed & ~climbs
    if schemes:
        allowed = allowed | scheme_of(value).isin(*schemes)
    return F.coalesce(allowed, F.lit(False))


def key_text(columns: Sequence[Column]) -> Column:
    """One text for a row key of any width."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return parts[0] if len(parts) == 1 else F.concat_ws(KEY_SEPARATOR, *parts)


def row_hash(columns: Sequence[Column]) -> Column:
    """Hash of a row's cells; NULL and '' differ."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in columns]))


def target_id(migration: Column, src_key: Column) -> Column:
    """Target id of a source key: the same on every run and under any partitioning."""
    return F.sha2(F.concat_ws(KEY_SEPARATOR, migration, src_key), 256)
