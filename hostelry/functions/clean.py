"""Column-level cleaning functions (catalogue C02-C11, C17-C22, C25-C30).

Every function maps Columns to a Column built from Spark built-ins, so the
whole cleaning step stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source system's code lists and formats.
# ---------------------------------------------------------------------------
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
LOYALTY_DEFAULT = "Bronze"
ROOM_TYPES = ("Standard", "Deluxe", "Suite", "Presidential")
ROOM_TYPE_DEFAULT = "Standard"
POS_CATEGORIES = ("Food", "Drink", "Service", "Spa")
POS_CATEGORY_DEFAULT = "Other"
BOOKING_CHANNELS = ("Website", "Phone", "OTA")          # matched by equality
BOOKING_CHANNEL_CONTAINS = (("WALK", "Walk-in"),)       # matched by substring
BOOKING_CHANNEL_DEFAULT = "Unknown"
ROOM_STATUSES = ("Clean", "Dirty", "Maintenance")       # matched by equality
ROOM_STATUS_CONTAINS = (("ORDER", "Out-of-Order"),)     # matched by substring
ROOM_STATUS_DEFAULT = "Unknown"
INVALID_EMAIL_SENTINEL = "invalid-email"
UNKNOWN_NAME = "Unknown"
UNKNOWN_COUNTRY = "UNKNOWN"
INVALID_ROOM_SENTINEL = "9999"

# Date formats, tried in this order; the first that parses wins.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")
CHECKOUT_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "MM/dd/yyyy")
SHORT_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss")
CHECKOUT_TIME_OF_DAY = "11:00:00"
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical(c: Column | str, labels: Iterable[str], default: str,
              contains: Sequence[tuple[str, str]] = ()) -> Column:
    """Case-insensitive lookup of a code list.

    ``labels`` match by equality of the upper-cased value, ``contains`` pairs
    (substring, label) match by substring; anything else, NULL included, maps
    to ``default``. The lookup is a literal map, evaluated JVM-side.
    """
    key = F.upper(_c(c))
    lookup = F.create_map(*[x for lab in labels for x in (F.lit(lab.upper()), F.lit(lab))])
    parts = [lookup[key]] if labels else []
    for sub, label in contains:
        parts.append(F.when(key.contains(sub), F.lit(label)))
    parts.append(F.lit(default))
    return F.coalesce(*parts)


def canonical_tier(c: Column | str) -> Column:
    return canonical(c, LOYALTY_TIERS, LOYALTY_DEFAULT)


def canonical_room_type(c: Column | str) -> Column:
    return canonical(c, ROOM_TYPES, ROOM_TYPE_DEFAULT)


def canonical_channel(c: Column | str) -> Column:
    return canonical(c, BOOKING_CHANNELS, BOOKING_CHANNEL_DEFAULT, BOOKING_CHANNEL_CONTAINS)


def canonical_category(c: Column | str) -> Column:
    return canonical(c, POS_CATEGORIES, POS_CATEGORY_DEFAULT)


def canonical_status(c: Column | str) -> Column:
    return canonical(c, ROOM_STATUSES, ROOM_STATUS_DEFAULT, ROOM_STATUS_CONTAINS)


def clean_name(c: Column | str) -> Column:
    """Trim, collapse whitespace runs, NULL -> 'Unknown'. Case is kept."""
    return F.coalesce(F.regexp_replace(F.trim(_c(c)), r"\s+", " "), F.lit(UNKNOWN_NAME))


def clean_email(c: Column | str) -> Column:
    """lower(trim); NULL and the raw sentinel become NULL."""
    c = _c(c)
    return F.when(c != F.lit(INVALID_EMAIL_SENTINEL), F.lower(F.trim(c)))


def clean_country(c: Column | str) -> Column:
    """upper(trim), NULL -> 'UNKNOWN' (C09)."""
    return F.coalesce(F.upper(F.trim(_c(c))), F.lit(UNKNOWN_COUNTRY))


def pattern_shape(fmt: str) -> str:
    """A regular expression every string the datetime pattern can parse
    matches (a superset: fixed-width fields, 4+ digit year, literals).

    Used as a guard so the parser only sees plausible strings: a failed parse
    costs an exception inside the task, a failed regex test does not."""
    out, i = ["^"], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "'":
            j = fmt.index("'", i + 1)
            out.append("".join("\\" + c if not c.isalnum() else c for c in fmt[i + 1:j]))
            i = j + 1
            continue
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch == "y":
            out.append("[+-]?[0-9]{%d,}" % run)
        elif ch.isalpha():
            out.append("[0-9]{%d}" % run)
        else:
            out.append("\\" + ch if not ch.isalnum() and ch != " " else ch)
        i = j
    return "".join(out) + "$"


def parse_date_multi(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses wins, else NULL."""
    c = _c(c)
    return F.coalesce(*[F.when(c.rlike(pattern_shape(f)), F.try_to_date(c, f)) for f in formats])


def parse_ts_multi(c: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First timestamp format that parses wins, else NULL (C11)."""
    c = _c(c)
    return F.coalesce(*[F.when(c.rlike(pattern_shape(f)), F.try_to_timestamp(c, F.lit(f))) for f in formats])


def null_outside_range(c: Column | str, lo: float, hi: float) -> Column:
    """Value if lo < value < hi, else NULL."""
    c = _c(c)
    return F.when((c > lo) & (c < hi), c)


def null_safe_sum(a: Column | str, b: Column | str) -> Column:
    """a + b, or b when a is NULL."""
    return F.coalesce(_c(a) + _c(b), _c(b))


def nights(start: Column | str, end: Column | str) -> Column:
    """Nights between two dates."""
    return F.datediff(_c(end), _c(start))


def email_base(c: Column | str) -> Column:
    """Drop a '+alias' (greedy from the first '+' to the '@') (C20)."""
    return F.regexp_replace(_c(c), r"\+.*@", "@")


def dedup_key(base: Column | str, guest_id: Column | str) -> Column:
    """E-mail base, or 'guest_<id>' when there is none."""
    return F.coalesce(_c(base), F.concat_ws("_", F.lit("guest"), _c(guest_id).cast("string")))


def surrogate_key(guest_id: Column | str, version: Column | str) -> Column:
    """'<id>_<version>' (C22)."""
    return F.concat_ws("_", _c(guest_id).cast("string"), _c(version).cast("string"))


def safe_ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round(num/den) when den > 0, else 0.0; a NULL numerator stays NULL."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, F.round(num / den, digits)).otherwise(F.lit(0.0))


def safe_percent(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """As safe_ratio, times 100 before rounding."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, F.round(num / den * 100, digits)).otherwise(F.lit(0.0))


def is_weekend(d: Column | str) -> Column:
    """Saturday or Sunday; Spark's dayofweek is Sunday=1 .. Saturday=7."""
    return F.dayofweek(_c(d)).isin(1, 7)


def is_late_checkout(ts: Column | str, check_out: Column | str) -> Column:
    """POS date on or after the check-out date."""
    return F.to_date(_c(ts)) >= _c(check_out)


def at_time_of_day(d: Column | str, hhmmss: str = CHECKOUT_TIME_OF_DAY) -> Column:
    """Date at a fixed wall-clock time as a timestamp."""
    return F.to_timestamp(F.concat(_c(d).cast("string"), F.lit(" " + hhmmss)))


def minutes_between(a: Column | str, b: Column | str) -> Column:
    """Elapsed minutes from a to b as double."""
    return (F.unix_timestamp(_c(b)) - F.unix_timestamp(_c(a))) / 60.0


def fill_missing(cols: Mapping[str, object]) -> dict[str, Column]:
    """coalesce(col, default) for each column (C17); use with withColumns."""
    return {k: F.coalesce(F.col(k), F.lit(v)) for k, v in cols.items()}
