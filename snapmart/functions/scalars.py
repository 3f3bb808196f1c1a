"""Scalar helpers, all built from Spark's own column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.schema import RATING_LABELS

# Accepted date texts, tried in this order, as shape and pattern.
DATE_FORMATS = (
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{3}, \d{4}$", "d MMM, yyyy"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]+, \d{4}$", "d MMMM, yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}$", "yyyy"),
)

# The short form of each label.
SHORT_LABELS = {
    "Overwhelmingly Positive": "Overwhelm+",
    "Very Positive": "Muy Pos.",
    "Positive": "Positivo",
    "Mostly Positive": "Mayorm+",
    "Mixed": "Mixto",
    "Mostly Negative": "Mayorm-",
    "Negative": "Negativo",
    "Very Negative": "Muy Neg.",
    "Overwhelmingly Negative": "Overwhelm-",
}

# Texts of the bands, of freshness and of a missing value.
BAND_POSITIVE, BAND_NEGATIVE, BAND_MIXED, BAND_NONE = "rating-pos", "rating-neg", "rating-mix", ""
FRESH, STALE = "ACTIVO", "INACTIVO"
FREE = "Free"
MISSING = "—"

MICROS = {
    "MICROSECOND": 1,
    "MILLISECOND": 1_000,
    "SECOND": 1_000_000,
    "MINUTE": 60_000_000,
    "HOUR": 3_600_000_000,
    "DAY": 86_400_000_000,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp(value: str | datetime | Column | None) -> Column:
    """A zoneless timestamp: a given moment, or now in UTC if there is none."""
    if value is None:
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: str | date | Column | None) -> Column:
    if value is None:
        return timestamp(None).cast("date")
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def before(moment: Column, amount: int, unit: str) -> Column:
    """``moment`` less an amount of hours, days and so on."""
    return F.timestamp_add(unit, F.lit(-amount), moment)


def is_recent(changed_at: Column | str, as_of: Column, hours: int = 24) -> Column:
    return _col(changed_at) >= before(as_of, hours, "HOUR")


def epoch_micros(moment: Column | str) -> Column:
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", origin, _col(moment).cast("timestamp_ntz"))


def boundaries_between(unit: str, start: Column | str, end: Column | str) -> Column:
    """How many starts of ``unit`` lie after ``start`` and up to ``end``.

    From 0.9 s to 1.1 s one second starts, although only 0.2 s pass.
    """
    size = F.lit(MICROS[unit.upper()])

    def unit_number(moment: Column | str) -> Column:
        micros = epoch_micros(moment)
        return F.call_function("div", micros - F.pmod(micros, size), size)

    return unit_number(end) - unit_number(start)


def percent_change(now: Column | str, then: Column | str) -> Column:
    """Change in percent with one decimal; null when there was nothing before."""
    difference = (_col(now) - _col(then)).cast("double")
    return (difference / F.nullif(_col(then), F.lit(0)) * 100).cast("decimal(8,1)")


def rating_percent(positive: Column | str, negative: Column | str) -> Column:
    """Share of positive votes in percent, two decimals, half up; 0 without votes."""
    p = _col(positive).cast("decimal(20,0)")
    votes = p + _col(negative).cast("decimal(20,0)")
    hundredths = F.call_function("div", p * 20_000 + votes, F.nullif(votes * 2, F.lit(0)))
    return F.coalesce(F.when(votes > 0, hundredths.cast("decimal(7,0)") / 100), F.lit(0)).cast("decimal(5,2)")


def collated(text: Column | str, collation: str | None) -> Column:
    """``text`` as it compares under a collation; without one it compares byte by byte."""
    return _col(text) if collation is None else F.collate(_col(text), collation)


def same_text(text: Column | str, value: str, collation: str | None = None) -> Column:
    return collated(text, collation) == F.lit(value)


def one_of(text: Column | str, values: Sequence[str], collation: str | None = None) -> Column:
    """Whether the text is one of ``values``; null for null. An empty list holds nothing."""
    return collated(text, collation).isin(*values)


def begins_with(text: Column | str, prefix: str, collation: str | None = None) -> Column:
    return F.startswith(collated(text, collation), collated(F.lit(prefix), collation))


def allowed_label(label: Column | str, allowed: Sequence[str] = RATING_LABELS, collation: str | None = None) -> Column:
    return F.when(one_of(label, allowed, collation), _col(label))


def rating_band(label: Column | str, collation: str | None = None) -> Column:
    c = collated(label, collation)
    return (
        F.when(F.coalesce(_col(label), F.lit("")) == "", BAND_NONE)
        .when(F.contains(c, F.lit("Positive")), BAND_POSITIVE)
        .when(F.contains(c, F.lit("Negative")), BAND_NEGATIVE)
        .otherwise(BAND_MIXED)
    )


def decode(code: Column | str, meanings: Mapping, default: Column | str | None = None) -> Column:
    """The text of a code; without a match the default, which may be a column."""
    c = _col(code)
    texts = F.create_map(*[F.lit(x) for pair in meanings.items() for x in pair])
    found = F.when(c.isNotNull(), F.try_element_at(texts, c))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def short_label(label: Column | str) -> Column:
    given = F.nullif(_col(label), F.lit(""))
    return F.coalesce(decode(given, SHORT_LABELS, given), F.lit(MISSING))


def price_text(price: Column | str) -> Column:
    amount = _col(price).cast("decimal(10,2)")
    return F.when(amount == 0, FREE).otherwise(F.concat(F.lit("$"), amount.cast("string")))


def freshness(last: Column | str, as_of: Column, minutes: int = 10) -> Column:
    """FRESH if less than ``minutes`` have passed since ``last``, otherwise STALE."""
    passed = F.timestamp_diff("MICROSECOND", _col(last), as_of)
    return F.when(_col(last).isNull(), None).when(passed < minutes * MICROS["MINUTE"], FRESH).otherwise(STALE)


def parse_date(text: Column | str) -> Column:
    """The first of ``DATE_FORMATS`` that fits, otherwise null."""
    tidy = F.trim(F.regexp_replace(_col(text), r"\s+", " "))
    return F.coalesce(*[
        F.when(tidy.rlike(shape), F.try_to_date(tidy, pattern)) for shape, pattern in DATE_FORMATS
    ])


def cents_to_price(cents: Column | str) -> Column:
    """Cents as a price, 0 for null; null if there are too many for one."""
    return (F.coalesce(_col(cents), F.lit(0)).try_cast("decimal(12,0)") / 100).try_cast("decimal(10,2)")


def strip(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def not_blank(text: Column | str) -> Column:
    return F.length(F.trim(_col(text))) > 0


def joined(items: Column | str, separator: str = ", ") -> Column:
    """The items of an array as one text; null for no items."""
    return F.nullif(F.array_join(_col(items), separator), F.lit(""))


def listed(json_array: Column | str, separator: str = ", ") -> Column:
    """A JSON array of texts as one text; MISSING for null."""
    items = F.from_json(_col(json_array), "array<string>")
    return F.coalesce(F.array_join(items, separator), F.lit(MISSING))


def json_array_of(names: Sequence[tuple[str, Column]]) -> Column:
    """JSON array of the names whose condition holds, in order; null if none does."""
    kept = F.filter(F.array(*[F.when(cond, name) for name, cond in names]), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.to_json(kept))


def clock_text(hhmmss: Column | str) -> Column:
    """An integer such as 63000 as '06:30'."""
    value = _col(hhmmss)

    def two_digits(number: Column) -> Column:
        return F.right(F.concat(F.lit("0"), number.cast("string")), F.lit(2))

    hours = F.call_function("div", value, F.lit(10_000))
    minutes = F.call_function("div", value % 10_000, F.lit(100))
    return F.concat(two_digits(hours), F.lit(":"), two_digits(minutes))


def megabytes(size: Column | str) -> Column:
    return (_col(size) / F.lit(1_048_576.0)).cast("decimal(12,2)")


def iso_text(moment: Column | str) -> Column:
    """ISO text; the fraction is written, with six digits, only where there is one."""
    c = _col(moment).cast("timestamp_ntz")
    fraction = F.pmod(epoch_micros(c), F.lit(MICROS["SECOND"]))
    whole = F.replace(F.substring(c.cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    digits = F.lpad(fraction.cast("string"), 6, "0")
    return F.when(fraction == 0, whole).otherwise(F.concat(whole, F.lit("."), digits))


def compact_stamp(moment: Column | str) -> Column:
    return F.date_format(_col(moment), "yyyyMMdd_HHmmss")
