"""Column expressions: durations, sizes, text, time and statistics. All of them stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2**31 - 1


def difference(a: Column, b: Column) -> Column:
    """a - b, null if either is."""
    return a - b


def transaction_size(count: Column, size: Column, mime_size: Column) -> Column:
    """Without attachments the size, with some the MIME size; a negative count gives null."""
    return F.when(count.isNull() | (count == 0), size).when(count > 0, mime_size)


def clamp_int(x: Column) -> Column:
    """Into the symmetric 32-bit range as int; null stays null (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(INT_MAX)), F.lit(-INT_MAX))).cast("int")


def escape_html(x: Column) -> Column:
    """&, < and > as character references, & first so nothing is escaped twice."""
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def joined(separator: str, *parts: Column) -> Column:
    """Parts that are neither null nor empty, joined."""
    return F.concat_ws(separator, *map(blank_to_null, parts))


def file_name(x: Column) -> Column:
    """Only ASCII letters, digits, dot, underscore and hyphen."""
    return F.regexp_replace(x, "[^A-Za-z0-9._-]", "")


def shortened(x: Column, most: int = 55) -> Column:
    return F.coalesce(F.substring(x, 1, most), F.lit(""))


def service_key(x: Column) -> Column:
    return F.concat(F.lit("service_"), F.lower(F.replace(F.trim(x), F.lit(" "), F.lit("_"))))


def python_text(x: Column, data_type: str) -> Column:
    """How Python prints a value: None for null, True and False for booleans."""
    text = F.initcap(x.cast("string")) if data_type == "boolean" else x.cast("string")
    return F.coalesce(text, F.lit("None"))


def version_at_least(version: Column, least: Sequence[int]) -> Column:
    """Dotted version compared part by part as numbers; a version that is missing or no number is not."""
    parts = F.transform(F.split(version, r"\."), lambda x: F.try_to_number(F.trim(x), F.lit("999999999")).cast("int"))
    whole = F.forall(parts, lambda x: x.isNotNull())
    return F.coalesce(whole & (parts >= F.array(*map(F.lit, least))), F.lit(False))


def to_hour(ms: Column) -> Column:
    """Epoch milliseconds cut to the hour of the session's time zone."""
    return F.unix_millis(F.date_trunc("HOUR", F.timestamp_millis(ms)))


def to_day(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def bucket(ms: Column, minutes: int) -> Column:
    """Start of the tumbling, epoch-aligned window."""
    return ms - ms % (60_000 * minutes)


def similar_period(ms: Column, parts: Sequence[str]) -> Column:
    """Seasonal key: parts of `hour`, `weekday` (Monday 0), `day`, joined by underscores."""
    at = F.timestamp_millis(ms)
    made = {"hour": F.hour(at), "weekday": F.weekday(at), "day": F.dayofmonth(at)}
    return F.concat_ws("_", *[made[p].cast("string") for p in parts])


def span_text(low: Column, mean: Column, high: Column) -> Column:
    """'low / mean / high' with halves rounded to even, None for null."""
    return F.concat_ws(" / ", *[F.coalesce(F.bround(x, 0).cast("long").cast("string"), F.lit("None")) for x in (low, mean, high)])


def two_sided_p(z: Column) -> Column:
    """Probability of a standard normal value at least as far from 0, exact to about 1e-13.

    Near 0 by the series of positive terms, erf(x) = 2 x / sqrt(pi) exp(-x^2) (1 + 2 x^2 / 3 + (2 x^2)^2 / 15 + ...); beyond 2
    by the continued fraction, exp(-x^2) / sqrt(pi) / (x + 1/2 / (x + 2/2 / (x + 3/2 / ...))).
    """
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    terms = [1.0]
    for n in range(1, 40):
        terms.append(terms[-1] * 2 / (2 * n + 1))
    x2 = F.when(x <= 2, x * x)
    series = F.aggregate(F.array(*map(F.lit, reversed(terms))), F.lit(0.0), lambda acc, c: acc * x2 + c)
    near = 1 - F.lit(2 / math.sqrt(math.pi)) * x * F.exp(-x * x) * series
    fraction = F.aggregate(F.array(*(F.lit(n / 2) for n in range(60, 0, -1))), x, lambda acc, c: x + c / acc)
    far = F.exp(-x * x) / (F.lit(math.sqrt(math.pi)) * fraction)
    return F.when(x <= 2, near).otherwise(far)


def nulls_like_postgres(column: str, order: str) -> Column:
    """Ascending puts nulls last, descending first: the opposite of Spark's own order."""
    return F.col(column).desc_nulls_first() if order.lower() == "desc" else F.col(column).asc_nulls_last()


#: Fixed value: what stands for a text without a translation.
UNTRANSLATED = "???"


def translation(key: Column, texts: Mapping[str, str]) -> Column:
    """The text of a key, else UNTRANSLATED."""
    if not texts:
        return F.lit(UNTRANSLATED)
    known = F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])
    return F.coalesce(F.try_element_at(known, key), F.lit(UNTRANSLATED))
