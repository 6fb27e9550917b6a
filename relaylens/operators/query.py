"""Validated filter, project, sort and page queries over a DataFrame."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.expr import nulls_like_postgres

ORDERED = ("=", "!=", "<", "<=", ">", ">=")
EQUALITY = ("=", "!=")
#: A constraint value that stands for null.
NULL_TEXT = "None"


class QueryError(ValueError):
    """The query names an unknown column, operator or order, or a value that its column can't hold."""


@dataclass(frozen=True)
class Constraint:
    column: str
    operator: str
    value: object


@dataclass(frozen=True)
class QuerySpec:
    columns: Sequence[str] = ()
    constraints: Sequence[Constraint] = ()
    order: Sequence[tuple[str, str]] = ()
    limit: int | None = None
    offset: int = 0

    @classmethod
    def parse(cls, columns: str = "[]", constraints: str = "[]", order: str = "[]", limit: int | None = None, offset: int = 0) -> QuerySpec:
        """From the JSON texts of a request."""
        try:
            c, k, o = (json.loads(x or "[]") for x in (columns, constraints, order))
        except json.JSONDecodeError as e:
            raise QueryError(f"not JSON: {e}") from None
        if not all(isinstance(x, list) for x in (c, k, o)):
            raise QueryError("columns, constraints and order are lists")
        try:
            return cls(c, [Constraint(x["column"], x["operator"], x["value"]) for x in k], [(x["column"], x["order"]) for x in o], limit, offset)
        except (KeyError, TypeError) as e:
            raise QueryError(f"missing {e}") from None


def operators_of(data_type: str) -> Sequence[str]:
    """Numbers and dates are ordered; text and booleans only compare for equality."""
    return EQUALITY if data_type in ("string", "boolean") else ORDERED


def catalogue(df: DataFrame) -> list[dict[str, object]]:
    """Name, type and valid operators of each column."""
    return [{"name": c, "type": t, "operators": list(operators_of(t))} for c, t in df.dtypes]


def validate(df: DataFrame, spec: QuerySpec) -> None:
    types = dict(df.dtypes)
    unknown = [c for c in [*spec.columns, *[k.column for k in spec.constraints], *[c for c, _ in spec.order]] if c not in types]
    if unknown:
        raise QueryError(f"unknown columns: {', '.join(map(str, unknown))}")
    for k in spec.constraints:
        if k.operator not in operators_of(types[k.column]):
            raise QueryError(f"operator {k.operator} doesn't apply to {k.column}")
        if k.value != NULL_TEXT and types[k.column] in ("int", "bigint", "double"):
            try:
                float(k.value)
            except (TypeError, ValueError):
                raise QueryError(f"{k.value!r} is no number for {k.column}") from None
    if wrong := [o for _, o in spec.order if str(o).lower() not in ("asc", "desc")]:
        raise QueryError(f"order is asc or desc, not {wrong[0]}")


def predicate(df: DataFrame, k: Constraint) -> Column:
    """The constraint as a typed comparison, so that Parquet can use it. NULL_TEXT: = means null, anything else not null."""
    c = F.col(k.column)
    if k.value == NULL_TEXT:
        return c.isNull() if k.operator == "=" else c.isNotNull()
    v = F.lit(k.value).cast(dict(df.dtypes)[k.column])
    return {"=": c == v, "!=": c != v, "<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}[k.operator]


def constrained(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [predicate(df, k) for k in constraints])) if constraints else df


def run_query(df: DataFrame, spec: QuerySpec) -> DataFrame:
    validate(df, spec)
    out = constrained(df, spec.constraints)
    if spec.order:
        out = out.orderBy(*[nulls_like_postgres(c, o) for c, o in spec.order])
    if spec.offset:
        out = out.offset(spec.offset)
    if spec.limit is not None:
        out = out.limit(spec.limit)
    return out.select(*(spec.columns or df.columns))


def count_query(df: DataFrame, spec: QuerySpec) -> int:
    validate(df, spec)
    return constrained(df, spec.constraints).count()


def harvest(df: DataFrame, from_ts: int, until_ts: int | None = None, after_id: int | None = None, limit: int | None = None, time: str = "requestInTs", key: str = "id") -> DataFrame:
    """Rows from a time on, optionally before another and after a key, in (time, key) order: keyset paging."""
    out = df.where(F.col(time) >= from_ts)
    if until_ts is not None:
        out = out.where(F.col(time) < until_ts)
    if after_id is not None:
        out = out.where(F.col(key) > after_id)
    out = out.orderBy(time, key)
    return out if limit is None else out.limit(limit)


@dataclass(frozen=True)
class HarvestSource:
    """What a source is asked by default: from when on, how many rows, until when, and the offset of its times of day."""

    from_dt: str
    limit: int
    until_dt: str | None = None
    tz_offset: str = "+0000"

    #: What a request may override.
    OVERRIDES = ("from_dt", "from_row_id", "offset", "until_dt")

    def _instant(self, name: str, text: str) -> str:
        try:
            at = dt.datetime.strptime(text, "%Y-%m-%dT%H:%M:%S")
            return dt.datetime.strptime(at.isoformat() + self.tz_offset, "%Y-%m-%dT%H:%M:%S%z").strftime("%Y-%m-%dT%H:%M:%S%z")
        except ValueError:
            raise ValueError(f"{name} has to be a time like 2024-01-31T12:00:00") from None

    def params(self, **overrides: object) -> dict[str, object]:
        """Parameters of a request; times get the source's offset."""
        if wrong := [k for k in overrides if k not in self.OVERRIDES]:
            raise ValueError(f"{wrong[0]} can't be overridden")
        out = {"from_dt": self.from_dt, "limit": self.limit, "until_dt": self.until_dt, **overrides}
        return {k: self._instant(k, str(v)) if k in ("from_dt", "until_dt") else v for k, v in out.items() if v is not None}

    def resumed(self, last: Mapping[str, object] | None, time: str = "requestInTs", key: str = "id") -> dict[str, object]:
        """Parameters that go on behind the last row of what is there; `last` as `resume_point` gives it, in UTC."""
        if not last or last[time] is None:
            return self.params()
        zone = dt.datetime.strptime(self.tz_offset, "%z").tzinfo
        at = dt.datetime.fromtimestamp(int(last[time]) // 1000, zone)
        return self.params(from_dt=at.strftime("%Y-%m-%dT%H:%M:%S"), from_row_id=last[key])


def harvest_page(df: DataFrame, params: Mapping[str, object], time: str = "requestInTs", key: str = "id") -> DataFrame:
    """The rows that a request with these parameters gets, in (time, key) order."""
    ms = lambda name: int(dt.datetime.strptime(str(params[name]), "%Y-%m-%dT%H:%M:%S%z").timestamp() * 1000) if name in params else None
    out = harvest(df, ms("from_dt") or 0, ms("until_dt"), params.get("from_row_id"), None, time, key)
    return out.offset(int(params.get("offset", 0))).limit(int(params["limit"]))


def resume_point(batch: DataFrame, time: str = "requestInTs", key: str = "id") -> DataFrame:
    """The last (time, key) of a batch, where the next one starts."""
    return batch.agg(F.max(F.struct(time, key)).alias("last")).select(f"last.{time}", f"last.{key}")


def date_range(df: DataFrame, column: str, delay_days: int = 0) -> DataFrame:
    """Earliest and latest date, the latest moved back by the publication delay."""
    return df.agg(F.min(column).alias("min_date"), F.date_sub(F.max(column), delay_days).alias("max_date"))


def published(df: DataFrame, column: str, today: dt.date, delay_days: int) -> DataFrame:
    return df.where(F.col(column) <= F.lit(today - dt.timedelta(days=delay_days)))


def row_range(rows: int, offset: int = 0) -> str:
    """Label of a page: first and last row, counted from 1."""
    return f"{offset + 1}-{offset + rows}" if rows else "0"


def incident_filter(column: str, data_type: str, operator: str, value: object) -> Column:
    """Numbers are equal within 0.001; a time equals its minute, a date its day."""
    c = F.col(column)
    if operator != "=":
        v = F.lit(value)
        return {"<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v, "!=": c != v}[operator]
    if data_type == "double":
        return c.between(F.lit(value) - 1e-3, F.lit(value) + 1e-3)
    if data_type in ("timestamp", "date"):
        span = dt.timedelta(minutes=1) if data_type == "timestamp" else dt.timedelta(days=1)
        return (c >= F.lit(value)) & (c < F.lit(value + span))
    return c == F.lit(value)


@dataclass(frozen=True)
class IncidentQuery:
    """Optional filters; what is None doesn't filter."""

    statuses: Sequence[str] | None = None
    metric: str | None = None
    timeunit: str | None = None
    created_from: dt.datetime | None = None
    created_to: dt.datetime | None = None
    equals: Mapping[str, object] = field(default_factory=dict)

    def apply(self, incidents: DataFrame) -> DataFrame:
        parts = [
            self.statuses is not None and F.col("incident_status").isin(*self.statuses),
            self.metric is not None and F.col("anomalous_metric") == self.metric,
            self.timeunit is not None and F.col("aggregation_timeunit") == self.timeunit,
            self.created_from is not None and F.col("incident_creation_timestamp") >= F.lit(self.created_from),
            self.created_to is not None and F.col("incident_creation_timestamp") <= F.lit(self.created_to),
            *[F.col(k) == v for k, v in self.equals.items()],
        ]
        return reduce(lambda df, p: df.where(p), [p for p in parts if p is not False], incidents)


def page(incidents: DataFrame, column: str, descending: bool, start: int, length: int) -> DataFrame:
    order = F.col(column).desc() if descending else F.col(column).asc()
    return incidents.orderBy(order).offset(start).limit(length)


def set_status(incidents: DataFrame, updates: DataFrame, now: dt.datetime, key: str = "incident_id") -> DataFrame:
    """Incidents with the status and comments of updates (key, incident_status, comments) and the time of the change."""
    u = updates.select(F.col(key).alias("__k"), F.col("incident_status").alias("__s"), F.col("comments").alias("__c"))
    hit = F.col("__k").isNotNull()
    out = incidents.join(u, F.col(key) == F.col("__k"), "left")
    changed = {"incident_status": F.when(hit, F.col("__s")).otherwise(F.col("incident_status")), "comments": F.when(hit, F.coalesce("__c", "comments")).otherwise(F.col("comments")), "incident_update_timestamp": F.when(hit, F.lit(now)).otherwise(F.col("incident_update_timestamp"))}
    return out.withColumns(changed).select(*incidents.columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column in order, nulls left out."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


#: Rows of a preview.
PREVIEW = 10


def preview(df: DataFrame, order: Sequence[str], n: int = PREVIEW) -> DataFrame:
    return df.orderBy(*order).limit(n)


def escaped_cells(df: DataFrame) -> DataFrame:
    """Every cell as text that is safe in HTML; nulls stay null."""
    return df.select(*[X.escape_html(F.col(c).cast("string")).alias(c) for c in df.columns])
