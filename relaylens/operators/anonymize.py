"""From clean calls to published logs: split into sides, mask, hide, substitute, coarsen."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X

Rule = Sequence[tuple[str, str]]


def dual_split(clean: DataFrame, fields: Mapping[str, str], carried: Sequence[str] = ()) -> DataFrame:
    """A row for each present side: `fields` maps a side's field to its published name, `carried` come from the call.

    Calls without a client instance are not published.
    """
    made = [F.when(F.col(s).isNotNull(), F.struct(F.lit(s).alias("side"), *[F.col(f"{s}.{a}").alias(b) for a, b in fields.items()])) for s in ("client", "producer")]
    rows = clean.where("client.clientXRoadInstance is not null").select(*carried, F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("r"))
    return rows.select("r.*", *carried)


def mask_sides(rows: DataFrame, client_only: Sequence[str], producer_only: Sequence[str], side: str = "side") -> DataFrame:
    """Null what belongs to the other side's agent."""
    own = {c: F.when(F.col(side) == "client", F.col(c)) for c in client_only} | {c: F.when(F.col(side) == "producer", F.col(c)) for c in producer_only}
    return rows.withColumns(own)


def matches(rows: DataFrame, rule: Rule) -> Column:
    """All of a rule's (field, pattern) hold; patterns start at the beginning of the value as Python prints it."""
    types = dict(rows.dtypes)
    each = [X.python_text(F.col(f), types[f]).rlike(f"^(?:{p})") if f in types else F.lit(False) for f, p in rule]
    return reduce(lambda a, b: a & b, each)


def hide(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that no rule matches."""
    return rows.where(~reduce(lambda a, b: a | b, [matches(rows, r) for r in rules])) if rules else rows


def substitute(rows: DataFrame, rules: Sequence[tuple[Rule, Mapping[str, object]]]) -> DataFrame:
    """Rules in order, each setting fields to constants where it matches; later rules see earlier results."""
    for rule, values in rules:
        hit, types = matches(rows, rule), dict(rows.dtypes)
        rows = rows.withColumns({c: F.when(hit, F.lit(v).cast(types[c])).otherwise(F.col(c)) for c, v in values.items()})
    return rows


def coarsen_times(rows: DataFrame, columns: Sequence[str] = ("requestInTs",)) -> DataFrame:
    return rows.withColumns({c: X.to_hour(F.col(c)) for c in columns})


def clamp_durations(rows: DataFrame, columns: Sequence[str] = ("totalDuration", "producerDurationProducerView")) -> DataFrame:
    return rows.withColumns({c: X.clamp_int(F.col(c)) for c in columns})


#: Further steps by name; each takes and gives a DataFrame.
TRANSFORMERS: dict[str, Callable[[DataFrame], DataFrame]] = {"hourly_times": coarsen_times, "int_durations": clamp_durations}


def anonymize(rows: DataFrame, hiding: Sequence[Rule] = (), substitutions: Sequence[tuple[Rule, Mapping[str, object]]] = (), transformers: Sequence[str] = ()) -> DataFrame:
    out = substitute(hide(rows, hiding), substitutions)
    return reduce(lambda df, name: df.transform(TRANSFORMERS[name]), transformers, out)
