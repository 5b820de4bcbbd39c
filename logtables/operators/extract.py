"""Extraction: captures, log type and timestamps as columns next to the input columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtables.functions.accessors import typed
from logtables.rules import TIMESTAMP, RuleSet
from logtables.sources.text import TEXT, text_column

LOG_TYPE, TIMESTAMPS = "log_type", "timestamps"
_FOUND, _GROUPS = "__found", "__groups"


def with_helper(df: DataFrame, name: str, column: Column, scan_once: bool) -> DataFrame:
    """Add a column that several later columns are made of.

    A plain column is evaluated once per row, but Catalyst copies it into every filter it moves below the
    projection, so that rows are scanned for the filter and again for the result. With ``scan_once`` the
    column is a generated one, which filters on it do not cross; filters on other columns still reach the
    scan. That costs a copy of the row, and pays off where a filter on the result follows.
    """
    if scan_once:
        return df.select("*", F.inline(F.array(F.struct(column.alias(name)))))
    return df.withColumn(name, column)


def extract(
    df: DataFrame,
    rules: RuleSet,
    text: str = TEXT,
    *,
    captures: Sequence[str] | None = None,
    log_type: bool = True,
    types: Mapping[str, str] | None = None,
    into: str | None = None,
    scan_once: bool = False,
) -> DataFrame:
    """Apply the rules to a text column.

    Adds one ``array<string>`` column per capture, ``log_type``, and ``timestamps`` if the rule set has
    timestamp rules. ``captures`` limits the columns (all rules still take part in matching), ``types``
    casts values, ``into`` puts everything into one struct column, ``scan_once`` is for results that are
    filtered by what was extracted. Works on batch and streaming input.
    """
    matcher = rules.matcher
    known = rules.capture_names
    wanted = list(known if captures is None else captures)
    for name in [*wanted, *(types or {})]:
        if name not in known:
            raise ValueError(f"unknown capture {name!r}; the rules have {', '.join(known)}")
    source = text_column(df, text)
    found = F.col(_FOUND)
    groups = matcher.groups(found, alternating=log_type) if wanted else None
    columns = {}
    for name in wanted:
        values = matcher.values(name, found, alternating=log_type, groups=None if groups is None else F.col(_GROUPS))
        columns[name] = typed(values, types[name]) if types and name in types else values
    if rules.has_timestamps:
        columns[TIMESTAMPS] = matcher.values(TIMESTAMP, found, alternating=log_type)
    if log_type:
        columns[LOG_TYPE] = matcher.log_type(found)
    if into:
        columns = {into: F.struct(*[column.alias(name) for name, column in columns.items()])}
    taken = {name.lower() for name in df.columns}
    for name in columns:
        if name.lower() in taken:
            raise ValueError(f"the input has a column {name!r} already: rename it or use into=")
    scan = matcher.pieces(source) if log_type else matcher.matches(source)
    scanned = with_helper(df, _FOUND, scan, scan_once)
    if groups is not None:
        scanned = with_helper(scanned, _GROUPS, groups, scan_once)
    return scanned.select(*[F.col(f"`{name}`") for name in df.columns], *[
        column.alias(name) for name, column in columns.items()
    ])


def matched(rules: RuleSet) -> Column:
    """Did any capture of the rule set match? For use on the result of ``extract``."""
    columns = [F.size(name) > 0 for name in rules.capture_names]
    columns += [F.size(TIMESTAMPS) > 0] if rules.has_timestamps else []
    test = columns[0]
    for column in columns[1:]:
        test = test | column
    return test
