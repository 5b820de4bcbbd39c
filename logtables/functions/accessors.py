"""Columns over extracted captures. A capture is an ``array<string>``: empty when it did not match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtables.functions import dialect


def let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scalar(capture: Column) -> Column:
    """The first value, NULL if there is none."""
    return F.get(capture, F.lit(0))


def scalar_or_list(capture: Column) -> Column:
    """A VARIANT: NULL without a value, a string for one value, an array for several."""
    return let(capture, lambda values: F.when(
        F.size(values) == 1, F.get(values, F.lit(0)).cast("variant")
    ).when(F.size(values) > 1, values.cast("variant")))


def as_text(capture: Column) -> Column:
    """NULL without a value, the value itself for one, a JSON array for several."""
    return let(capture, lambda values: F.when(
        F.size(values) == 1, F.get(values, F.lit(0))
    ).when(F.size(values) > 1, F.to_json(values)))


def strict(capture: Column, name: str) -> Column:
    """The first value; the query fails on an event without one."""
    return F.coalesce(
        F.get(capture, F.lit(0)), F.raise_error(F.lit(f"capture '{name}' has no value in this event"))
    )


def variables(captures: dict[str, Column]) -> Column:
    """Map of all captures that matched."""
    names = F.array(*[F.lit(name) for name in captures])
    filled = F.map_from_arrays(names, F.array(*captures.values()))
    return F.map_filter(filled, lambda _, values: F.size(values) > 0)


def event_json(captures: dict[str, Column], log_type: Column | None = None, pretty: bool = False) -> Column:
    """JSON text of an event: a string for one value, an array for several, nothing for none."""
    entries = {name: scalar_or_list(values) for name, values in captures.items()}
    if log_type is not None:
        entries["@LogType"] = log_type.cast("variant")
    names = F.array(*[F.lit(name) for name in entries])
    filled = F.map_from_arrays(names, F.array(*entries.values()))
    shown = F.map_filter(filled, lambda _, value: value.isNotNull())
    return F.to_json(shown, {"pretty": "true"} if pretty else {})


def typed(capture: Column, data_type: str) -> Column:
    """Values cast to a type; a value that cannot be cast becomes NULL."""
    return F.transform(capture, lambda value: value.try_cast(data_type))


def event_time(timestamps: Column, *formats: str) -> Column:
    """The first timestamp of the event, read with the first of the formats that fits."""
    first = F.get(timestamps, F.lit(0))
    return F.coalesce(*[F.try_to_timestamp(first, F.lit(pattern)) for pattern in formats])


def tokens(text: Column, rules) -> Column:
    """The text cut at the delimiters of the rule set."""
    inside = dialect.java_class(dialect.complement(rules.delimiter_ranges))
    return F.regexp_extract_all(text, F.lit(f"{inside}+"), F.lit(0))
