r"""Enrich JSON logs with captures found in their string values.

An object is carried as ``map<string, variant>``: any keys and any value types, without a schema. The
strings to mine are either given paths, or all string values at any depth in document order. For the
latter the JSON text itself is scanned: a string literal that is not followed by a colon is a value.
"""

from __future__ import annotations

from collections.abc import Sequence
from enum import StrEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.functions.accessors import scalar_or_list
from logtables.operators.events import first_event
from logtables.operators.extract import with_helper
from logtables.rules import RuleSet
from logtables.sources.text import TEXT

OBJECT, CONFLICTS, CORRUPT = "object", "conflicts", "_corrupt_record"
ALL_STRINGS = "*"


class ConflictStrategy(StrEnum):
    """Where captures go. The plain names work as well."""

    NEST = "nest"
    PREFIX = "prefix"
    OVERWRITE = "overwrite"
    RAISE = "raise"


NEST, PREFIX, OVERWRITE, RAISE = ConflictStrategy
# Names in the enriched objects.
EXTRACTED_KEY, EXTRACTED_PREFIX = "extracted", "extracted."
ORIGINAL_VALUE, LOG_TYPE_KEY = "original_value", "@log_type"

_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_STRING_VALUES = rf"{_LITERAL}\s*+:|({_LITERAL})"


def parse_object(text: Column, strict: bool = True) -> Column:
    """The object in a JSON text; a key given twice has its last value."""
    entries = F.from_json(text, "map<string,variant>", {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    keys = F.map_keys(entries)
    last = F.filter(
        F.map_entries(entries),
        lambda entry, i: F.array_position(F.reverse(keys), entry["key"]) == F.size(keys) - i,
    )
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.when(unique, entries).when(~unique, F.map_from_entries(last))


def _steps(path: Sequence[str]) -> str:
    return "$" + "".join('["' + step.replace("\\", "\\\\").replace('"', '\\"') + '"]' for step in path)


def value_at(entries: Column, path: str) -> Column:
    """The value at a dotted path, as VARIANT; a key that equals the whole path goes first."""
    parts = path.split(".")
    value = entries[parts[0]]
    if len(parts) == 1:
        return value
    return F.coalesce(entries[path], F.try_variant_get(value, _steps(parts[1:]), "variant"))


def string_at(entries: Column, path: str) -> Column:
    """The string at a dotted path; NULL if there is none or it is no string."""
    parts = path.split(".")
    value = entries[parts[0]]
    if len(parts) > 1:
        value = F.try_variant_get(value, _steps(parts[1:]), "variant")
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))


def all_strings(text: Column) -> Column:
    """All string values of a JSON text, at any depth, in document order."""
    literals = F.filter(F.regexp_extract_all(text, F.lit(_STRING_VALUES), F.lit(1)), lambda s: s != "")
    return F.from_json(F.concat(F.lit("["), F.array_join(literals, ","), F.lit("]")), "array<string>")


def check_fields(fields: str | Sequence[str]) -> list[str] | None:
    """The paths to mine; None stands for all strings."""
    names = [fields] if isinstance(fields, str) else list(fields)
    if not names:
        raise ValueError("fields cannot be empty: name at least one field, or use '*'")
    return None if ALL_STRINGS in names else names


def _mined(rules: RuleSet, strings: Column, log_type: bool, all_events: bool) -> Column:
    """Per string, its pieces (with log type) or matches (without)."""
    matcher = rules.matcher
    scan = matcher.pieces if log_type else matcher.matches
    if all_events:
        texts = F.flatten(F.transform(strings, matcher.events))
    else:
        texts = F.transform(strings, lambda text: first_event(text, rules))
    return F.transform(texts, scan)


def _captures(rules: RuleSet, found: Column, log_type: bool) -> dict[str, Column]:
    matcher = rules.matcher

    def values(name: str) -> Column:
        return F.flatten(F.transform(found, lambda one: matcher.values(name, one, alternating=log_type)))

    columns = {name: values(name) for name in rules.capture_names}
    if log_type:
        columns[LOG_TYPE_KEY] = F.transform(found, matcher.log_type)
    return columns


def enrich_json(
    df: DataFrame,
    rules: RuleSet,
    text: str = TEXT,
    *,
    fields: str | Sequence[str] = ALL_STRINGS,
    on_conflict: str = NEST,
    key: str = EXTRACTED_KEY,
    prefix: str = EXTRACTED_PREFIX,
    log_type: bool = False,
    all_events: bool = False,
    strict: bool = True,
    keep_text: bool = False,
    observe: str | None = None,
    scan_once: bool = False,
) -> DataFrame:
    """Mine each JSON object for captures and merge them into it.

    Replaces the text column by ``object`` (``map<string, variant>``) and ``conflicts``, the keys that were
    taken already. ``on_conflict`` says where captures go: "nest" (under ``key``; a value that was there is
    kept as "original_value"), "prefix", "overwrite" or "raise". The first event of each string is mined,
    or every event with ``all_events``. With ``strict=False`` text that is no JSON object gives a NULL object
    and is kept in ``_corrupt_record``. ``observe`` names a metric that counts conflicts.
    ``scan_once`` is for results that are filtered by fields of the object.
    """
    if on_conflict not in list(ConflictStrategy):
        raise ValueError(f"unknown conflict handling {on_conflict!r}")
    for name in (OBJECT, CONFLICTS):
        if name in df.columns:
            raise ValueError(f"the input has a column {name!r} already: rename it")
    paths = check_fields(fields)
    source = F.col(f"`{text}`")
    others = [F.col(f"`{name}`") for name in df.columns if keep_text or name != text]

    base = with_helper(df, "__object", parse_object(source, strict), scan_once)
    entries = F.col("__object")
    strings = all_strings(source) if paths is None else F.array_compact(
        F.array(*[string_at(entries, path) for path in paths])
    )
    mined = with_helper(base, "__found", _mined(rules, strings, log_type, all_events), scan_once)
    columns = _captures(rules, F.col("__found"), log_type)
    filled = F.map_from_arrays(
        F.array(*[F.lit(name) for name in columns]),
        F.array(*[scalar_or_list(values) for values in columns.values()]),
    )
    matched = F.map_filter(filled, lambda _, value: value.isNotNull())
    extracted = with_helper(mined, "__extracted", matched, scan_once)
    new = F.col("__extracted")

    if on_conflict == NEST:
        taken = F.map_contains_key(entries, key)
        original = F.create_map(F.lit(ORIGINAL_VALUE), entries[key])
        inner = F.when(
            taken, F.map_concat(F.map_filter(new, lambda k, _: k != ORIGINAL_VALUE), original)
        ).otherwise(new)
        rest = F.when(taken, F.map_filter(entries, lambda k, _: k != key)).otherwise(entries)
        result = F.map_concat(rest, F.create_map(F.lit(key), F.to_variant_object(inner)))
        clash = taken & F.map_contains_key(new, ORIGINAL_VALUE)
        conflicts = F.when(clash, F.array(F.lit(ORIGINAL_VALUE))).otherwise(
            F.array().cast("array<string>")
        )
    else:
        if on_conflict == PREFIX:
            new = F.transform_keys(new, lambda k, _: F.concat(F.lit(prefix), k))
        conflicts = F.array_intersect(F.map_keys(new), F.map_keys(entries))
        rest = F.when(
            F.size(conflicts) > 0, F.map_filter(entries, lambda k, _: ~F.map_contains_key(new, k))
        ).otherwise(entries)
        result = F.map_concat(rest, new)
        if on_conflict == RAISE:
            message = F.concat(F.lit("keys exist in the JSON object already: "), F.array_join(conflicts, ", "))
            # without strict the object is reported like text that is not JSON
            refused = F.raise_error(message) if strict else F.lit(None)
            result = F.when(F.size(conflicts) > 0, refused).otherwise(result)
    out = extracted.select(
        *others,
        result.alias(OBJECT),
        conflicts.alias(CONFLICTS),
        *([] if strict else [F.when(entries.isNull() | result.isNull(), source).alias(CORRUPT)]),
    )
    if observe:
        out = out.observe(observe, F.sum(F.size(CONFLICTS)).alias("conflicts"))
    return out


def field_text(entries: Column, path: str) -> Column:
    """The value at a path as text: strings as they are, lists and objects as JSON."""
    return value_at(entries, path).cast("string")


def object_json(entries: Column) -> Column:
    """JSON text of an object."""
    return F.to_json(entries)


def _leaves(column: Column, data_type: T.DataType) -> Column | None:
    """All strings inside a column of known type, in schema order, as one array."""
    if isinstance(data_type, T.StringType):
        return F.array(column)
    if isinstance(data_type, T.StructType):
        parts = [_leaves(column[f.name], f.dataType) for f in data_type.fields]
        parts = [part for part in parts if part is not None]
        return F.flatten(F.array(*parts)) if parts else None
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        is_map = isinstance(data_type, T.MapType)
        inner_type = data_type.valueType if is_map else data_type.elementType
        items = F.map_values(column) if is_map else column
        if isinstance(inner_type, T.StringType):
            return F.coalesce(items, F.array().cast("array<string>"))
        if _leaves(F.lit(None), inner_type) is None:
            return None
        inner = F.flatten(F.transform(items, lambda item: _leaves(item, inner_type)))
        return F.coalesce(inner, F.array().cast("array<string>"))
    return None


def enrich_columns(
    df: DataFrame,
    rules: RuleSet,
    fields: str | Sequence[str] = ALL_STRINGS,
    *,
    key: str = EXTRACTED_KEY,
    log_type: bool = False,
    all_events: bool = False,
) -> DataFrame:
    """The same for a table with typed (also nested) columns: adds a struct of ``array<string>`` captures.

    A value the column ``key`` had before is kept inside as "original_value".
    """
    paths = check_fields(fields)
    if paths is None:
        picked = [(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    else:
        picked = [(F.col(path), df.select(path).schema[0].dataType) for path in paths]
        picked = [(column, t) for column, t in picked if isinstance(t, T.StringType)]
    parts = [_leaves(column, data_type) for column, data_type in picked]
    parts = [part for part in parts if part is not None]
    strings = F.array_compact(F.flatten(F.array(*parts))) if parts else F.array().cast("array<string>")
    mined = with_helper(df, "__found", _mined(rules, strings, log_type, all_events), scan_once=False)
    columns = _captures(rules, F.col("__found"), log_type)
    if key in df.columns:
        columns[ORIGINAL_VALUE] = F.col(f"`{key}`")
    inner = F.struct(*[column.alias(name) for name, column in columns.items()])
    return mined.withColumn(key, inner).drop("__found")
