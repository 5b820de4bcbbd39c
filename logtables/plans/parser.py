"""Parser objects that hold settings and give DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.operators import jsonlogs
from logtables.operators.events import MESSAGE, assemble_events, first_event, split_events
from logtables.operators.extract import extract
from logtables.rules import RuleSet
from logtables.sources.json import json_objects, read_json_logs
from logtables.sources.text import BLOCK, LINE, SOURCE, TEXT, as_logs, from_strings, text_column


class LogParser:
    """Collects rules step by step and applies them to text logs.

    >>> parser = LogParser()
    >>> parser.add_var("metric", r"metric=(?<name>[a-z]+) value=(?<value>[0-9]+)")
    >>> parser.compile()
    >>> parser.parse("/logs/*.log")
    """

    def __init__(self, delimiters: str | None = None, rules: RuleSet | None = None):
        if rules is None:
            rules = RuleSet() if delimiters is None else RuleSet.with_delimiters(delimiters)
        self.rules = rules
        self._compiled = bool(rules.rules)

    def add_var(self, name: str, regex: str, priority: int = 0) -> LogParser:
        self.rules = self.rules.var(name, regex, priority)
        self._compiled = False
        return self

    def add_timestamp(self, name: str, regex: str) -> LogParser:
        self.rules = self.rules.timestamp(name, regex)
        self._compiled = False
        return self

    def compile(self) -> LogParser:
        """Check the rules as a whole; needed before parsing."""
        self.rules.validate(SparkSession.getActiveSession())
        self._compiled = True
        return self

    def get_vars(self) -> list[str]:
        """The names of all captures."""
        return list(self.rules.capture_names)

    def checked_rules(self) -> RuleSet:
        if not self._compiled:
            raise RuntimeError("call compile() before parsing")
        return self.rules

    def events(self, source, text: str = TEXT, multiline: bool = False) -> DataFrame:
        """The events of a source, not yet mined, in the column ``message``.

        Paths are read as lines and, if there are timestamp rules, put together to events. Rows of a
        DataFrame are events already, unless ``multiline`` says that each holds a text of several events.
        """
        rules = self.checked_rules()
        if isinstance(source, DataFrame):
            text_column(source, text)
            events = split_events(source, rules, text) if multiline else source.withColumn(
                text, text_column(source, text)
            )
            return events.withColumnRenamed(text, MESSAGE)
        lines = as_logs(SparkSession.getActiveSession(), source)
        if not rules.has_timestamps:
            return lines.withColumnRenamed(TEXT, MESSAGE)
        return assemble_events(lines, rules, TEXT, source=SOURCE, order=[BLOCK, LINE], chunk=BLOCK)

    def parse(self, source, text: str = TEXT, multiline: bool = False, **options) -> DataFrame:
        """The events with one column per capture, ``log_type`` and ``timestamps``."""
        return extract(self.events(source, text, multiline), self.checked_rules(), MESSAGE, **options)

    def parse_event(self, source, text: str = TEXT, **options) -> DataFrame:
        """The first event of each row, mined."""
        rules = self.checked_rules()
        if isinstance(source, (str, bytes)):
            source = from_strings(SparkSession.getActiveSession(), [source])
        first = source.withColumn(text, first_event(text_column(source, text), rules))
        return extract(first.withColumnRenamed(text, MESSAGE), rules, MESSAGE, **options)


class JsonLogParser:
    """Settings for mining JSON logs: which fields, where the captures go, with or without log type."""

    def __init__(self, parser: LogParser | RuleSet):
        self.parser = parser if isinstance(parser, LogParser) else LogParser(rules=parser)
        self._fields: str | Sequence[str] = jsonlogs.ALL_STRINGS
        self._conflict = {"on_conflict": jsonlogs.NEST}
        self._log_type = False

    def target_fields(self, fields: str | Sequence[str]) -> JsonLogParser:
        jsonlogs.check_fields(fields)
        self._fields = fields
        return self

    def on_conflict(self, strategy: str, *, key: str = jsonlogs.EXTRACTED_KEY,
                    prefix: str = jsonlogs.EXTRACTED_PREFIX) -> JsonLogParser:
        self._conflict = {"on_conflict": strategy, "key": key, "prefix": prefix}
        return self

    def include_log_type(self, include: bool = True) -> JsonLogParser:
        self._log_type = include
        return self

    def log_type_of(self, object_column: str = jsonlogs.OBJECT):
        """All log types an enriched object holds, as an array, wherever this parser put them."""
        entries = F.col(object_column)
        strategy, key = self._conflict["on_conflict"], self._conflict.get("key", jsonlogs.EXTRACTED_KEY)
        if strategy == jsonlogs.NEST:
            value = F.try_variant_get(entries[key], '$["@log_type"]', "variant")
        elif strategy == jsonlogs.PREFIX:
            value = entries[self._conflict["prefix"] + jsonlogs.LOG_TYPE_KEY]
        else:
            value = entries[jsonlogs.LOG_TYPE_KEY]
        one = F.array_compact(F.array(F.try_variant_get(value, "$", "string")))
        many = F.try_variant_get(value, "$", "array<string>")
        return F.when(F.schema_of_variant(value).startswith("ARRAY"), many).otherwise(one)

    def objects(self, source, text: str = TEXT, layout: str | None = None, strict: bool = True) -> DataFrame:
        """The JSON objects of a source, one text per row. Paths are read as lines unless told otherwise."""
        if isinstance(source, DataFrame):
            return json_objects(source, text, layout or "auto", strict)
        return read_json_logs(SparkSession.getActiveSession(), source, layout or "lines", strict)

    def parse(self, source, text: str = TEXT, layout: str | None = None, strict: bool = True,
              **options) -> DataFrame:
        """The enriched objects, in the column ``object``."""
        rows = self.objects(source, text, layout, strict)
        return self._enriched(rows, text, strict, **options)

    def parse_one(self, df: DataFrame, text: str = TEXT, strict: bool = True, **options) -> DataFrame:
        """Each row of the column is one JSON object, possibly over several lines."""
        return self._enriched(df.withColumn(text, text_column(df, text)), text, strict, **options)

    def _enriched(self, rows: DataFrame, text: str, strict: bool, **options) -> DataFrame:
        return jsonlogs.enrich_json(
            rows, self.parser.checked_rules(), text, fields=self._fields, log_type=self._log_type,
            strict=strict, **self._conflict, **options,
        )
