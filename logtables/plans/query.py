"""A fluent query over parsed logs. It only builds a lazy DataFrame; Spark does the rest."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtables.functions.accessors import as_text
from logtables.operators import analytics
from logtables.operators.events import MESSAGE
from logtables.operators.extract import LOG_TYPE, TIMESTAMPS, extract
from logtables.operators.jsonlogs import OBJECT, field_text, object_json
from logtables.plans.parser import JsonLogParser, LogParser
from logtables.rules import RuleSet
from logtables.sources.text import BLOCK, LINE, SOURCE, TEXT

_ORDER = "__order"
# Names for the generated template and the original message.
META = {"@log_type": LOG_TYPE, "@log_message": MESSAGE}


class LogQuery:
    """Select fields of log events, filter, count and export.

    >>> (LogQuery(rules).select(["user", "amount"]).filter("double(amount) > 50")
    ...     .from_("/logs/*.log").to_dataframe())

    Fields of text logs are capture names, ``timestamp``, ``@log_type``, ``@log_message`` and ``*`` for all
    captures; a field is text: NULL without a value, a JSON array for several. With ``raw_output`` it is the
    array of all values. Fields of JSON logs are dotted paths into the enriched object.

    Filters are Columns or SQL text. Text logs offer all fields and the input's own columns as columns;
    JSON logs offer the input's columns and ``object``, and ``field("a.b")`` makes a Column of a path.
    """

    def __init__(self, parser: LogParser | JsonLogParser | RuleSet, raw_output: bool = False):
        self.parser = LogParser(rules=parser) if isinstance(parser, RuleSet) else parser
        self.raw_output = raw_output
        self._fields: list[str] | None = None
        self._filters: list[Column] = []
        self._source = None
        self._options: dict = {}
        self._order: list[str] | None = None

    # ------------------------------------------------------------ building
    @property
    def is_json(self) -> bool:
        return isinstance(self.parser, JsonLogParser)

    @property
    def capture_names(self) -> tuple[str, ...]:
        parser = self.parser.parser if self.is_json else self.parser
        return parser.rules.capture_names

    def select(self, fields: str | Sequence[str]) -> LogQuery:
        names = [fields] if isinstance(fields, str) else list(fields)
        if not self.is_json:
            every = list(self.capture_names)
            names = [n for name in names for n in (every if name == "*" else [name])]
        self._fields = names
        return self

    def filter(self, predicate: Column | str) -> LogQuery:
        """Keep events for which the predicate holds; several calls are combined with AND."""
        self._filters.append(F.expr(predicate) if isinstance(predicate, str) else predicate)
        return self

    def replace_filter(self, predicate: Column | str) -> LogQuery:
        """Forget earlier filters and use this one."""
        self._filters = []
        return self.filter(predicate)

    @staticmethod
    def field(path: str) -> Column:
        """A path of a JSON log, as text, for use in filters."""
        return field_text(F.col(OBJECT), path)

    def from_(self, source, text: str = TEXT, order: str | Sequence[str] | None = None, **options) -> LogQuery:
        """The input: a DataFrame with a text column, or paths. ``order`` names columns of a DataFrame that
        say what comes first. ``multiline`` (text) and ``layout``, ``strict`` (JSON) go to the parser."""
        if not isinstance(source, DataFrame):
            paths = [source] if isinstance(source, str) else source
            if not isinstance(paths, (list, tuple)) or not all(isinstance(p, str) for p in paths):
                raise TypeError(f"the input must be a DataFrame or paths, not {type(source).__name__}")
            order = order or [SOURCE, BLOCK, LINE]
        self._source, self._options = source, {"text": text, **options}
        self._order = [order] if isinstance(order, str) else list(order) if order else None
        return self

    select_from = from_

    def validate_query(self) -> LogQuery:
        """Check that fields and input are set and, by Spark's analysis, that all names exist."""
        self._check_parts()
        self.to_dataframe()
        return self

    def _check_parts(self) -> None:
        if self._fields is None:
            raise AttributeError("select the fields first")
        if not self._fields:
            raise AttributeError("the list of fields is empty")
        if self._source is None:
            raise AttributeError("set the input with from_() first")

    # ------------------------------------------------------------ plan
    def _events(self, log_type: bool) -> DataFrame:
        if self._source is None:
            raise AttributeError("set the input with from_() first")
        source = self._source
        if self._order is None and isinstance(source, DataFrame) and not source.isStreaming:
            source = source.withColumn(_ORDER, F.monotonically_increasing_id())
        if self.is_json:
            events = self.parser.parse(source, scan_once=bool(self._filters), **self._options)
        else:
            rules = self.parser.checked_rules()
            # captures first stay arrays in a struct, so that they cannot clash with input columns
            events = extract(
                self.parser.events(source, **self._options), rules, MESSAGE, log_type=log_type, into="__event",
                scan_once=bool(self._filters),
            )
            names = [*rules.capture_names, *([TIMESTAMPS] if rules.has_timestamps else [])]
            columns = {}
            for name in names:
                values = F.col(f"__event.`{name}`")
                shown = "timestamp" if name == TIMESTAMPS else name
                columns[shown] = values if self.raw_output else as_text(values)
            if log_type:
                columns[LOG_TYPE] = F.col("__event").getField(LOG_TYPE)
            events = events.select(
                *[F.col(f"`{name}`") for name in events.columns if name != "__event" and name not in columns],
                *[column.alias(name) for name, column in columns.items()],
            )
        for predicate in self._filters:
            events = events.where(predicate)
        return events

    def _checked_events(self, log_type: bool) -> DataFrame:
        """The events; the log type is made if it is asked for or a filter cannot be resolved without it."""
        try:
            return self._events(log_type)
        except AnalysisException:
            if log_type or not self._filters:
                raise
            return self._events(True)

    def to_dataframe(self) -> DataFrame:
        self._check_parts()
        events = self._checked_events("@log_type" in self._fields)
        if self.is_json:
            return events.select(*[
                (F.col(f"`{name}`") if name in events.columns and name != OBJECT else self.field(name)).alias(name)
                for name in self._fields
            ])
        return events.select(*[F.col(f"`{META.get(name, name)}`").alias(name) for name in self._fields])

    to_df = to_dataframe

    # ------------------------------------------------------------ export
    def map_arrow(self, function, schema) -> DataFrame:
        """Hand the result to a function as Arrow batches, in the tasks: it gets and gives iterators of them."""
        return self.to_dataframe().mapInArrow(function, schema)

    def arrow_streams(self) -> DataFrame:
        """The result as Arrow IPC streams, one per batch of a task: (n_rows, stream). A stream can be stored or sent, and read by itself."""

        def write(batches):
            for batch in batches:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as stream:
                    stream.write_batch(batch)
                made = [pa.array([batch.num_rows], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["n_rows", "stream"])

        return self.map_arrow(write, "n_rows bigint, stream binary")

    def to_arrow(self):
        """The result as an Arrow table. It all goes to the driver's memory; ``map_arrow`` stays in the tasks."""
        return self.to_dataframe().toArrow()

    to_pa = to_arrow

    def to_pandas(self):
        return self.to_dataframe().toPandas()

    def get_rows(self) -> list[list]:
        """The result as lists. It all goes to the driver's memory; ``iterate_rows`` goes through it part by part."""
        return [list(row) for row in self.to_dataframe().collect()]

    def iterate_rows(self):
        return (list(row) for row in self.to_dataframe().toLocalIterator())

    def row_lists(self) -> DataFrame:
        """The result as one list of texts per row, ``row array<string>``: ``get_rows`` without the driver."""
        found = self.to_dataframe()
        return found.select(F.array(*(F.col(f"`{name}`").cast("string") for name in found.columns)).alias("row"))

    def to_parquet(self, path: str, mode: str = "errorifexists") -> None:
        self.to_dataframe().write.mode(mode).parquet(path)

    # ------------------------------------------------------------ log types
    def _typed_events(self) -> tuple[DataFrame, list[str], str]:
        events = self._events(log_type=True)
        order = self._order or [_ORDER]
        if not self.is_json:
            return events, order, MESSAGE
        types = events.withColumn(LOG_TYPE, F.explode(self.parser.log_type_of()))
        return types.withColumn("__json", object_json(F.col(OBJECT))), order, "__json"

    def get_log_types(self) -> DataFrame:
        """Each log type once, in the order of first appearance."""
        events, order, _ = self._typed_events()
        return analytics.log_types(events, order)

    def get_log_type_counts(self) -> DataFrame:
        return analytics.log_type_counts(self._typed_events()[0])

    def get_log_type_with_sample(self, sample_size: int = 3) -> DataFrame:
        """The first messages of each log type (JSON logs: the enriched objects as text)."""
        events, order, message = self._typed_events()
        return analytics.log_type_samples(events, message, order, sample_size)
