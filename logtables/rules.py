"""Rule sets: what to look for in a log text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from functools import cached_property

from logtables.functions import dialect

# Delimiters used when the user gives none, and names the output columns need.
DEFAULT_DELIMITERS = " \t\r\n:,!;%@/()[]"
TIMESTAMP = "timestamp"
RESERVED = frozenset({"timestamp", "timestamps", "log_type", "log_message"})

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class Rule:
    name: str
    regex: str
    priority: int = 0
    is_timestamp: bool = False
    node: object = field(default=None, repr=False, compare=False)

    @property
    def capture_names(self) -> list[str]:
        return dialect.captures(self.node)


@dataclass(frozen=True)
class RuleSet:
    """An immutable set of rules; ``var`` and ``timestamp`` return a larger one.

    >>> RuleSet().var("metric", r"metric=(?<name>[a-z]+) value=(?<value>[0-9]+)")
    """

    delimiters: str = DEFAULT_DELIMITERS
    rules: tuple[Rule, ...] = ()
    right_boundary: bool = True

    @classmethod
    def with_delimiters(cls, delimiters: str, **options) -> RuleSet:
        """Delimiters may be written with escapes, as in ``r" \\t\\n,:"``."""
        decoded = delimiters.encode("latin-1", "backslashreplace").decode("unicode_escape")
        if not decoded:
            raise ValueError("at least one delimiter is needed")
        return cls(delimiters=decoded, **options)

    @cached_property
    def delimiter_ranges(self) -> dialect.Ranges:
        return dialect.of_text(self.delimiters)

    def var(self, name: str, regex: str, priority: int = 0) -> RuleSet:
        """Add an extraction rule; it needs at least one named capture ``(?<name>...)``."""
        rule = Rule(name, regex, priority, node=self._parse(name, regex))
        if any(name == other.name for other in self.rules if not other.is_timestamp):
            raise ValueError(f"rule {name!r} exists already")
        names = rule.capture_names
        if not names:
            raise ValueError(f"rule {name!r} needs at least one named capture: {regex!r}")
        for capture in names:
            if not _NAME.fullmatch(capture):
                raise ValueError(f"rule {name!r}: bad capture name {capture!r}")
            if capture.lower() in RESERVED:
                raise ValueError(f"rule {name!r}: capture name {capture!r} is reserved")
            for known in self.capture_names:
                if known != capture and known.lower() == capture.lower():
                    raise ValueError(f"captures {known!r} and {capture!r} differ only by case")
        if len({capture.lower() for capture in names}) < len(names):
            raise ValueError(f"rule {name!r}: capture names must differ by more than case")
        RuleSet(self.delimiters, (rule,), self.right_boundary).matcher  # refuses what no regex can be built for
        return replace(self, rules=(*self.rules, rule))

    def timestamp(self, name: str, regex: str) -> RuleSet:
        """Add a timestamp rule: found at the start of a line, it begins a new event.

        A second timestamp of the same name replaces the first.
        """
        node = dialect.Capture(TIMESTAMP, dialect.without_captures(self._parse(name, regex)))
        rule = Rule(name, regex, is_timestamp=True, node=node)
        RuleSet(self.delimiters, (rule,), self.right_boundary).matcher  # refuses what no regex can be built for
        if any(other.is_timestamp and other.name == name for other in self.rules):
            kept = tuple(
                rule if other.is_timestamp and other.name == name else other for other in self.rules
            )
            return replace(self, rules=kept)
        return replace(self, rules=(*self.rules, rule))

    def _parse(self, name: str, regex: str):
        node = dialect.parse(regex, self.delimiter_ranges)
        if dialect.width(node)[0] == 0:
            raise ValueError(f"rule {name!r} can match the empty text: {regex!r}")
        return node

    @property
    def ordered(self) -> tuple[Rule, ...]:
        """Timestamps first, then by falling priority; ties keep the order of definition."""
        timestamps = [rule for rule in self.rules if rule.is_timestamp]
        variables = [rule for rule in self.rules if not rule.is_timestamp]
        return (*timestamps, *sorted(variables, key=lambda rule: -rule.priority))

    @property
    def has_timestamps(self) -> bool:
        return any(rule.is_timestamp for rule in self.rules)

    @property
    def capture_names(self) -> tuple[str, ...]:
        """Names of all captures, in rule order, without the timestamp."""
        names = (n for rule in self.ordered if not rule.is_timestamp for n in rule.capture_names)
        return tuple(dict.fromkeys(names))

    @cached_property
    def matcher(self):
        from logtables.functions.matching import Matcher

        return Matcher(self)

    def validate(self, spark=None) -> RuleSet:
        """Check the set as a whole; with a session, also let Spark compile the resulting regex."""
        if not self.rules:
            raise RuntimeError("no rule was added")
        pattern = self.matcher.find
        if spark is not None:
            from pyspark.sql import functions as F

            spark.range(1).select(F.regexp_like(F.lit(" "), F.lit(pattern))).collect()
        return self
