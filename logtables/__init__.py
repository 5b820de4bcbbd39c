"""Turn semi-structured logs into tables on Spark."""

from logtables.operators.extract import extract
from logtables.operators.jsonlogs import ConflictStrategy, enrich_columns, enrich_json
from logtables.operators.events import assemble_events, line_events, split_events
from logtables.patterns import PATTERN
from logtables.plans.parser import JsonLogParser, LogParser
from logtables.plans.query import LogQuery
from logtables.rules import Rule, RuleSet

__all__ = [
    "PATTERN", "ConflictStrategy", "JsonLogParser", "LogParser", "LogQuery",
    "Rule", "RuleSet",
    "assemble_events", "enrich_columns", "enrich_json", "extract", "line_events", "split_events",
]
