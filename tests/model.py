"""The matching rules written down as slowly and plainly as possible, to test the Spark expressions."""

import re
from dataclasses import dataclass


@dataclass
class ModelRule:
    name: str
    regex: str  # Python syntax
    priority: int = 0
    is_timestamp: bool = False


def ordered(rules):
    stamps = [r for r in rules if r.is_timestamp]
    return stamps + sorted((r for r in rules if not r.is_timestamp), key=lambda r: -r.priority)


def scan(rules, text, delimiters):
    """All winning matches as (start, end, rule)."""
    found, position = [], 0
    for start in range(len(text)):
        if start < position or (start > 0 and text[start - 1] not in delimiters):
            continue
        best = None
        for rule in ordered(rules):
            for end in range(len(text), start, -1):
                if end < len(text) and text[end] not in delimiters:
                    continue
                if re.fullmatch(rule.regex, text[start:end]):
                    if best is None or end > best[1]:
                        best = (start, end, rule)
                    break
        if best:
            found.append(best)
            position = best[1]
    return found


def parse(rules, text, delimiters):
    """Captures (name to list of values) and log type of one event."""
    captures, log_type, cursor = {}, "", 0
    for start, end, rule in scan(rules, text, delimiters):
        log_type += text[cursor:start]
        part = text[start:end]
        if rule.is_timestamp:
            captures.setdefault("timestamps", []).append(part)
            log_type += "<timestamp>"
        else:
            match = re.fullmatch(rule.regex, part)
            at = 0
            spans = sorted((match.span(n), n) for n in match.groupdict() if match.span(n)[0] >= 0)
            for (a, b), name in spans:
                captures.setdefault(name, []).append(match[name])
                if a < at:
                    continue  # inside another capture
                log_type += part[at:a] + f"<{name}>"
                at = b
            log_type += part[at:]
        cursor = end
    return captures, log_type + text[cursor:]
