r"""The rule dialect and its translation to Java regex text. Runs on the driver only, once per rule set.

A small reader turns a rule into nodes and refuses what the dialect does not have; the nodes are written back as
Java regex. Every character class becomes an explicit set of code points, so nested classes,
``&&`` and shorthand escapes cannot change meaning between the two regex flavours.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

MAX_CODE = 0x10FFFF
END = MAX_CODE + 1  # stands for "end of text" in head sequences

# What the shorthand escapes stand for.
SHORTHAND = {
    "d": ((0x30, 0x39),),
    "s": ((0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x20)),
    "w": ((0x30, 0x39), (0x41, 0x5A), (0x5F, 0x5F), (0x61, 0x7A)),
}
#: Options of alternations, and combinations of several optional parts, that are written out one by one; rules with more are
#: matched and read in other ways.
MOST_OPTIONS = 4096
MOST_COMBINATIONS = 64
HEAD_LENGTH = 24
HEAD_COUNT = 96

Ranges = tuple[tuple[int, int], ...]


# ---------------------------------------------------------------- sets of code points
def union(ranges) -> Ranges:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return tuple(out)


def complement(ranges: Ranges) -> Ranges:
    out, start = [], 0
    for lo, hi in ranges:
        if lo > start:
            out.append((start, lo - 1))
        start = hi + 1
    if start <= MAX_CODE:
        out.append((start, MAX_CODE))
    return tuple(out)


def overlap(a: Ranges, b: Ranges) -> bool:
    return any(x[0] <= y[1] and y[0] <= x[1] for x in a for y in b)


def of_text(chars: str) -> Ranges:
    return union((ord(c), ord(c)) for c in chars)


# ---------------------------------------------------------------- pattern nodes
@dataclass(frozen=True)
class Chars:
    ranges: Ranges


@dataclass(frozen=True)
class Seq:
    items: tuple


@dataclass(frozen=True)
class Alt:
    options: tuple


@dataclass(frozen=True)
class Repeat:
    low: int
    high: int | None
    item: object


@dataclass(frozen=True)
class Capture:
    name: str
    item: object


def seq(*nodes) -> Seq:
    flat: list = []
    for node in nodes:
        flat.extend(node.items if isinstance(node, Seq) else (node,))
    return Seq(tuple(flat))


class RuleSyntaxError(ValueError):
    """The rule is not valid in the dialect."""


_CONTROL = {"t": 0x09, "n": 0x0A, "r": 0x0D, "f": 0x0C, "v": 0x0B, "a": 0x07}
_HEX = {"x": 2, "u": 4, "U": 8}
_QUANTIFIER = re.compile(r"\{(\d*)(?:(,)(\d*))?\}")
_GROUP_NAME = re.compile(r"\?P?<([^<>()=!]*)>")


class _Reader:
    """Reads one rule from left to right."""

    def __init__(self, pattern: str, delimiters: Ranges):
        self.pattern, self.at, self.any_char = pattern, 0, complement(delimiters)
        self.names: set[str] = set()

    def invalid(self, why: str) -> RuleSyntaxError:
        return RuleSyntaxError(f"invalid regex {self.pattern!r}: {why} at position {self.at}")

    def refused(self, what: str) -> RuleSyntaxError:
        return RuleSyntaxError(f"{what} are not supported: {self.pattern!r}")

    def peek(self, text: str) -> bool:
        return self.pattern.startswith(text, self.at)

    def take(self, text: str) -> bool:
        found = self.peek(text)
        self.at += len(text) * found
        return found

    def char(self) -> str:
        if self.at >= len(self.pattern):
            raise self.invalid("it ends too early")
        self.at += 1
        return self.pattern[self.at - 1]

    def alternation(self):
        options = [self.sequence()]
        while self.take("|"):
            options.append(self.sequence())
        if len(options) > 1 and all(isinstance(option, Chars) for option in options):
            return Chars(union(r for option in options for r in option.ranges))
        return options[0] if len(options) == 1 else Alt(tuple(options))

    def sequence(self):
        items = []
        while self.at < len(self.pattern) and not self.peek("|") and not self.peek(")"):
            if self.peek("(?#"):
                end = self.pattern.find(")", self.at)
                if end < 0:
                    raise self.invalid("a comment has no end")
                self.at = end + 1
                continue
            items.append(self.quantified(self.atom()))
        out = seq(*items)
        return out.items[0] if len(out.items) == 1 else out

    def quantified(self, item):
        bounds = self.quantifier()
        if bounds is None:
            return item
        if self.take("?"):
            raise self.refused("non-greedy quantifiers")
        if self.take("+"):
            raise self.refused("possessive quantifiers")
        if self.quantifier() is not None:
            raise self.invalid("two quantifiers stand together")
        low, high = bounds
        if high is not None and low > high:
            raise self.invalid("the least is above the most")
        return repeat(low, high, item)

    def quantifier(self) -> tuple[int, int | None] | None:
        for mark, bounds in (("*", (0, None)), ("+", (1, None)), ("?", (0, 1))):
            if self.take(mark):
                return bounds
        found = _QUANTIFIER.match(self.pattern, self.at)
        if not found or not (found[1] or found[2]):
            return None  # a brace that is no quantifier stands for itself
        self.at = found.end()
        low = int(found[1] or 0)
        return low, (int(found[3]) if found[3] else None) if found[2] else low

    def atom(self):
        char = self.char()
        if char == "(":
            return self.group()
        if char == "[":
            return Chars(self.char_class())
        if char == ".":
            return Chars(self.any_char)
        if char in "^$":
            raise self.refused("anchors and word boundaries")
        if char in "*+?" or char == "{" and _QUANTIFIER.match(self.pattern, self.at - 1) and self.pattern[self.at] != "}":
            raise self.invalid("there is nothing to repeat")
        if char == "\\":
            return Chars(self.escape(False))
        return Chars(((ord(char), ord(char)),))

    def group(self):
        name = None
        if self.peek("?"):
            if self.take("?:"):
                pass
            elif self.peek("?=") or self.peek("?!") or self.peek("?<=") or self.peek("?<!"):
                raise self.refused("lookaround")
            elif self.peek("?P="):
                raise self.refused("backreferences")
            elif self.peek("?("):
                raise self.refused("conditional groups")
            elif self.peek("?>"):
                raise self.refused("atomic groups")
            elif found := _GROUP_NAME.match(self.pattern, self.at):
                name = found[1]
                if not name.isidentifier() or name in self.names:
                    raise self.invalid(f"bad or repeated group name {name!r}")
                self.names.add(name)
                self.at = found.end()
            elif re.compile(r"\?[aiLmsux-]+[:)]").match(self.pattern, self.at):
                raise RuleSyntaxError(f"inline flags are not supported: {self.pattern!r}")
            else:
                raise self.invalid("unknown kind of group")
        inner = self.alternation()
        if not self.take(")"):
            raise self.invalid("a group has no end")
        return inner if name is None else Capture(name, inner)

    def escape(self, in_class: bool) -> Ranges:
        char = self.char()
        if char.lower() in SHORTHAND:
            ranges = SHORTHAND[char.lower()]
            return ranges if char.islower() else complement(ranges)
        if char in _HEX:
            digits = self.pattern[self.at : self.at + _HEX[char]]
            if len(digits) < _HEX[char] or not re.fullmatch("[0-9a-fA-F]+", digits) or int(digits, 16) > MAX_CODE:
                raise self.invalid(f"bad escape \\{char}")
            self.at += len(digits)
            return ((int(digits, 16),) * 2,)
        octal = re.compile("[0-7]{3}" if char != "0" and not in_class else "[0-7]{1,3}").match(self.pattern, self.at - 1)
        if char.isdigit() and octal:
            self.at = octal.end()
            if int(octal[0], 8) > 0o377:
                raise self.invalid("an octal escape is too large")
            return ((int(octal[0], 8),) * 2,)
        if char.isdigit() and not in_class:
            raise self.refused("backreferences")
        if in_class and char == "b":
            return ((0x08, 0x08),)
        if char in "bBAZ" and not in_class:
            raise self.refused("anchors and word boundaries")
        if char in _CONTROL:
            return ((_CONTROL[char],) * 2,)
        if char.isascii() and char.isalnum():
            raise self.invalid(f"bad escape \\{char}")
        return ((ord(char), ord(char)),)

    def char_class(self) -> Ranges:
        negated, ranges, first_place = self.take("^"), [], self.at
        while self.at == first_place or not self.peek("]"):
            low = self.class_item()
            if self.peek("-") and not self.peek("-]"):
                self.take("-")
                high = self.class_item()
                if not _is_char(low) or not _is_char(high) or low[0][0] > high[0][0]:
                    raise self.invalid("bad character range")
                low = ((low[0][0], high[0][0]),)
            ranges += low
        self.take("]")
        return complement(union(ranges)) if negated else union(ranges)

    def class_item(self) -> Ranges:
        char = self.char()
        return self.escape(True) if char == "\\" else ((ord(char), ord(char)),)


def _is_char(ranges: Ranges) -> bool:
    return len(ranges) == 1 and ranges[0][0] == ranges[0][1]


def parse(pattern: str, delimiters: Ranges):
    """Read one rule. ``.`` stands for any character that is not a delimiter."""
    reader = _Reader(pattern, delimiters)
    node = reader.alternation()
    if reader.at < len(pattern):
        raise reader.invalid("a bracket closes nothing")
    return node


def repeat(low: int, high: int | None, item):
    """``(X+){n,}`` is the same language as ``X{n,}``, without the backtracking of the nested form."""
    if high is None and isinstance(item, Repeat) and item.low == 1 and item.high is None:
        return Repeat(low, None, item.item)
    return Repeat(low, high, item)


# ---------------------------------------------------------------- properties
def children(node) -> tuple:
    if isinstance(node, Seq):
        return node.items
    if isinstance(node, Alt):
        return node.options
    return () if isinstance(node, Chars) else (node.item,)


def captures(node) -> list[str]:
    own = [node.name] if isinstance(node, Capture) else []
    return own + [name for child in children(node) for name in captures(child)]


def touches(node, ranges: Ranges) -> bool:
    if isinstance(node, Chars):
        return overlap(node.ranges, ranges)
    return any(touches(child, ranges) for child in children(node))


def alphabet(node) -> Ranges:
    """All characters the node can match."""
    if isinstance(node, Chars):
        return node.ranges
    return union(r for child in children(node) for r in alphabet(child))


def width(node) -> tuple[int, int | None]:
    """Shortest and longest match length; ``None`` means unbounded."""
    if isinstance(node, Chars):
        return 1, 1
    if isinstance(node, Seq):
        parts = [width(item) for item in node.items]
        highs = [high for _, high in parts]
        return sum(low for low, _ in parts), None if None in highs else sum(highs)
    if isinstance(node, Alt):
        parts = [width(option) for option in node.options]
        highs = [high for _, high in parts]
        return min(low for low, _ in parts), None if None in highs else max(highs)
    if isinstance(node, Repeat):
        low, high = width(node.item)
        return low * node.low, None if high is None or node.high is None else high * node.high
    return width(node.item)


def count(node, ranges: Ranges) -> tuple[int, int | None]:
    """How many characters of a set a match holds: least and most; ``None`` means unbounded."""
    if isinstance(node, Chars):
        inside = not overlap(node.ranges, complement(ranges))
        return int(inside), int(overlap(node.ranges, ranges))
    if isinstance(node, (Seq, Alt)):
        parts = [count(item, ranges) for item in children(node)]
        lows, highs = [low for low, _ in parts], [high for _, high in parts]
        if isinstance(node, Alt):
            return min(lows), None if None in highs else max(highs)
        return sum(lows), None if None in highs else sum(highs)
    if isinstance(node, Repeat):
        low, high = count(node.item, ranges)
        if high == 0 or node.high == 0:
            return low * node.low, 0
        return low * node.low, None if high is None or node.high is None else high * node.high
    return count(node.item, ranges)


def literal(node) -> str | None:
    """The only text the node matches, or ``None`` if it can match several."""
    if isinstance(node, Chars):
        (low, high), *rest = node.ranges or ((0, 1),)
        return chr(low) if low == high and not rest else None
    if isinstance(node, Seq):
        parts = [literal(item) for item in node.items]
        return None if None in parts else "".join(parts)
    if isinstance(node, Repeat) and node.low == node.high:
        inner = literal(node.item)
        return None if inner is None else inner * node.low
    return None


def without_captures(node):
    if isinstance(node, Chars):
        return node
    if isinstance(node, Seq):
        return Seq(tuple(without_captures(item) for item in node.items))
    if isinstance(node, Alt):
        return Alt(tuple(without_captures(option) for option in node.options))
    if isinstance(node, Repeat):
        return repeat(node.low, node.high, without_captures(node.item))
    return without_captures(node.item)


# ---------------------------------------------------------------- how a match can begin
def heads(node, length: int = HEAD_LENGTH) -> list[tuple[tuple[Ranges, ...], bool]]:
    """Sequences of character sets every match begins with; True marks one that is the whole match."""
    if isinstance(node, Chars):
        return [((node.ranges,), True)]
    if isinstance(node, Capture):
        return heads(node.item, length)
    if isinstance(node, Alt):
        return _capped([head for option in node.options for head in heads(option, length)], length)
    if isinstance(node, Seq):
        result = [((), True)]
        for item in node.items:
            if not any(whole for _, whole in result):
                break
            result = _follow(result, heads(item, length), length)
        return result
    inner = heads(node.item, length)
    result = [((), True)]
    for _ in range(min(node.low, length)):
        result = _follow(result, inner, length)
    if node.high == node.low:
        return result
    if node.high is not None and node.high - node.low == 1:
        return _capped(result + _follow(result, inner, length), length)
    more = [(head, False) for head, _ in _follow(result, inner, length)]
    return _capped(result + more, length)


def _follow(firsts, seconds, length):
    out = []
    for head, whole in firsts:
        if not whole or len(head) >= length:
            out.append((head, False))
        else:
            out.extend(((head + tail)[:length], end and len(head) + len(tail) <= length) for tail, end in seconds)
    return _capped(out, length)


def _capped(sequences, length):
    """Keep the number of sequences small by cutting them shorter."""
    unique = dict.fromkeys(sequences)
    while len(unique) > HEAD_COUNT:
        length -= 1
        unique = dict.fromkeys((head[:length], whole and len(head) <= length) for head, whole in unique)
    return list(unique)


def bounded_heads(node, delimiters: Ranges) -> list[tuple[Ranges, ...]]:
    """Heads in which a whole match is followed by a delimiter or by the end of the text."""
    stop = delimiters + ((END, END),)
    return [head + (stop,) if whole else head for head, whole in heads(node)]


def compatible(firsts, seconds) -> bool:
    """Can one text begin with a head of each list?"""
    return any(all(overlap(x, y) for x, y in zip(a, b)) for a in firsts for b in seconds)


# ---------------------------------------------------------------- alternatives
def decided(node, after: tuple, stop: Ranges | None) -> bool:
    """Does every text leave at most one way through the node that takes another character?

    Then Java's first match of a rule is its longest one, however many optional parts there are: what can go on in one
    way only loses nothing by going on, and to end is always the shorter way. ``after`` holds the items that follow and ``stop`` what can
    come after a whole match, if that is known.
    """
    if isinstance(node, Chars):
        return True
    if isinstance(node, Capture):
        return decided(node.item, after, stop)
    if isinstance(node, Seq):
        return all(decided(item, (*node.items[i + 1 :], *after), stop) for i, item in enumerate(node.items))
    if isinstance(node, Alt):
        ways = [seq(option, *after) for option in node.options]
        if any(width(seq(option, *after))[0] == 0 for option in node.options[:-1]):
            return False  # an earlier option could end where a later one goes on
        apart = all(_apart(a, b, stop) for i, a in enumerate(ways) for b in ways[i + 1 :])
        return apart and all(decided(option, after, stop) for option in node.options)
    if node.high == 0:
        return True
    more = Repeat(0, None, node.item) if node.high != 1 else Seq(())
    if node.low != node.high:
        if width(node.item)[0] == 0:
            return False
        if not _apart(seq(node.item, more, *after), seq(*after), stop):
            return False
    return decided(node.item, (more, *after), stop)


def _apart(first, second, stop: Ranges | None) -> bool:
    """Can no text begin with a match of each, but for the empty match? A few characters mostly tell."""

    def beginnings(node, length: int) -> list[tuple[Ranges, ...]]:
        found = [(head, whole) for head, whole in heads(node, length) if head]
        return [head + (stop,) if whole and stop is not None else head for head, whole in found]

    return any(not compatible(beginnings(first, length), beginnings(second, length)) for length in (1, 5, HEAD_LENGTH))


class TooManyOptions(Exception):
    """Too many to be written out."""


def expand(node, wanted, before: tuple = (), after: tuple = ()) -> list:
    """Multiply out the parts for which ``wanted(node, nodes before, nodes after)`` holds, in order of preference.

    A capture in a repeated group keeps its last value: ``(a(?<x>b)){2,5}`` is ``(ab){1,4}a(?<x>b)``.
    """
    if isinstance(node, Alt) and wanted(node, before, after):
        return _limited([v for option in node.options for v in expand(option, wanted, before, after)])
    if isinstance(node, Seq):
        variants = [()]
        for i, item in enumerate(node.items):
            choice = expand(item, wanted, (*before, *node.items[:i]), (*node.items[i + 1 :], *after))
            if len(variants) > 1 < len(choice) and len(variants) * len(choice) > MOST_COMBINATIONS:
                raise TooManyOptions
            variants = _limited([(*parts, one) for parts, one in product(variants, choice)])
        return [seq(*parts) for parts in variants]
    if isinstance(node, Capture):
        return [Capture(node.name, item) for item in expand(node.item, wanted, before, after)]
    if isinstance(node, Repeat) and node.high != 0 and wanted(node, before, after):
        last = expand(node.item, wanted, before, after)
        if node.high != 1:
            earlier = repeat(
                max(node.low - 1, 0),
                None if node.high is None else node.high - 1,
                without_captures(node.item),
            )
            last = [seq(earlier, item) for item in last]
        return _limited(last + ([Seq(())] if node.low == 0 else []))
    return [node]


def expand_few(node, wanted) -> list:
    """The same as ``expand`` if there is one option; otherwise some list of more than one."""
    try:
        return expand(node, wanted)
    except TooManyOptions:
        return [node, node]


def _limited(variants):
    if len(variants) > MOST_OPTIONS:
        raise TooManyOptions
    return variants


def read_at_once(node) -> bool:
    """Can one regex tell which captures took part? Yes if none can be empty and none is in a repeated group."""
    if isinstance(node, Capture):
        return width(node)[0] > 0 and read_at_once(node.item)
    if isinstance(node, Repeat) and captures(node) and node.high != 1:
        return False
    return all(read_at_once(child) for child in children(node))


#: Begins the names of groups that only tell whether a part took part.
PART = "?"


def last_rounds(node):
    """The node with captures in the last round of a repetition only, where they keep their values."""
    if isinstance(node, Chars) or not captures(node):
        return node
    if isinstance(node, Capture):
        return Capture(node.name, last_rounds(node.item))
    if isinstance(node, Seq):
        return seq(*(last_rounds(item) for item in node.items))
    if isinstance(node, Alt):
        return Alt(tuple(last_rounds(option) for option in node.options))
    last = last_rounds(node.item)
    if node.high != 1:
        last = seq(repeat(max(node.low - 1, 0), None if node.high is None else node.high - 1, without_captures(node.item)), last)
    return Repeat(0, 1, last) if node.low == 0 else last


def told_apart(node):
    """(node, guards): every optional part and every option with captures as a group of its own, by which one can see if it took part.

    ``guards`` has the innermost such group of each capture that may be missing. None if the text of a part can be empty, which tells nothing.
    """
    guards: dict[str, str] = {}
    names = iter(range(10**6))

    def wrapped(part, guard: str | None):
        if not captures(part):
            return part
        if width(part)[0] == 0:
            raise TooManyOptions
        name = f"{PART}{next(names)}"
        return Capture(name, walk(part, name))

    def walk(part, guard: str | None):
        if isinstance(part, Capture):
            if guard is not None:
                guards[part.name] = guard
            return Capture(part.name, walk(part.item, guard))
        if isinstance(part, Seq):
            return Seq(tuple(walk(item, guard) for item in part.items))
        if isinstance(part, Alt):
            return Alt(tuple(wrapped(option, guard) for option in part.options))
        if isinstance(part, Repeat) and captures(part):
            return Repeat(part.low, part.high, wrapped(part.item, guard) if part.low == 0 else walk(part.item, guard))
        return part

    try:
        return walk(last_rounds(node), None), guards
    except TooManyOptions:
        return None


def parts(node) -> tuple[str, list[str | None]]:
    """Java regex in which each capture and all text between captures is a group; the groups' captures or None."""
    if not captures(node):
        return (f"({java(node)})", [None]) if width(node) != (0, 0) else ("", [])
    if isinstance(node, Capture) and node.name.startswith(PART):
        text, names = parts(node.item)
        return f"({text})", [node.name, *names]
    if isinstance(node, Capture):
        return f"({java(node.item)})", [node.name]
    if isinstance(node, Seq):
        text, names, run = "", [], []
        for item in (*node.items, None):
            if item is not None and not captures(item):
                run.append(item)
                continue
            for piece in ([seq(*run)] if run else []) + ([item] if item is not None else []):
                more, found = parts(piece)
                text, names = text + more, names + found
            run = []
        return text, names
    texts = [parts(child) for child in children(node)]
    names = [name for _, found in texts for name in found]
    if isinstance(node, Alt):
        return "(?:" + "|".join(text for text, _ in texts) + ")", names
    return f"(?:{texts[0][0]})" + ("?" if node.low == 0 else ""), names


# ---------------------------------------------------------------- Java regex text
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_ =<>\"'~")


def java_char(code: int) -> str:
    char = chr(code)
    if char in _PLAIN:
        return char
    return "\\" + char if 0x21 <= code < 0x7F else f"\\x{{{code:x}}}"


def java_class(ranges: Ranges) -> str:
    """Java tests listed Latin characters with one look at a bit set, but each range by itself."""
    if not ranges:
        return "[^\\x{0}-\\x{10ffff}]"
    if len(ranges) == 1 and ranges[0][0] == ranges[0][1]:
        return java_char(ranges[0][0])
    negated = ranges[-1][1] == MAX_CODE and ranges != ((0, MAX_CODE),)
    shown = complement(ranges) if negated else ranges
    body = ""
    for low, high in shown:
        if low == high or (len(shown) > 1 and high < 0x100):
            body += "".join(java_char(code) for code in range(low, high + 1))
        else:
            body += f"{java_char(low)}-{java_char(high)}"
    return f"[{'^' if negated else ''}{body}]"


def first(node) -> tuple[Ranges, bool]:
    """The characters a match can begin with, and whether the node matches the empty text."""
    if isinstance(node, Chars):
        return node.ranges, False
    if isinstance(node, Alt):
        found = [first(option) for option in node.options]
        return union(r for ranges, _ in found for r in ranges), any(empty for _, empty in found)
    if isinstance(node, Seq):
        ranges: list = []
        for item in node.items:
            own, empty = first(item)
            ranges += own
            if not empty:
                return union(ranges), False
        return union(ranges), True
    ranges, empty = first(node.item)
    return ranges, empty or (isinstance(node, Repeat) and node.low == 0)


def _segments(node) -> tuple | None:
    """(segment, separator) of an unbounded repetition of segments, each ended by a character that is not in it."""
    if not isinstance(node, Repeat) or node.high is not None or captures(node) or not isinstance(node.item, Seq):
        return None
    *segment, separator = node.item.items
    if not segment or not isinstance(separator, Chars) or touches(Seq(tuple(segment)), separator.ranges):
        return None
    return Seq(tuple(segment)), separator


def _flat_loop(items: tuple, follow: Ranges, right: str, delimiters: Ranges) -> str | None:
    """The first of the items, a repetition of segments, in a form that Java runs as a loop; None if it must be able to step back.

    Java calls itself for every round of a repetition it may have to step back in, and a long text ends the JVM's stack.
    There is nothing to step back to where the end of the repetition and of what follows it is certain: what comes
    next can be no character of theirs. Where segments end at a delimiter, a match may end there, so a round is done only
    if the next segment, or some of it, can end the match as well.
    """
    segment, separator = _segments(items[0])
    taken, rest = alphabet(items[0]), list(items[1:])
    tail = []
    while rest:
        ranges, empty = first(rest[0])
        if not empty and not overlap(ranges, union((*taken, *(r for item in tail for r in alphabet(item))))):
            follow = ranges
            break
        tail.append(rest.pop(0))
    held = union((*taken, *(r for item in tail for r in alphabet(item))))
    low = items[0].low
    times = {0: "*+", 1: "++"}.get(low, f"{{{low},}}+")
    if not overlap(follow, held) and not touches(Seq(tuple(tail)), separator.ranges):
        return f"(?:(?>{java(segment)}){java(separator)}){times}"
    last = tail[0] if len(tail) == 1 and not rest else None
    while isinstance(last, Capture):
        last = last.item
    same = len(segment.items) == 1 and segment.items[0] == last and isinstance(last, Repeat) and isinstance(last.item, Chars)
    if right and same and last.low == 1 and last.high is None and not overlap(separator.ranges, complement(delimiters)):
        return f"(?:(?>{java(segment)}){java(separator)}(?={java(last)}{right})){times}"
    return None


def java(node, groups: list[str] | None = None, follow: Ranges | None = None, right: str = "", delimiters: Ranges = ()) -> str:
    """Java regex for the node. With ``groups``, captures become numbered groups, named in that list.

    ``follow`` tells which characters, or the end, come after a match; ``right`` is the test for that, which the caller
    puts after the whole.
    """
    if isinstance(node, Chars):
        return java_class(node.ranges)
    if isinstance(node, Seq):
        text, after, tests = [], follow, right
        following = []
        for item in reversed(node.items):
            following.append((after, tests))
            if after is not None:
                ranges, empty = first(item)
                after = union((*ranges, *after)) if empty else ranges
            tests = ""
        for i, (item, (after, tests)) in enumerate(zip(node.items, reversed(following))):
            loop = None
            if follow is not None and _segments(item):
                loop = _flat_loop(node.items[i:], follow, right, delimiters)
            text.append(loop or java(item, groups, after, tests, delimiters))
        return "".join(text)
    if isinstance(node, Alt):
        return "(?:" + "|".join(java(option, groups, follow, right, delimiters) for option in node.options) + ")"
    if isinstance(node, Capture):
        if groups is None:
            return f"(?:{java(node.item, None, follow, right, delimiters)})"
        groups.append(node.name)
        return f"({java(node.item, groups, follow, right, delimiters)})"
    if follow is not None and _segments(node):
        loop = _flat_loop((node,), follow, right, delimiters)
        if loop:
            return loop
    inside = None if follow is None else union((*first(node.item)[0], *follow)) if node.high != 1 else follow
    inner = java(node.item, groups, inside, right if node.high == 1 else "", delimiters)
    if isinstance(node.item, (Seq, Repeat)):
        inner = f"(?:{inner})"
    low, high = node.low, node.high
    if (low, high) == (0, 1):
        return inner + "?"
    if high is None:
        return inner + {0: "*", 1: "+"}.get(low, f"{{{low},}}")
    return inner + (f"{{{low}}}" if low == high else f"{{{low},{high}}}")
