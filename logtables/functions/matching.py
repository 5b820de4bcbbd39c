r"""Column expressions that apply a rule set to a text column, made of built-in functions only.

*One* regex finds all matches of all rules in one pass over the text. A match starts at the start of the
text or after a delimiter and ends before a delimiter or at the end. Where two rules can match at the same
place, the longest match wins and ties go to the rule order. Java tries alternatives in order. As every match
ends before a delimiter or at the end, of two matches at one place the one with more delimiters inside is the
longer one, and with as many they are equal. So alternatives go by falling number of delimiters. Where that
number varies, an alternative that a later one may beat is guarded: it is refused when the other one's match
leaves less of the run of characters that the two can take. Rules that can never start alike (``user=``,
``action=``) need no guard. A rule that any text leaves one way to go on in needs none for its own options and optional
parts either.

Where a rule has more combinations of optional parts than can be written out, a fold takes the place of the regex:
each place where a match may start has an array of candidates, one for each place where it may end, the longest first; the first one that a
rule matches as a whole is kept, and a fold over the places picks matches from left to right.

The captures are then read from the short matched texts, not from the whole line.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtables.functions import dialect
from logtables.functions.dialect import Alt, Capture, Repeat, Seq

MARK = "\x1e"
MAX_PREFIXES = 9
ENDED = (dialect.END, dialect.END)
REST = 2**31 - 1


def all_of(tests: list[Column]) -> Column:
    return reduce(lambda first, second: first & second, tests)


@dataclass
class Variant:
    """One way a rule can match: a flat sequence in which every capture takes part."""

    node: Seq
    heads: list
    pattern: str = ""
    groups: list[str] = field(default_factory=list)
    refused: str = ""
    prefix: str = ""
    by_prefix: bool = False  # a match that begins with the prefix can only be of this variant
    optional: bool = False  # captures that took no part read as empty
    guards: dict[str, str] | None = None  # groups that are empty if the capture took no part
    certain: bool = False  # the prefixes of all variants tell whether a match is of this one


class Matcher:
    def __init__(self, rules):
        if not rules.rules:
            raise RuntimeError("no rule was added")
        self.rules = rules
        self.delimiters = rules.delimiter_ranges
        inside = dialect.java_class(dialect.complement(self.delimiters))
        self.left = f"(?<!{inside})"
        self.right = f"(?!{inside})" if rules.right_boundary else ""
        nodes = [rule.node for rule in rules.ordered]
        timestamps = [rule.node for rule in rules.ordered if rule.is_timestamp]
        self.has_timestamps, self.event_start, self.event = bool(timestamps), None, None
        try:
            self.find, self.fold = self._scan(nodes, self.left), None
        except dialect.TooManyOptions:
            self.find, self.fold = self._any(nodes), Fold(self, nodes, timestamps)
        if timestamps and not self.fold:
            self.event_start = self._scan(nodes, "", len(timestamps))
            # from one line break to the next one before a timestamp; group 1 is the event
            following = self._scan(nodes, "", len(timestamps), groups_before=1)
            self.event = f"\\n((?s:.)*?)(?=\\z|\\n{following})"
        self.variants = self._variants(nodes)

    # ------------------------------------------------------------ driver side: regex text
    def _ambiguous(self, node, before: tuple, after: tuple) -> bool:
        """Could Java settle for a match that ends at a delimiter, where the rule has a longer one?

        Options of an alternation: if two of them, followed by the rest of the rule, can begin alike.
        Something optional that holds a delimiter: if a repetition before it can take its first character.
        """
        if isinstance(node, Repeat):
            if node.low > 0 or not dialect.touches(node.item, self.delimiters):
                return False
            beginnings = [head for head, _ in dialect.heads(node.item)]
            firsts = dialect.union(r for head in beginnings if head for r in head[0])
            return not all(beginnings) or self._can_shift(before, firsts)
        if not isinstance(node, Alt):
            return False
        if not any(dialect.touches(item, self.delimiters) for item in (node, *after)):
            return False
        beginnings = [self._heads(dialect.seq(option, *after)) for option in node.options]
        return any(
            dialect.compatible(first, second)
            for i, first in enumerate(beginnings)
            for second in beginnings[i + 1 :]
        )

    @staticmethod
    def _can_shift(before: tuple, firsts: dialect.Ranges) -> bool:
        """Can a part of variable length before this place take one of the characters?

        Not if a character in between, which that part cannot take, fixes the place.
        """
        variable = [i for i, item in enumerate(before) if len(set(dialect.width(item))) > 1]
        if not variable:
            return False
        taken = dialect.union(r for i in variable for r in dialect.alphabet(before[i]))
        anchors = [item for item in before[variable[-1] + 1 :] if isinstance(item, dialect.Chars)]
        if any(not dialect.overlap(anchor.ranges, taken) for anchor in anchors):
            return False
        return dialect.overlap(taken, firsts)

    def _heads(self, node):
        if not self.right:
            return [head for head, _ in dialect.heads(node)]
        return dialect.bounded_heads(node, self.delimiters)

    def _scan(self, nodes, left: str, first_rules: int | None = None, groups_before: int = 0) -> str:
        """Regex for the winning matches; ``first_rules`` keeps only the wins of so many first rules.

        ``groups_before`` is the number of groups in the regex this one becomes a part of.
        """
        plain = []
        for index, node in enumerate(nodes):
            plain += [(index, option) for option in self._options(dialect.without_captures(node))]
        if self.right:
            counts = [dialect.count(option, self.delimiters) for _, option in plain]
        else:
            counts = [dialect.width(option) for _, option in plain]
        order = sorted(range(len(plain)), key=lambda i: -counts[i][0])  # ties keep the rule order
        texts = [f"(?:{self._java(option)}){self.right}" for _, option in plain]
        heads = [self._heads(option) for _, option in plain]
        bodies, group = [], groups_before
        kept = [i for i in order if first_rules is None or plain[i][0] < first_rules]
        for i in kept:
            guards = ""
            for j in order[order.index(i) + 1 :]:
                most = counts[j][1]
                wins_ties = j < i
                if most is not None and (most < counts[i][0] or most == counts[i][0] and not wins_ties):
                    continue
                if dialect.compatible(heads[i], heads[j]):
                    group += 1
                    run = dialect.java_class(dialect.union((*dialect.alphabet(plain[i][1]), *dialect.alphabet(plain[j][1]))))
                    more = "*" if wins_ties else "+"
                    guards += f"(?!(?={texts[j]}({run}*+))(?>{texts[i]}){run}{more}\\{group}(?!{run}))"
            bodies.append(f"(?={texts[i]}){guards}{texts[i]}" if guards else texts[i])
        firsts = [head for i in kept for head in heads[i]]
        ahead = ""
        if all(firsts):
            ahead = f"(?={dialect.java_class(dialect.union(r for head in firsts for r in head[0]))})"
        return f"{ahead}{left}(?:{'|'.join(bodies)})"

    def _java(self, node) -> str:
        """Regex text of a match that its right boundary follows."""
        if not self.right:
            return dialect.java(node)
        stop = dialect.union((*self.delimiters, ENDED))
        return dialect.java(node, None, stop, self.right, self.delimiters)

    def _options(self, node) -> list:
        """A rule as the options that have to be compared by length."""
        stop = dialect.union((*self.delimiters, ENDED)) if self.right else None
        return [node] if dialect.decided(node, (), stop) else dialect.expand(node, self._ambiguous)

    @staticmethod
    def _any(nodes) -> str:
        """Regex for texts that one of the rules matches as a whole."""
        return f"\\A(?:{'|'.join(dialect.java(dialect.without_captures(node), None, (ENDED,)) for node in nodes)})\\z"

    def _variants(self, nodes) -> list[Variant]:
        def wanted(node, before, after) -> bool:
            return bool(dialect.captures(node))

        variants: list[Variant] = []
        for node in nodes:
            optional, guards = dialect.read_at_once(node), None
            if optional:
                flats = [node]
                if len(dialect.expand_few(node, wanted)) == 1:
                    flats, optional = dialect.expand(node, wanted), False
            else:
                try:
                    flats = dialect.expand(node, wanted)
                except dialect.TooManyOptions:
                    told = dialect.told_apart(node)
                    if told is None:
                        raise dialect.RuleSyntaxError("too many combinations of optional parts of which some match the empty text") from None
                    flats, guards = [told[0]], told[1]
            for flat in flats:
                flat = flat if isinstance(flat, Seq) else Seq((flat,))
                variants.append(Variant(flat, self._heads(flat), optional=optional, guards=guards))
        for i, variant in enumerate(variants):
            # a match is shown to one variant only: the first that fits it as a whole
            variant.refused = "".join(
                f"(?!(?:{dialect.java(dialect.without_captures(other.node), None, (ENDED,))})\\z)"
                for other in variants[:i]
                if dialect.compatible(variant.heads, other.heads)
            )
            body = dialect.java(variant.node, variant.groups, (ENDED,))
            variant.pattern = f"\\A{variant.refused}{body}\\z"
            for item in variant.node.items:
                text = dialect.literal(item)
                if text is None:
                    break
                variant.prefix += text
            opening = [tuple(dialect.of_text(char) for char in variant.prefix)]
            variant.by_prefix = bool(variant.prefix) and not any(
                dialect.compatible(opening, other.heads) for other in variants if other is not variant
            )
        others = [variant for variant in variants if not variant.by_prefix]
        for variant in variants:
            variant.certain = variant.by_prefix or (others == [variant] and len(variants) <= MAX_PREFIXES)
        return variants

    # ------------------------------------------------------------ executor side: columns
    def matches(self, text: Column) -> Column:
        """All matches in text order."""
        if self.fold:
            return self.fold.matches(text)
        return F.regexp_extract_all(text, F.lit(self.find), F.lit(0))

    def pieces(self, text: Column) -> Column:
        """Static text and matches in turn: even entries are static, odd entries are matches."""
        if self.fold:
            return self.fold.pieces(text)
        marked = F.regexp_replace(text, F.lit(self.find), F.lit(f"{MARK}$0{MARK}"))
        zipped = F.zip_with(
            F.split(text, self.find, -1), self.matches(text), lambda static, match: F.array(static, match)
        )
        whole = F.filter(F.flatten(zipped), lambda piece: piece.isNotNull())
        return F.when(F.contains(text, F.lit(MARK)), whole).otherwise(F.split(marked, MARK, -1))

    def groups(self, found: Column, alternating: bool = False) -> Column | None:
        """For each match the texts of all groups, read by one regex; None where captures are read one by one."""
        variant = self.variants[0]
        if len(self.variants) > 1 or not variant.certain or not (variant.guards or variant.optional):
            return None
        own = F.filter(found, lambda piece, i: i % 2 == 1) if alternating else found
        return F.transform(own, lambda match: self._groups(match, variant.pattern, len(variant.groups)))

    @staticmethod
    def _groups(match: Column, pattern: str, count: int) -> Column:
        """The texts of the groups of a regex that matches the whole text; those that took no part are empty."""
        marked = F.regexp_replace(match, F.lit(pattern), F.lit(MARK.join(f"${i + 1}" for i in range(count))))
        single = F.array(*(F.regexp_extract(match, pattern, i + 1) for i in range(count)))
        return F.when(F.contains(match, F.lit(MARK)), single).otherwise(F.split(marked, MARK, -1))

    def values(self, name: str, found: Column, alternating: bool = False, groups: Column | None = None) -> Column:
        """All values of a capture in text order, from ``matches`` or (alternating) from ``pieces``.

        ``groups`` is the column that the method of that name has made, if any.
        """
        holders = [v for v in self.variants if name in v.groups]
        if groups is not None:
            variant = holders[0]
            places = [i for i, group in enumerate(variant.groups) if group == name]
            guard = (variant.guards or {}).get(name)

            def read(texts: Column) -> Column:
                one = [F.get(texts, F.lit(i)) for i in places]
                if guard:
                    return F.when(F.get(texts, F.lit(variant.groups.index(guard))) != "", one[0])
                return one[0] if len(one) == 1 else F.concat(*one)

            return F.filter(F.transform(groups, read), lambda item: item.isNotNull() if variant.guards else item != "")
        if len(holders) == 1 and holders[0].certain:
            variant = holders[0]
            if alternating:
                own = F.filter(found, lambda piece, i: all_of([i % 2 == 1, *self._tests(variant, piece)]))
            elif len(self.variants) == 1:
                own = found
            else:
                own = F.filter(found, lambda match: all_of(self._tests(variant, match)))
            read = F.transform(own, lambda match: self._read(variant, name, match))
            if variant.guards:
                return F.filter(read, lambda item: item.isNotNull())
            return F.filter(read, lambda item: item != "") if variant.optional else read

        # variants exclude each other, so of several texts at most one is not empty
        never_empty = all(not variant.guards and self._always_text(variant.node, name) for variant in holders)

        def value(match: Column) -> Column:
            texts = []
            for variant in holders:
                text = self._read(variant, name, match)
                if variant.certain:
                    tests = self._tests(variant, match)
                    text = F.when(all_of(tests), text) if tests else text
                    text = text.otherwise(F.lit("")) if tests and never_empty else text
                elif not never_empty:
                    text = F.when(F.rlike(match, F.lit(variant.pattern)), text)
                texts.append(text)
            if len(texts) == 1:
                return texts[0]
            return F.concat(*texts) if never_empty else F.coalesce(*texts)

        if alternating:
            read = F.transform(found, lambda piece, i: F.when(i % 2 == 1, value(piece)))
        else:
            read = F.transform(found, value)
        return F.filter(read, lambda item: item != "" if never_empty else item.isNotNull())

    def _tests(self, variant: Variant, match: Column) -> list[Column]:
        """Conditions that together tell whether a match belongs to a variant that is ``certain``."""
        if variant.by_prefix:
            return [match.startswith(variant.prefix)]
        return [~match.startswith(other.prefix) for other in self.variants if other is not variant]

    def _read(self, variant: Variant, name: str, match: Column) -> Column:
        """The capture's text in a match that belongs to the variant."""
        cut = self._cut(variant, name, match) if variant.certain else None
        if cut is not None:
            return cut
        places = [i + 1 for i, group in enumerate(variant.groups) if group == name]
        texts = [F.regexp_extract(match, variant.pattern, place) for place in places]
        guard = (variant.guards or {}).get(name)
        if guard:
            return F.when(F.regexp_extract(match, variant.pattern, variant.groups.index(guard) + 1) != "", texts[0])
        return texts[0] if len(texts) == 1 else F.concat(*texts)

    @staticmethod
    def _cut(variant: Variant, name: str, match: Column) -> Column | None:
        """The capture cut out at the fixed texts around it, without a regex, where these are certain.

        In ``a=(?<x>[0-9]+) b=(?<y>.+)`` the text " b=" ends x, because x can hold no blank.
        """
        fixed, caps = [""], []
        for item in variant.node.items:
            text = dialect.literal(item)
            if isinstance(item, Capture):
                caps.append(item)
                fixed.append("")
            elif text is None:
                return None
            else:
                fixed[-1] += text
        position = next((i for i, cap in enumerate(caps) if cap.name == name), None)
        if position is None or position > 2:
            return None
        rest = F.substring(match, len(fixed[0]) + 1, REST)
        for i in range(position + 1):
            after, last = fixed[i + 1], i == len(caps) - 1
            if last:
                return F.left(rest, F.length(rest) - len(after)) if after else rest
            if not after or dialect.overlap(dialect.alphabet(caps[i]), dialect.of_text(after[0])):
                return None
            if i == position:
                return F.substring_index(rest, after, 1)
            rest = F.substring(rest, F.instr(rest, after) + len(after), F.lit(REST))
        return None

    @staticmethod
    def _always_text(node, name: str) -> bool:
        if isinstance(node, Capture) and node.name == name:
            return dialect.width(node)[0] > 0
        return any(Matcher._always_text(child, name) for child in dialect.children(node))

    def template(self, match: Column) -> Column:
        """The match with each capture replaced by its ``<name>``."""
        ordered = sorted(self.variants, key=lambda v: not v.by_prefix)
        result = self._placeholders(ordered[-1], match)
        branches = None
        for variant in ordered[:-1]:
            if variant.by_prefix:
                test = match.startswith(variant.prefix)
            else:
                test = F.rlike(match, F.lit(variant.pattern))
            text = self._placeholders(variant, match)
            branches = F.when(test, text) if branches is None else branches.when(test, text)
        return result if branches is None else branches.otherwise(result)

    @staticmethod
    def _placeholders(variant: Variant, match: Column) -> Column:
        """Captures inside another capture get no placeholder of their own."""
        if variant.optional or variant.guards:
            body, names = dialect.parts(variant.node)

            def shown(read: list[Column]) -> Column:
                texts = []
                for text, name in zip(read, names):
                    guard = (variant.guards or {}).get(name)
                    if name is None:
                        texts.append(text)
                    elif not variant.guards:
                        texts.append(F.when(text != "", f"<{name}>").otherwise(""))
                    elif guard:
                        texts.append(F.when(read[names.index(guard)] != "", f"<{name}>").otherwise(""))
                    elif not name.startswith(dialect.PART):
                        texts.append(F.lit(f"<{name}>"))
                return F.concat(*texts)

            texts = Matcher._groups(match, f"\\A{body}\\z", len(names))
            return let(texts, lambda found: shown([F.get(found, F.lit(i)) for i in range(len(names))]))
        pattern, replacement, fixed, group, after_group = "", "", "", 0, False
        follows, follow = [], (ENDED,)
        for item in reversed(variant.node.items):
            follows.insert(0, follow)
            ranges, empty = dialect.first(item)
            follow = dialect.union((*ranges, *follow)) if empty else ranges
        for at, item in enumerate(variant.node.items):
            text = dialect.literal(item)
            if isinstance(item, Capture):
                pattern += f"(?:{dialect.java(item.item, None, follows[at])})"
                shown = written = f"<{item.name}>"
            elif text is not None:
                pattern += dialect.java(item)
                shown, written = text, text.replace("\\", "\\\\").replace("$", "\\$")
                if after_group and written[:1].isdigit():
                    written = "\\" + written  # else it would be read as part of the group number
            else:
                group += 1
                pattern += f"({dialect.java(item, None, follows[at])})"
                shown, written = None, f"${group}"
            after_group = shown is None
            replacement += written
            fixed = None if fixed is None or shown is None else fixed + shown
        if fixed is not None:
            return F.lit(fixed)
        return F.regexp_replace(match, F.lit(f"\\A{pattern}\\z"), F.lit(replacement))

    def log_type(self, pieces: Column) -> Column:
        """The text with every capture replaced by its ``<name>``."""
        written = F.transform(
            pieces, lambda piece, i: F.when(i % 2 == 1, self.template(piece)).otherwise(piece)
        )
        return F.array_join(written, "")

    def starts_event(self, line: Column) -> Column:
        """Does the line begin with a timestamp?"""
        if not self.has_timestamps:
            return F.lit(True)
        if self.fold:
            return self.fold.starts_event(line)
        return F.rlike(line, F.lit(f"\\A{self.event_start}"))

    def events(self, text: Column) -> Column:
        """The events of a text of several lines: one per timestamp line, or one per line without any.

        Text before the first timestamp is an event of its own; a final line break ends the last line.
        """
        body = self._body(text)
        if self.fold and self.has_timestamps:
            return self.fold.events(F.split(body, "\n", -1))
        if self.event is None:
            return F.split(body, "\n", -1)
        return F.regexp_extract_all(F.concat(F.lit("\n"), body), F.lit(self.event), F.lit(1))

    def first_event(self, text: Column) -> Column:
        """The first of ``events``."""
        if self.fold and self.has_timestamps:
            return F.get(self.events(text), F.lit(0))
        if self.event_start is None:
            return F.substring_index(self._body(text), "\n", 1)
        return F.regexp_extract(F.concat(F.lit("\n"), self._body(text)), self.event, 1)

    @staticmethod
    def _body(text: Column) -> Column:
        """The text with plain line breaks and none at the end."""
        plain = F.when(F.contains(text, F.lit("\r\n")), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
        return F.when(plain.endswith("\n"), F.left(plain, F.length(plain) - 1)).otherwise(plain)


def let(value: Column, body) -> Column:
    """What ``body`` makes of the value, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Fold:
    """Longest matches by candidates: for each start the ends from the farthest on, until a rule matches the whole text between them.

    A text is cut into runs of other characters and single delimiters in turn, so that matches start and end at runs. The work for a start is
    bounded by the delimiters that a match can hold; where a rule sets no such bound, all ends are candidates.
    """

    PICKS = "array<struct<i:int,j:int>>"

    def __init__(self, matcher: Matcher, nodes: list, timestamps: list):
        if not matcher.right:
            raise dialect.RuleSyntaxError("rules with so many optional parts need right_boundary=True")
        self.whole, self.stamp = Matcher._any(nodes), Matcher._any(timestamps) if timestamps else None
        self.delimiter = dialect.java_class(matcher.delimiters)
        counts = [dialect.count(node, matcher.delimiters)[1] for node in nodes]
        self.most = None if None in counts else max(counts)
        firsts = [dialect.first(node)[0] for node in nodes]
        self.first = f"\\A{dialect.java_class(dialect.union(r for ranges in firsts for r in ranges))}"

    def _cut(self, text: Column) -> Column:
        both = F.zip_with(F.split(text, self.delimiter, -1), F.regexp_extract_all(text, F.lit(self.delimiter), F.lit(0)), lambda a, b: F.array(a, b))
        return F.filter(F.flatten(both), lambda part: part.isNotNull())

    @staticmethod
    def _joined(parts: Column, i: Column, j: Column) -> Column:
        return F.array_join(F.slice(parts, i + 1, F.greatest(j - i + 1, F.lit(0))), "")

    def _end(self, parts: Column, i: Column) -> Column:
        """The run with which the longest match from run ``i`` on ends, or null."""
        last = F.size(parts) - 1
        farthest = last if self.most is None else F.least(last, i + 2 * self.most)
        end = F.aggregate(
            F.sequence(farthest, i, F.lit(-2)), F.lit(None).cast("int"),
            lambda found, j: F.coalesce(found, F.when(F.rlike(self._joined(parts, i, j), F.lit(self.whole)), j)),
        )
        return F.when(F.rlike(F.concat(F.get(parts, i), F.coalesce(F.get(parts, i + 1), F.lit(""))), F.lit(self.first)), end)

    def _picks(self, parts: Column) -> Column:
        """First and last run of all matches; the next one may start at the delimiter where one has ended, if another precedes it."""
        starts = F.sequence(F.lit(0), F.size(parts) - 1, F.lit(2))
        kind = f"struct<next:int,found:{self.PICKS}>"

        def fold(ends: Column) -> Column:
            def pick(done: Column, i: Column) -> Column:
                j = F.get(ends, F.shiftright(i, 1))
                following = F.when(F.get(parts, j) == "", j).otherwise(j + 2)
                more = F.struct(following.alias("next"), F.array_append(done["found"], F.struct(i.alias("i"), j.alias("j"))).alias("found"))
                return F.when((i < done["next"]) | j.isNull(), done).otherwise(more.cast(kind))

            none = F.struct(F.lit(0).alias("next"), F.array().cast(self.PICKS).alias("found")).cast(kind)
            return F.aggregate(starts, none, pick, lambda done: done["found"])

        return let(F.transform(starts, lambda i: self._end(parts, i)), fold)

    def matches(self, text: Column) -> Column:
        return let(self._cut(text), lambda parts: F.transform(self._picks(parts), lambda p: self._joined(parts, p["i"], p["j"])))

    def pieces(self, text: Column) -> Column:
        def cut(parts: Column, picks: Column) -> Column:
            n = F.size(picks)

            def static(k: Column) -> Column:
                first = F.when(k == 0, F.lit(0)).otherwise(F.get(picks, k - 1)["j"] + 1)
                last = F.when(k == n, F.size(parts) - 1).otherwise(F.get(picks, k)["i"] - 1)
                return self._joined(parts, first, last)

            found = F.transform(picks, lambda p: self._joined(parts, p["i"], p["j"]))
            both = F.zip_with(F.transform(F.sequence(F.lit(0), n), static), found, lambda a, b: F.array(a, b))
            return F.filter(F.flatten(both), lambda piece: piece.isNotNull())

        return let(self._cut(text), lambda parts: let(self._picks(parts), lambda picks: cut(parts, picks)))

    def starts_event(self, line: Column) -> Column:
        def test(parts: Column) -> Column:
            found = let(self._end(parts, F.lit(0)), lambda j: self._joined(parts, F.lit(0), j))
            return F.coalesce(F.rlike(found, F.lit(self.stamp)), F.lit(False))

        return let(self._cut(line), test)

    def events(self, lines: Column) -> Column:
        def add(done: Column, line: Column) -> Column:
            n = F.size(done)
            longer = F.concat(F.slice(done, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(F.concat(F.get(done, n - 1), F.lit("\n"), line)))
            return F.when((n == 0) | self.starts_event(line), F.array_append(done, line)).otherwise(longer)

        return F.aggregate(lines, F.array().cast("array<string>"), add)
