import random
import time

import model
import pytest
from pyspark.sql import functions as F

from logtables.functions import dialect
from logtables.functions.matching import MARK, Fold
from logtables.operators.extract import extract
from logtables.patterns import PATTERN
from logtables.rules import RuleSet

D = " :/"
DOT = "[^ :/]"
ATOMS = ["a", "b", "1", "=", "[ab]", "[0-9]", "[a1]", ".", "ab", "a=", "[a-b ]", " ", ":", "a b"]


def random_rule(rng, prefix):
    """A rule as (dialect text, Python text) with one or two captures."""
    counter = iter(range(9))

    def atom():
        text = rng.choice(ATOMS)
        return text, text.replace(".", DOT)

    def piece(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.5:
            text, py = atom()
            quantifier = rng.choice(["", "", "", "+", "*", "?", "{1,2}"])
            wrap = "(?:%s)%s" if len(text) > 1 and quantifier else "%s%s"
            return wrap % (text, quantifier), wrap % (py, quantifier)
        if kind < 0.75:
            left, right = chain(depth - 1), chain(depth - 1)
            return f"({left[0]}|{right[0]})", f"(?:{left[1]}|{right[1]})"
        inner = chain(depth - 1)
        quantifier = rng.choice(["?", "", "{1,2}", "*"])
        return f"({inner[0]}){quantifier}", f"(?:{inner[1]}){quantifier}"

    def chain(depth):
        parts = [piece(depth) for _ in range(rng.randint(1, 2))]
        return "".join(p[0] for p in parts), "".join(p[1] for p in parts)

    out, py = "", ""
    for _ in range(rng.randint(1, 3)):
        kind = rng.random()
        if kind < 0.5:
            text = piece(1)
        elif kind < 0.6:
            name = f"{prefix}{next(counter)}"
            a, b = chain(1)
            text = f"(?:(?<{name}>{a})=)?", f"(?:(?P<{name}>{b})=)?"
        else:
            name = f"{prefix}{next(counter)}"
            a, b = chain(1)
            text = f"(?<{name}>{a})", f"(?P<{name}>{b})"
        out, py = out + text[0], py + text[1]
    return out, py


def random_case(rng):
    """A rule set, the same rules for the model, and texts to apply them to."""
    rules, plain = RuleSet(delimiters=D), []
    for i in range(rng.randint(1, 4)):
        dialect_text, py = random_rule(rng, "cdefg"[i])
        priority = rng.choice([0, 0, 1, -1])
        try:
            rules = rules.var(f"r{i}", dialect_text, priority)
        except ValueError:
            continue
        plain.append(model.ModelRule(f"r{i}", py, priority))
    texts = ["".join(rng.choice("aab1= :/") for _ in range(rng.randint(0, 14))) for _ in range(60)]
    return rules, plain, texts


def check(spark, rules, plain, texts, delimiters=D):
    rows = extract(spark.createDataFrame([(t,) for t in texts], "value string"), rules).collect()
    wrong = []
    for row in rows:
        captures, log_type = model.parse(plain, row["value"], delimiters)
        got = {n: row[n] for n in row.asDict() if n not in ("value", "log_type") and row[n]}
        if (got, row["log_type"]) != (captures, log_type):
            wrong.append((row["value"], got, row["log_type"], captures, log_type))
    return wrong


@pytest.mark.parametrize("seed", range(70))
def test_expressions_equal_the_model(spark, seed):
    rng = random.Random(seed)
    rules, plain, texts = random_case(rng)
    if not plain:
        pytest.skip("no valid rule in this case")
    wrong = check(spark, rules, plain, texts)
    assert not wrong, ([r.regex for r in rules.rules], wrong[:2], len(wrong))


def only(spark, rules, text, **options):
    row = extract(spark.createDataFrame([(text,)], "value string"), rules, **options).first().asDict()
    row.pop("value")
    return {name: value for name, value in row.items() if value}


@pytest.mark.parametrize("rules, text, expected", [
    # "." stops at a delimiter; a class may hold delimiters
    (RuleSet().var("m", r"(?<match>d.*)"), "abc def ghi", {"match": ["def"], "log_type": "abc <match> ghi"}),
    (RuleSet().var("m", r"(?<match>d[a-z ]*i)"), "abc def ghi", {"match": ["def ghi"], "log_type": "abc <match>"}),
    (RuleSet().var("r", r"(?<gb>\-{0,1}[0-9]+\.[0-9]+) GiB ram"),
     "16/05/04 04:24:58 INFO Registering worker with 1 core and 4.0 GiB ram",
     {"gb": ["4.0"], "log_type": "16/05/04 04:24:58 INFO Registering worker with 1 core and <gb> GiB ram"}),
    # several values, several captures
    (RuleSet().var("u", r"user=(?<u>\d+)"), "user=123 then user=456",
     {"u": ["123", "456"], "log_type": "user=<u> then user=<u>"}),
    (RuleSet().var("m", r"metric=(?<n>[a-zA-Z0-9_]+) value=(?<v>\d+)"), "2024-01-01 INFO: metric=cpu value=42",
     {"n": ["cpu"], "v": ["42"], "log_type": "2024-01-01 INFO: metric=<n> value=<v>"}),
    # priority, ties by order, longest match first of all
    (RuleSet().var("n", r"(?<num>\d+)", -1).var("i", r"USER:(?<id>\d{4})", 1), "USER:1234",
     {"id": ["1234"], "log_type": "USER:<id>"}),
    (RuleSet().var("a", r"(?<x>[0-9]+)").var("b", r"(?<y>\d+)"), "7", {"x": ["7"], "log_type": "<x>"}),
    (RuleSet().var("a", r"(?<x>[0-9]+)").var("b", r"(?<y>\d+)", 1), "7", {"y": ["7"], "log_type": "<y>"}),
    (RuleSet().var("a", r"(?<x>u=\d+)", 9).var("b", r"(?<y>u=\d+ x)"), "u=1 x u=2",
     {"x": ["u=2"], "y": ["u=1 x"], "log_type": "<y> <x>"}),
    # inside one rule as well: options and optional parts are compared by length
    (RuleSet().var("o", r"(?<x>foo|foo bar)(?<y>=\d)?"), "foo bar=1 foo=2 foo",
     {"x": ["foo bar", "foo", "foo"], "y": ["=1", "=2"], "log_type": "<x><y> <x><y> <x>"}),
    (RuleSet().var("o", r"(?<x>[ab]+)(?<y>b a)?"), "ab a bb", {"x": ["a", "bb"], "y": ["b a"], "log_type": "<x><y> <x>"}),
    # a match ends at a delimiter and starts after one
    (RuleSet().var("u", r"u=(?<u>\d+)"), "u=1a xu=2 (u=3)", {"u": ["3"], "log_type": "u=1a xu=2 (u=<u>)"}),
    (RuleSet(right_boundary=False).var("u", r"u=(?<u>\d+)"), "u=1a", {"u": ["1"], "log_type": "u=<u>a"}),
    # timestamps are replaced as a whole and go first
    (RuleSet().var("d", r"(?<d>\d\d:\d\d)", 100).timestamp("t", r"\d\d:\d\d"), "12:30 x",
     {"timestamps": ["12:30"], "log_type": "<timestamp> x"}),
    # nested captures: one placeholder, both values
    (RuleSet().var("n", r"at=(?<outer>(?<inner>\d+)-\d+)"), "at=1-2",
     {"outer": ["1-2"], "inner": ["1"], "log_type": "at=<outer>"}),
    # the last repetition of a repeated capture, optional and empty captures
    (RuleSet().var("r", r"(a(?<c>\d);){1,3}"), "a1;a2;", {"c": ["2"], "log_type": "a1;a<c>;"}),
    (RuleSet().var("o", r"k(=(?<c>\d*))?"), "k k= k=5", {"c": ["", "5"], "log_type": "k k=<c> k=<c>"}),
    # text that looks like placeholders, group references or the internal mark
    (RuleSet().var("u", r"\$u=(?<u>\d+)1"), f"$u=41 <u> $1 \\ {MARK} $u=51",
     {"u": ["4", "5"], "log_type": f"$u=<u>1 <u> $1 \\ {MARK} $u=<u>1"}),
    (RuleSet().var("g", r"[ab]+1(?<c>[xy])2"), "ab1x2 c", {"c": ["x"], "log_type": "ab1<c>2 c"}),
    (RuleSet().var("u", r"naïve=(?<u>[^ ]+)"), "naïve=日本 x", {"u": ["日本"], "log_type": "naïve=<u> x"}),
])
def test_examples(spark, rules, text, expected):
    assert only(spark, rules, text) == expected


def test_no_match_and_null(spark):
    rules = RuleSet().var("u", r"user=(?<u>\d+)")
    rows = extract(spark.createDataFrame([("nothing",), ("",), (None,)], "value string"), rules).collect()
    assert [(r["u"], r["log_type"]) for r in rows] == [([], "nothing"), ([], ""), (None, None)]


def test_custom_delimiters(spark):
    rules = RuleSet.with_delimiters(r" \t\n,").var("m", r"(?<m>a.*)")
    assert only(spark, rules, "x:a a:b/c,d") == {"m": ["a:b/c"], "log_type": "x:a <m>,d"}


def test_capture_list_without_log_type(spark):
    rules = RuleSet().var("u", r"user=(?<u>\d+)").var("n", r"(?<n>\d+)")
    assert only(spark, rules, "7 user=3", log_type=False) == {"u": ["3"], "n": ["7"]}
    assert only(spark, rules, "7 user=3", log_type=False, captures=["u"]) == {"u": ["3"]}
    assert only(spark, rules, "7 user=3", log_type=False, types={"u": "int"}) == {"u": [3], "n": ["7"]}
    with pytest.raises(ValueError, match="unknown capture"):
        only(spark, rules, "x", captures=["nope"])
    with pytest.raises(ValueError, match="already"):
        extract(spark.createDataFrame([("a", "b")], "value string, u string"), rules)
    with pytest.raises(TypeError):
        extract(spark.createDataFrame([(1,)], "value int"), rules)


def test_long_text(spark):
    rules = RuleSet().var("n", r"(?<n>\d+)").var("u", r"\d+ (?<u>u+)")
    text = " ".join(f"{i} u" if i % 3 == 0 else f"{i}" for i in range(20_000))
    row = extract(spark.createDataFrame([(text,)], "value string"), rules).first()
    assert len(row["u"]) == 6_667 and len(row["n"]) == 13_333
    assert row["log_type"] == " ".join(f"{i} <u>" if i % 3 == 0 else "<n>" for i in range(20_000))


def test_one_scan_and_pruning(spark):
    rules = RuleSet().var("u", r"user=(?<u>\d+)").var("a", r"act=(?<a>[a-z]+)")
    source = spark.range(5).select("id", F.concat(F.lit("user="), "id").alias("value"))
    found = extract(source, rules, scan_once=True).where("u[0] > 2").where("id < 4").select("a")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1  # not repeated in the filter
    assert "Range" in plan and plan.index("id") > plan.index("Generate")  # filter on id is below the scan
    assert "act=<a>" not in plan  # the log type was not asked for


@pytest.mark.parametrize("pairs", [5, 15, 150])
def test_many_options(spark, pairs):
    options = "|".join(f"s{i}|s{i} more" for i in range(pairs))
    rules = RuleSet().var("k", rf"k=(?<v>{options})").var("n", r"(?<n>\d+)")
    assert only(spark, rules, f"k=s3 more k=s{pairs - 1} x 7 k=s{pairs}") == {
        "v": ["s3 more", f"s{pairs - 1}"], "n": ["7"], "log_type": f"k=<v> k=<v> x <n> k=s{pairs}"
    }


def test_nine_optional_captures(spark):
    rng = random.Random(4)
    names = "abcdefghi"
    rules, plain = RuleSet(delimiters=D), []
    rules = rules.var("r", "x" + "".join(rf"(?: {n}=(?<{n}>\d+))?" for n in names))
    plain.append(model.ModelRule("r", "x" + "".join(rf"(?: {n}=(?P<{n}>\d+))?" for n in names)))
    texts = ["x" + "".join(f" {n}={rng.randrange(30)}" for n in names if rng.random() < 0.6) + rng.choice(["", " y", "/x"]) for _ in range(60)]
    assert not check(spark, rules, plain, texts)


def test_competing_rules_take_linear_time(spark):
    rules = RuleSet().var("n", r"(?<n>\d+)").var("u", r"\d+ (?<u>u+)").var("w", r"(?<w>\d+[a-z ]*)x")
    times = []
    for n in (16_000, 64_000):
        text = spark.createDataFrame([("1 u " * n,)], "value string")
        extract(text, rules).count()
        started = time.perf_counter()
        row = extract(text, rules).select(F.size("u"), F.length("log_type")).first()
        times.append(time.perf_counter() - started)
        assert tuple(row) == (n, 6 * n)
    assert times[1] < 8 * times[0] + 2


@pytest.mark.parametrize("pattern, text, value", [
    (PATTERN.LINUX_FILE_PATH, "ab/" * 350_000 + "c", "ab/" * 350_000 + "c"),
    (PATTERN.LINUX_FILE_PATH, "ab/" * 350_000, "ab/" * 349_999 + "ab"),
    (PATTERN.LINUX_FILE_PATH, "ab/" * 1000 + "c=", "ab/" * 999 + "ab"),
    (PATTERN.LINUX_FILE_PATH, "a/b c/x=", "a/b c"),
    (PATTERN.LINUX_FILE_PATH, "a/b c=/", "a/b"),
    (PATTERN.JAVA_FULLY_QUALIFIED_CLASS_NAME, "ab." * 350_000 + "Cd", "ab." * 350_000 + "Cd"),
    (PATTERN.JAVA_FULLY_QUALIFIED_CLASS_NAME, "ab.cd.Ef,", "ab.cd.Ef"),
])
def test_long_paths_and_class_names(spark, pattern, text, value):
    rules = RuleSet().var("f", rf"f=(?<v>{pattern})").var("n", r"(?<n>\d+)")
    row = extract(spark.createDataFrame([(f"7 f={text}",)], "value string"), rules).first()
    assert row["v"] == [value] and row["n"] == ["7"]
    assert row["log_type"] == f"<n> f=<v>{text[len(value):]}"
    # a right end that something else decides
    rules = RuleSet().var("f", rf"f=(?<v>{pattern});(?<n>\d+)")
    row = extract(spark.createDataFrame([(f"f={value};12",)], "value string"), rules).first()
    assert (row["v"], row["n"]) == ([value], ["12"])


@pytest.mark.parametrize("delimiters", [" :/", " :/.", " "])
@pytest.mark.parametrize("seed", range(4))
def test_segment_loops_equal_the_model(spark, seed, delimiters):
    rng = random.Random(seed)
    loop = rng.choice(["([ab ]+/)*[ab ]+", "([ab]+/)+[ab]+", "([ab ]+[.])*[ab ]+", "([a][ab]*[.])+[ab]+", "([ab]+/)*", "([ab ]+/)+[ab ]+"])
    prefix, suffix = "p=", rng.choice(["", "", "x", "(?:/x)?"])
    rules = RuleSet(delimiters=delimiters).var("r", f"{prefix}(?<v>{loop}){suffix}")
    plain = [model.ModelRule("r", f"{prefix}(?P<v>{loop}){suffix}")]
    texts = ["p=" + "".join(rng.choice("aab /.x=") for _ in range(rng.randint(0, 12))) for _ in range(150)]
    assert not check(spark, rules, plain, texts, delimiters)


def optional_rule(parts, first="k"):
    """(dialect, Python) of a rule of optional parts, given as texts with one capture each."""
    return first + "".join(f"(?:{p})?" for p in parts), first + "".join(f"(?:{p})?" for p in parts).replace("(?<", "(?P<").replace(".", DOT)


def built(pattern, name="r"):
    started = time.perf_counter()
    rules = RuleSet(delimiters=D).var(name, pattern)
    matcher = rules.matcher
    assert time.perf_counter() - started < 1
    return rules, matcher


@pytest.mark.parametrize("value", [r"\d+", r"\d*", r"\d+|x", r"[0-9x]+"])
@pytest.mark.parametrize("n", [7, 20])
def test_many_optional_captures_that_begin_apart(spark, n, value):
    """One regex of a length in proportion to the parts; captures may be empty."""
    rng = random.Random(n)
    pattern, py = optional_rule([rf" a{i}=(?<c{i}>{value})" for i in range(n)])
    rules, matcher = built(pattern)
    assert matcher.fold is None and len(matcher.find) < 60 * n + 200
    texts = ["k" + "".join(f" a{i}={rng.choice(['', '7', '12', 'x', 'y'])}" for i in range(n) if rng.random() < 0.7) + rng.choice(["", " y", "/x"]) for _ in range(40)]
    assert not check(spark, rules, [model.ModelRule("r", py)], texts)


def test_many_optional_captures_that_begin_alike(spark):
    """Which parts to take is only known at the end of the match, so candidates are compared by a fold."""
    rng = random.Random(1)
    pattern, py = optional_rule([rf" (?<c{i}>[ab]+){'x' if i % 2 else ''}" for i in range(20)])
    rules, matcher = built(pattern)
    assert isinstance(matcher.fold, Fold)
    texts = ["k" + "".join(" " + rng.choice(["a", "ab", "bx", "ax", "c"]) for _ in range(rng.randint(0, 7))) for _ in range(40)]
    assert not check(spark, rules, [model.ModelRule("r", py)], texts + ["", "k", "  k a k b", "k  a/k bx/"])


@pytest.mark.parametrize("seed", range(0, 70, 3))
def test_fold_equals_the_model(spark, monkeypatch, seed):
    """All rules through the fold, whatever their size."""
    rules, plain, texts = random_case(random.Random(seed))
    if not plain:
        pytest.skip("no valid rule in this case")
    monkeypatch.setattr(Fold, "__bool__", lambda self: True, raising=False)
    matcher = rules.matcher
    nodes = [rule.node for rule in rules.ordered]
    matcher.fold = Fold(matcher, nodes, [])
    assert not check(spark, rules, plain, texts)


def test_fold_and_events(spark, monkeypatch):
    monkeypatch.setattr(dialect, "MOST_COMBINATIONS", 0)
    alike = "".join(rf"(?: (?<c{i}>[ab]+))?(?: (?<d{i}>[ab]+)x)?" for i in range(3))
    rules = RuleSet().timestamp("t", r"\d\d").var("r", f"k{alike}").var("n", r"(?<n>\d\d-\d)")
    assert rules.matcher.fold
    text = "first\n12 k a bx\nmore k b\n34-5 no event\n56 end\n"
    frame = spark.createDataFrame([(text,), (None,), ("",)], "value string")
    rows = frame.select(rules.matcher.events(F.col("value")), rules.matcher.first_event(F.col("value"))).collect()
    assert rows[0][0] == ["first", "12 k a bx\nmore k b\n34-5 no event", "56 end"] and rows[0][1] == "first"
    assert rows[1][0] is None
    row = extract(frame, rules).first()
    assert (row["c0"], row["d0"], row["n"], row["timestamps"]) == (["a", "b"], ["bx"[0]], ["34-5"], ["12", "56"])


def test_refused_when_added():
    parts = "".join(rf"(?: (?<c{i}>[ab]+))?" for i in range(20))
    with pytest.raises(ValueError, match="right_boundary"):
        RuleSet(right_boundary=False).var("r", f"k{parts}")
    empty = "".join(rf"(?:(?<c{i}>[ab]*))?" for i in range(20))
    with pytest.raises(ValueError, match="empty text"):
        RuleSet().var("r", f"k{empty}")


def test_groups_of_many_parts_are_read_by_one_regex(spark):
    rules = RuleSet().var("many", "go" + "".join(rf"(?: f{i}=(?<f{i}>[^ ]*))?" for i in range(12)))
    assert rules.matcher.groups(F.col("x")) is not None
    lines = ["go f0=a f3= f11=z", "go", "x go f1=\x1e f2=b\x1e\x1e y", "go f5=5 go f6=6"]
    rows = extract(spark.createDataFrame([(x,) for x in lines], "line string"), rules, "line").collect()
    found = {r.line: ({f"f{i}": r[f"f{i}"] for i in range(12) if r[f"f{i}"]}, r.log_type) for r in rows}
    assert found[lines[0]] == ({"f0": ["a"], "f3": [""], "f11": ["z"]}, "go f0=<f0> f3=<f3> f11=<f11>")
    assert found[lines[1]] == ({}, "go")
    assert found[lines[2]] == ({"f1": ["\x1e"], "f2": ["b\x1e\x1e"]}, "x go f1=<f1> f2=<f2> y")
    assert found[lines[3]] == ({"f5": ["5"], "f6": ["6"]}, "go f5=<f5> go f6=<f6>")
