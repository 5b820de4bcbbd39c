import pytest

from logtables import PATTERN, LogParser, RuleSet
from logtables.functions import dialect


def names(rules):
    return [rule.name for rule in rules.ordered]


def test_order():
    rules = RuleSet().var("a", "a(?<a>x)").var("b", "b(?<b>x)")
    assert names(rules) == ["a", "b"]
    rules = rules.var("high", "c(?<c>x)", 100).var("low", "d(?<d>x)", -5).var("lower", "e(?<e>x)", -10)
    assert names(rules) == ["high", "a", "b", "low", "lower"]
    rules = rules.timestamp("t", r"\d+").var("top", "f(?<f>x)", 10**6)
    assert names(rules) == ["t", "top", "high", "a", "b", "low", "lower"]
    assert rules.capture_names == ("f", "c", "a", "b", "d", "e")


def test_sets_are_immutable():
    first = RuleSet().var("a", "a(?<a>x)")
    second = first.var("b", "b(?<b>x)")
    assert names(first) == ["a"] and names(second) == ["a", "b"]


def test_timestamp_of_same_name_replaces():
    rules = RuleSet().timestamp("t", "a").timestamp("u", "b").timestamp("t", "c")
    assert [(r.name, r.regex) for r in rules.rules] == [("t", "c"), ("u", "b")]


@pytest.mark.parametrize("regex, message", [
    ("(?<a>[0-9", "invalid regex"),
    (r"\d+", "named capture"),
    (r"(?<a>x)\b", "word boundaries"),
    (r"(?=x)(?<a>x)", "lookaround"),
    (r"(?<a>x+?)", "non-greedy"),
    (r"(?<a>x)(?P=a)", "backreferences"),
    (r"(?i)(?<a>x)", "flags"),
    (r"^(?<a>x)", "anchors"),
    (r"(?<a>x*)", "empty text"),
    (r"(?<timestamp>x)", "reserved"),
    (r"(?<a>x)(?<A>y)", "case"),
    ("".join(f"(?<c{i}>a*)?" for i in range(13)) + "b", "combinations"),
])
def test_refused_rules(regex, message):
    with pytest.raises(ValueError, match=message):
        RuleSet().var("r", regex).matcher


def test_refused_names():
    rules = RuleSet().var("r", "(?<a>x)")
    with pytest.raises(ValueError, match="exists"):
        rules.var("r", "(?<b>y)")
    with pytest.raises(ValueError, match="case"):
        rules.var("s", "(?<A>y)")
    assert rules.var("s", "(?<a>y)").capture_names == ("a",)  # two rules may fill one capture


def test_compile_first(spark):
    parser = LogParser()
    with pytest.raises(RuntimeError):
        parser.compile()
    parser.add_var("r", r"(?<a>\d+)")
    with pytest.raises(RuntimeError, match="compile"):
        parser.parse_event("1")
    parser.compile()
    assert parser.get_vars() == ["a"]
    assert parser.parse_event("x 1").first()["a"] == ["1"]


@pytest.mark.parametrize("pattern, good, bad", [
    (PATTERN.UUID, ["550e8400-e29b-41d4-a716-446655440000"], ["550e8400"]),
    (PATTERN.IPV4, ["192.168.1.1", "0.0.0.0", "255.255.255.255"], ["256.1.1.1", "1.2.3", "01.2.3.4"]),
    (PATTERN.IP_OCTET, ["0", "99", "255"], ["256", "1000"]),
    (PATTERN.PORT, ["1", "65535"], ["655350", "x"]),
    (PATTERN.INT, ["-1", "42"], ["1.0", "--1"]),
    (PATTERN.FLOAT, ["-1.5", "0.25"], ["1.", ".5", "1"]),
    (PATTERN.LINUX_FILE_NAME, ["app.log", "my file-v1.2_3"], ["a/b"]),
    (PATTERN.LINUX_FILE_PATH, ["app.log", "var/log/app.log"], ["/app", "a//b"]),
    (PATTERN.JAVA_IDENTIFIER, ["inner$class", "x_1"], ["a.b"]),
    (PATTERN.LOG_LINE, ["Error: [x] (y) <z> a\\b"], ['say "x"', "{}"]),
    (PATTERN.LOG_LINE_NO_WHITE_SPACE, ["user@example.com"], ["a b"]),
    (PATTERN.JAVA_PACKAGE_SEGMENT, ["com."], ["com", "$a."]),
    (PATTERN.JAVA_CLASS_NAME, ["MyClass"], ["X", "$A"]),
    (PATTERN.JAVA_FULLY_QUALIFIED_CLASS_NAME, ["java.util.ArrayList"], ["ArrayList"]),
    (PATTERN.JAVA_LOGGING_CODE_LOCATION_HINT, ["~[A.java:42?]", "~[?:100?]", "~[A.java:42]", "~[?:?]"], ["[a:1]"]),
    (PATTERN.JAVA_STACK_LOCATION,
     ["a.B.run(Native Method)", "java.lang.Thread.run(Thread.java:750)", "a.Bc.run(E.java:1) ~[f.jar:?]"],
     ["a.B.run", "run(A.java:1)"]),
])
def test_pattern_library(spark, pattern, good, bad):
    from pyspark.sql import functions as F

    delimiters = RuleSet().delimiter_ranges
    java = f"\\A(?:{dialect.java(dialect.parse(pattern, delimiters))})\\z"
    rows = spark.createDataFrame([(t,) for t in good + bad], "t string").select("t", F.rlike("t", F.lit(java)))
    assert [row[0] for row in rows.collect() if row[1]] == good


def test_classes_in_java(spark):
    """Every character class means the same in both regex flavours."""
    import re

    from pyspark.sql import functions as F

    chars = [chr(c) for c in range(1, 300)] + ["日", "😀"]
    frame = spark.createDataFrame([(c,) for c in chars], "c string")
    for text in [r"[\w&&\[a]", r"[^\d\-x]", r"[\D]", r"[a\S]", r"[^\s]", r"\W", r"[\]\^\\#~|-]", r"[À-ÿ]", r"[^a]"]:
        java = dialect.java(dialect.parse(text, RuleSet().delimiter_ranges))
        got = {r[0] for r in frame.where(F.rlike("c", F.lit(f"\\A{java}\\z"))).collect()}
        python = text.replace(r"\s", " \\t\\r\\n").replace("[a\\S]", "[^ \\t\\r\\n]")
        assert got == {c for c in chars if re.fullmatch(python, c, re.ASCII)}, text
