"""JSON logs: one object per line, arrays of objects, or a column of JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtables.sources.text import BLOCK, LINE, SOURCE, TEXT, place_of_lines, read_text_logs, text_column

_BLANK = "^\\s*$"
_OPENS_OBJECT = "^\\s*\\{"
_OPENS_ARRAY = "^\\s*\\["


def is_array(text: Column) -> Column:
    """Does the text hold a JSON array? Decided by its first non-blank character."""
    return F.rlike(text, F.lit(_OPENS_ARRAY))


def is_object(text: Column, strict: bool = True) -> Column:
    """Does the text hold a JSON object? Text that is not JSON fails the job if ``strict``."""
    parse = F.parse_json if strict else F.try_parse_json
    other = F.schema_of_variant(parse(text)).startswith("OBJECT")
    return F.when(F.rlike(text, F.lit(_OPENS_OBJECT)), F.lit(True)).otherwise(F.coalesce(other, F.lit(False)))


def array_objects(text: Column) -> Column:
    """The objects of a JSON array as texts; other elements are left out."""
    kinds = F.from_json(text, "array<variant>", {"mode": "FAILFAST"})
    texts = F.from_json(text, "array<string>", {"mode": "FAILFAST"})
    kept = F.filter(
        F.arrays_zip(texts.alias("t"), kinds.alias("k")),
        lambda item: F.schema_of_variant(item["k"]).startswith("OBJECT"),
    )
    return F.transform(kept, lambda item: item["t"])


def json_objects(df: DataFrame, text: str = TEXT, layout: str = "lines", strict: bool = True) -> DataFrame:
    """One row per JSON object; blank text and values that are no objects are left out.

    ``layout``: "lines" if each row is one line of a file, "array" if each row is a whole array, "auto" if
    each row is a whole document: an array, or objects on lines of their own. With ``strict=False``, text
    that is not JSON is kept, for ``enrich_json`` to report.
    """
    value = text_column(df, text)
    if layout == "lines":
        rows = df.withColumn(text, value)
    else:
        lines = F.split(value, "\\n", -1)
        found = array_objects(value) if layout == "array" else (
            F.when(is_array(value), array_objects(value)).otherwise(lines)
        )
        others = [F.col(f"`{name}`") for name in df.columns if name != text]
        rows = df.where(~F.rlike(value, F.lit(_BLANK))).select(*others, F.explode(found).alias(text))
    rows = rows.where(~F.rlike(text, F.lit(_BLANK)))
    keep = is_object(F.col(text), strict)
    if not strict:
        keep = keep | F.try_parse_json(F.col(text)).isNull()
    return rows.where(keep)


def _pieces(spark: SparkSession, path: str | Sequence[str], where: Column | None = None) -> DataFrame:
    """Files cut after every closing brace, in splits: a line would be a whole file of one array."""
    pieces = spark.read.option("lineSep", "}").text(path)
    return place_of_lines(pieces if where is None else pieces.where(where))


def json_layouts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The layout of each file: (source, layout), from the first non-blank character of its first split.

    A file that begins with a split of blanks is read as lines.
    """
    pieces = _pieces(spark, path, F.col("_metadata.file_block_start") == 0).where(~F.rlike(TEXT, F.lit(_BLANK)))
    firsts = pieces.groupBy(SOURCE).agg(F.min_by(is_array(F.col(TEXT)), F.struct(BLOCK, LINE)).alias("array"))
    return firsts.select(SOURCE, F.when(F.col("array"), "array").otherwise("lines").alias("layout"))


def _braces(text: Column) -> Column:
    """Brackets and braces opened minus brackets closed, of a piece without strings."""
    return F.regexp_count(text, F.lit("[\\[{]")) - F.regexp_count(text, F.lit("\\]"))


def read_json_arrays(spark: SparkSession, path: str | Sequence[str], sources: DataFrame | None = None) -> DataFrame:
    """The objects of files that hold one JSON array each, as text, with their place; other elements are left out.

    Files are read in splits, whatever their size and however their lines are broken. Every piece up to a closing brace tells how it changes the
    depth, if it begins within a string and if it doesn't. Running sums per split, and of one row per split along a file, give the state each
    piece begins in, and so the braces that end an element. Texts move once, by file and split; only what crosses the
    border of a split moves again. A file that is no JSON array stops the job; a blank one has no objects. ``sources`` selects files by
    their names in its column.
    """
    pieces = _pieces(spark, path)
    if sources is not None:
        pieces = pieces.join(sources.select(SOURCE), SOURCE, "left_semi")
    others = [F.col(f"`{name}`") for name in pieces.columns if name not in (TEXT, SOURCE, BLOCK, LINE)]
    strings = F.lit('"[^"]*+(?:"|\\z)')
    plain = F.regexp_replace(TEXT, F.lit("(?s)\\\\."), F.lit(""))
    outside = F.regexp_replace(plain, strings, F.lit(""))
    inside = F.regexp_replace(F.regexp_replace(plain, F.lit('\\A[^"]*+(?:"|\\z)'), F.lit("")), strings, F.lit(""))
    quotes = F.regexp_count(plain, F.lit('"')) % 2
    # the brace that ends the piece counts if no string is open there
    measured = pieces.select(
        "*", quotes.alias("_quotes"), (_braces(outside) - (1 - quotes)).alias("_outside"), (_braces(inside) - quotes).alias("_inside")
    )
    along = Window.partitionBy(SOURCE, BLOCK).orderBy(LINE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    opened = (F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2).alias("_opened")
    states = measured.select("*", opened)
    # for a split that begins outside of strings, and for one that begins within
    states = states.withColumn("_even", F.when(F.col("_opened") == 0, F.col("_outside")).otherwise(F.col("_inside")))
    states = states.withColumn("_odd", F.when(F.col("_opened") == 0, F.col("_inside")).otherwise(F.col("_outside")))
    splits = states.groupBy(SOURCE, BLOCK).agg((F.sum("_quotes") % 2).alias("_quotes"), F.sum("_even").alias("_even"), F.sum("_odd").alias("_odd"))
    files = Window.partitionBy(SOURCE).orderBy(BLOCK)
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("*", (F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2).alias("_begins"))
    splits = splits.withColumn("_change", F.when(F.col("_begins") == 0, F.col("_even")).otherwise(F.col("_odd")))
    depth = F.coalesce(F.sum("_change").over(earlier), F.lit(0))
    # the piece after the last brace has none to end it, which leaves a closed array at -1
    closed = F.lead(BLOCK).over(files).isNotNull() | (depth + F.col("_change") == -1)
    error = F.raise_error(F.concat(F.lit("no complete JSON array: "), F.col(SOURCE))).cast("bigint")
    splits = splits.select(SOURCE, BLOCK, "_begins", F.when(closed, depth).otherwise(error).alias("_depth"))

    placed = states.join(splits, [SOURCE, BLOCK])
    change = F.when(F.col("_begins") == 0, F.col("_even")).otherwise(F.col("_odd"))
    placed = placed.withColumn("_depth", F.col("_depth") + F.sum(change).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    open_string = (F.col("_begins") + F.col("_opened") + F.col("_quotes")) % 2 == 1
    placed = placed.withColumn("_ends", (~open_string & (F.col("_depth") == 1)).cast("int"))
    placed = placed.withColumn("_element", F.coalesce(F.sum("_ends").over(before), F.lit(0)))
    texts = F.transform(F.array_sort(F.collect_list(F.struct(LINE, TEXT))), lambda p: F.concat(p[TEXT], F.lit("}")))
    elements = placed.groupBy(SOURCE, *others, BLOCK, "_element").agg(
        F.min(LINE).alias(LINE), F.max("_ends").alias("_ends"), F.array_join(texts, "").alias(TEXT)
    )
    names = [F.col(f"`{name}`") for name in pieces.columns]
    whole = (F.col("_element") > 0) & (F.col("_ends") == 1)
    # what begins or ends in another split
    cut = elements.where(~whole).select(
        "*", F.coalesce(F.sum("_ends").over(Window.partitionBy(SOURCE).orderBy(BLOCK, "_element").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_number")
    )
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, "_element", LINE, TEXT)))
    joined = cut.groupBy(SOURCE, *others, "_number").agg(F.max("_ends").alias("_ends"), parts.alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda p: p[TEXT]), "")
    first = F.get("_parts", F.lit(0))
    # an element after others follows a comma, the first one a bracket; after the last one the array is closed
    text = F.when(F.col("_number") == 0, F.ltrim(F.regexp_replace(text, F.lit("\\A\\x{feff}"), F.lit("")))).otherwise(F.concat(F.lit("[0"), text))
    text = F.when(F.col("_ends") == 1, F.concat(text, F.lit("]"))).otherwise(F.left(text, F.length(text) - 1))
    joined = joined.select(SOURCE, *others, first[BLOCK].alias(BLOCK), first[LINE].alias(LINE), text.alias(TEXT))
    inner = elements.where(whole).withColumn(TEXT, F.concat(F.lit("[0"), F.col(TEXT), F.lit("]"))).select(*names)
    arrays = inner.unionByName(joined.select(*names)).where(~F.rlike(TEXT, F.lit(_BLANK)))
    ended = F.rlike(TEXT, F.lit("\\]\\s*\\z"))
    checked = F.when(is_array(F.col(TEXT)) & ended, F.col(TEXT)).otherwise(F.raise_error(F.concat(F.lit("no JSON array: "), F.col(SOURCE))).cast("string"))
    found = arrays.select(*(n for n in names if n is not names[pieces.columns.index(TEXT)]), F.explode(array_objects(checked)).alias(TEXT))
    return found.select(*names)


def read_json_logs(
    spark: SparkSession, path: str | Sequence[str], layout: str = "lines", strict: bool = True
) -> DataFrame:
    """Objects of JSON files, as text. All layouts read large files in splits.

    "lines" has objects on lines of their own, "array" one array per file. "auto" finds out per file, from its first split, which costs more
    scans of the files; which file has which layout stays in tables.
    """
    paths = path if isinstance(path, str) else list(path)
    if layout == "lines":
        return json_objects(read_text_logs(spark, paths), TEXT, "lines", strict)
    if layout == "array":
        return read_json_arrays(spark, paths)
    layouts = json_layouts(spark, paths)
    of_lines = read_text_logs(spark, paths)
    names = of_lines.columns
    # the text depends on the layout, so that no text of an array is parsed as a line, wherever Spark puts the filters
    of_lines = of_lines.join(layouts.withColumnRenamed("layout", "_layout"), SOURCE).withColumn(TEXT, F.when(F.col("_layout") == "lines", F.col(TEXT))).select(*(F.col(f"`{n}`") for n in names))
    lines = json_objects(of_lines, TEXT, "lines", strict)
    return lines.unionByName(read_json_arrays(spark, paths, layouts.where("layout = 'array'")))
