"""Text logs: files, binary data, table columns and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns every text source has: the line, its file, its split of the file, its place in the split.
TEXT, SOURCE, BLOCK, LINE = "value", "source", "block", "line"


def place_of_lines(lines: DataFrame) -> DataFrame:
    """The lines of a file source with their file, split and place."""
    return lines.select(
        *[F.col(f"`{name}`") for name in lines.columns],  # the text and partition columns, if any
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(LINE),
    )


def read_text_logs(
    spark: SparkSession, path: str | Sequence[str], where: str | Column | None = None, wholetext: bool = False
) -> DataFrame:
    """Lines of text files. Large files are read in splits; (source, block, line) is the file order.

    ``where`` selects files by partition columns or ``_metadata`` before anything is read. (A later filter
    cannot do that: Spark does not move filters below generated line numbers.) ``wholetext`` reads each
    file as one text.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path), wholetext=wholetext)
    if where is not None:
        lines = lines.where(where)
    return place_of_lines(lines)


def read_binary_logs(spark: SparkSession, path: str | Sequence[str], strict: bool = True) -> DataFrame:
    """Lines of UTF-8 files. Bytes that are not UTF-8 fail the job, or (not strict) give a NULL line."""
    check = F.validate_utf8 if strict else F.try_validate_utf8
    return read_text_logs(spark, path).withColumn(TEXT, check(TEXT))


def read_text_stream(
    spark: SparkSession, path: str, max_files: int | None = None, numbered: bool = False, placed: bool = False
) -> DataFrame:
    """Lines of newly added files, as a stream: (value, source).

    Streams know no line order; ``numbered`` adds it (line, and block for pieces of 100,000 lines) by
    reading each file as a whole, which suits small rolled log files. ``placed`` adds the file's split (block) only, so that large files
    are read in splits; ``EventAssembly.of_files`` numbers their lines in its batches. Kafka and the like have offsets instead.
    """
    if numbered and placed:
        raise ValueError("numbered and placed exclude each other")
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path, wholetext=numbered).select(
        F.col("value").alias(TEXT), F.col("_metadata.file_path").alias(SOURCE),
        *([F.col("_metadata.file_block_start").alias(BLOCK)] if placed else []),
    )
    if not numbered:
        return lines
    body = F.regexp_replace(TEXT, F.lit("\\r?\\n\\z"), F.lit(""))
    split = lines.select(SOURCE, F.posexplode(F.split(body, "\r?\n", -1)).alias(LINE, TEXT))
    return split.select(TEXT, SOURCE, F.floor(F.col(LINE) / 100_000).alias(BLOCK), LINE)


def from_strings(spark: SparkSession, texts: Sequence[str | bytes]) -> DataFrame:
    """In-memory texts as a table, for trying out rules."""
    if isinstance(texts, (str, bytes)):
        texts = [texts]
    for text in texts:
        if not isinstance(text, (str, bytes)):
            raise TypeError(f"a text must be str or bytes, not {type(text).__name__}")
    rows = [(i, t.decode("utf-8") if isinstance(t, bytes) else t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"{LINE} long, {TEXT} string")


def text_column(df: DataFrame, name: str = TEXT, strict: bool = True) -> Column:
    """The column as text: strings as they are, binary data as UTF-8. Other types are refused."""
    data_type = df.select(name).schema[0].dataType
    if isinstance(data_type, T.StringType):
        return F.col(name)
    if isinstance(data_type, T.BinaryType):
        check = F.validate_utf8 if strict else F.try_validate_utf8
        return check(F.col(name).cast("string"))
    raise TypeError(f"column {name!r} must hold text or binary data, not {data_type.simpleString()}")


def as_logs(spark: SparkSession | None, source) -> DataFrame:
    """Any accepted input as a DataFrame: a DataFrame, a path or paths of text files."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str) or (
        isinstance(source, (list, tuple)) and source and all(isinstance(p, str) for p in source)
    ):
        spark = spark or SparkSession.getActiveSession()
        return read_text_logs(spark, source)
    raise TypeError(f"the input must be a DataFrame or paths, not {type(source).__name__}")
