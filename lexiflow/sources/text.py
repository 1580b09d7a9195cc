"""Labelled text lines ``text;label``, one record per line.

The reference read these files with the comma-separated reader, so text after
a comma was lost with its label; here lines are read whole with
``spark.read.text`` and split on the label separator ourselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_part

MALFORMED_POLICIES = ("keep", "drop", "fail")


def parse_labeled_lines(df: DataFrame, line_col: str = "value", sep: str = ";",
                        text_col: str = "text", label_col: str = "emotion",
                        malformed: str = "keep", keep: list[str] | None = None) -> DataFrame:
    """Split each line into (text, label): parts 0 and 1; further parts are dropped.

    A line with no separator (or an empty line) is *malformed*: its label is null.
    ``malformed`` chooses what happens to it: ``keep`` (label null), ``drop`` or
    ``fail`` (the query raises when such a row is evaluated).
    """
    if malformed not in MALFORMED_POLICIES:
        raise ValueError(f"malformed must be one of {MALFORMED_POLICIES}")
    line = F.col(line_col)
    text = split_part(line, sep, 0)
    label = split_part(line, sep, 1)
    bad: Column = label.isNull()
    if malformed == "fail":
        label = F.when(bad, F.raise_error(F.concat(F.lit("malformed labelled line: "), line))).otherwise(label)
    cols = [F.col(c) for c in (keep or [])] + [text.alias(text_col), label.alias(label_col)]
    out = df.select(*cols)
    if malformed == "drop":
        out = out.filter(F.col(label_col).isNotNull())
    return out


def read_labeled_text(spark: SparkSession, path: str | list[str], sep: str = ";",
                      text_col: str = "text", label_col: str = "emotion",
                      malformed: str = "keep") -> DataFrame:
    """Read one or more text files of ``text<sep>label`` lines."""
    lines = spark.read.text(path)
    return parse_labeled_lines(lines, "value", sep, text_col, label_col, malformed)


def read_labeled_files(spark: SparkSession, path: str | list[str], sep: str = ";", text_col: str = "text",
                       label_col: str = "emotion") -> tuple[DataFrame, DataFrame]:
    """(records, malformed) of text files of ``text<sep>label`` lines.

    ``records`` has the text, the label and the line's ``file``; ``malformed`` has ``file`` and ``line`` of each line
    without a label, so that a bad file can be found and mended.  Both are read from the files when they
    are used; nothing is dropped in silence.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    bad = split_part(F.col("line"), sep, 1).isNull()
    records = parse_labeled_lines(lines.filter(~bad), "line", sep, text_col, label_col, keep=["file"])
    return records, lines.filter(bad).select("file", "line")
