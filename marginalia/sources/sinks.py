"""Outputs: JSON and CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.text import csv_array, csv_cell

HELPERS = ("key", "section_no")  # columns that only join problems to tests


def cells(df: DataFrame) -> list[Column]:
    """Each column as a CSV cell: arrays always quoted, texts where they must be, nulls blank."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType):
            c = csv_array(c.cast("array<string>"))
        elif isinstance(f.dataType, StringType):
            c = csv_cell(c)
        else:
            c = F.coalesce(c.cast("string"), F.lit(""))
        out.append(c.alias(f.name))
    return out


def csv_lines(df: DataFrame) -> DataFrame:
    """line: each row as a line of CSV, without the header."""
    return df.select(F.concat_ws(",", *cells(df)).alias("line"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV lines with a header in each part; an empty table leaves a header alone. Cells are made
    by ``cells``, the writer only adds the header and never quotes."""
    names = df.sparkSession.createDataFrame([tuple(df.columns)], [f"c{i}" for i in range(len(df.columns))])
    header = ",".join(names.select(*[csv_cell(F.col(c)) for c in names.columns]).first())
    options = {"header": True, "quote": "", "escape": "", "escapeQuotes": False, "emptyValue": "", "nullValue": "", "sep": "\u0001", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    csv_lines(df).withColumnRenamed("line", header).write.mode(mode).options(**options).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object on each line, nulls included; a blank path writes nothing."""
    if path.strip():
        df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_normalised(series: DataFrame, tests: DataFrame, problems: DataFrame, folder: str) -> None:
    """series, tests and problems as CSV, problems also as JSON."""
    for name, df in (("series", series), ("tests", tests.drop(*HELPERS)), ("problems", problems)):
        write_csv(df, f"{folder}/{name}.csv")
    write_json(problems, f"{folder}/problems.json")
