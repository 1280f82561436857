"""Scans: source tables with a fixed schema, declared-only tables, and uploaded CSV files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketry.schemas import DECLARED_ONLY, SOURCE_SCHEMAS


def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one source table, stored as ``<folder>/<name>.parquet``."""
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def register_declared(spark: SparkSession, folder: str) -> list[str]:
    """Make the declared-only tables that exist available to SQL; return their names."""
    registered = []
    for name in DECLARED_ONLY:
        try:
            df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        df.createOrReplaceTempView(name)
        registered.append(name)
    return registered


# ------------------------------------------------------------------- CSV

# The spellings of a missing cell.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# The spellings of a boolean cell.
BOOLEAN_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
ANY_NUMBER = (
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
)


def _cell(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scan a CSV file with a header, inferring each column's type from all its cells.

    A column is whole numbers (bigint), numbers (double), booleans or text. As in a
    pandas frame, whole numbers with missing cells become doubles and booleans with
    missing cells stay text. Quoted cells may hold line breaks, at the price of reading
    each file in one task; large files without any are read in pieces with
    ``multi_line=False``. Short rows are filled up with missing cells; a row with a filled cell
    beyond the header is an error. The file is read for its header, for types and faults, and for its rows.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line)
    names = reader.csv(path).columns
    # The text of rows that have more or fewer cells than the header.
    uneven = "_row" + "_" * max(map(len, names), default=0)
    columns = StructType([StructField(c, StringType()) for c in [*names, uneven]])
    raw = reader.option("columnNameOfCorruptRecord", uneven).schema(columns).csv(path)
    cells = raw.select(
        *[F.when(~_cell(c).isin(*MISSING_TOKENS), _cell(c)).alias(c) for c in names], _cell(uneven)
    )
    # One pass over the file decides every type and finds rows that are too long.
    counts = cells.agg(
        F.count("*").alias("rows"),
        F.max(F.when(_cells_of(_cell(uneven)) > len(names), _cell(uneven))).alias("too_long"),
        *[
            F.struct(
                F.count(_cell(c)).alias("present"),
                F.count_if(_cell(c).rlike(WHOLE_NUMBER) & _as_long(c).isNotNull()).alias("whole"),
                F.count_if(_cell(c).rlike(ANY_NUMBER)).alias("number"),
                F.count_if(_cell(c).isin(*BOOLEAN_TOKENS)).alias("boolean"),
            ).alias(f"c{i}")
            for i, c in enumerate(names)
        ],
    ).first()
    if counts.too_long is not None:
        raise ValueError(f"{path}: more cells than the header has, in {counts.too_long!r}")
    return cells.select(
        *[_typed(c, counts[f"c{i}"], counts["rows"]).alias(c) for i, c in enumerate(names)]
    )


def _cells_of(row: Column) -> Column:
    """Cells of a row's text up to the last that is not empty; what is quoted counts as one character."""
    bare = F.regexp_replace(F.regexp_replace(row, r'"(?:[^"]|"")*"', "q"), r"[,\s]+$", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _as_long(name: str) -> Column:
    return F.trim(_cell(name)).try_cast("long")


def _typed(name: str, counts, rows: int) -> Column:
    if counts.present == 0:
        # Nothing but missing cells: a column of missing numbers.
        return F.lit(None).cast("double")
    if counts.whole == counts.present == rows:
        return _as_long(name)
    if counts.number == counts.present:
        return F.trim(_cell(name)).cast("double")
    if counts.boolean == counts.present == rows:
        return F.lower(_cell(name)).cast("boolean")
    return _cell(name)
