"""CSV and Parquet sources and the curated-table sink.

No schema inference: CSV columns are found by their header names and their cells are
converted with a check, so a bad cell stops the read and nothing turns NULL unseen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ID_COLUMNS
from ..functions.scalar import nan_to_null
from ..operators.reshape import CELLS, header_of, to_cells, with_header

# Columns the planning views keep from the curated table.
CURATED_COLUMNS = ["item_id", "store_id", "state_id", "cat_id", "dept_id", "date", "sales",
                   "sell_price"]


def _by_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV with all columns as text, named by the header (quoted names too); a row with another
    number of cells is an error."""
    return spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)


def _number(c: str, kind: str = "double") -> Column:
    """A numeric cell: ``3.0`` is a whole number, empty and NaN are NULL, anything else is an error.

    Cast without ``try``: a cell that is no number stops the job instead of becoming NULL.
    """
    text = F.trim(F.col(f"`{c}`"))
    value = nan_to_null(F.when(text != "", text).try_cast("double"))
    bad = (text != "") & text.try_cast("double").isNull()
    if kind == "int":
        bad = bad | (value != F.floor(value))
        value = value.cast("int")
    return F.when(bad, F.raise_error(F.concat(F.lit(f"column {c} holds no {kind}: "), text))).otherwise(value).cast(kind).alias(c)


def read_sales_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide sales CSV: text ids, and a whole number for every other column of the header."""
    raw = _by_header(spark, path)
    return raw.select(*[F.col(f"`{c}`") if c in ID_COLUMNS else _number(c, "int") for c in raw.columns])


#: A cell of a CSV line: quoted (a doubled quote inside stands for one), or everything up to the comma.
_CELL = '(?:^|,)("(?:[^"]++|"")*+"|[^,]*)'
#: Whole numbers of up to nine digits and empty cells, separated by commas.
_PLAIN_NUMBERS = "(?:\\s*+(?:[+-]?[0-9]{1,9})?+\\s*+(?:,|$))*+"


def _cells(line: Column) -> Column:
    """The cells of a CSV line."""
    bare = F.transform(F.regexp_extract_all(line, F.lit(_CELL), F.lit(1)), lambda c: F.when(
        c.startswith('"'), F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), '""', '"')).otherwise(c))
    return F.when(line.contains('"'), bare).otherwise(F.split(line, ",", -1))


def _whole_numbers(cells: Column, names: list[str]) -> Column:
    """Text cells as an array of whole numbers: one cast of the array where all cells are plain; else each
    cell with its check, as ``_number`` does it."""
    def checked(c, i):
        text = F.trim(c)
        value = nan_to_null(F.when(text != "", text).try_cast("double"))
        bad = ((text != "") & text.try_cast("double").isNull()) | (value != F.floor(value))
        return F.when(bad, F.raise_error(F.concat(F.lit("column "), F.get(F.lit(names), i), F.lit(" holds no int: "), text))).otherwise(value.cast("int"))

    plain = F.array_join(cells, ",").rlike(f"\\A{_PLAIN_NUMBERS}\\z")
    return F.when(plain, cells.try_cast("array<int>")).otherwise(F.transform(cells, checked))


def read_sales_cells_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide sales CSV: the text ids, and the other cells of each line as one ``cells array<int>``.

    The line is read as text and split once, so the schema has one column for all days.
    Every file's header line must be that of the first; a line with another number of cells,
    or a cell that is no whole number, stops the read.
    """
    lines = spark.read.text(path)
    head = lines.where(F.length(F.trim("value")) > 0).select(F.col("value"), _cells(F.col("value")).alias("names")).first()
    if head is None:
        raise ValueError(f"{path} has no header line")
    names = [n.lstrip("\ufeff") for n in head["names"]]
    missing = [c for c in ID_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {missing}")
    days = [n for n in names if n not in ID_COLUMNS]
    at = {n: i for i, n in enumerate(names)}
    # Spark may test the cells of a line before it drops header lines, so these have none.
    is_row = (F.col("value") != F.lit(head["value"])) & (F.length(F.trim("value")) > 0)
    rows = lines.where(is_row).select(F.when(is_row, _cells(F.col("value"))).alias("c"))
    wrong = F.raise_error(F.concat(F.lit(f"a line of {path} has "), F.size("c").cast("string"), F.lit(f" cells, not {len(names)}")))
    rows = rows.select(F.when(F.col("c").isNull() | (F.size("c") == len(names)), F.col("c")).otherwise(wrong).alias("c"))
    first = len(names) - len(days)
    if names[first:] == days:  # the ids stand first, as they usually do
        cells = F.slice("c", first + 1, len(days)) if days else F.array().cast("array<string>")
    else:
        cells = F.array(*[F.get("c", at[n]) for n in days])
    ids = [F.when(F.get("c", at[i]) != "", F.get("c", at[i])).alias(i) for i in ID_COLUMNS]
    return rows.select(*ids, with_header(_whole_numbers(cells, days) if days else cells.cast("array<int>"), header_of(days)))


def write_sales_cells_csv(wide: DataFrame, path: str) -> None:
    """A cells table as wide CSV files, each with the header line."""
    header = wide.schema[CELLS].metadata["header"]
    if "names" in header:
        days = F.lit(header["names"])
    else:
        days = F.transform(F.sequence(F.lit(0), F.size(CELLS) - 1), lambda i: F.concat(F.lit(header["prefix"]), (i + header["first"]).cast("string")))

    def cell(c) -> Column:
        return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))

    values = F.transform(CELLS, lambda v: F.coalesce(v.cast("string"), F.lit("")))
    line = F.concat_ws(",", *[cell(c) for c in ID_COLUMNS], values)
    head = F.concat_ws(",", *[F.lit(c) for c in ID_COLUMNS], days)
    # The first row of each task, and so of each file, brings the header.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = wide.select(first.alias("first"), head.alias("head"), line.alias("line"))
    lines.select(F.explode(F.when(F.col("first"), F.array("head", "line")).otherwise(F.array("line"))).alias("value")).write.text(path)


def read_sales_cells_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A wide Parquet file (a column for each day) as ids and one ``cells array<int>``."""
    return to_cells(spark.read.parquet(path))


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Calendar CSV; only ``d, date, wm_yr_wk`` are used (other columns ignored)."""
    raw = _by_header(spark, path)
    return raw.select(F.col("d"), F.to_date("date").alias("date"), _number("wm_yr_wk", "int"))


def read_prices_csv(spark: SparkSession, path: str) -> DataFrame:
    """Prices by column name, whatever their order in the file."""
    raw = _by_header(spark, path)
    return raw.select("store_id", "item_id", _number("wm_yr_wk", "int"), _number("sell_price"))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """Parquet scan; column selection and predicates reach the file reader
    (``ReadSchema`` / ``PushedFilters``, and ``PartitionFilters`` on a
    store-partitioned table)."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    if where is not None:
        df = df.filter(where)
    return df


def read_curated(spark: SparkSession, path: str, item_id: str | None = None,
                 store_id: str | None = None) -> DataFrame:
    """The curated table with the planning columns, optionally one series."""
    cond = F.lit(True)
    if item_id:
        cond = cond & (F.col("item_id") == F.lit(item_id))
    if store_id:
        cond = cond & (F.col("store_id") == F.lit(store_id))
    return read_parquet(spark, path, CURATED_COLUMNS, cond)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
