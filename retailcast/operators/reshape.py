"""Reshape and projection operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ID_COLUMNS


#: The array column that holds a wide row's day cells, in the order of the header.
CELLS = "cells"


def numbered_days(prefix: str = "d_", first: int = 1) -> dict:
    """Header of a cells column whose names follow a rule: ``d_1, d_2, ...``."""
    return {"prefix": prefix, "first": first}


def header_of(names: Sequence[str]) -> dict:
    """Header of a cells column: the rule if the names follow one, else the names themselves."""
    names = list(names)
    rule = numbered_days()
    return rule if names == [f"{rule['prefix']}{rule['first'] + i}" for i in range(len(names))] else {"names": names}


def with_header(cells: Column, header: Mapping, name: str = CELLS) -> Column:
    """A cells column that knows its header (kept as metadata of the column)."""
    return cells.alias(name, metadata={"header": dict(header)})


def to_cells(wide: DataFrame, id_vars: Sequence[str] = ID_COLUMNS, value_type: str = "int") -> DataFrame:
    """A table with a column for each day -> the ids and one array column (mixed types are cast to one)."""
    value_cols = [c for c in wide.columns if c not in set(id_vars)]
    # Built as one SQL expression: constructing thousands of Column objects
    # one by one through the Python bridge costs more than running the melt.
    items = ",".join("`{}`".format(c.replace("`", "``")) for c in value_cols)
    one = F.expr(f"array({items})").cast(f"array<{value_type}>")
    return wide.select(*[F.col(f"`{c}`") for c in id_vars], with_header(one, header_of(value_cols)))


def melt_cells(wide: DataFrame, var_name: str = "d", value_name: str = "sales") -> DataFrame:
    """One row for each cell of the ``cells`` array: ``posexplode``, and the name from the position.

    The plan has one array column and one generator, however many days there are.
    """
    header = wide.schema[CELLS].metadata["header"]
    if "names" in header:
        name = F.get(F.lit(header["names"]) if header["names"] else F.array().cast("array<string>"), F.col("pos"))
    else:
        name = F.concat(F.lit(header["prefix"]), (F.col("pos") + header["first"]).cast("string"))
    ids = [F.col(f"`{c}`") for c in wide.columns if c != CELLS]
    return wide.select(*ids, F.posexplode(CELLS).alias("pos", value_name)).select(*ids, name.alias(var_name), F.col(f"`{value_name}`"))


def melt(wide: DataFrame, id_vars: Sequence[str] = ID_COLUMNS,
         var_name: str = "d", value_name: str = "sales",
         value_type: str = "int") -> DataFrame:
    """Wide -> long: every non-id column, or every cell of a ``cells`` array, becomes a row ``(var_name, value)``."""
    cells = wide if CELLS in wide.columns else to_cells(wide, id_vars, value_type)
    return melt_cells(cells, var_name, value_name)


def to_model_input(df: DataFrame, date_col: str = "date", sales_col: str = "sales",
                   keys: Sequence[str] = ("item_id", "store_id"),
                   extra: Sequence[str] = ()) -> DataFrame:
    """Select and rename to ``ds, y`` (``y`` as double), keeping the series keys."""
    return df.select(*keys, F.col(date_col).cast("date").alias("ds"),
                     F.col(sales_col).cast("double").alias("y"), *extra)


def rename(df: DataFrame, mapping: Mapping[str, str], keep_only: bool = True) -> DataFrame:
    """Rename to display names; by default keep only the mapped columns."""
    if keep_only:
        return df.select(*[F.col(k).alias(v) for k, v in mapping.items()])
    return df.withColumnsRenamed(dict(mapping))


def metrics_side_by_side(long_metrics: DataFrame, key_cols: Sequence[str],
                         slot_col: str = "slot", slots: Sequence[str] = ("A", "B"),
                         metric_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Metric rows x slot columns: ``groupBy(keys, metric).pivot(slot)``."""
    return (long_metrics.groupBy(*key_cols, metric_col)
            .pivot(slot_col, list(slots)).agg(F.first(value_col)))
