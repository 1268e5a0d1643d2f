"""Column expressions shared by the checks. Each one is a built-in Spark expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

# Row amounts are read with eight decimals, so that sums are exact and do not depend on
# how the rows are spread over tasks.
MONEY = "decimal(28,8)"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def slice_long(text, start, end) -> Column:
    """The whole number in ``text`` from ``start`` to ``end`` (0-based, end left out).

    The positions may be ints or columns, as every job can have its own. Null when the
    piece is no whole number or the positions are not ``0 <= start < end``.
    """
    text = _col(text)
    start = F.lit(start) if isinstance(start, int) else _col(start)
    end = F.lit(end) if isinstance(end, int) else _col(end)
    piece = F.trim(F.substring(text, start + F.lit(1), end - start))
    return F.when((start >= 0) & (start < end), piece.try_cast("bigint"))


def as_money(value) -> Column:
    """An amount as a decimal. Text that is no number gives null and so drops out of sums."""
    return _col(value).try_cast(MONEY)


def whole_amount(value) -> Column:
    """An amount without its fraction, cut toward zero."""
    return _col(value).cast("bigint")


def clock_text(ts) -> Column:
    return F.date_format(_col(ts), "HH:mm:ss")


def shift_minutes(ts, minutes) -> Column:
    """``ts`` moved by a number of minutes, which may have a fraction."""
    seconds = (_col(minutes) * F.lit(60)).cast("decimal(18,6)")
    return _col(ts) + F.make_interval(secs=seconds)


def is_blank(value) -> Column:
    return F.coalesce(F.trim(_col(value)), F.lit("")) == ""


def first_comma_split(line) -> tuple[Column, Column]:
    """(text before the first comma, text after it or '' when there is no comma)."""
    parts = F.split(_col(line), ",", 2)
    return parts[0], F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


def file_label(prefix: str, ts, suffix: str = ".csv") -> Column:
    return F.concat(F.lit(prefix), F.date_format(_col(ts), "yyyyMMdd"), F.lit(suffix))


def cell_text(name: str, dtype: DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(dtype, (ArrayType, MapType, StructType, VariantType)):
        return F.to_json(column, {
            "ignoreNullFields": "false",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        })
    return column.cast("string")


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One text per row in which no two different rows look alike.

    Every cell is written as its length, a colon and its text; a null cell as '-'. So a
    separator inside a cell can not move a cell border, and null differs from ''.
    """
    cells = []
    for name in columns or df.columns:
        text = cell_text(name, df.schema[name].dataType)
        cells.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*cells)
