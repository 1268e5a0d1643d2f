"""Csv records of split files: quoted cells may hold commas, doubled quotes and line ends.

Spark reads a file of any size as lines, in splits that know nothing of each other. Whether a line begins inside a quoted
cell depends on all quotes before it in its file, of which only their number matters, and of that only whether it is odd. So
one aggregate counts the lines with an odd number of quotes in every split, a running sum over the splits of a file says how
many there are before a split, and one over the lines of the few splits that have any says it for every line. All other
splits pass through without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

# Stands before what a comma or itself was replaced by, while cells are cut.
_MARK = "\x01"
_BLANKS = " \t\r\n\f\x0b"


def csv_cells(line: Column) -> Column:
    """The cells of a record; a cell in quotes may hold commas, line ends and doubled quotes, an empty one is null.

    Every second piece between quotes is inside a cell: its commas are set aside while the record is cut at the others, so
    the work is in proportion to the length, whatever the number of cells. Of a record with an odd number of quotes the last
    piece is outside.
    """
    def aside(inside: int) -> Callable[[Column, Column], Column]:
        def one(piece: Column, at: Column) -> Column:
            safe = F.replace(piece, F.lit(_MARK), F.lit(_MARK + "e"))
            return F.when(at % 2 == inside, F.replace(safe, F.lit(","), F.lit(_MARK + "c"))).otherwise(safe)

        return one

    def back(cell: Column) -> Column:
        trimmed = F.btrim(cell, F.lit(_BLANKS))
        inside = F.substring(trimmed, F.lit(2), F.length(trimmed) - 2)
        quoted = F.startswith(trimmed, F.lit('"')) & F.endswith(trimmed, F.lit('"')) & (F.length(trimmed) > 1)
        plain = F.when(quoted, F.replace(inside, F.lit('""'), F.lit('"'))).otherwise(cell)
        return F.replace(F.replace(plain, F.lit(_MARK + "c"), F.lit(",")), F.lit(_MARK + "e"), F.lit(_MARK))

    pieces = F.when(odd_quotes(line) == 0, F.array_join(F.transform(F.split(line, '"'), aside(1)), '"')).otherwise(
        F.array_join(F.transform(F.split(line, '"'), aside(0)), '"'))
    cells = F.when(F.contains(line, F.lit('"')), F.transform(F.split(pieces, ","), back)).otherwise(F.split(line, ","))
    return F.transform(cells, lambda c: F.nullif(c, F.lit("")))


def odd_quotes(line: Column) -> Column:
    """1 if a line has an odd number of quotes, else 0."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2


def quote_state(lines: DataFrame) -> DataFrame:
    """``(file, block_start, odd_before)`` of the splits in which a line begins or ends inside a quoted cell.

    Files whose quotes do not pair up have none: what is inside of them can't be said, and each of their lines is a record.
    """
    counted = lines.groupBy("file", "block_start").agg(F.sum(odd_quotes(F.col("value"))).alias("_odd"))
    order = Window.partitionBy("file").orderBy("block_start")
    before = F.coalesce(F.sum("_odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pairs = F.sum("_odd").over(Window.partitionBy("file")) % 2 == 0
    # One row per split here.
    state = counted.select("file", "block_start", "_odd", before.alias("odd_before"), pairs.alias("_pairs"))
    return state.where(F.col("_pairs") & ((F.col("_odd") > 0) | (F.col("odd_before") % 2 == 1))).drop("_odd", "_pairs")


def whole_records(lines: DataFrame) -> DataFrame:
    """``(file, block_start, row_seq, value)`` of the records of csv files, from all of their lines.

    A record that goes over several lines has the place of its first one, and a line feed where each line ended. Which
    splits a file is cut into, and how they are dealt to tasks, makes no difference.
    """
    columns = ["file", "block_start", "row_seq", "value"]
    state = quote_state(lines)
    on = ["file", "block_start"]
    plain = lines.join(state, on, "left_anti").select(columns)
    mixed = lines.join(state, on).withColumn("_odd", odd_quotes(F.col("value")))
    so_far = Window.partitionBy(on).orderBy("row_seq").rowsBetween(Window.unboundedPreceding, 0)
    mixed = mixed.withColumn("_before", F.col("odd_before") + F.sum("_odd").over(so_far) - F.col("_odd"))
    # The lines of a record share the number of its opening line among the lines that open one; others stand for themselves.
    several = (F.col("_before") % 2 == 1) | (F.col("_odd") == 1)
    own = F.when(~several, F.struct("block_start", "row_seq"))
    record = F.when(several, F.floor(F.col("_before") / 2))
    line = F.struct("block_start", "row_seq", "value")
    joined = mixed.withColumns({"_own": own, "_record": record}).groupBy("file", "_own", "_record").agg(
        F.array_sort(F.collect_list(line)).alias("_lines"))
    first = F.get("_lines", F.lit(0))
    glued = joined.select(
        "file", first["block_start"].alias("block_start"), first["row_seq"].alias("row_seq"),
        F.array_join(F.transform("_lines", lambda x: x["value"]), "\n").alias("value"))
    return plain.unionByName(glued)
