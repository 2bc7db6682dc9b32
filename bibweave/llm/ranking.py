"""Running sums over an order, without putting a whole group into one task.

Rows carry an order key whose leading hex digits are spread evenly (a hash).
Totals per (group, leading digits), the cells, are summed first; a window runs
only inside one cell, and the sum of the cells before is added. A group with a
third of all rows is thus spread over as many tasks as it has cells. Cells are
summed up in the same way, two digits at a time, so no window holds more than
256 of them, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one cell holds on average, at most.
CELL_ROWS = 1024


def digits_for(rows: int, cell_rows: int = CELL_ROWS) -> int:
    """Leading hex digits (1 to 8) that give cells of about ``cell_rows`` rows."""
    n = 1
    while n < 8 and rows > cell_rows * 16**n:
        n += 1
    return n


def source_key(col: str = "source") -> Column:
    """A text whose code-point order is that of the source, null last; never null."""
    c = F.col(col)
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c.cast("string")))


def hashed(seed: str, id_: str = "doc_id", text: str = "text") -> Column:
    """md5 of seed and id, of seed and text for rows without an id."""
    own = F.coalesce(F.col(id_).cast("string"), F.concat(F.lit("null:"), F.coalesce(F.col(text), F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}:"), own).cast("binary"))


def running(df: DataFrame, group: list[str], cell: str, digits: int, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group that come before.

    ``cell`` has so many hex digits, and must not decrease along ``order`` within a group.
    """
    keys = [*group, cell]
    cells = df.groupBy(*keys).agg(F.sum(value).alias("_in_cell"))
    before = cells.select(*keys, F.lit(0).cast("long").alias("_before_cell"))
    for length in range(digits, 0, -2):
        above = max(0, length - 2)
        sums = cells.groupBy(*group, F.substring(cell, 1, length).alias("_p")).agg(F.sum("_in_cell").alias("_s"))
        w = Window.partitionBy(*group, F.substring("_p", 1, above)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select(*group, "_p", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_s"))
        before = before.withColumn("_p", F.substring(cell, 1, length)).join(sums, [*group, "_p"]).select(*keys, (F.col("_before_cell") + F.col("_s")).alias("_before_cell"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(before, keys).withColumn(out, F.col("_before_cell") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_before_cell")
