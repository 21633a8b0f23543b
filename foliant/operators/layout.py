"""Layout blocks of pages: columns, reading order, formatted pages. Native expressions over block rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as T

GUTTER = 0.02


def single_column(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, single): over two fifths of the text blocks have their centre within 2 % of the page's middle."""
    centre = (F.col("x0") + F.col("x1")) / 2
    text = (F.col("btype") == 0) & (T.strip(F.col("text")) != "")
    near = F.abs(centre - F.col("width") / 2) <= GUTTER * F.col("width")
    return blocks.filter(text).groupBy(*keys).agg((F.avg(near.cast("int")) > 0.4).alias("single"))


def columns(blocks: DataFrame, keys: list[str], quarters: bool = False) -> DataFrame:
    """(keys, col, text): blocks left and right of the gutter, in quarters top and bottom, from the top down; blocks across the gutter are left out."""
    middle, gap = F.col("width") / 2, GUTTER * F.col("width")
    side = F.when(F.col("x1") <= middle + gap, 0).when(F.col("x0") >= middle - gap, 1)
    half = F.when((F.col("y0") + F.col("y1")) / 2 <= F.col("height") / 2, 0).otherwise(1)
    # a, b down the left side and c, d down the right
    col = F.when(side == 0, F.when(half == 0, "a").otherwise("b")).otherwise(F.when(half == 0, "c").otherwise("d")) if quarters else F.when(side == 0, "a").otherwise("b")
    rows = blocks.filter((F.col("btype") == 0) & (T.strip(F.col("text")) != "") & side.isNotNull()).withColumn("col", col)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", T.strip(F.col("text")).alias("t")))), lambda b: b["t"]), "\n")
    return rows.groupBy(*keys, "col").agg(body.alias("text"))


def split_at_spine(lines: DataFrame, keys: list[str], gap: float = 25.0) -> DataFrame:
    """Blocks (keys, page, block, width, x0, y0, x1, text) of text lines; a block over both columns becomes a piece of each.

    lines: (keys, page, block, width, bx0, by0, bx1, lx0, ly0, line), the bounds
    of a line's block and the line's own place. A block spans the spine if it
    reaches further than ``gap`` beyond it on both sides and has lines in both
    columns; its pieces are put in order of their lines' heights, other blocks
    keep the order of ``line_no``. Lines above the page are dropped.
    """
    centre = F.col("width") / 2
    rows = lines.filter((F.col("ly0") >= 0) & (T.strip(F.col("text")) != ""))
    spans = (F.col("bx0") < centre - gap) & (F.col("bx1") > centre + gap)
    own = [*keys, "page", "block"]
    sides = rows.groupBy(*own).agg(F.max((spans & (F.col("lx0") < centre)).cast("int")).alias("l"), F.max((spans & (F.col("lx0") >= centre)).cast("int")).alias("r"), F.max(spans.cast("int")).alias("s"))
    placed = rows.join(sides.select(*own, "s", ((F.col("l") == 1) & (F.col("r") == 1)).alias("both")), own).filter((F.col("s") == 0) | F.col("both"))
    side = F.when(F.col("both"), (F.col("lx0") >= centre).cast("int")).otherwise(((F.col("bx0") + F.col("bx1")) / 2 >= centre).cast("int"))
    order = F.struct(F.when(F.col("both"), F.round("ly0")).alias("y"), F.when(F.col("both"), F.col("lx0")).alias("x"), "line_no", F.struct("lx0", "ly0").alias("at"), T.strip(F.col("text")).alias("t"))
    joined = placed.groupBy(*own, "width", side.alias("col")).agg(F.max("both").alias("both"), F.array_sort(F.collect_list(order)).alias("ls"), F.min("bx0").alias("bx0"), F.min("by0").alias("by0"))
    first = F.col("ls")[0]["at"]
    return joined.select(*own, "width", "col", F.when(F.col("both"), first["lx0"]).otherwise(F.col("bx0")).alias("x0"), F.when(F.col("both"), first["ly0"]).otherwise(F.col("by0")).alias("y0"), F.array_join(F.transform("ls", lambda x: x["t"]), " ").alias("text"))


def reading_order(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks with pos: by page, column, then top to bottom; whole blocks across the spine count to the left column (see ``split_at_spine``)."""
    from pyspark.sql import Window

    col = F.when(F.col("x0") < F.col("width") / 2, 0).otherwise(1)
    order = Window.partitionBy(*keys).orderBy("page", "col", "y0", "x0", "text")
    return blocks.withColumn("col", col).withColumn("pos", F.row_number().over(order))


def formatted_pages(cols: DataFrame, keys: list[str], page: str) -> DataFrame:
    """(keys, text): "[<page><col>]" over each column's text, sections parted by blank lines, in page order."""
    section = F.concat(F.lit("["), F.col(page).cast("string"), F.col("col"), F.lit("]\n"), T.clean_text(F.col("text")))
    rows = cols.filter(F.col(page) >= 1).withColumn("section", section)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, "col", "section"))), lambda s: s["section"]), "\n\n")
    return rows.groupBy(*keys).agg(joined.alias("text"))
