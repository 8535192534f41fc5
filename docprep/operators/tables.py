"""Extracted tables: rendering, and merging of tables that continue on the next page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CELL_CHARS, TABLE_ROWS
from ..functions.text import let, strip


def _row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def to_markdown(table: Column) -> Column:
    """TBL1: array of rows of cells; the first row is the header. Fewer than two rows give an empty text."""
    width = F.array_max(F.transform(table, lambda r: F.size(r)))
    cells = F.transform(
        table,
        lambda r: F.transform(
            F.sequence(F.lit(0), width - 1),
            lambda i: F.transform(F.array(strip(F.coalesce(F.get(r, i), F.lit("")))), lambda s: F.when(F.length(s) > CELL_CHARS, F.concat(F.substring(s, 1, CELL_CHARS), F.lit("…"))).otherwise(s))[0],
        ),
    )
    named = F.transform(F.element_at(cells, 1), lambda h, i: F.when(h == "", F.concat(F.lit("Col_"), i.cast("string"))).otherwise(h))
    head = F.transform(named, lambda h, i: F.transform(F.array(F.size(F.filter(F.slice(named, F.lit(1), i), lambda x: x == h))), lambda n: F.when(n > 0, F.concat(h, F.lit("_"), n.cast("string"))).otherwise(h))[0])
    body = F.slice(cells, 2, TABLE_ROWS)
    note = F.when(F.size(table) - 1 > TABLE_ROWS, F.format_string("\n> **Tabla truncada** — se muestran %d de %d filas.\n", F.lit(TABLE_ROWS), F.size(table) - 1)).otherwise("")
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), width))
    md = F.concat(F.lit("\n"), F.array_join(F.concat(F.array(_row(head), rule), F.transform(body, _row)), "\n"), F.lit("\n"), note)
    return F.when(F.size(table) >= 2, md).otherwise("")


def merge_continued(pages: DataFrame, mode: str = "pairs", file: str = "file_name", page: str = "page_no", table: str = "first_table") -> DataFrame:
    """TBL2: file, page, table (null where absorbed). Neighbours with one header merge by twos, or with mode ``full`` whole runs."""
    w = Window.partitionBy(file).orderBy(page)
    header = F.element_at(F.col(table), 1)
    breaks = pages.withColumn("_new", F.when(header.isNotNull() & header.eqNullSafe(F.lag(header).over(w)), 0).otherwise(1))
    runs = breaks.withColumn("_run", F.sum("_new").over(w))
    in_run = Window.partitionBy(file, "_run").orderBy(page)
    placed = runs.withColumn("_at", F.row_number().over(in_run) - 1)
    placed = placed.withColumn("_part", F.floor(F.col("_at") / 2) if mode == "pairs" else F.lit(0))
    part = Window.partitionBy(file, "_run", "_part")
    first = F.row_number().over(part.orderBy(page)) == 1
    return _merged(placed.withColumn("_first", first), file, page, table)


def _merged(d: DataFrame, file: str, page: str, table: str) -> DataFrame:
    own = F.when(F.col("_first"), F.col(table)).otherwise(F.slice(F.col(table), 2, 1 << 30))
    whole = F.collect_list(F.struct(F.col(page).alias("p"), own.alias("t"))).over(Window.partitionBy(file, "_run", "_part"))
    rows = F.flatten(F.transform(F.array_sort(whole), lambda s: s["t"]))
    return d.withColumn(table, F.when(F.col("_first") & F.col(table).isNotNull(), rows)).select(file, page, table)


def with_page_tables(pages: DataFrame, tables: DataFrame, file: str = "file_name", page: str = "page_no", text: str = "text", table: str = "first_table") -> DataFrame:
    """TBL3, JN5: page texts with the rendered table of the page after them."""
    t = tables.select(file, page, F.col(table).alias("_t"))
    return pages.select(file, page, text).join(t, [file, page], "left").select(file, page, F.concat(F.col(text), F.coalesce(to_markdown(F.col("_t")), F.lit(""))).alias(text))


def merge_in_row(tables: Column) -> Column:
    """TBL2 by twos for the tables of one file as an array (null: a page without one): what a page before takes up becomes null."""

    def header(i: Column) -> Column:
        return F.get(F.get(tables, i), F.lit(0))

    def place(seen: Column, i: Column) -> Column:
        same = header(i).isNotNull() & header(i).eqNullSafe(header(i - 1))
        return F.concat(seen, F.array(F.when(same, F.get(seen, i - 1) + 1).otherwise(F.lit(0))))

    def merged(at: Column) -> Column:
        follows = lambda i: F.coalesce(F.get(at, i) % 2 == 1, F.lit(False))
        whole = lambda t, i: F.when(follows(i + 1), F.concat(t, F.slice(F.get(tables, i + 1), 2, 1 << 30))).otherwise(t)
        return F.transform(tables, lambda t, i: F.when(~follows(i), whole(t, i)))

    places = F.aggregate(F.sequence(F.lit(0), F.size(tables) - 1), F.expr("cast(array() as array<int>)"), place)
    return F.when(F.size(tables) > 0, let(places, merged)).otherwise(tables)
