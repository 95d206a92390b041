"""HTML as arrays of tokens: splitting, filling, grids, styles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TAG = r"(<[^>]+>|[^<]+)"


def tokens(html: Column) -> Column:
    """Tags and the texts between them, in order."""
    return F.regexp_extract_all(html, F.lit(TAG), F.lit(1))


def fill_cells(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Table HTML with recognised texts put into its cells: (table_id, html).

    rows: (table_id, structure array<string>), tokens such as ``<td>`` or ``<td``, `` colspan="2"``, ``>``, ``</td>``.
    texts: (table_id, cell_id from 0, span_id, text); texts of a cell are joined by blanks, in
    span order; where all of them are bold, the bold is stated once.
    """
    listed = F.transform(F.array_sort(F.collect_list(F.struct("span_id", "text"))), lambda x: x.text)
    cells = texts.groupBy("table_id", "cell_id").agg(listed.alias("t"))
    bold = F.forall("t", lambda x: x.startswith("<b>") & x.endswith("</b>"))
    bare = F.transform("t", lambda x: F.regexp_replace(x, "</?b>", ""))
    cells = cells.select("table_id", "cell_id", F.when(bold, F.concat(F.lit("<b>"), F.array_join(bare, " "), F.lit("</b>"))).otherwise(F.array_join("t", " ")).alias("content"))
    by_cell = cells.groupBy("table_id").agg(F.map_from_entries(F.collect_list(F.struct("cell_id", "content"))).alias("content"))
    state = F.struct(F.lit("").alias("html"), F.lit(0).cast("long").alias("cell"))

    def step(acc: Column, token: Column) -> Column:
        ends = token == "</td>"
        text = F.when(ends, F.coalesce(F.col("content")[acc.cell], F.lit(""))).otherwise("")
        both = token == "<td></td>"
        text = F.when(both, F.coalesce(F.col("content")[acc.cell], F.lit(""))).otherwise(text)
        shown = F.when(both, F.concat(F.lit("<td>"), text, F.lit("</td>"))).otherwise(F.concat(text, token))
        return F.struct(F.concat(acc.html, shown).alias("html"), (acc.cell + (ends | both).cast("long")).alias("cell"))

    return rows.join(by_cell, "table_id", "left").select("table_id", F.aggregate("structure", state, step, lambda acc: acc.html).alias("html"))


def first_cells(structure: Column) -> Column:
    """Number, from 0, of the first cell of each row of a token list."""
    state = F.struct(F.lit(0).cast("long").alias("cell"), F.lit(False).alias("wait"), F.array().cast("array<long>").alias("out"))

    def step(acc: Column, token: Column) -> Column:
        opens = token.startswith("<td")
        return F.struct(
            (acc.cell + opens.cast("long")).alias("cell"),
            F.when(token == "<tr>", True).when(opens, False).otherwise(acc.wait).alias("wait"),
            F.when(opens & acc.wait, F.array_append(acc.out, acc.cell)).otherwise(acc.out).alias("out"),
        )

    return F.aggregate(structure, state, step, lambda acc: acc.out)


def until_end(structure: Column, end: str = "eos") -> Column:
    """Decoded tokens before the first end mark."""
    at = F.array_position(structure, F.lit(end))
    return F.when(at > 0, F.slice(structure, F.lit(1), (at - 1).cast("int"))).otherwise(structure)


def grid(tables: DataFrame) -> DataFrame:
    """(table_id, row, place, text, colspan, rowspan) of the cells written in table HTML.

    tables: (table_id, html).  Rows and cells are counted from 0 in writing order.
    """
    trs = tables.select("table_id", F.posexplode(F.regexp_extract_all("html", F.lit("(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "tr"))
    tds = trs.select("table_id", "row", F.posexplode(F.regexp_extract_all("tr", F.lit("(?s)(<t[dh][^>]*>.*?</t[dh]>)"), F.lit(1))).alias("place", "td"))

    def span(name: str) -> Column:
        return F.coalesce(F.regexp_extract("td", f'^<t[dh][^>]*{name}="?(\\d+)', 1).try_cast("int"), F.lit(1))

    return tds.select("table_id", "row", "place", F.trim(F.regexp_replace("td", "<[^>]+>", "")).alias("text"), span("colspan").alias("colspan"), span("rowspan").alias("rowspan"))


def styles(css: Column) -> Column:
    """A style attribute as a map."""
    pairs = F.filter(F.transform(F.split(css, ";"), lambda p: F.split(p, ":", 2)), lambda p: F.size(p) == 2)
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.lower(F.trim(p[0])), F.trim(p[1]))))


def _nearest_line(lines: Column, edge: Column) -> Column:
    """Number of the grid line whose centre is nearest, ties to the first."""
    return F.array_min(F.transform(lines, lambda g: F.struct(F.abs(g.center - edge).alias("d"), g.line.alias("line")))).line


def cells_to_html(cells: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """(page_id, html, n_rows, n_cols): table HTML from cell boxes.

    Edges are clustered into grid lines on both axes; each cell's edges go to the nearest line,
    which gives its row, column and spans.  Where cells claim one place the first (box_id) has it.
    """
    from pagewright.operators.sequence import cluster_positions

    placed = cells
    for axis in "xy":
        edges = cells.select("page_id", F.explode(F.array(f"{axis}1", f"{axis}2")).alias("pos"))
        lines = cluster_positions(edges, tolerance).select("page_id", (F.col("cluster") - 1).cast("int").alias("line"), "center")
        lists = lines.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("line", "center"))).alias(f"_{axis}"))
        placed = placed.join(lists, "page_id")
        for end in "12":
            placed = placed.withColumn(f"_{axis}{end}", _nearest_line(F.col(f"_{axis}"), F.col(f"{axis}{end}")))
    sized = placed.select("page_id", "box_id", "text", F.col("_y1").alias("row"), F.col("_x1").alias("col"), F.greatest(F.col("_y2") - F.col("_y1"), F.lit(1)).alias("rowspan"), F.greatest(F.col("_x2") - F.col("_x1"), F.lit(1)).alias("colspan"))
    first = F.row_number().over(Window.partitionBy("page_id", "row", "col").orderBy("box_id"))
    own = sized.withColumn("_n", first).where("_n = 1").drop("_n")
    attribute = [F.when(F.col(s) > 1, F.concat(F.lit(f' {s}="'), F.col(s), F.lit('"'))).otherwise("") for s in ("rowspan", "colspan")]
    td = F.concat(F.lit("<td"), *attribute, F.lit(">"), F.col("text"), F.lit("</td>"))
    rows = own.withColumn("td", td).groupBy("page_id", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "td"))), lambda x: x.td), "").alias("tds"), F.max(F.col("col") + F.col("colspan")).alias("n_cols"))
    whole = rows.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "tds"))), lambda x: F.concat(F.lit("<tr>"), x.tds, F.lit("</tr>"))), "").alias("body"), F.count(F.lit(1)).alias("n_rows"), F.max("n_cols").alias("n_cols"))
    return whole.select("page_id", F.concat(F.lit("<html><body><table>"), "body", F.lit("</table></body></html>")).alias("html"), "n_rows", "n_cols")
