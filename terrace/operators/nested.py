"""Nested data and semi-structured tables (NEST-1 to NEST-10, RSH-1, RSH-2, FLT-8).

A grid is array<array<string>>: the rows of a raw table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.text import collapse, fold_header
from terrace.sources.storage import stored


def flatten_tree(df: DataFrame, root: str, depth: int, fields: list[str], present: str, children: str = "children", keep: list[str] = ()) -> DataFrame:
    """Rows of a nested tree: the kept columns, level, the fields, and each ancestor's first field as name_1, name_2, ...

    A node without ``present`` gives no row, but its children do. One pass: the nodes of all levels become one array.
    """

    def nodes(n: Column, above: list[Column], level: int) -> Column:
        padding = [F.lit(None).cast("string")] * (depth - 1 - len(above))
        names = [x.alias(f"name_{k + 1}") for k, x in enumerate([*above, *padding])]
        own = F.filter(F.array(F.struct(F.lit(level).alias("level"), *(n[f].alias(f) for f in fields), *names)), lambda _: n[present].isNotNull())
        if level == depth:
            return own
        below = F.flatten(F.transform(n[children], lambda c: nodes(c, [*above, n[fields[0]].cast("string")], level + 1)))
        return F.concat(own, F.when(n[children].isNotNull(), below).otherwise(F.slice(own, 1, 0)))

    return df.select(*keep, F.explode(nodes(F.col(root), [], 1)).alias("n")).select(*keep, "n.*")


def find_field(df: DataFrame, json: str, field: str, keep: list[str], depth: int | None = None) -> DataFrame:
    """(keep..., depth, value) for each place where a JSON text holds the field, however deep, or down to ``depth``.

    The texts are read and parsed once. A level of nesting is one small table: its objects and arrays, opened, are
    the next, so the work ends with the deepest text and shrinks on the way.
    """
    spark, opened = df.sparkSession, F.expr("schema_of_variant(v) RLIKE '^(OBJECT|ARRAY)'")
    dealt = df.repartition(*keep, json)  # a small file may hold many texts
    at, found, level = stored(dealt.select(*keep, F.try_parse_json(json).alias("v")).where(opened), "level"), [], 0
    while True:
        level += 1
        spread = spark.sql(f"SELECT {', '.join(f't.`{k}`' for k in keep)}, e.key AS _key, e.value AS v FROM {{at}} t, LATERAL variant_explode(t.v) e", at=at)
        spread = stored(spread.where((F.col("_key") == field) | opened), "level")
        found.append(spread.where(F.col("_key") == field).select(*keep, F.lit(level).alias("depth"), F.to_json("v").alias("value")))
        at = spread.where(opened).select(*keep, "v")
        if level == depth or at.isEmpty():
            return reduce(DataFrame.unionByName, found)


def explode_elements(df: DataFrame, response: str, schema: str, keep: list[str]) -> DataFrame:
    """One row for each element of a response text: the kept columns and the element's fields."""
    elements = F.from_json(F.col(response), f"elements array<{schema}>")["elements"]
    return df.select(*keep, F.explode(elements).alias("e")).select(*keep, "e.*")


def choose_table(tables: Column, marker: str) -> Column:
    """The first grid whose first cell, folded, is the marker's; null without one."""
    return F.get(F.filter(tables, lambda t: fold_header(F.get(F.get(t, F.lit(0)), F.lit(0))) == fold_header(F.lit(marker))), F.lit(0))


def padded(row: Column, width: Column) -> Column:
    """A row cut or filled with nulls to a width."""
    return F.slice(F.concat(row, F.array_repeat(F.lit(None).cast("string"), width)), F.lit(1), width)


def grid_records(df: DataFrame, grid: str, keep: list[str]) -> DataFrame:
    """(keep..., row_number, record): maps from the header row's labels to the cells of each further row."""
    header = F.get(F.col(grid), F.lit(0))
    rows = df.select(*keep, header.alias("_h"), F.posexplode(F.slice(F.col(grid), 2, F.greatest(F.size(grid) - 1, F.lit(0)))).alias("_p", "_r"))
    return rows.select(*keep, (F.col("_p") + 1).alias("row_number"), F.map_from_arrays("_h", padded(F.col("_r"), F.size("_h"))).alias("record"))


def merged_header(first: Column, second: Column) -> Column:
    """One header row out of two: an empty cell takes the label before it, and sub-labels follow theirs.

    The second row counts as sub-labels only if one of its cells names an amount, a share or deposits.
    """
    clean = lambda row: F.transform(row, lambda c: collapse(F.coalesce(c, F.lit(""))))
    top, sub = clean(first), clean(second)
    n = F.greatest(F.size(top), F.size(sub))
    fill = lambda row: F.transform(padded(row, n), lambda c: F.coalesce(c, F.lit("")))
    carried = F.aggregate(fill(top), F.array().cast("array<string>"), lambda out, c: F.concat(out, F.array(F.when(c != "", c).otherwise(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(""))))))
    labelled = F.exists(sub, lambda c: F.lower(c).contains("montant") | c.contains("%") | F.lower(c).contains("dépôts"))
    return F.when(labelled, F.zip_with(carried, fill(sub), lambda a, b: F.trim(F.concat_ws(" ", a, b)))).otherwise(top)


def expand_cells(df: DataFrame, row: str, keep: list[str]) -> DataFrame:
    """(keep..., line, row): a row whose cells all hold n lines becomes n rows; any other stays one."""
    parts = F.transform(F.col(row), lambda c: F.split(F.coalesce(c, F.lit("")), "\n"))
    sizes = F.array_distinct(F.transform(F.filter(parts, lambda p: p != F.array(F.lit(""))), F.size))
    many = (F.size(sizes) == 1) & (F.get(sizes, F.lit(0)) > 1)
    lines = F.when(many, F.get(sizes, F.lit(0))).otherwise(1)
    spread = df.select(*keep, F.col(row).alias("_row"), parts.alias("_parts"), many.alias("_many"), F.explode(F.sequence(F.lit(1), lines)).alias("line"))
    cells = F.when(F.col("_many"), F.transform("_parts", lambda p: F.get(p, F.col("line") - 1))).otherwise(F.col("_row"))
    return spread.select(*keep, "line", cells.alias("row"))


def expanded_grid(grid: Column) -> Column:
    """A grid whose third row's cells all hold the same number of lines, with these lines as rows.

    Below two header rows such a table has one row of cells and, unless that is of lines too, one summary row.
    """
    third, fourth = F.coalesce(F.get(grid, F.lit(2)), F.array().cast("array<string>")), F.get(grid, F.lit(3))
    parts = F.transform(third, lambda c: F.split(F.coalesce(c, F.lit("")), "\n"))
    sizes = F.array_distinct(F.transform(F.filter(parts, lambda p: p != F.array(F.lit(""))), F.size))
    n = F.get(sizes, F.lit(0))
    lines = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(parts, lambda p: F.get(p, i)))
    summary = F.when(~F.coalesce(F.exists(fourth, lambda c: F.contains(F.coalesce(c, F.lit("")), F.lit("\n"))), F.lit(True)), F.slice(grid, 4, 1)).otherwise(F.slice(grid, 1, 0))
    return F.when((F.size(sizes) == 1) & (n > 1), F.concat(F.slice(grid, 1, 2), lines, summary)).otherwise(grid)


# Words one of which a header row holds.
HEADER_WORDS = ("rayon", "localite", "code", "dépôts", "crédit", "nombre")


def header_index(grid: Column) -> Column:
    """0-based index of the header among the first three rows, 0 by default."""
    has = lambda row: F.exists(row, lambda c: reduce(lambda a, b: a | b, (F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(w)) for w in HEADER_WORDS)))
    return F.greatest(F.array_position(F.transform(F.slice(grid, 1, 3), has), True).cast("int") - 1, F.lit(0))


def table_rows(df: DataFrame, grid: str, keep: list[str]) -> DataFrame:
    """(keep..., row_number, record) of a grid with a two-row header: cells of lines become rows, blank first cells and totals are dropped."""
    df = df.select(*keep, expanded_grid(F.col(grid)).alias(grid))
    at = df.withColumn("_at", header_index(F.col(grid)))
    head = at.withColumn("_h", merged_header(F.get(F.col(grid), F.col("_at")), F.coalesce(F.get(F.col(grid), F.col("_at") + 1), F.array().cast("array<string>"))))
    rows = head.select(*keep, "_h", F.posexplode(F.slice(F.col(grid), F.col("_at") + 3, F.greatest(F.size(grid) - F.col("_at") - 2, F.lit(0)))).alias("_p", "_r"))
    rows = rows.where(data_row(F.get("_r", F.lit(0))))
    names = F.transform("_h", lambda h, i: F.when(h == "", F.concat(F.lit("column_"), i.cast("string"))).otherwise(h))
    return rows.select(*keep, (F.col("_p") + 1).alias("row_number"), F.map_from_arrays(names, padded(F.col("_r"), F.size("_h"))).alias("record"))


def data_row(first_cell: Column) -> Column:
    """Neither blank nor a total."""
    t = F.trim(F.coalesce(first_cell, F.lit("")))
    return (t != "") & ~F.lower(t).startswith("total")


def with_period(record: Column, period: Column, key: str = "periode") -> Column:
    """The record with a period, unless it has one."""
    return F.when(F.map_contains_key(record, key), record).otherwise(F.map_concat(record, F.create_map(F.lit(key), period)))


def sheet_records(df: DataFrame, record: str, keep: list[str], position: str) -> DataFrame:
    """Records without their null cells; those with none left are dropped, the rest numbered from 1 by keep."""
    full = df.select(*keep, position, F.map_filter(F.col(record), lambda k, v: v.isNotNull()).alias("record")).where(F.size("record") > 0)
    return full.withColumn("row_number", F.row_number().over(Window.partitionBy(*keep).orderBy(position))).drop(position)


def unpivot_series(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row for each id and column that holds something."""
    return df.unpivot(ids, columns, name, value).where(F.col(value).isNotNull() & (F.trim(F.col(value).cast("string")) != ""))


def pivot_series(df: DataFrame, ids: list[str], name: str, values: list[str], value: Column) -> DataFrame:
    """Wide table with one column for each of the given names; one pass, no scan for the names."""
    return df.groupBy(*ids).pivot(name, values).agg(value)
