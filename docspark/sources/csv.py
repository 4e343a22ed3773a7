"""Delimited data as text: one document per row, or a table with many rows per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docspark.functions.text import or_placeholder
from docspark.operators.joins import left_join_unique
from docspark.session import materialize

# --- Fixed values ---
EMPTY_CSV = "(empty CSV)"
COLUMNS, TOTAL_ROWS, ROW, EXTRA_COLUMN = "Columns: ", "Total rows: ", "Row ", "col_"
# one field: quoted (an open quote runs to the end), plain, or empty; then one record
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+(?:"[^,\r\n]*+|\z)|[^",\r\n][^,\r\n]*+|)'
RECORD = rf"({FIELD}(?:,{FIELD})*+)(?:\r\n|\r|\n|\z)"
# a line, begun outside a quoted cell, that ends inside one
CLOSED = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,\r]*+|[^",\r][^,\r]*+|)'
OPEN = rf'\A(?:{CLOSED}[,\r])*+"[^"]*+(?:""[^"]*+)*+\z'
QUOTED = r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"?+(.*)\z'

# Not fixed: the default number of rows in one part of a table's text
PART_ROWS = 1000
SALTS = 64


def _fields(record: Column) -> Column:
    """Cells of a record; a blank line has none."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({FIELD})"), F.lit(1))

    def unquote(cell: Column) -> Column:
        inner = F.replace(F.regexp_extract(cell, QUOTED, 1), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"'), F.concat(inner, F.regexp_extract(cell, QUOTED, 2))).otherwise(cell)

    return F.when(record == "", F.array().cast("array<string>")).otherwise(F.transform(cells, unquote))


def _row_text(head: Column, cells: Column, number: Column) -> Column:
    def pair(cell: Column, j: Column) -> Column:
        name = F.coalesce(F.get(head, j), F.concat(F.lit(EXTRA_COLUMN), j.cast("string")))
        return F.concat(name, F.lit(": "), cell)

    return F.concat(F.lit(ROW), number.cast("string"), F.lit(": "), F.array_join(F.transform(cells, pair), " | "))


def _full_text(names: Column, rows: Column, shown: Column) -> Column:
    return F.concat(
        F.lit(COLUMNS), names, F.lit("\n" + TOTAL_ROWS), rows.cast("string"), F.lit("\n"),
        F.when(rows > 0, F.concat(F.lit("\n"), shown)).otherwise(""),
    )


def parse(df: DataFrame, content: str = "content", prefix: str = "") -> DataFrame:
    """Add raw_content, meta_row_count and meta_column_count for CSV text held in a column."""
    records, head = f"{prefix}_records", f"{prefix}_head"
    raw = F.col(content)
    # past the last record the pattern matches once more, on nothing
    df = df.withColumn(records, F.regexp_extract_all(raw, F.lit(RECORD), F.lit(1)))
    df = df.withColumn(records, F.slice(records, F.lit(1), F.greatest(F.size(records) - 1, F.lit(0))))
    df = df.withColumn(head, _fields(F.get(records, F.lit(0))))
    rows = F.greatest(F.size(records) - 1, F.lit(0))
    shown = F.transform(
        F.slice(F.col(records), F.lit(2), F.greatest(rows, F.lit(1))), lambda r, i: _row_text(F.col(head), _fields(r), i + 1)
    )
    text = _full_text(F.array_join(head, ", "), rows, F.array_join(shown, "\n"))
    df = df.withColumns(
        {
            f"{prefix}raw_content": F.when(raw == "", EMPTY_CSV).otherwise(text),
            f"{prefix}meta_row_count": F.when(raw == "", 0).otherwise(rows),
            f"{prefix}meta_column_count": F.when(raw == "", 0).otherwise(F.size(head)),
        }
    )
    return df.withColumn(f"{prefix}raw_content", or_placeholder(F.col(f"{prefix}raw_content"), EMPTY_CSV)).drop(records, head)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of CSV files as (file, ordinal, is_head, cells), as ``parse`` finds them in the whole text of a file.

    Files are read in splits, so a task does not know whether its first line lies in a quoted cell. Each line
    is a function of that: whether it ends inside a quoted cell, when it begins outside and when it begins inside one. Functions
    of two states compose, so a sum over the lines of a split, then one over the splits of a file, tells for
    every line. Lines that are a record by themselves move no further; those of longer records are put together.

    Lines end with a line feed (or carriage return and line feed); carriage returns alone end records too, but one split reads all up to the next line
    feed. Blank lines are records without cells, empty files have none. A quote that is never closed takes the rest of its file into one cell, without
    the last line feed.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    place = Window.partitionBy("file", "block").orderBy("_at")
    so_far = place.rowsBetween(Window.unboundedPreceding, 0)
    # at the end of a line: outside a quoted cell or inside one, for both beginnings
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"),
        F.col("value").rlike(OPEN).alias("_out"), F.concat(F.lit('"'), "value").rlike(OPEN).alias("_in"),
    )
    flips = F.sum((F.col("_out") & ~F.col("_in")).cast("int")).over(so_far) % 2 == 1
    lines = lines.withColumns({"row": F.row_number().over(place), "_flip": flips})
    # beginning does not matter from the last line on that has but one end
    lines = lines.withColumn("_sure", F.last(F.when(F.col("_out") == F.col("_in"), _xor("_out", "_flip")), ignorenulls=True).over(so_far))
    lines = materialize(lines.select("file", "block", "row", "line", "_flip", "_sure"), "csv-lines")

    splits = lines.groupBy("file", "block").agg(F.max_by("_flip", "row").alias("_flip"), F.max_by("_sure", "row").alias("_sure"))
    splits = _carried(splits.withColumn("_end", _xor("_sure", "_flip")))
    known = lines.join(splits, ["file", "block"])
    inside = F.coalesce(_xor("_sure", "_flip"), _xor("_begin", "_flip"))
    known = known.select("file", "block", "row", "line", "_begin", inside.alias("_inside"))
    before = F.coalesce(F.lag("_inside").over(Window.partitionBy("file", "block").orderBy("row")), F.col("_begin"))
    known = materialize(known.withColumn("_new", ~before).drop("_begin"), "csv-states")

    alone = known.filter(F.col("_new") & ~F.col("_inside")).select("file", "block", "row", "line", F.lit(False).alias("_open"))
    long = known.filter(~F.col("_new") | F.col("_inside"))
    start = F.last(F.when(F.col("_new"), F.struct("block", "row")), ignorenulls=True)
    own = start.over(Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    long = long.withColumn("_start", own)
    # a record that goes on from split to split: the last one begun before
    begun = long.groupBy("file", "block").agg(F.max("_start").alias("_last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("file", "block", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    long = long.join(begun, ["file", "block"]).withColumn("_start", F.coalesce("_start", "_before"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "row", "line", "_inside")))
    joined = long.groupBy("file", "_start").agg(pieces.alias("_lines")).select(
        "file", "_start.block", "_start.row", F.array_join(F.col("_lines.line"), "\n").alias("line"), F.element_at("_lines", -1)["_inside"].alias("_open")
    )
    text = F.when(F.col("_open"), F.col("line")).otherwise(F.concat("line", F.lit("\n")))
    found = F.regexp_extract_all(text, F.lit(RECORD), F.lit(1))
    found = F.slice(found, F.lit(1), F.size(found) - 1)  # past the last record the pattern matches once more, on nothing
    records = alone.unionByName(joined).select("file", "block", "row", F.posexplode(found).alias("part", "record"))
    first = (F.col("block") == 0) & (F.col("row") == 1) & (F.col("part") == 0)
    return records.select("file", F.struct("block", "row", "part").alias("ordinal"), first.alias("is_head"), _fields(F.col("record")).alias("cells"))


def _xor(a: str, b: str) -> Column:
    return F.col(a) != F.col(b)


def _carried(splits: DataFrame) -> DataFrame:
    """(file, block, _begin): whether a split begins inside a quoted cell; one row per split of at most a file's number of splits in a task."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    to_here = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    # splits whose end is sure set the state, the others turn it or leave it
    turn = F.when(F.col("_end").isNull() & F.col("_flip"), 1).otherwise(0)
    splits = splits.withColumn("_turns", F.sum(turn).over(to_here) % 2 == 1)
    splits = splits.withColumn("_set", _xor("_end", "_turns"))
    last = F.coalesce(F.last("_set", ignorenulls=True).over(earlier), F.lit(False))
    turns = F.coalesce(F.lag("_turns").over(Window.partitionBy("file").orderBy("block")), F.lit(False))
    return splits.select("file", "block", (last != turns).alias("_begin"))


def read_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV files as (file, ordinal, columns, extra_cells): ordinals follow the file order, also over splits.

    Cells go to ``columns`` by their place; a cell that a row does not have is null, cells beyond the columns are kept in
    ``extra_cells``. Blank lines are rows of nulls. The first record of a file is its header and no row.
    """
    rows = read_records(spark, path).filter(~F.col("is_head"))
    named = [F.get("cells", F.lit(k)).alias(c) for k, c in enumerate(columns)]
    extra = F.slice("cells", F.lit(len(columns) + 1), F.greatest(F.size("cells") - len(columns), F.lit(0)))
    return rows.select("file", "ordinal", *named, extra.alias("extra_cells"))


def files_text(spark: SparkSession, path: str, part_rows: int = PART_ROWS) -> DataFrame:
    """The text of all rows of CSV files with their own headers, in numbered parts, with the counts of ``parse``.

    (file, part, row_count, column_count, raw_content); part 0 of a file without rows has its header only. Empty files have no row.
    """
    records = materialize(read_records(spark, path), "csv-records")
    heads = records.filter("is_head").select("file", F.col("cells").alias("_head"))
    rows = numbered_rows(records.filter(~F.col("is_head")).select("file", "ordinal", "cells"), "file", ["ordinal"])
    line = _row_text(F.col("_head"), F.col("cells"), F.col("row"))
    parts = _parts(left_join_unique(rows, heads, "file"), "file", line, part_rows)
    names = F.array_join("_head", ", ")
    count, part = F.coalesce("row_count", F.lit(0).cast("bigint")), F.coalesce("part", F.lit(0).cast("bigint"))
    return heads.join(parts, "file", "left").select(
        "file", part.alias("part"), count.alias("row_count"), F.size("_head").alias("column_count"),
        _full_text(names, count, F.col("_shown")).alias("raw_content"),
    )


def counts(df: DataFrame, file: str, columns: list[str]) -> DataFrame:
    """Rows and columns per file."""
    return df.groupBy(file).agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(columns)))


def first_rows(df: DataFrame, file: str, order: list[str], n: int, salts: int = SALTS) -> DataFrame:
    """The first ``n`` rows of every file, numbered in ``row``; no task gathers a whole file.

    First the leading rows of each salted slice of a file, then the leading rows of those. Spark
    cuts each task's input to ``n`` rows per slice before the shuffle, so a file with a third of
    all rows sends at most ``n`` rows per task and slice.
    """
    salt = F.pmod(F.xxhash64(*order), F.lit(salts))
    slices = Window.partitionBy(file, "_salt").orderBy(*order)
    files = Window.partitionBy(file).orderBy(*order)
    lead = df.withColumn("_salt", salt).withColumn("row", F.row_number().over(slices)).filter(F.col("row") <= n)
    return lead.withColumn("row", F.row_number().over(files)).filter(F.col("row") <= n).drop("_salt")


def numbered_rows(df: DataFrame, file: str, order: list[str]) -> DataFrame:
    """All rows with their number in their file in ``row``, from 1, and the file's ``row_count``; no task gathers a whole file.

    Rows are range-partitioned by file and order and written once with their place; one count per
    partition and file, summed up in a window over at most as many rows per file as there are
    partitions, says where each partition's share of a file begins.
    """
    keys = [file, *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_slice", F.shiftrightunsigned("_at", 33)), "csv-rows")
    slices = placed.groupBy(F.col(file).alias("_file"), "_slice").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_file").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumnRenamed("_slice", "_s")
    slices = slices.withColumn("row_count", F.sum("_n").over(Window.partitionBy("_file")))
    own = F.col(file).eqNullSafe(F.col("_file")) & (F.col("_slice") == F.col("_s"))
    row = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return placed.join(slices, own).withColumn("row", row).drop("_at", "_slice", "_file", "_s", "_first", "_n", "_before")


def table_text(df: DataFrame, file: str, order: list[str], columns: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """The text of all rows of each file of a (file, ordinal, columns) table, in numbered parts.

    A part has the header, the file's row count and up to ``part_rows`` rows, so what is collected in
    one place does not grow with the file.
    """
    rows = numbered_rows(df.select(file, *order, *[c for c in columns if c not in (file, *order)]), file, order)
    cells = F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    head = F.array(*[F.lit(c) for c in columns])
    parts = _parts(rows, file, _row_text(head, cells, F.col("row")), part_rows)
    text = _full_text(F.lit(", ".join(columns)), F.col("row_count"), F.col("_shown"))
    return parts.select(file, "row_count", F.lit(len(columns)).alias("column_count"), "part", text.alias("raw_content"))


def _parts(rows: DataFrame, file: str, text: Column, part_rows: int) -> DataFrame:
    """Up to ``part_rows`` numbered rows of a file in one text: (file, part, row_count, _shown)."""
    part = F.floor((F.col("row") - 1) / part_rows).cast("bigint")
    lines = F.array_sort(F.collect_list(F.struct("row", text.alias("line"))))
    return rows.groupBy(file, part.alias("part")).agg(F.max("row_count").alias("row_count"), F.array_join(lines["line"], "\n").alias("_shown"))
