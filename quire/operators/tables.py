"""Table blocks to table chunks: rows out of HTML, serialised, split at the hard cap with repeated columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.packing import row_bins
from quire.options import Options


def _cells(r: Column) -> Column:
    return F.array_join(r, " | ")


def _lines(*parts: Column) -> Column:
    """The non-null parts, one a line."""
    return F.concat_ws("\n", *parts)


def parsed_tables(blocks: DataFrame) -> DataFrame:
    """Adds `headers, rows, caption, footnote`: the first row is the header, attributes hide cells."""
    t = blocks.withColumn("_rows", X.html_rows(F.col("content.html")))
    return (
        t.withColumn("headers", F.coalesce(F.get("_rows", F.lit(0)), F.array().cast("array<string>")))
        .withColumn("rows", F.coalesce(F.slice("_rows", F.lit(2), F.greatest(F.size("_rows") - 1, F.lit(0))), F.array().cast("array<array<string>>")))
        .withColumn("caption", X.inline_text(F.col("content.table_caption")))
        .withColumn("footnote", X.inline_text(F.col("content.table_footnote")))
        .drop("_rows")
    )


def row_texts(rows: Column) -> Column:
    """`Row i: a | b` of each row with its number from 1; null for rows without cells."""
    return F.transform(rows, lambda r, i: F.when(F.size(r) > 0, F.concat(F.lit("Row "), (i + 1).cast("string"), F.lit(": "), _cells(r))))


def _head(label: Column) -> tuple[Column, Column]:
    title = F.when(F.col("caption") != "", F.concat(F.lit("Table: "), F.col("caption"), label))
    columns = F.when(F.size("headers") > 0, F.concat(F.lit("Columns: "), _cells(F.col("headers"))))
    return title, columns


def table_text() -> Column:
    """A table as text; absent parts are left out."""
    title, columns = _head(F.lit(""))
    note = F.when(F.col("footnote") != "", F.concat(F.lit("Note: "), F.col("footnote")))
    body = F.filter(row_texts(F.col("rows")), lambda x: x.isNotNull())
    return _lines(title, columns, F.when(F.size(body) > 0, F.array_join(body, "\n")), note)


def split_tables(tables: DataFrame, opts: Options = Options()) -> DataFrame:
    """One row for each table chunk: `part, parts, is_split, chunk_text, oversized`; other columns stay.

    A table within the hard cap is one chunk if its text is long enough, none otherwise.  A larger one is
    packed row by row; a row over the cap stays whole in a part of its own and is flagged; without rows there
    is no chunk.
    """
    t = tables.withColumn("_full", table_text())
    small = X.tokens(F.col("_full")) <= opts.hard_cap
    whole = t.where(small & (F.length(X.strip(F.col("_full"))) > opts.min_table_text))
    whole = whole.select("*", F.lit(0).alias("part"), F.lit(1).alias("parts"), F.lit(False).alias("is_split"), F.col("_full").alias("chunk_text"), F.lit(None).cast("bigint").alias("oversized"))
    large = t.where(~small & (F.size("rows") > 0))
    title, columns = _head(F.lit(" (Part X/Y)"))
    head = F.concat(F.coalesce(F.concat(title, F.lit("\n")), F.lit("")), F.coalesce(columns, F.lit("")))
    large = large.withColumn("_texts", row_texts(F.col("rows")))
    sizes = F.transform("_texts", lambda x: X.tokens(F.coalesce(x, F.lit(""))))
    large = large.withColumn("_bins", row_bins(sizes, X.tokens(head), F.col("footnote") != "", opts.hard_cap)).withColumn("parts", F.array_max("_bins") + 1)
    large = large.withColumn("_zip", F.arrays_zip(F.col("_texts").alias("t"), F.col("_bins").alias("b")))
    large = large.withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    mine = F.filter("_zip", lambda z: z["b"] == F.col("part") - 1)
    body = F.filter(F.transform(mine, lambda z: z["t"]), lambda x: x.isNotNull())
    note = F.when((F.col("part") == F.col("parts")) & (F.col("footnote") != ""), F.concat(F.lit("Note: "), F.col("footnote")))

    def text(of: Column) -> Column:
        title, columns = _head(F.concat(F.lit(" (Part "), F.col("part").cast("string"), F.lit("/"), of.cast("string"), F.lit(")")))
        return _lines(title, columns, F.when(F.size(body) > 0, F.array_join(body, "\n")), note)

    # a part is measured with a provisional total, the one its own number of rows suggests
    guess = F.greatest(F.lit(2), F.ceil(F.size("rows") / F.size(mine)).cast("int"))
    measured = X.tokens(text(guess))
    # the final label replaces every provisional one, also where a cell only looks like one
    label = F.concat(F.lit("(Part "), F.col("part").cast("string"), F.lit("/"), F.col("parts").cast("string"), F.lit(")"))
    final = F.when((F.col("caption") != ""), F.regexp_replace(text(F.col("parts")), F.lit(r"(?U)\(Part \d+/\d+\)"), label)).otherwise(text(F.col("parts")))
    large = large.select("*", F.lit(True).alias("is_split"), final.alias("chunk_text"), F.when(measured > opts.hard_cap, measured).alias("oversized"))
    return whole.unionByName(large.drop("_texts", "_bins", "_zip"), allowMissingColumns=True).drop("_full")
