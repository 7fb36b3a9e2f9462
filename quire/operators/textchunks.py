"""Text blocks to text chunks: segments between flushing blocks, short texts merged, long ones split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.packing import greedy_bins, split_pieces
from quire.options import Options

_ITEM = ("block_index", "text", "page_no", "section_title", "section_path", "block_id", "bbox")


def merged_texts(blocks: DataFrame, opts: Options = Options()) -> DataFrame:
    """One row for each merged text: `key, doc_id, segment, bin` and the first member's place.

    Texts shorter than `min_text` are left out.  A segment never crosses a flushing block but may cross
    titles and pages.
    """
    items = blocks.where((F.col("route") == "text") & (F.length("text") >= opts.min_text))
    seg = items.groupBy("key", "segment").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct(*_ITEM))).alias("items"))
    seg = seg.withColumn("bins", greedy_bins(F.transform("items", lambda i: X.tokens(i["text"])), opts.merge_cap, opts.short_block))
    zipped = F.arrays_zip("items", "bins")
    groups = F.transform(F.sequence(F.lit(0), F.array_max("bins")), lambda n: F.transform(F.filter(zipped, lambda z: z["bins"] == n), lambda z: z["items"]))
    g = seg.select("key", "doc_id", "segment", F.posexplode(groups).alias("bin", "g"))
    first = F.get(F.col("g"), F.lit(0))
    many = F.size("g") > 1
    return g.select(
        "key",
        "doc_id",
        "segment",
        "bin",
        F.array_join(F.transform("g", lambda i: i["text"]), "\n\n").alias("text"),
        first["page_no"].alias("page_no"),
        first["section_title"].alias("section_title"),
        first["section_path"].alias("section_path"),
        F.when(many, F.concat(F.lit("merged_"), first["block_id"])).otherwise(first["block_id"]).alias("source_block_id"),
        first["bbox"].alias("bbox"),
        F.when(many, F.transform("g", lambda i: i["block_id"])).otherwise(F.array().cast("array<string>")).alias("merge_from_block_ids"),
    )


def text_chunks(merged: DataFrame, opts: Options = Options()) -> DataFrame:
    """Merged texts cut at the hard cap; pieces after the first are flagged."""
    p = merged.select("*", F.posexplode(split_pieces(F.col("text"), opts.hard_cap)).alias("piece", "chunk_text")).drop("text")
    flags = F.when(F.col("piece") > 0, F.array(F.lit("split_continuation"))).otherwise(F.array().cast("array<string>"))
    return p.withColumn("cleanup_flags", flags)
