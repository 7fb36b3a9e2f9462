"""Image blocks to figure chunks: text near each image, its class, and parts folded into their figure.

The text near an image is the first that exists of: the next blocks of its page, the blocks before, the
latest text chunk of its section within reach, the neighbouring pages, its section's title.  Pages travel
as one short array of eligible texts each, joined by (document, page), so no image scans its document; the
latest chunk is an as-of window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as X
from quire.options import Options


def page_texts(blocks: DataFrame, opts: Options = Options()) -> DataFrame:
    """`key, page_no, texts`: the eligible texts of each page in order (idx, text cut to length, section)."""
    ok = blocks.where(F.col("type").isin("paragraph", "list") & (F.length("text") > opts.min_nearby))
    item = F.struct("block_idx", F.left("text", F.lit(opts.nearby_length)).alias("text"), F.col("section_title").alias("section"))
    return ok.groupBy("key", "page_no").agg(F.array_sort(F.collect_list(item)).alias("texts"))


def _first(texts: Column, section: Column, near: Column | None = None) -> Column:
    fits = lambda t: (section == "") | (t["section"] == "") | (t["section"] == section)
    return F.get(F.filter(texts, fits), F.lit(0))["text"]


def positional_text(images: DataFrame, pages: DataFrame, opts: Options = Options()) -> DataFrame:
    """Adds `forward, backward` (own page) and `neighbour` (pages around) to images."""
    deltas = [d for k in range(1, opts.page_reach + 1) for d in (-k, k)]
    wanted = images.select("key", "block_index", "block_idx", "section_title", F.col("page_no").alias("own"), F.explode(F.array(*[F.lit(d) for d in (0, *deltas)])).alias("delta"))
    wanted = wanted.withColumn("page_no", F.col("own") + F.col("delta"))
    j = wanted.join(pages, ["key", "page_no"])
    s, i = F.col("section_title"), F.col("block_idx")
    ahead = F.filter("texts", lambda t: (t["block_idx"] > i) & (t["block_idx"] <= i + opts.nearby_window))
    behind = F.reverse(F.filter("texts", lambda t: (t["block_idx"] < i) & (t["block_idx"] >= i - opts.nearby_window)))
    around = F.when(F.col("delta") < 0, _first(F.reverse("texts"), s)).otherwise(_first(F.col("texts"), s))
    rank = F.when(F.col("delta") == 0, F.lit(None)).otherwise(F.abs("delta") * 2 + F.when(F.col("delta") > 0, 1).otherwise(0))
    got = j.select(
        "key",
        "block_index",
        F.when(F.col("delta") == 0, _first(ahead, s)).alias("f"),
        F.when(F.col("delta") == 0, _first(behind, s)).alias("b"),
        F.when(rank.isNotNull() & around.isNotNull(), F.struct(rank.alias("r"), around.alias("t"))).alias("n"),
    )
    best = got.groupBy("key", "block_index").agg(F.max("f").alias("forward"), F.max("b").alias("backward"), F.min("n")["t"].alias("neighbour"))
    return images.join(best, ["key", "block_index"], "left")


def recent_text(images: DataFrame, chunks: DataFrame, opts: Options = Options()) -> DataFrame:
    """Adds `recent`: the latest text chunk before the image, of its section where it has one, within page reach.

    Pages never decrease along a document, so if the latest chunk is too far, all earlier ones are.
    """
    cols = ["key", "segment", "kind", "a", "b", "section_title", "page_no", "t"]
    text = F.left("chunk_text", F.lit(opts.nearby_length))
    c = chunks.select("key", "segment", F.lit(0).alias("kind"), F.col("bin").alias("a"), F.col("piece").alias("b"), "section_title", "page_no", F.struct(F.col("page_no").alias("p"), text.alias("t")).alias("t"))
    i = images.select("key", "segment", F.lit(1).alias("kind"), F.col("block_index").alias("a"), F.lit(0).alias("b"), "section_title", "page_no", F.lit(None).cast(c.schema["t"].dataType).alias("t"))
    both = c.select(cols).unionByName(i.select(cols))
    order = ("segment", "kind", "a", "b")
    last = lambda *by: F.last("t", ignorenulls=True).over(Window.partitionBy("key", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    seen = both.withColumn("any", last()).withColumn("same", last("section_title")).where("kind = 1")
    pick = F.when(F.col("section_title") == "", F.col("any")).otherwise(F.col("same"))
    near = F.when(F.abs(pick["p"] - F.col("page_no")) <= opts.page_reach, pick["t"])
    return images.join(seen.select("key", F.col("a").alias("block_index"), near.alias("recent")), ["key", "block_index"], "left")


def figure_class(caption: Column, nearby: Column, section: Column, chunk_text: Column) -> Column:
    """`subfigure`, `weak` or `formal`, by the first rule that holds."""
    cap, near = X.strip(F.coalesce(caption, F.lit(""))), X.strip(F.coalesce(nearby, F.lit("")))
    valid = F.length(cap) > 5
    total = F.length(cap) + F.length(near)
    return (
        F.when(X.is_subfigure_label(cap), "subfigure")
        .when(chunk_text.startswith("Context:") & ~valid, "weak")
        .when(X.has_figure_number(cap), "formal")
        .when(valid & (near != section) & (total >= 50), "formal")
        .when(~valid & (near == section), "weak")
        .when(total < 30, "weak")
        .otherwise("formal")
    )


def described(images: DataFrame) -> DataFrame:
    """Adds `caption, nearby, chunk_text, class` to images with their four nearby texts."""
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    i = images.withColumn("caption", X.inline_text(F.col("content.image_caption")))
    i = i.withColumn("nearby", F.coalesce(filled("forward"), filled("backward"), filled("recent"), filled("neighbour"), F.col("section_title")))
    lines = F.concat_ws("\n", F.when(F.col("caption") != "", F.concat(F.lit("Figure: "), F.col("caption"))), F.when(F.col("nearby") != "", F.concat(F.lit("Context: "), F.col("nearby"))))
    i = i.withColumn("chunk_text", F.when(lines == "", "Figure (see image)").otherwise(lines))
    return i.withColumn("class", figure_class(F.col("caption"), F.col("nearby"), F.col("section_title"), F.col("chunk_text")))


def with_parents(images: DataFrame) -> DataFrame:
    """Adds `parent`: for a part, the block index of the latest formal figure since the last title, at most a page away."""
    w = Window.partitionBy("key", "title_no").orderBy("block_index").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("class") == "formal", F.struct("block_index", "page_no")), ignorenulls=True).over(w)
    i = images.withColumn("_last", last)
    near = F.abs(F.col("_last.page_no") - F.col("page_no")) <= 1
    return i.withColumn("parent", F.when((F.col("class") == "subfigure") & near, F.col("_last.block_index"))).drop("_last")


def folded(images: DataFrame) -> DataFrame:
    """Formal figures with their parts appended in order: `chunk_text` and `subfigures`."""
    part = F.concat(F.lit("\n[Subfigure: "), F.col("caption"), F.lit("]"), F.when(F.col("image_path") != "", F.concat(F.lit(" (Image: "), F.col("image_path"), F.lit(")"))).otherwise(""))
    item = F.struct("block_index", part.alias("t"), F.struct("caption", "image_path", "page_no").alias("s"))
    parts = images.where("parent is not null").groupBy("key", F.col("parent").alias("block_index")).agg(F.array_sort(F.collect_list(item)).alias("parts"))
    f = images.where("class = 'formal'").join(parts, ["key", "block_index"], "left")
    tail = F.coalesce(F.array_join(F.transform("parts", lambda p: p["t"]), ""), F.lit(""))
    return f.withColumn("chunk_text", F.concat("chunk_text", tail)).withColumn("subfigures", F.transform("parts", lambda p: p["s"])).drop("parts")
