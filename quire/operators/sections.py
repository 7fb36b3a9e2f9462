"""Pages to blocks, the section each block stands in, and the route it takes.

A file is one row until its blocks are exploded, so everything that depends on the blocks before (number,
section stack, skipped sections, flush segments) is one fold over the pages and blocks of that row: no
shuffle, no window, and no bound on the depth of sections.  The fold keeps the titles' stack: a title of level
l leaves l - 1 titles standing and puts itself on top.

Defined results: null pages and null arrays give no blocks but keep their numbers; a null block is counted,
routed as unsupported and has no type; a level that is null is 1, one below 1 is 1 and flagged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.options import NOISE_TYPES, Options

_ITEM = "struct<block_index:int,title_no:int,section_path:array<string>,skip:boolean,route:string,segment:int>"


def explode_blocks(files: DataFrame, key: str = "file_id", doc: str = "doc_id", pages: str = "pages") -> DataFrame:
    """One row for each block: `key, doc_id, page_no, block_idx, block_index, block_id, type, bbox, content`."""
    size = lambda p: F.coalesce(F.size(p), F.lit(0))
    before = F.aggregate(F.col(pages), F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.greatest(size(p), F.lit(0)))))
    f = files.select(F.col(key).alias("key"), F.col(doc).alias("doc_id"), before.alias("_before"), F.col(pages).alias("_pages"))
    zipped = F.transform("_pages", lambda p, i: F.struct(F.get(F.col("_before"), i).alias("before"), p.alias("page")))
    p = f.select("key", "doc_id", F.posexplode(zipped).alias("p", "z"))
    b = p.select("key", "doc_id", (F.col("p") + 1).alias("page_no"), F.col("z.before").alias("_before"), F.posexplode("z.page").alias("block_idx", "block"))
    b = b.withColumn("block_index", F.col("_before") + F.col("block_idx") + 1)
    return b.select("key", "doc_id", "page_no", "block_idx", "block_index", _block_id(), F.col("block.type").alias("type"), F.col("block.bbox").alias("bbox"), F.col("block.content").alias("content"))


def _block_id() -> Column:
    return F.format_string("p%d_b%d", "page_no", "block_index").alias("block_id")


def _route(kind: Column, is_title: Column, skip: Column) -> Column:
    return (
        F.when(is_title, "title")
        .when(kind.isin(*NOISE_TYPES), "noise")
        .when(skip & kind.isin("paragraph", "list", "table"), "low_value")
        .when(kind.isin("paragraph", "list"), "text")
        .when(kind == "table", "table")
        .when(kind == "image", "image")
        .when(kind == "equation_interline", "formula")
        .otherwise("unsupported")
    )


def _level(content: Column) -> Column:
    return F.greatest(_given_level(content), F.lit(1))


def _given_level(content: Column) -> Column:
    """The level, which may come as text; 1 where there is none."""
    return F.coalesce(content["level"].try_cast("int"), F.lit(1))


def _context(pages: Column, page_type: str) -> Column:
    """For every block of every page its place in the document, as arrays of the pages' shape."""
    empty = F.array().cast(f"array<{_ITEM}>")

    def state(s: Column, out: Column) -> Column:
        return F.struct(s["n"].alias("n"), s["titles"].alias("titles"), s["stack"].alias("stack"), s["skip"].alias("skip"), s["segment"].alias("segment"), out.alias("out"))

    def block(s: Column, b: Column) -> Column:
        is_title = F.coalesce(b["type"] == "title", F.lit(False))

        def titled(t: Column) -> Column:
            stack = F.when(is_title, F.concat(F.slice(s["stack"], F.lit(1), _level(b["content"]) - 1), F.array(t))).otherwise(s["stack"])
            skip = F.when(is_title, X.skips_section(t)).otherwise(s["skip"])
            return X.bound(F.struct(stack.alias("stack"), skip.alias("skip")), lambda v: X.bound(_route(b["type"], is_title, v["skip"]), lambda r: placed(v, r)))

        def placed(v: Column, route: Column) -> Column:
            titles = s["titles"] + is_title.cast("int")
            item = F.struct((s["n"] + 1).alias("block_index"), titles.alias("title_no"), v["stack"].alias("section_path"), v["skip"].alias("skip"), route.alias("route"), s["segment"].alias("segment"))
            flush = route.isin("table", "image", "formula", "unsupported").cast("int")
            return F.struct((s["n"] + 1).alias("n"), titles.alias("titles"), v["stack"].alias("stack"), v["skip"].alias("skip"), (s["segment"] + flush).alias("segment"), F.concat(s["out"], F.array(item)).alias("out"))

        return X.bound(F.when(is_title, X.inline_text(b["content"]["title_content"])), titled)

    def page(s: Column, p: Column) -> Column:
        inner = F.aggregate(F.coalesce(p, F.array().cast(page_type)), state(s, empty), block)
        return X.bound(inner, lambda r: state(r, F.concat(s["out"], F.array(r["out"]))))

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("titles"), F.array().cast("array<string>").alias("stack"), F.lit(False).alias("skip"), F.lit(0).alias("segment"), F.array().cast(f"array<array<{_ITEM}>>").alias("out"))
    return F.aggregate(pages, zero, page, lambda s: s["out"])


def sectioned(files: DataFrame, key: str = "file_id", doc: str = "doc_id", pages: str = "pages", opts: Options = Options()) -> DataFrame:
    """The blocks of `explode_blocks` with `is_title, title_text, title_no, bad_level, depth, section_path, section_title, skip, route, segment, text`."""
    shape = files.schema[pages].dataType.elementType.simpleString()
    f = files.select(F.col(key).alias("key"), F.col(doc).alias("doc_id"), F.arrays_zip(F.col(pages).alias("page"), _context(F.col(pages), shape).alias("at")).alias("_z"))
    p = f.select("key", "doc_id", F.posexplode("_z").alias("p", "z"))
    b = p.select("key", "doc_id", (F.col("p") + 1).alias("page_no"), F.posexplode(F.arrays_zip(F.col("z.page").alias("block"), F.col("z.at").alias("at"))).alias("block_idx", "z"))
    b = b.select("key", "doc_id", "page_no", "block_idx", "z.at.*", F.col("z.block.type").alias("type"), F.col("z.block.bbox").alias("bbox"), F.col("z.block.content").alias("content"))
    c = lambda name: F.col(f"content.{name}")
    title = F.col("route") == "title"
    title_text = F.when(title, X.inline_text(c("title_content")))
    raw = F.when(F.col("type") == "paragraph", X.inline_text(c("paragraph_content"))).when(F.col("type") == "list", X.list_text(c("list_items"))).when(title, X.clean_title(title_text)).otherwise("")
    return b.select(
        "*",
        _block_id(),
        title.alias("is_title"),
        title_text.alias("title_text"),
        (title & (_given_level(F.col("content")) < 1)).alias("bad_level"),
        F.size("section_path").alias("depth"),
        F.array_join("section_path", " > ").alias("section_title"),
        X.clean_text(raw).alias("text"),
    )
