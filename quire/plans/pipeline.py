"""The whole packager as one plan: files of pages to chunks, events and counters.

Order of work: sections, text chunks, figure context (which reads text chunks), figure classes, parents,
numbering, affix removal.  Each step is a table that is planned only when something asks for it, so a reader
of text chunks never pays for figures; steps that several others read are written once to the shared
checkpoint folder.  Sections need no shuffle; the rest is keyed by file.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as X
from quire.operators import dedup, figures, tables, textchunks
from quire.operators.sections import sectioned
from quire.options import COUNTERS, Options
from quire.runtime import cut

EVENT = {
    "key": "bigint", "doc_id": "string", "category": "string", "block_id": "string", "type": "string", "reason": "string", "page_no": "int", "section_title": "string", "caption": "string",
    "nearby_text_preview": "string", "expected_path": "string", "error": "string", "content_preview": "string", "tokens": "bigint", "limit_tokens": "bigint",
}

_SUB = "array<struct<caption:string,image_path:string,page_no:int>>"
_SPLIT = "struct<is_split:boolean,split_index:int,total_splits:int>"


def _event(df: DataFrame, key_type: str, **values) -> DataFrame:
    given = {"key": F.col("key"), "doc_id": F.col("doc_id")} | {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}
    return df.select(*[given.get(n, F.lit(None)).cast(key_type if n == "key" else t).alias(n) for n, t in EVENT.items()])


def with_images(blocks: DataFrame, listing: DataFrame | None, opts: Options) -> DataFrame:
    """Adds `image_path` ('' without an existing image) and `missing` (a good path that is not listed).

    `listing` has `key, path` of the files there are; without one every good path exists.
    """
    raw = F.col("content.image_source.path")
    b = blocks.withColumn("_raw", raw).withColumn("_ok", X.is_image_path(raw))
    if listing is None:
        b = b.withColumn("_there", F.col("_ok"))
    else:
        there = listing.select("key", F.col("path").alias("_raw"), F.lit(True).alias("_hit")).distinct()
        b = b.join(there, ["key", "_raw"], "left").withColumn("_there", F.col("_ok") & F.coalesce("_hit", F.lit(False))).drop("_hit")
    return b.withColumn("image_path", F.when(F.col("_there"), X.relative_path(F.col("_raw"), opts.project_root)).otherwise("")).withColumn("missing", F.col("_ok") & ~F.col("_there"))


class Packed:
    """One run over `files` (key, doc, pages): `chunks` (wide), `events` (one row each), `stats` (14 counters a document)."""

    def __init__(self, files: DataFrame, listing: DataFrame | None, opts: Options, key: str, doc: str):
        self.files = files.select(F.col(key).alias("key"), F.col(doc).alias("doc_id"), "pages")
        self.listing, self.opts = listing, opts

    @cached_property
    def blocks(self) -> DataFrame:
        return cut(sectioned(self.files, "key", "doc_id", opts=self.opts))

    @cached_property
    def texts(self) -> DataFrame:
        return cut(textchunks.text_chunks(textchunks.merged_texts(self.blocks, self.opts), self.opts))

    @cached_property
    def tables(self) -> DataFrame:
        """Table blocks with cells and image; `filled` tells those that can give chunks."""
        t = tables.parsed_tables(with_images(self.blocks.where("route = 'table'"), self.listing, self.opts))
        return t.withColumn("filled", (F.size("headers") > 0) | (F.size("rows") > 0) | (F.col("image_path") != ""))

    @cached_property
    def parts(self) -> DataFrame:
        return cut(tables.split_tables(self.tables.where("filled"), self.opts))

    @cached_property
    def images(self) -> DataFrame:
        """Image blocks with nearby text, class and parent figure."""
        i = with_images(self.blocks.where("route = 'image'"), self.listing, self.opts)
        i = figures.recent_text(figures.positional_text(i, figures.page_texts(self.blocks, self.opts), self.opts), self.texts, self.opts)
        return cut(figures.with_parents(figures.described(i)))

    @cached_property
    def figures(self) -> DataFrame:
        return figures.folded(self.images)

    @cached_property
    def formulas(self) -> DataFrame:
        return self.blocks.where("route = 'formula'").withColumn("chunk_text", F.coalesce("content.math_content", F.lit("")))

    @cached_property
    def gathered(self) -> DataFrame:
        """Chunks of all kinds with their places in the document, not yet numbered."""
        none = lambda t: F.lit(None).cast(t)
        flags = F.array().cast("array<string>")

        def chunk(df, kind, nontext, a, b, image, block, extra):
            meta = {"section_path": F.col("section_path"), "block_bbox": F.col("bbox"), "merge_from_block_ids": none("array<string>"), "cleanup_flags": flags, "table_title": none("string"), "figure_title": none("string"), "nearby_text": none("string"), "subfigures": none(_SUB), "split_info": none(_SPLIT), "parser": F.lit(self.opts.parser)} | extra
            return df.select("key", "doc_id", "segment", F.lit(nontext).alias("_n"), a.cast("int").alias("_a"), b.cast("int").alias("_b"), "page_no", F.lit(kind).alias("content_type"), "section_title", "chunk_text", image.alias("image_path"), block.alias("source_block_id"), F.struct(*[v.alias(k) for k, v in meta.items()]).alias("metadata"))

        split = F.when(F.col("is_split"), F.struct("is_split", F.col("part").alias("split_index"), F.col("parts").alias("total_splits")))
        table_flags = F.when(F.col("is_split"), F.array(F.lit("table_split"))).otherwise(flags)
        merged_flag = F.coalesce(F.transform("subfigures", lambda s: F.lit("merged_subfigure")), flags)
        return (
            chunk(self.texts, "text", 0, F.col("bin"), F.col("piece"), F.lit(""), F.col("source_block_id"), {"merge_from_block_ids": F.col("merge_from_block_ids"), "cleanup_flags": F.col("cleanup_flags")})
            .unionByName(chunk(self.parts, "table", 1, F.col("block_index"), F.col("part"), F.col("image_path"), F.col("block_id"), {"table_title": F.col("caption"), "split_info": split, "cleanup_flags": table_flags}))
            .unionByName(chunk(self.figures, "figure", 1, F.col("block_index"), F.lit(0), F.col("image_path"), F.col("block_id"), {"figure_title": F.col("caption"), "nearby_text": F.col("nearby"), "subfigures": F.col("subfigures"), "cleanup_flags": merged_flag}))
            .unionByName(chunk(self.formulas.where("chunk_text <> ''"), "formula", 1, F.col("block_index"), F.lit(0), F.lit(""), F.col("block_id"), {}))
        )

    @cached_property
    def stripped(self) -> DataFrame:
        """Numbered chunks, repeated heads and tails of texts cut."""
        seq = F.row_number().over(Window.partitionBy("key").orderBy("segment", "_n", "_a", "_b"))
        c = self.gathered.withColumn("seq", seq).withColumn("chunk_id", F.format_string("%s:p%d:%s:%d", "doc_id", "page_no", "content_type", "seq")).drop("segment", "_n", "_a", "_b")
        c = dedup.strip_affixes(c, dedup.affix_counts(self.texts, opts=self.opts), only=F.col("content_type") == "text")
        return c.withColumn("metadata", F.col("metadata").withField("cleanup_flags", F.concat("metadata.cleanup_flags", "removed"))).drop("removed")

    @cached_property
    def chunks(self) -> DataFrame:
        return self.stripped.where("content_type <> 'text' or chunk_text <> ''") if self.opts.strict else self.stripped

    def minimal(self) -> DataFrame:
        """The six columns that are delivered; section titles are cleaned only here."""
        return self.chunks.select("chunk_id", "page_no", "content_type", X.clean_title(F.col("section_title")).alias("section_title"), "chunk_text", "image_path")

    @cached_property
    def events(self) -> DataFrame:
        kt = self.files.schema["key"].dataType.simpleString()
        skipped = "skipped_blocks"
        ev = lambda df, **v: _event(df, kt, **v)
        b, typ, page = F.col("block_id"), F.col("type"), F.col("page_no")
        blocks, tb, im, parts = self.blocks, self.tables, self.images, self.parts
        titles = blocks.where("route = 'title'")
        low = X.skips_section(F.col("title_text"))
        events = [
            ev(titles.where(low), category=skipped, block_id=b, type="title", reason="low-value section", page_no=page, section_title=F.col("title_text")),
            ev(titles.where(~low), category=skipped, block_id=b, type="title", reason="title used for section tracking only", page_no=page),
            ev(titles.where("bad_level"), category="parse_errors", block_id=b, type="title", error="title level below 1 read as 1"),
            ev(blocks.where("route = 'noise'"), category=skipped, block_id=b, type=typ, reason="page noise", page_no=page),
            ev(blocks.where("route = 'low_value'"), category=skipped, block_id=b, type=typ, reason="content of a low-value section", page_no=page, section_title=F.col("section_title")),
            ev(blocks.where("route = 'unsupported'"), category="unsupported_blocks", block_id=b, type=typ, page_no=page, content_preview=F.left(F.to_json("content"), F.lit(200))),
            ev(tb.where("missing"), category="missing_images", block_id=b, type="table", expected_path=F.col("_raw")),
            ev(im.where("missing"), category="missing_images", block_id=b, type="figure", expected_path=F.col("_raw")),
            ev(tb.where("not filled"), category=skipped, block_id=b, type="table", reason="empty table content and no image", page_no=page),
            ev(parts.where("oversized is not null"), category="oversized_table_chunks", block_id=b, page_no=page, tokens=F.col("oversized"), limit_tokens=self.opts.hard_cap),
            ev(im.where("class = 'weak'"), category=skipped, block_id=b, type="image", reason="weak figure", page_no=page, caption=F.left("caption", F.lit(100)), nearby_text_preview=F.left("nearby", F.lit(100))),
            ev(im.where("class = 'subfigure' and parent is null"), category=skipped, block_id=b, type="image", reason="subfigure without a parent figure", page_no=page, caption=F.left("caption", F.lit(100))),
            ev(self.formulas.where("chunk_text = ''"), category="parse_errors", block_id=b, type="equation_interline", error="empty formula"),
        ]
        if self.opts.strict:
            lost = tb.where("filled").join(parts.select("key", "block_index").distinct(), ["key", "block_index"], "left_anti")
            emptied = self.stripped.where("content_type = 'text' and chunk_text = ''")
            events.append(ev(lost, category=skipped, block_id=b, type="table", reason="table text too short or without rows", page_no=page))
            events.append(ev(emptied, category=skipped, block_id=F.col("source_block_id"), type="text", reason="emptied by affix removal", page_no=page))
        out = events[0]
        for e in events[1:]:
            out = out.unionByName(e)
        return out

    @cached_property
    def stats(self) -> DataFrame:
        folds = self.images.where("parent is not null").groupBy("key").agg(F.count(F.lit(1)).alias("subfigure_fragments_merged"))
        # numbers and cut affixes do not change how many chunks there are, unless emptied ones are dropped
        return _stats(self.chunks if self.opts.strict else self.gathered, self.events, folds, self.files.select("key", "doc_id").distinct())


def pack(files: DataFrame, listing: DataFrame | None = None, opts: Options = Options(), key: str = "file_id", doc: str = "doc_id") -> Packed:
    """Run the packager over `files` (`key`, `doc`, `pages`); `listing` has `key, path` of the images there are."""
    return Packed(files, listing, opts, key, doc)


def _stats(chunks: DataFrame, events: DataFrame, folds: DataFrame, docs: DataFrame) -> DataFrame:
    n = lambda cond, name: F.count_if(cond).alias(name)
    t, cat, why, typ = F.col("content_type"), F.col("category"), F.col("reason"), F.col("type")
    c = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("total_chunks"), *[n(t == k, f"{k}_chunks") for k in ("text", "table", "figure", "formula")])
    noise = (why == "page noise") & (typ != "page_aside_text")
    e = events.groupBy("key").agg(
        n(cat == "missing_images", "missing_images"),
        n((cat == "skipped_blocks") & (noise | (why == "title used for section tracking only")), "skipped_noise"),
        n(why == "empty table content and no image", "skipped_empty"),
        n(why == "low-value section", "skipped_low_value_sections"),
        n(why.isin("weak figure", "subfigure without a parent figure"), "skipped_weak_figures"),
        n((why == "page noise") & (typ == "page_aside_text"), "aside_noise"),
        n(cat == "oversized_table_chunks", "oversized_table_chunks"),
    )
    j = docs.join(c, "key", "left").join(e, "key", "left").join(folds, "key", "left").withColumn("unparseable_blocks", F.lit(0).cast("bigint"))
    return j.select("key", "doc_id", *[F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias(k) for k in COUNTERS])


def error_summary(events: DataFrame) -> DataFrame:
    """Events of each document by category."""
    cats = ("missing_images", "skipped_blocks", "unsupported_blocks", "parse_errors")
    return events.groupBy("doc_id").agg(*[F.count_if(F.col("category") == c).alias(c) for c in cats])
