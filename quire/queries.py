"""Queries of the core operators; each takes (spark, folder of the tables) and runs over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import dedup, figures, nested, tables, textchunks
from quire.operators.packing import greedy_bins, split_pieces
from quire.operators.sections import explode_blocks, sectioned
from quire.options import COUNTERS, Options
from quire.plans.pipeline import Packed, pack
from quire.plans.pipeline import error_summary as summarised
from quire.runtime import cut, shared_folder, ship, table
from quire.sources import parser_dirs, writers

Query = Callable[[SparkSession, str], DataFrame]


def _files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "content_list_v2")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return explode_blocks(_files(spark, d)).withColumnRenamed("key", "file_id")


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return sectioned(_files(spark, d))


def _listing(spark: SparkSession, d: str) -> DataFrame:
    """Images there are: those that packaged chunks refer to."""
    return table(spark, d, "kb_chunks").where("image_path <> ''").select("image_path").distinct()


def _packed(spark: SparkSession, d: str, opts: Options = Options()) -> Packed:
    """The packager over every parsed file, with the images that packaged chunks of the same document refer to."""
    images = table(spark, d, "kb_chunks").where("image_path <> ''").select("doc_id", F.col("image_path").alias("path")).distinct()
    files = _files(spark, d)
    listing = files.select(F.col("file_id").alias("key"), "doc_id").join(images, "doc_id").select("key", "path")
    return pack(files, listing, opts)


# ---- nested records ----------------------------------------------------------------------------


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = nested.page_nodes(_files(spark, d), table(spark, d, "content_list_raw"), set(nested.PATHS.values()))
    return nested.located(nodes).select("file_id", "page_no", "block_no", "field", "list_no", "item_no").distinct()


def _related(spark: SparkSession, d: str) -> DataFrame:
    nodes = nested.page_nodes(_files(spark, d), table(spark, d, "content_list_raw"), set(nested.TABLES.values()))
    return nested.related(nodes, "file_id", nested.TABLES)


def p1_tables(spark: SparkSession, d: str) -> DataFrame:
    """The seven related tables as one: every row with its label, the table and label of its parent row, and its scalars."""
    r = _related(spark, d)
    scalar = lambda *names: F.coalesce(*[F.get_json_object("value", f"$.{n}") for n in names])
    struct = F.col("shape") == "object"
    text = F.when(struct, scalar("content", "path")).otherwise(F.col("value"))
    return r.select("table_name", "file_id", "label", "parent_table", "parent", "position", F.when(struct, scalar("type", "item_type")).alias("kind"), text.alias("text"))


def p1_children(spark: SparkSession, d: str) -> DataFrame:
    """Item contents counted by the list item they hang on, by joining child rows to their parent rows."""
    t = nested.tables_of(_related(spark, d), nested.TABLES)
    kids = t["item_contents"].groupBy("file_id", F.col("parent").alias("label")).agg(F.count(F.lit(1)).alias("contents"))
    blocks = t["blocks"].select("file_id", F.col("label").alias("parent"), F.col("parent").cast("int").alias("page_no"), F.col("position").alias("block_no"))
    items = t["list_items"].join(blocks, ["file_id", "parent"])
    return items.join(kids, ["file_id", "label"], "left").select("file_id", "page_no", "block_no", F.col("position").alias("list_no"), F.coalesce("contents", F.lit(0)).alias("contents"))


# ---- sources and identity ----------------------------------------------------------------------


def doc_identity(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select("file_id", X.doc_id(F.col("dir_name")).alias("made_id"), X.doc_title(F.col("dir_name")).alias("made_title"))


def _listed(spark: SparkSession, d: str) -> DataFrame:
    """Files of parser folders as a listing: those that manifests name, and a second, prefixed layout beside each layout."""
    m = table(spark, d, "kb_manifest").select(F.explode("input_files_all").alias("role", "path")).where("path is not null")
    path = F.when(F.col("role") == "images_dir", F.concat("path", F.lit("/p1.png"))).otherwise(F.col("path"))
    again = m.where("role = 'layout'").select("role", F.regexp_replace("path", "layout.json$", "x_layout.json").alias("path"))
    return m.select("role", path.alias("path")).unionByName(again).select(*parser_dirs.placed(F.col("path"))).distinct()


def discovered_files(spark: SparkSession, d: str) -> DataFrame:
    """Role of every file of every folder and whether it is used."""
    f = parser_dirs.discovered(_listed(spark, d))
    return f.select("dirname", F.explode("files_all").alias("role", "path"), "files_used").select("dirname", "role", "path", F.col("files_used")[F.col("role")].isNotNull().alias("used"))


def content_choice(spark: SparkSession, d: str) -> DataFrame:
    """The content list to read of every folder; folders without one become events."""
    paths = parser_dirs.content_paths(parser_dirs.discovered(_listed(spark, d)))
    events = parser_dirs.load_events(paths, paths.where("path is not null").withColumn("pages", F.lit(True)))
    return paths.join(events.select(F.col("key").alias("dirname"), "error"), "dirname", "left")


def _loaded(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "content_list_raw").select("file_id", "doc_id", "body")
    return parser_dirs.decoded(raw, "body")


def loaded_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages and blocks of every file that exists as JSON text; null where it cannot be decoded."""
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    blocks = F.aggregate("pages", F.lit(0), lambda n, p: n + size(p))
    return _loaded(spark, d).select("file_id", F.when(F.col("pages").isNotNull(), F.size("pages")).alias("pages"), blocks.alias("blocks"))


def load_errors(spark: SparkSession, d: str) -> DataFrame:
    """Files whose JSON cannot be decoded; they become parse errors and an empty document."""
    files = _loaded(spark, d).select(F.col("file_id").cast("string").alias("dirname"), F.lit(None).cast("string").alias("path"), "pages")
    return parser_dirs.load_events(files.limit(0), files).select(F.col("key").cast("bigint").alias("file_id"), "category", "error")


def packed_raw(spark: SparkSession, d: str) -> DataFrame:
    """The whole packager over the files that exist as JSON text."""
    p = pack(_loaded(spark, d))
    return p.chunks.select(F.col("key").alias("file_id"), "chunk_id", "page_no", "content_type", X.clean_title(F.col("section_title")).alias("section_title"), "chunk_text")


def shared_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles under which several files would share one file of chunks."""
    return writers.shared_titles(_files(spark, d).select(X.doc_title(F.col("dir_name")).alias("doc_title"), F.col("file_id").alias("doc_id")))


def relative_paths(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "kb_manifest")
    return m.select("doc_id", X.relative_path(F.col("source_pdf"), "raw").alias("pdf"), X.relative_path(F.col("source_dir"), "raw").alias("dir"))


# ---- blocks, sections, routes --------------------------------------------------------------------


def block_ids(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("file_id", "page_no", "block_idx", F.col("block_index").cast("bigint").alias("block_index"), "block_id", "type")


def inline_texts(spark: SparkSession, d: str) -> DataFrame:
    c = lambda f: F.col(f"content.{f}")
    return _blocks(spark, d).select("file_id", "block_id", X.inline_text(c("title_content")).alias("title"), X.inline_text(c("paragraph_content")).alias("paragraph"), X.list_text(c("list_items")).alias("list"), X.inline_text(c("image_caption")).alias("caption"))


def clean_texts(spark: SparkSession, d: str) -> DataFrame:
    """The cleaning chain over every chunk text and document."""
    a = table(spark, d, "kb_chunks").select("chunk_id", "chunk_text").distinct().select(F.col("chunk_id").alias("id"), F.col("chunk_text").alias("t"))
    b = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("t"))
    return a.unionByName(b).select("id", X.clean_text(F.col("t")).alias("clean"))


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.tokens(F.col("text")).alias("tokens"))


def section_paths(spark: SparkSession, d: str) -> DataFrame:
    return _sections(spark, d).select(F.col("key").alias("file_id"), "block_id", F.col("depth").cast("bigint").alias("depth"), "section_title")


def clean_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "kb_chunks").select("chunk_id", X.clean_title(F.col("section_title")).alias("title"), X.skips_section(F.col("section_title")).alias("skips")).distinct()


def routes(spark: SparkSession, d: str) -> DataFrame:
    b = _sections(spark, d)
    return b.groupBy(F.col("key").alias("file_id"), "route").agg(F.count(F.lit(1)).alias("blocks"))


def segments(spark: SparkSession, d: str) -> DataFrame:
    return _sections(spark, d).select(F.col("key").alias("file_id"), "block_id", F.col("segment").cast("bigint").alias("segment"))


# ---- packing -----------------------------------------------------------------------------------------


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Documents as sequences of lines: `doc_id, lines`."""
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", F.split("text", "\n").alias("lines"))


def merge_bins(spark: SparkSession, d: str) -> DataFrame:
    """Bins of the lines of every document, with the packager's budgets."""
    o = Options()
    b = _lines(spark, d).select("doc_id", greedy_bins(F.transform("lines", X.tokens), o.merge_cap, o.short_block).alias("bins"))
    return b.select("doc_id", F.posexplode("bins").alias("pos", "bin")).select("doc_id", "pos", "bin")


def split_texts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(split_pieces(F.col("text"), Options().hard_cap)).alias("piece", "part"))


def text_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Text chunks before affixes are cut: merged, split, with the blocks they come from."""
    t = textchunks.text_chunks(textchunks.merged_texts(_sections(spark, d)))
    return t.select(F.col("key").alias("file_id"), "segment", "bin", "piece", "page_no", "section_title", "source_block_id", F.array_join("merge_from_block_ids", ",").alias("members"), "chunk_text")


# ---- tables ------------------------------------------------------------------------------------------


def _tables(spark: SparkSession, d: str) -> DataFrame:
    return tables.parsed_tables(_blocks(spark, d).where("type = 'table'"))


def html_tables(spark: SparkSession, d: str) -> DataFrame:
    cells = lambda r: F.array_join(r, " | ")
    return _tables(spark, d).select("file_id", "block_id", cells(F.col("headers")).alias("header"), F.array_join(F.transform("rows", cells), "\n").alias("body"), "caption", "footnote")


def table_texts(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).select("file_id", "block_id", tables.table_text().alias("text"))


def table_parts(spark: SparkSession, d: str) -> DataFrame:
    """Every table split at the packager's cap."""
    return tables.split_tables(_tables(spark, d)).select("file_id", "block_id", "part", "parts", "is_split", "chunk_text")


def table_parts_tight(spark: SparkSession, d: str) -> DataFrame:
    """Every table split at a cap of 120 tokens, where most of them need several parts."""
    t = tables.split_tables(_tables(spark, d), Options(hard_cap=120))
    return t.select("file_id", "block_id", "part", "parts", "is_split", "chunk_text", "oversized")


# ---- figures -----------------------------------------------------------------------------------------


def image_check(spark: SparkSession, d: str) -> DataFrame:
    """Paths of images and tables: good, there, missing."""
    there = _listing(spark, d).select(F.col("image_path").alias("path"), F.lit(True).alias("hit"))
    b = _blocks(spark, d).where("type in ('image', 'table')").select("file_id", "block_id", F.col("content.image_source.path").alias("path"))
    b = b.withColumn("good", X.is_image_path(F.col("path"))).join(there, "path", "left")
    return b.select("file_id", "block_id", "good", (F.col("good") & F.coalesce("hit", F.lit(False))).alias("there"), (F.col("good") & ~F.coalesce("hit", F.lit(False))).alias("missing"))


def nearby_texts(spark: SparkSession, d: str) -> DataFrame:
    """For every image: the next and the previous eligible text of its page and the nearest of the pages around."""
    b = cut(_sections(spark, d))
    i = figures.positional_text(b.where("type = 'image'"), figures.page_texts(b))
    return i.select(F.col("key").alias("file_id"), "block_id", "forward", "backward", "neighbour")


def figure_labels(spark: SparkSession, d: str) -> DataFrame:
    cap = X.inline_text(F.col("content.image_caption"))
    b = _blocks(spark, d).where("type = 'image'").select("file_id", "block_id", cap.alias("caption"))
    return b.select("file_id", "block_id", X.has_figure_number(F.col("caption")).alias("numbered"), X.is_subfigure_label(F.col("caption")).alias("part_label"))


def figure_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Formal figures with text near them and their parts folded in."""
    f = _packed(spark, d).figures
    return f.select(F.col("key").alias("file_id"), "block_id", "section_title", "chunk_text", "image_path", F.coalesce(F.size("subfigures"), F.lit(0)).alias("parts"))


def figure_context(spark: SparkSession, d: str) -> DataFrame:
    """Every image with the text near it, the latest text chunk before it, its class and its parent figure."""
    i = _packed(spark, d).images
    return i.select(F.col("key").alias("file_id"), "block_id", "recent", "nearby", F.col("class").alias("class"), F.col("parent").alias("parent"), "missing")


def formulas(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d).where("type = 'equation_interline'")
    return b.select("file_id", "block_id", F.coalesce("content.math_content", F.lit("")).alias("formula"))


# ---- affixes, counters, reports ------------------------------------------------------------------------


def _chunk_texts(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "kb_chunks").where("content_type = 'text' and chunk_text is not null")
    return k.select(F.col("source").alias("key"), "chunk_id", "chunk_text").distinct()


def affix_frequency(spark: SparkSession, d: str) -> DataFrame:
    return dedup.affix_counts(_chunk_texts(spark, d)).select(F.col("key").alias("source"), "side", "affix", "n")


def affix_strip(spark: SparkSession, d: str) -> DataFrame:
    """Repeated heads and tails cut; the texts of a source stand for the texts of a document."""
    t = _chunk_texts(spark, d)
    out = dedup.strip_affixes(t, dedup.affix_counts(t))
    return out.select("chunk_id", "chunk_text", F.array_contains("removed", "removed_header").alias("head_cut"), F.array_contains("removed", "removed_footer").alias("tail_cut"))


def error_summary(spark: SparkSession, d: str) -> DataFrame:
    return summarised(table(spark, d, "kb_errors").distinct())


def counter_totals(spark: SparkSession, d: str) -> DataFrame:
    """The 14 counters of the whole run, added up as the command line does, as long rows."""
    t = _packed(spark, d).stats.agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return t.unpivot([], list(COUNTERS), "counter", "total")


def self_check(spark: SparkSession, d: str) -> DataFrame:
    """The report's five health figures of each file packed."""
    return writers.self_check(_packed(spark, d).stats).withColumnRenamed("key", "file_id")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents to deliver: `key, doc_id, doc_title, source_dir, input_files_all, input_files_used, folder`."""
    m = table(spark, d, "kb_manifest")
    return m.select(F.col("doc_id").alias("key"), "doc_id", "doc_title", "source_dir", "input_files_all", "input_files_used", F.concat("source_dir", F.lit("/output")).alias("folder"))


def _counters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "kb_stats").withColumn("key", F.col("doc_id"))


def manifests(spark: SparkSession, d: str) -> DataFrame:
    """Fields of the manifest made for every document, read back out of its JSON."""
    j = writers.manifests(_documents(spark, d), _counters(spark, d), Options(project_root="inbox"))
    at = lambda p: F.get_json_object("manifest", f"$.{p}")
    names = {"title": "doc_title", "dir": "source_dir", "pdf": "source_pdf", "target_tokens": "chunking_policy.target_tokens", "hard_cap": "chunking_policy.hard_cap", "image_type": "chunking_policy.type_mapping.image", "chunks_file": "output_files.chunks_jsonl", "report_file": "output_files.error_report", "layout": "input_files_all.layout", "list_used": "input_files_used.content_list_v2", "total_chunks": "stats.total_chunks", "aside_noise": "stats.aside_noise"}
    return j.select(F.col("key").alias("doc_id"), *[at(p).alias(n) for n, p in names.items()])


def error_reports(spark: SparkSession, d: str) -> DataFrame:
    """Counts and lists of the error report made for every document, read back out of its JSON."""
    e = table(spark, d, "kb_errors").distinct().withColumn("key", F.col("doc_id"))
    j = writers.error_reports(e, _documents(spark, d))
    length = lambda k: F.coalesce(F.json_array_length(F.get_json_object("report", f"$.{k}")), F.lit(0)).cast("bigint").alias(k)
    total = lambda k: F.get_json_object("report", f"$.summary.total_{k}").cast("bigint").alias(f"total_{k}")
    return j.select(F.col("key").alias("doc_id"), *[total(k) for k in writers.CATEGORIES], *[length(k) for k in (*writers.CATEGORIES, "oversized_table_chunks")])


def readmes(spark: SparkSession, d: str) -> DataFrame:
    """The table of counters in every document's readme."""
    r = writers.readmes(_documents(spark, d), _counters(spark, d))
    return r.select(F.col("key").alias("doc_id"), F.get(F.split("readme", "\n"), F.lit(0)).alias("head"), F.array_join(F.regexp_extract_all("readme", F.lit(r"\| (\d+) \|"), F.lit(1)), ",").alias("counts"))


def _delivered(spark: SparkSession, d: str) -> DataFrame:
    """Chunks packaged before, in the order of their numbers; repeated ingestions once."""
    k = table(spark, d, "kb_chunks").select(F.col("doc_id").alias("key"), "doc_id", *writers.SIX).distinct()
    return k.withColumn("seq", F.regexp_extract("chunk_id", r":(\d+)$", 1).cast("int"))


def _read_back(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Writes `files` by their paths and reads the lines again, with the names of their files."""
    paths = [r["root"] for r in files.select(F.regexp_extract("file", "^(.*/quire-written/[^/]+)/", 1).alias("root")).distinct().collect()]
    schema = "chunk_id string, page_no int, content_type string, section_title string, chunk_text string, image_path string"
    if not paths:
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(""))
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(paths).withColumn("_file", F.col("_metadata.file_path"))


def written_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks written as one file for each document into the shared folder, and read again."""
    root = f"{shared_folder(spark)}/quire-written/chunks-{uuid.uuid4().hex}"
    docs = _documents(spark, d).withColumn("folder", F.concat(F.lit(root + "/"), F.md5("doc_id")))
    return _read_back(spark, writers.chunk_files(_delivered(spark, d), docs)).drop("_file")


def shared_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks written as one file for each title into the shared folder, and counted by file."""
    root = f"{shared_folder(spark)}/quire-written/shared-{uuid.uuid4().hex}"
    docs = _documents(spark, d).where("doc_title is not null")
    back = _read_back(spark, writers.shared_files(_delivered(spark, d), docs, root))
    name = F.url_decode(F.replace(F.regexp_extract("_file", r"([^/]+)\.jsonl$", 1), F.lit("+"), F.lit("%2B")))
    return back.groupBy(name.alias("title")).agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("chunk_id").alias("chunks"))


def packed_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The whole packager over content_list_v2: the six delivered columns, with the file they come from."""
    p = _packed(spark, d)
    return p.chunks.select(F.col("key").alias("file_id"), "chunk_id", "page_no", "content_type", X.clean_title(F.col("section_title")).alias("section_title"), "chunk_text", "image_path")


def packed_stats(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).stats.withColumnRenamed("key", "file_id")


def packed_events(spark: SparkSession, d: str) -> DataFrame:
    """Every event; the preview of unsupported contents, which engines spell differently, is left out."""
    return _packed(spark, d).events.withColumnRenamed("key", "file_id").drop("content_preview")


flagship = packed_chunks


def queries() -> dict[str, Query]:
    names = [
        p1_found, p1_tables, p1_children, doc_identity, discovered_files, content_choice, loaded_pages, load_errors, relative_paths, block_ids, inline_texts, clean_texts, token_counts, section_paths, clean_titles,
        routes, segments, merge_bins, split_texts, text_chunks, html_tables, table_texts, table_parts, table_parts_tight, image_check, nearby_texts, figure_labels, figure_context, figure_chunks, formulas,
        affix_frequency, affix_strip, error_summary, packed_chunks, packed_stats, packed_events, packed_raw, counter_totals, self_check, shared_titles, manifests, error_reports, readmes, written_chunks, shared_chunks,
    ]

    def ready(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {f.__name__: ready(f) for f in names}


def oracle_sql() -> dict[str, str]:
    from quire.oracles import SQL

    return dict(SQL)
