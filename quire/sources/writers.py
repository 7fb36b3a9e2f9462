"""What a run delivers, as one file each for every document: JSON lines of chunks, manifest, error report, readme.

Files are written by the tasks that hold their rows: lines come sorted by file and place, go to a file of
another name and are moved to their own at the end, so a task that is run again or twice leaves the same file.
Paths may name any file system that Arrow knows.
"""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.options import COUNTERS, TYPE_MAPPING, Options
from quire.plans.pipeline import Packed

SIX = ("chunk_id", "page_no", "content_type", "section_title", "chunk_text", "image_path")
#: Name of each delivered file.
FILES = {"chunks_jsonl": "kb_chunks.jsonl", "manifest": "kb_manifest.json", "readme": "README_kb.md", "error_report": "error_report.json"}
CATEGORIES = ("missing_images", "skipped_blocks", "unsupported_blocks", "parse_errors")


def _located(name: str):
    """File system and path of a full path, which may hold any characters and need not be escaped as URIs are."""
    from pyarrow import fs

    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(//[^/]*)?(/.*)", name, re.S)
    if m is None:
        return fs.LocalFileSystem(), name
    if m.group(1).lower() == "file":
        return fs.LocalFileSystem(), m.group(3)
    system, root = fs.FileSystem.from_uri(f"{m.group(1)}:{m.group(2) or '//'}/")
    return system, root.rstrip("/") + m.group(3)


def write_lines(rows: DataFrame, order: list[str]) -> DataFrame:
    """Write the `line`s of every `file` (a full path) in `order`; gives `file, lines` of the files written.

    Lazy: the files are written when the result is read.  A file's lines pass through one task but are never
    held together.  A null line only makes its file exist.
    """

    def run(batches):
        current, sink, count, done = None, None, 0, []

        def close():
            nonlocal sink
            if sink is not None:
                system, temporary, target, stream = sink
                stream.close()
                system.move(temporary, target)
                done.append((current, count))
                sink = None

        for pdf in batches:
            for name, line in zip(pdf["file"], pdf["line"]):
                if name != current:
                    close()
                    system, target = _located(name)
                    system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    temporary = f"{target}.{uuid.uuid4().hex}"
                    current, count, sink = name, 0, (system, temporary, target, system.open_output_stream(temporary))
                if isinstance(line, str):
                    sink[3].write((line + "\n").encode("utf-8", "replace"))
                    count += 1
        close()
        yield pd.DataFrame(done, columns=["file", "lines"]).astype({"lines": "int64"})

    kept = rows.where("file is not null")
    return kept.repartition("file").sortWithinPartitions("file", *order).select("file", "line").mapInPandas(run, "file string, lines bigint")


def chunk_line() -> Column:
    """The six delivered fields in this order as JSON; section titles are cleaned only here."""
    fields = [X.clean_title(F.col(c)).alias(c) if c == "section_title" else F.col(c) for c in SIX]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _into(folder: Column, name: str) -> Column:
    return F.concat(folder, F.lit(f"/{name}"))


def chunk_files(chunks: DataFrame, docs: DataFrame) -> DataFrame:
    """kb_chunks.jsonl of each document; `docs` has `key, folder`; one without chunks gets an empty file."""
    rows = docs.select("key", "folder").join(chunks, "key", "left").select(_into(F.col("folder"), FILES["chunks_jsonl"]).alias("file"), "seq", F.when(F.col("chunk_id").isNotNull(), chunk_line()).alias("line"))
    return write_lines(rows, ["seq"])


def shared_files(chunks: DataFrame, docs: DataFrame, path: str) -> DataFrame:
    """One file of chunks named after each title (`docs`: key, doc_title); documents of one title share a file."""
    name = F.concat(F.lit(path.rstrip("/") + "/"), F.translate("doc_title", "/\\", "__"), F.lit(".jsonl"))
    rows = chunks.join(docs.select("key", "doc_title"), "key").select(name.alias("file"), "doc_id", "seq", chunk_line().alias("line"))
    return write_lines(rows, ["doc_id", "seq"])


def shared_titles(titles: DataFrame) -> DataFrame:
    """`doc_title, docs` of titles that more than one document has."""
    return titles.where("doc_title is not null").groupBy("doc_title").agg(F.count_distinct("doc_id").alias("docs")).where("docs > 1")


def manifests(docs: DataFrame, stats: DataFrame, opts: Options = Options()) -> DataFrame:
    """`key, folder, manifest`: JSON with paths below the project's root, files, chunking policy and counters.

    `docs` has `key, doc_id, doc_title, source_dir, input_files_all, input_files_used, folder`.
    """
    rel = lambda c: X.relative_path(c, opts.project_root)
    each = lambda m: F.transform_values(m, lambda k, v: F.when(v.isNotNull(), rel(v)))
    mapping = F.create_map(*[F.lit(x) for kv in TYPE_MAPPING.items() for x in kv])
    policy = F.struct(
        F.lit(f"{opts.short_block}-{opts.merge_cap}").alias("target_tokens"),
        F.lit(opts.hard_cap).alias("hard_cap"),
        F.lit(True).alias("merge_short_blocks"),
        F.lit(True).alias("deduplicate_headers"),
        F.lit(True).alias("table_split"),
        mapping.alias("type_mapping"),
    )
    body = F.struct(
        "doc_id",
        "doc_title",
        rel(F.col("source_dir")).alias("source_dir"),
        rel(F.col("input_files_used")["origin_pdf"]).alias("source_pdf"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        each(F.col("input_files_all")).alias("input_files_all"),
        each(F.col("input_files_used")).alias("input_files_used"),
        F.struct(*[rel(_into(F.col("folder"), n)).alias(k) for k, n in FILES.items()]).alias("output_files"),
        policy.alias("chunking_policy"),
        F.struct(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTERS]).alias("stats"),
    )
    j = docs.join(stats.drop("doc_id"), "key", "left")
    return j.select("key", "folder", F.to_json(body, {"ignoreNullFields": "false"}).alias("manifest"))


def error_reports(events: DataFrame, docs: DataFrame) -> DataFrame:
    """`key, report` for every document of `docs` (key, doc_id): counts of the four categories and a list of each.

    Oversized tables have a list only where there are any, and no count.
    """
    fields = {
        "missing_images": ("block_id", "expected_path", "type"),
        "skipped_blocks": ("block_id", "type", "reason", "page_no", "section_title", "caption", "nearby_text_preview"),
        "unsupported_blocks": ("block_id", "type", "page_no", "content_preview"),
        "parse_errors": ("block_id", "type", "expected_path", "error"),
        "oversized_table_chunks": ("block_id", "page_no", "tokens", "limit_tokens"),
    }
    number = lambda c: F.regexp_extract(c, r"_b(\d+)$", 1).try_cast("int")
    picked = [F.array_sort(F.collect_list(F.when(F.col("category") == k, F.struct(number(F.col("block_id")).alias("_o"), *[c for c in f])))).alias(k) for k, f in fields.items()]
    per = events.groupBy("key").agg(*picked)
    j = docs.select("key", "doc_id").join(per, "key", "left")

    def listed(k: str) -> Column:
        items = F.transform(k, lambda x: F.struct(*[x[c].alias(c) for c in fields[k]]))
        return items if k == "oversized_table_chunks" else F.coalesce(items, F.array())

    count = lambda k: F.greatest(F.coalesce(F.size(k), F.lit(0)), F.lit(0)).alias(f"total_{k}")
    over = F.when(F.size("oversized_table_chunks") > 0, listed("oversized_table_chunks")).alias("oversized_table_chunks")
    body = F.struct("doc_id", F.struct(*[count(k) for k in CATEGORIES]).alias("summary"), *[listed(k).alias(k) for k in CATEGORIES], over)
    return j.select("key", F.to_json(body).alias("report"))


#: Counters a readme shows, with their labels.
_SHOWN = {
    "total_chunks": "Chunks in all", "text_chunks": "Text chunks", "table_chunks": "Table chunks", "figure_chunks": "Figure chunks", "formula_chunks": "Formula chunks",
    "missing_images": "Images missing", "skipped_noise": "Noise blocks left out", "skipped_empty": "Empty blocks left out",
}


def readmes(docs: DataFrame, stats: DataFrame) -> DataFrame:
    """`key, readme`: what a document's files are, how to load them, and eight counters."""
    j = docs.select("key", "doc_title").join(stats.drop("doc_id"), "key", "left")
    head = F.concat(F.lit("# "), F.coalesce("doc_title", F.lit("")), F.lit(f"\n\n`{FILES['chunks_jsonl']}` holds one retrieval chunk a line: {', '.join(SIX)}.\nEmbed `chunk_text`; the other fields are metadata.\n\n| count | value |\n|---|---|\n"))
    rows = F.concat_ws("\n", *[F.concat(F.lit(f"| {label} | "), F.coalesce(F.col(c), F.lit(0)).cast("string"), F.lit(" |")) for c, label in _SHOWN.items()])
    return j.select("key", F.concat(head, rows).alias("readme"))


def self_check(stats: DataFrame) -> DataFrame:
    """The report's five health figures for each document."""
    return stats.select("key", "skipped_low_value_sections", "skipped_weak_figures", "subfigure_fragments_merged", "oversized_table_chunks", "aside_noise")


def write_all(packed: Packed, docs: DataFrame, opts: Options = Options()) -> None:
    """The four files of every document of `docs` into its `folder`."""
    single = lambda df, name, text: write_lines(df.select(_into(F.col("folder"), FILES[name]).alias("file"), F.col(text).alias("line")), [])
    folders = docs.select("key", "folder")
    written = chunk_files(packed.chunks, docs)
    for df in (
        single(manifests(docs, packed.stats, opts), "manifest", "manifest"),
        single(error_reports(packed.events, docs).join(folders, "key"), "error_report", "report"),
        single(readmes(docs, packed.stats).join(folders, "key"), "readme", "readme"),
    ):
        written = written.unionByName(df)
    written.write.format("noop").mode("overwrite").save()


def write_corpus(packed: Packed, path: str) -> None:
    """All chunks as one set of JSON-lines files, for corpora with too many documents for a file each."""
    rows = packed.chunks.select("doc_id", "seq", *[X.clean_title(F.col(c)).alias(c) if c == "section_title" else F.col(c) for c in SIX])
    rows.repartition("doc_id").sortWithinPartitions("doc_id", "seq").drop("doc_id", "seq").write.mode("overwrite").json(path)

