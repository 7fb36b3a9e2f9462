"""Folders that layout parsers write: which files they hold, which are used, and the decoded pages.

    <root>/<title>.pdf-<uuid>/  [prefix_]content_list_v2.json, [prefix_]content_list.json, [prefix_]layout.json,
                                [prefix_]model.json, [prefix_]origin.pdf, full.md, images/<name>

Only the chosen content list is opened.  Of several files for one role the smallest path is taken, prefixed
names before plain ones.  Folders are listed by a distributed scan that reads no contents; files of no bytes
are not listed, so an empty image counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.nested import PAGES

ROLES = ("origin_pdf", "content_list_v2", "content_list", "layout", "model", "full_md", "images_dir")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """`path, dirname, name` of every file below the folders of `root`; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    return files.select(*placed(F.col("path")))


def placed(path: Column) -> tuple[Column, Column, Column]:
    """A path with the name of its document's folder and its own name within that folder."""
    tail = F.regexp_extract(path, r"([^/]+)/((?:images/)?[^/]+)$", 0)
    return path.alias("path"), F.regexp_extract(tail, r"^([^/]+)/", 1).alias("dirname"), F.regexp_extract(tail, r"^[^/]+/(.+)$", 1).alias("name")


def with_roles(files: DataFrame) -> DataFrame:
    """Adds `role` (null for other files) and `rank`: prefixed names first where a role has both."""
    n = F.col("name")
    ends = lambda s: (n == s) | n.endswith("_" + s)
    role = (
        F.when(n.startswith("images/"), "images_dir")
        .when(ends("origin.pdf"), "origin_pdf")
        .when(ends("content_list_v2.json"), "content_list_v2")
        .when(ends("content_list.json"), "content_list")
        .when(ends("layout.json"), "layout")
        .when(ends("model.json"), "model")
        .when(n == "full.md", "full_md")
    )
    return files.withColumn("role", role).withColumn("rank", F.when(n.isin("content_list_v2.json", "content_list.json", "layout.json", "model.json"), 1).otherwise(0))


def discovered(files: DataFrame) -> DataFrame:
    """`dirname, files_all, files_used`: maps of role to path; the v1 list is used only without a v2 list."""
    r = with_roles(files).where("role is not null")
    best = r.groupBy("dirname", "role").agg(F.min(F.struct("rank", "path"))["path"].alias("path"))
    best = best.withColumn("path", F.when(F.col("role") == "images_dir", F.regexp_extract("path", r"^(.*/images)/", 1)).otherwise(F.col("path")))
    per = best.groupBy("dirname").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("role", "path")))).alias("files_all"))
    used = F.map_filter("files_all", lambda k, v: (k != "content_list") | F.get(F.array(F.col("files_all")["content_list_v2"]), F.lit(0)).isNull())
    return per.withColumn("files_used", used)


def content_paths(dirs: DataFrame) -> DataFrame:
    """`dirname, path` of the content list to read; null where a folder has none."""
    return dirs.select("dirname", F.coalesce(F.col("files_used")["content_list_v2"], F.col("files_used")["content_list"]).alias("path"))


#: Pages as they are decoded: levels come as numbers or as text.
_DECODED = PAGES.simpleString().replace("level:int", "level:string")


def decoded(files: DataFrame, body: str = "value") -> DataFrame:
    """`files` with `pages` out of JSON text; null where it cannot be decoded."""
    return files.withColumn("pages", F.from_json(body, _DECODED)).drop(body)


def load_pages(spark: SparkSession, root: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(`dirname, doc_id, doc_title, pages`, events): one row for each folder; undecodable files have null pages.

    A folder without any content list raises if `strict`, otherwise it becomes an event.
    """
    paths = content_paths(discovered(listing(spark, root)))
    if strict and not paths.where("path is null").isEmpty():
        raise ValueError("a folder has neither content_list_v2.json nor content_list.json")
    read = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*content_list*.json").select(F.col("_metadata.file_path").alias("path"), "value")
    out = decoded(paths.where("path is not null").join(read, "path", "left")).select("dirname", X.doc_id(F.col("dirname")).alias("doc_id"), X.doc_title(F.col("dirname")).alias("doc_title"), "path", "pages")
    return out.drop("path"), load_events(paths, out)


def load_events(paths: DataFrame, loaded: DataFrame) -> DataFrame:
    """`key, doc_id, category, expected_path, error` of folders without a content list and of undecodable ones."""
    row = lambda df, error: df.select(F.col("dirname").alias("key"), X.doc_id(F.col("dirname")).alias("doc_id"), F.lit("parse_errors").alias("category"), F.col("path").alias("expected_path"), F.lit(error).alias("error"))
    return row(loaded.where("pages is null"), "content list is not decodable").unionByName(row(paths.where("path is null"), "no content list"))


def image_listing(spark: SparkSession, root: str) -> DataFrame:
    """`dirname, path` (as content lists write it) of every image there is."""
    return listing(spark, root).where(F.col("name").startswith("images/")).select("dirname", F.col("name").alias("path"))
