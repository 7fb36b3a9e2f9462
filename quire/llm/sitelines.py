"""Lines that one source repeats across its documents: find them and take them out.

Two lines are the same if they agree after trimming, collapsing spaces and tabs, lower-casing and
treating every run of digits alike.  Only lines of at least `min_letters` letters are looked at.

Documents that are copies of each other are collapsed first: a document's fingerprint is the sum
of two hashes of each of its chunk texts, documents of one source with equal fingerprints are one cluster,
and only the cluster's first document has its lines counted.  For every line come out the distinct
clusters, the distinct publication dates, and the documents, which are the sizes of those clusters
added up; so a line is counted once for an article that was republished a thousand times, and the
number of documents is still exact.

A line is boilerplate of its source if its documents reach `min_docs` and `min_share` of all documents
of the source (null texts included), its clusters `min_clusters` and its dates `min_dates`; the dates are
those known, and a `min_dates` of 1 asks for none, so a source delivered without dates is treated alike.

Scale: texts are never shuffled; line hashes are made distinct per document at the scan, and counted
with partial aggregation, so neither a hot source nor a hot line gathers in one task.  The lines found
are few for each source (at most lines per document / min_share), are counted, and are broadcast only
within a bound.

Defined results: null, empty and blank texts have no lines to find and are left as they are; rows with a
null source are left as they are; rows with a null doc_id count for no document but lose their source's lines; repeated rows count once; a chunk that
loses all its lines becomes an empty text, its row stays; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.runtime import bounded_join, cut


def same_text(text: Column) -> Column:
    """The text with spaces, tabs, case and digits of its lines levelled (line feeds stay; lines not yet trimmed)."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\p{Nd}+", "0"))


def line_hash(line: Column) -> Column:
    """64-bit hash of a levelled line, trimmed."""
    return F.xxhash64(F.trim(line))


def _letters(line: Column) -> Column:
    return F.regexp_count(line, F.lit(r"\p{L}"))


class SiteLines:
    """`lines`: every line looked at with its counts; `found`: the boilerplate among them."""

    def __init__(self, chunks: DataFrame, lines: DataFrame, found: DataFrame, min_letters: int):
        self.chunks, self.lines, self.found, self.min_letters = chunks, lines, found, min_letters

    def places(self) -> DataFrame:
        """`chunk_id, line_no` of each boilerplate line (1-based, empty lines counted), distinct."""
        src = self.chunks.select("chunk_id", "source", F.posexplode(F.split(same_text(F.col("chunk_text")), "\n")).alias("i", "line"))
        src = src.where(F.length("line") >= self.min_letters).select("chunk_id", "source", "i", "line", line_hash(F.col("line")).alias("h"))
        hit = bounded_join(src, self.found.select("source", "h"), ["source", "h"])
        return hit.where(_letters(F.col("line")) >= self.min_letters).select("chunk_id", (F.col("i") + 1).alias("line_no")).distinct()

    def report(self) -> DataFrame:
        """`source, line` (levelled), with its documents, clusters and dates, of each boilerplate line."""
        src = self.chunks.select("source", F.explode(F.split(same_text(F.col("chunk_text")), "\n")).alias("line")).where(F.length("line") >= self.min_letters)
        src = src.select("source", F.trim("line").alias("line"), line_hash(F.col("line")).alias("h"))
        text = bounded_join(src, self.found.select("source", "h"), ["source", "h"]).groupBy("source", "h").agg(F.min("line").alias("line"))
        return self.found.join(text, ["source", "h"]).where(_letters(F.col("line")) >= self.min_letters).select("source", "line", "docs", "clusters", "dates", "source_docs")

    def cleaned(self) -> DataFrame:
        """The chunks with `clean_text` and `removed` (lines taken out); one row for each input row."""
        per = self.found.groupBy("source").agg(F.collect_set("h").alias("_hs"))
        j = bounded_join(self.chunks, per, "source", "left")
        pairs = F.arrays_zip(F.split("chunk_text", "\n").alias("o"), F.split(same_text(F.col("chunk_text")), "\n").alias("s"))
        own = F.filter(pairs, lambda p: ~((F.length(p["s"]) >= self.min_letters) & F.array_contains(F.col("_hs"), line_hash(p["s"])) & (_letters(p["s"]) >= self.min_letters)))
        kept = F.when(F.col("_hs").isNull() | F.col("chunk_text").isNull(), F.col("chunk_text")).otherwise(F.array_join(F.transform(own, lambda p: p["o"]), "\n"))
        removed = F.when(F.col("_hs").isNull() | F.col("chunk_text").isNull(), F.lit(0)).otherwise(F.size(F.split("chunk_text", "\n")) - F.size(own))
        return j.select("chunk_id", "doc_id", "source", "chunk_text", kept.alias("clean_text"), removed.alias("removed"))


def site_lines(
    chunks: DataFrame,
    min_docs: int = 4,
    min_share: tuple[int, int] = (1, 10),
    min_letters: int = 20,
    min_clusters: int = 1,
    min_dates: int = 1,
) -> SiteLines:
    """Boilerplate lines of `chunks` (chunk_id, doc_id, source, chunk_text, created_at).

    `min_share` is a fraction (numerator, denominator), so the comparison is exact.
    """
    chunks = chunks.select("chunk_id", "doc_id", "source", "chunk_text", F.to_date("created_at").alias("_day"))
    known = chunks.where("source is not null and doc_id is not null")
    # a text of a chunk counts once however often it was ingested
    once = known.groupBy("source", "doc_id", "chunk_id", F.xxhash64("chunk_text").alias("h")).agg(F.min("_day").alias("day"))
    docs = once.groupBy("source", "doc_id").agg(F.sum(F.xxhash64("h") % 1_000_003_000_001).alias("f1"), F.sum(F.xxhash64("h", F.lit(1)) % 1_000_003_000_001).alias("f2"), F.min("day").alias("day"))
    clusters = docs.groupBy("source", "f1", "f2").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("size"), F.min("day").alias("day"))
    clusters = cut(clusters.select("source", "doc_id", "size", "day"))
    totals = clusters.groupBy("source").agg(F.sum("size").alias("source_docs"))

    line = F.explode(F.split(same_text(F.col("chunk_text")), "\n")).alias("line")
    each = known.select("source", "doc_id", line).where(F.length("line") >= min_letters)
    each = each.select("source", "doc_id", line_hash(F.col("line")).alias("h")).distinct()
    counted = each.join(clusters, ["source", "doc_id"])
    by_day = counted.groupBy("source", "h", "day").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("d"))
    lines = by_day.groupBy("source", "h").agg(F.sum("d").alias("docs"), F.sum("c").alias("clusters"), F.count("day").alias("dates"))
    # one row for each source
    lines = lines.where(F.col("docs") >= min_docs).join(totals, "source")
    rule = (F.col("docs") * min_share[1] >= F.col("source_docs") * min_share[0]) & (F.col("clusters") >= min_clusters)
    if min_dates > 1:
        rule &= F.col("dates") >= min_dates
    return SiteLines(chunks, lines, cut(lines.where(rule)), min_letters)
