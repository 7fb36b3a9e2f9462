"""Queries of the training-data operators, by the number of their problem."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import encode as enc
from quire.llm import markup as mk
from quire.llm import mix as mx
from quire.llm import neardup as nd
from quire.llm import repeat as rp
from quire.llm import scan as sc
from quire.llm import sitelines as sl
from quire.runtime import cut, ship, spread, table

Query = Callable[[SparkSession, str], DataFrame]


def _similar(spark: SparkSession, d: str) -> nd.NearDuplicates:
    return nd.near_duplicates(table(spark, d, "kb_chunks"), width=3, num=3, den=5, min_words=20)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nd.spelled_pairs(_similar(spark, d), spelled=None).select(F.col("id_a").alias("chunk_id_a"), F.col("id_b").alias("chunk_id_b"))


def p2_members(spark: SparkSession, d: str) -> DataFrame:
    """The join of p2_found: smallest chunk_id of the same set of runs and of the same text for every chunk in it."""
    return nd.memberships(_similar(spark, d)).withColumnRenamed("id", "chunk_id")


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """Five words and 0.8: group and number of links of every chunk; shorter texts are grouped where they are equal."""
    chunks = table(spark, d, "kb_chunks")
    return nd.all_groups(nd.near_duplicates(chunks), chunks).withColumnRenamed("id", "chunk_id")


def _site_lines(spark: SparkSession, d: str) -> sl.SiteLines:
    return sl.site_lines(spread(table(spark, d, "kb_chunks").select("chunk_id", "doc_id", "source", "chunk_text", "created_at")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _site_lines(spark, d).places()


def p3_lines(spark: SparkSession, d: str) -> DataFrame:
    """Documents, clusters and dates of each boilerplate line."""
    return _site_lines(spark, d).report()


def p3_republished(spark: SparkSession, d: str) -> DataFrame:
    """Boilerplate by clusters and dates, of a corpus in which every document was published again three times.

    A line of a document alone stands in four documents, but in one cluster; only lines of at least four clusters
    on at least two days are found.
    """
    chunks = spread(table(spark, d, "kb_chunks").select("chunk_id", "doc_id", "source", "chunk_text", "created_at"))
    again = [chunks.withColumn("chunk_id", F.concat("chunk_id", F.lit(f"#{k}"))).withColumn("doc_id", F.concat("doc_id", F.lit(f"#{k}"))).withColumn("created_at", F.col("created_at") + F.expr(f"INTERVAL {k} DAYS")) for k in (1, 2, 3)]
    for a in again:
        chunks = chunks.unionByName(a)
    return sl.site_lines(chunks, min_clusters=4, min_dates=2).report()


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    out = _site_lines(spark, d).cleaned()
    return out.select("chunk_id", "clean_text", F.col("removed").cast("bigint").alias("removed")).distinct()


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """`file_id, doc_id, source, page_no, block_no, blocks, bbox, content` of every block of content_list_v2."""
    files = table(spark, d, "content_list_v2").select("file_id", "doc_id", "source", F.posexplode("pages").alias("p", "page"))
    blocks = files.select("file_id", "doc_id", "source", "p", F.size("page").alias("blocks"), F.posexplode("page").alias("b", "block"))
    return blocks.select("file_id", "doc_id", "source", (F.col("p") + 1).alias("page_no"), (F.col("b") + 1).alias("block_no"), "blocks", F.col("block.bbox").alias("bbox"), F.col("block.content").alias("content"))


def _block_key():
    return F.concat_ws(":", "file_id", "page_no", "block_no")


def _scanned(spark: SparkSession, d: str) -> sc.Scanned:
    """Texts of both tables with where they stand: page, height of the block on it, first or last block of it."""
    height = lambda bbox, i: F.get(bbox, F.lit(i)).cast("double")
    box = F.col("metadata.block_bbox")
    chunks = table(spark, d, "kb_chunks").select(
        F.lit("kb_chunks").alias("place"), F.col("chunk_id").alias("record_key"), "doc_id", F.col("doc_title").alias("title"), F.col("chunk_text").alias("text"), "page_no", height(box, 1).alias("top"), height(box, 3).alias("bottom"), F.lit(None).cast("int").alias("edge")
    )
    items = F.col("content.paragraph_content")
    text = F.array_join(F.transform(items, lambda i: i["content"]), "")
    edge = (F.col("block_no") == 1).cast("int") + F.when(F.col("block_no") == F.col("blocks"), 2).otherwise(0)
    blocks = _pages(spark, d).where(items.isNotNull()).select(
        F.lit("content_list_v2").alias("place"), _block_key().alias("record_key"), "doc_id", F.lit(None).cast("string").alias("title"), text.alias("text"), "page_no", height(F.col("bbox"), 1).alias("top"), height(F.col("bbox"), 3).alias("bottom"), edge.alias("edge")
    )
    return sc.Scanned(chunks.unionByName(blocks))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _scanned(spark, d).found()


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    return _scanned(spark, d).repaired().distinct()


def _marked_up(spark: SparkSession, d: str) -> mk.Markup:
    chunks = table(spark, d, "kb_chunks").where(~F.col("content_type").eqNullSafe("formula"))
    records = chunks.select(F.lit("kb_chunks").alias("place"), F.col("chunk_id").alias("record_key"), F.col("source").alias("host"), F.col("chunk_text").alias("text"))
    blocks = _pages(spark, d).where("content is not null")
    for field in ("html", "math_content"):
        part = blocks.select(F.lit(field).alias("place"), _block_key().alias("record_key"), F.col("source").alias("host"), F.col(f"content.{field}").alias("text"))
        records = records.unionByName(part.where("text is not null"))
    records = spread(records)
    return mk.Markup(records, mk.wrappers(records))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _marked_up(spark, d).found()


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    return _marked_up(spark, d).cleaned().distinct()


def p5_wrappers(spark: SparkSession, d: str) -> DataFrame:
    """The wrapper of each host and root element, as JSON of (label, quantifier, parts)."""
    return _marked_up(spark, d).wraps


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return enc.encode(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text")


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Whether decoding the ids of every document gives its text back."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return docs.select("doc_id", (enc.text_column(enc.ids_column(F.col("text"))) == F.coalesce("text", F.lit(""))).alias("same"))


def _mixture(spark: SparkSession, d: str) -> mx.Mixture:
    return mx.mix(spread(table(spark, d, "documents").select("doc_id", "source", "text")), table(spark, d, "mix_targets"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).rows()


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).shares()


def p7_reached(spark: SparkSession, d: str) -> DataFrame:
    """For each target source: whether it is present, within its cap, and within half a point, or two slots, of its share among those present."""
    s = cut(_mixture(spark, d).shares())
    # the broadcast side is a single row
    present = F.col("tokens_available") > 0
    whole = s.where(present).agg(F.sum("target_share").alias("whole"), F.sum("slots").alias("all_slots"))
    share = F.when(present, F.col("target_share") / F.col("whole")).otherwise(0.0)
    return s.crossJoin(F.broadcast(whole)).select("source", present.alias("present"), (F.col("most_uses") <= F.col("max_repeats")).alias("within_cap"), (F.abs(F.col("actual_share") - share) <= F.greatest(F.lit(0.005), 2 / F.col("all_slots"))).alias("reached"))


def p7_sized(spark: SparkSession, d: str) -> DataFrame:
    """A mixture as large as all texts together: shares wanted and reached where small sources end at their caps."""
    docs = spread(table(spark, d, "documents").select("doc_id", "source", "text"))
    return mx.mix(docs, table(spark, d, "mix_targets"), total_tokens="all").shares()


def _repetition(spark: SparkSession, d: str) -> DataFrame:
    return rp.repetition(spread(table(spark, d, "documents").select("doc_id", "lang", "source", "text")))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _repetition(spark, d)


def p8_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """The cutoff of each language and source: the 0.95 quantile of its own, its language's or all shares."""
    return rp.cutoffs(cut(_repetition(spark, d)), "run_share", 0.95, 0.0, 1.0)


def p8_heavy(spark: SparkSession, d: str) -> DataFrame:
    """Documents that repeat more than is usual for their language and source (never below a share of 0.1)."""
    shares = cut(_repetition(spark, d))
    return rp.heavy(shares, rp.cutoffs(shares, "run_share", 0.95, 0.1, 1.0)).select("doc_id", "lang", "source", "run_share", "cutoff")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Adaptive cutoffs held to at most 0.3 give the candidates; the stated 0.3 is then checked in integers."""
    shares = cut(_repetition(spark, d))
    near = rp.heavy(shares, rp.cutoffs(shares, "run_share", 0.95, 0.1, 0.3))
    return near.where("repeated_runs * 10 >= runs * 3").select("doc_id").distinct()


def queries() -> dict[str, Query]:
    names = [p2_found, p2_members, p2_groups, p3_found, p3_lines, p3_republished, p3_clean, p4_found, p4_clean, p5_found, p5_clean, p5_wrappers, p6_ids, p6_round_trip, p7_mix, p7_shares, p7_reached, p7_sized, p8_found, p8_shares, p8_cutoffs, p8_heavy]

    def ready(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {f.__name__: ready(f) for f in names}


def oracle_sql() -> dict[str, str]:
    from quire.llm.oracles import SQL

    return dict(SQL)
