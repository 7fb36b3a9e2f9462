"""Mixing of sources to target weights.

1. Equal texts count once: each distinct non-empty text of the listed sources is kept under its
   smallest (source, id), so that no text can exceed its cap under a second id.
2. The tokens of each source are laid end to end and cut into blocks of `block` tokens; the last block
   of a source may be shorter.  Offsets are prefix sums in two levels (bucket totals, then within a
   bucket); a source has as many buckets as its tokens need, so a bucket is a bounded piece of work.
   Unless given, the block is the largest power of two up to LONGEST of which the smallest quota holds GRAIN.
3. The mixture has N slots.  Without `total_tokens` that is the most for which no source needs more than its
   blocks times its `max_repeats`, so every source reaches its share and the scarcest sets the size.  With
   `total_tokens` it is that size; a source whose share of it exceeds its cap gives all it may, the others
   their shares of the size, and the shares reached are reported.  Quotas are rounded by largest remainders.
   Slots are split evenly over output shards; each shard draws its per-source counts from a multinomial with
   its own seeded generator, in parallel.  Draws scatter about the quotas: a source's slots beyond its quota are
   numbered and handed, in that order, to the sources whose draws fell short, so that the whole meets
   every quota exactly and no cap is ever passed, while shards stay random.
4. The k-th slot of a source is epoch k div blocks, place k mod blocks; the place is sent through the
   source's and epoch's pseudorandom permutation of block numbers (a cycle-walking Feistel network),
   which needs no shuffle and no stored permutation.
5. Slots join blocks on (source, block number).

Defined results: sources without usable text or with a null, zero or negative share or cap get no
slot, are reported with share 0, and the others are scaled up; null and empty texts and null sources take no
part; a source named twice in the targets keeps its first row by (share, cap); empty tables give empty
results.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quire.llm.encode import count_column
from quire.runtime import cut

#: Longest block, blocks that the smallest quota holds at least, and tokens of a bucket.
LONGEST, GRAIN, BUCKET = 2048, 16, 1 << 24


def _usable(docs: DataFrame, targets: DataFrame, path: str | None) -> DataFrame:
    """`source, doc_id, tokens` of each distinct text of a listed source."""
    listed = targets.select("source").where("source is not null").distinct()
    d = docs.select("doc_id", "source", "text").where("source is not null and text is not null and text <> ''")
    d = d.join(listed, "source", "left_semi")
    d = d.select("doc_id", "source", F.xxhash64("text").alias("_h1"), F.md5("text").alias("_h2"), count_column(F.col("text"), path).cast("bigint").alias("tokens"))
    return d.groupBy("_h1", "_h2").agg(F.min(F.struct("source", "doc_id", "tokens")).alias("m")).select("m.*").where("tokens > 0")


def pack(sized: DataFrame, block: int, tokens: dict[str, int], bucket: int = BUCKET) -> DataFrame:
    """Segments `source, block_no, doc_id, start, length`: which tokens of which text lie in which block.

    `start` is the first token within its text.  A text longer than a block spans several.  `tokens` are the
    totals of the sources.
    """
    # one row for each listed source
    parts = sized.sparkSession.createDataFrame([(s, -(-n // bucket)) for s, n in tokens.items()], "source string, parts bigint")
    b = sized.join(F.broadcast(parts), "source").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.col("parts"))).drop("parts")
    totals = b.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
    base = totals.selectExpr("source", "bucket", "sum(n) over (partition by source order by bucket) - n as base")
    inner = b.selectExpr("source", "bucket", "doc_id", "tokens", "sum(tokens) over (partition by source, bucket order by doc_id) - tokens as within")
    at = inner.join(base, ["source", "bucket"]).select("source", "doc_id", "tokens", (F.col("base") + F.col("within")).alias("lo"))
    at = at.withColumn("hi", F.col("lo") + F.col("tokens"))
    first, last = F.expr(f"lo div {block}"), F.expr(f"(hi - 1) div {block}")
    seg = at.withColumn("block_no", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("lo"), F.col("block_no") * block)
    hi = F.least(F.col("hi"), (F.col("block_no") + 1) * block)
    return seg.select("source", "block_no", "doc_id", (lo - F.col("lo")).alias("start"), (hi - lo).alias("length"))


def entries_of(targets: list[dict], tokens: dict[str, int]) -> list[dict]:
    """One entry for each usable source: its share scaled to 1, its tokens and how often they may be used."""
    seen, use = set(), []
    key = lambda t: (t["source"] or "", t["target_share"] is None, t["target_share"] or 0.0, t["max_repeats"] or 0)
    for t in sorted(targets, key=key):
        s = t["source"]
        if s is None or s in seen:
            continue
        seen.add(s)
        if tokens.get(s) and (t["target_share"] or 0) > 0 and (t["max_repeats"] or 0) > 0:
            use.append({"source": s, "share": float(t["target_share"]), "tokens": tokens[s], "repeats": int(t["max_repeats"])})
    whole = sum(u["share"] for u in use)
    for u in use:
        u["share"] /= whole
    return use


def block_for(use: list[dict], total_tokens: int | None) -> int:
    """Length of a block: a power of two up to LONGEST that cuts the smallest quota into GRAIN blocks, 16 at least."""
    if not use:
        return LONGEST
    size = total_tokens or min(int(u["tokens"] * u["repeats"] / u["share"]) for u in use)
    least = min(min(u["tokens"] * u["repeats"], size * u["share"]) for u in use)
    return max(16, min(LONGEST, 1 << (max(1, int(least / GRAIN)).bit_length() - 1)))


def plan(use: list[dict], blocks: dict[str, int], slots: int | None = None) -> int:
    """Number of slots; gives every entry its `blocks`, `cap` and `quota`.  `slots` is the size wanted, if any."""
    for u in use:
        u["blocks"] = blocks[u["source"]]
        u["cap"] = u["blocks"] * u["repeats"]
    total = slots or min((int(u["cap"] / u["share"]) for u in use), default=0)
    for u in use:
        u["quota"] = min(u["cap"], int(total * u["share"]))
    # what rounding down left goes to the largest remainders that have room
    left = total - sum(int(total * u["share"]) for u in use)
    for u in sorted(use, key=lambda u: (u["quota"] - total * u["share"], u["source"])):
        if left > 0 and u["quota"] < u["cap"]:
            u["quota"] += 1
            left -= 1
    return sum(u["quota"] for u in use)


def _draws(spark: SparkSession, use: list[dict], slots: int, shards: int, seed: int) -> DataFrame:
    """`shard, source, slots` drawn from a multinomial in each shard; made in parallel, one row of work a shard."""
    names, shares = [u["source"] for u in use], [u["quota"] / slots for u in use]

    def draw(batches):
        import numpy as np

        for pdf in batches:
            rows = []
            for shard in pdf["id"]:
                size = slots // shards + (shard < slots % shards)
                for s, c in zip(names, np.random.default_rng([seed, int(shard)]).multinomial(size, shares)):
                    if c:
                        rows.append((int(shard), s, int(c)))
            yield pd.DataFrame(rows, columns=["shard", "source", "slots"]).astype({"shard": "int64", "slots": "int64"})

    return spark.range(shards).mapInPandas(draw, "shard bigint, source string, slots bigint")


def permute(place, size, salt):
    """Images of numpy arrays `place` under the permutations of 0..size-1 that `salt` names.

    A four-round Feistel network over the smallest even number of bits that holds `size`; values that
    fall outside go through it again until all are inside, which keeps it a permutation.
    """
    import numpy as np

    x, size, salt = (np.asarray(v).astype(np.uint64) for v in (place, size, salt))
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(float) + 0.5)).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(x))
    out = x.copy()
    with np.errstate(over="ignore"):
        while len(todo):
            v, h, m, z = out[todo], half[todo], mask[todo], salt[todo]
            left, right = v >> h, v & m
            for r in range(4):
                f = (right + z + np.uint64(r) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
                f = (f ^ (f >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ (f >> np.uint64(29)) & m
            out[todo] = left << h | right
            todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


@F.pandas_udf(LongType())
def _permuted(place: pd.Series, size: pd.Series, salt: pd.Series) -> pd.Series:
    return pd.Series(permute(place.to_numpy(), size.to_numpy(), salt.to_numpy()))


class Mixture:
    """`segments` (packed blocks), `slots` (what each slot of each shard holds) and `entries` (the plan)."""

    def __init__(self, segments: DataFrame, slots: DataFrame, entries: list[dict], targets: DataFrame):
        self.segments, self.slots, self.entries, self.targets = segments, slots, entries, targets

    def rows(self) -> DataFrame:
        """`shard, slot, source, epoch, block_no, doc_id, start, length` of every piece of the mixture."""
        return self.slots.join(self.segments, ["source", "block_no"]).select("shard", "slot", "source", "epoch", "block_no", "doc_id", "start", "length")

    def shares(self) -> DataFrame:
        """For each target source: wanted and reached share, tokens, slots, and the most uses of any block."""
        sizes = self.segments.groupBy("source", "block_no").agg(F.sum("length").alias("tokens"))
        use = self.slots.groupBy("source", "block_no").agg(F.count(F.lit(1)).alias("uses"))
        got = (
            sizes.join(use, ["source", "block_no"], "left")
            .groupBy("source")
            .agg(
                F.sum("tokens").alias("tokens_available"),
                F.coalesce(F.sum(F.col("tokens") * F.col("uses")), F.lit(0)).alias("tokens"),
                F.coalesce(F.sum("uses"), F.lit(0)).alias("slots"),
                F.coalesce(F.max("uses"), F.lit(0)).alias("most_uses"),
            )
        )
        t = self.targets.where("source is not null").groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
        j = t.join(got, "source", "left").na.fill(0, ["tokens_available", "tokens", "slots", "most_uses"])
        # the broadcast side is a single row
        return j.crossJoin(F.broadcast(j.agg(F.sum("tokens").alias("_all")))).select(
            "source",
            "target_share",
            F.when(F.col("_all") > 0, F.col("tokens") / F.col("_all")).otherwise(F.lit(0.0)).alias("actual_share"),
            "tokens",
            "tokens_available",
            "slots",
            "most_uses",
            "max_repeats",
        )


def mix(docs: DataFrame, targets: DataFrame, block: int | None = None, slots_per_shard: int = 4096, seed: int = 7, path: str | None = None, total_tokens: int | str | None = None, bucket: int = BUCKET) -> Mixture:
    """Plan the mixture of `docs` (doc_id, source, text) for `targets` (source, target_share, max_repeats).

    `total_tokens` is the size wanted, or "all" for that of all usable texts.  Only the target rows and two
    counts for each listed source reach the driver; both are as long as the list of targets.
    """
    spark = docs.sparkSession
    sized = cut(_usable(docs, targets, path))
    tokens = {r["source"]: r["n"] for r in sized.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    entries = entries_of([r.asDict() for r in targets.select("source", "target_share", "max_repeats").collect()], tokens)
    wanted = sum(tokens.values()) if total_tokens == "all" else total_tokens
    block = block or block_for(entries, wanted)
    segments = cut(pack(sized, block, tokens, bucket))
    total = plan(entries, {s: -(-n // block) for s, n in tokens.items()}, wanted and max(1, wanted // block))
    shards = max(1, math.ceil(total / slots_per_shard))
    if total:
        drawn = cut(_draws(spark, entries, total, shards, seed))
    else:
        drawn = spark.createDataFrame([], "shard bigint, source string, slots bigint")
    got = {r["source"]: r["n"] for r in drawn.groupBy("source").agg(F.sum("slots").alias("n")).collect()}
    # surplus slots of all sources are numbered one after the other; so are the missing ones
    over, moved, missing = 0, [], 0
    rows = []
    for e in entries:
        n = got.get(e["source"], 0)
        rows.append((e["source"], e["blocks"], e["quota"], over))
        over += max(0, n - e["quota"])
        if n < e["quota"]:
            moved.append((missing, missing + e["quota"] - n, e["source"], n, e["blocks"]))
            missing += e["quota"] - n
    size = spark.createDataFrame(rows, "source string, blocks bigint, quota bigint, over bigint")
    short = spark.createDataFrame(moved, "lo bigint, hi bigint, to string, from_k bigint, to_blocks bigint")
    # one row for each shard and listed source
    first = drawn.selectExpr("*", "sum(slots) over (partition by source order by shard) - slots as first", "sum(slots) over (partition by shard order by source) - slots as at")
    k = first.join(F.broadcast(size), "source").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    k = k.select("shard", (F.col("at") + F.col("i")).alias("slot"), "source", "blocks", "quota", (F.col("first") + F.col("i")).alias("k"), "over")
    kept = k.where("k < quota").select("shard", "slot", "source", "blocks", "k")
    # `short` has at most one row for each listed source
    j = k.where("k >= quota").withColumn("j", F.expr("over + k - quota")).join(F.broadcast(short), F.expr("j >= lo and j < hi"))
    slots = kept.unionByName(j.selectExpr("shard", "slot", "to as source", "to_blocks as blocks", "from_k + j - lo as k")).withColumn("epoch", F.expr("k div blocks"))
    slots = slots.withColumn("block_no", _permuted(F.expr("k % blocks"), F.col("blocks"), F.xxhash64("source", "epoch", F.lit(seed))))
    return Mixture(segments, slots.select("shard", "slot", "source", "epoch", "block_no"), entries, targets)
