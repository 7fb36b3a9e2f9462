"""Near-duplicate texts: set-similarity self-join by adaptive multi-match prefixes.

A text is the set of its runs of `width` words; a pair is similar if the Jaccard similarity of the two
sets reaches num/den.  The join is exact:

* Texts with equal sets form one class (all copies of a text are one member of the join).
* Runs are put into one global order, rare first.  Frequencies come from a counting sketch, sized from the
  input, that every class of a partition feeds once; any order gives right results, a good one few candidates.
* For sizes a, b a similar pair shares at least alpha = ceil(num (a+b) / (num+den)) runs, so for every
  l <= alpha it shares at least l among the first a-alpha+l and b-alpha+l runs.  Each text lengthens its
  prefix by its own l, the one with the least estimated cost: postings touched (from the sketch) plus
  verifications expected, which fall by RATE with every further match required.
* Postings (run, text) meet by run in one shuffle; a meeting counts only if it lies within both prefixes
  at the l of that pair, at positions that leave room for alpha shared runs, and a pair becomes a candidate at
  l or more meetings.
* Runs that the sketch proves unique are never sent.
* Candidates are verified on the texts themselves.

Scale: the sketch grows with the input up to SLOTS_MOST counters, summed in 32 bits and broadcast in a byte each;
beyond that it only prunes less.  Texts are not shuffled to be posted.  A run in more than CELL classes (by the sketch,
which never counts too few) is spread over as many cells of a grid as it takes, so that no cell holds more than about
two parts of CELL and every pair of its classes meets exactly once; meetings are counted by pair with partial
aggregation.  The rarest-first order keeps runs that a third of all texts share out of nearly every prefix.

Defined results: null texts and texts under `min_words` words or without any run take no part; empty
tables give no pairs; repeated rows of an id count once; if one id has several texts the smallest text
is taken; only the named columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.shingle import mix64, overlaps, shingles
from quire.runtime import bounded_join, cut, spread

#: Counters of the sketch (powers of two): at least, and at most (32 MB in all, as they are broadcast).
SLOTS_LEAST, SLOTS_MOST = 1 << 20, 1 << 25
#: Pieces in which sketches travel.
PIECES = 16
#: Longest lengthening of a prefix.
MOST = 8
#: Share of candidates that also have a further match, and cost of verifying one in postings touched.
RATE, VERIFY = 0.05, 200.0
#: Texts of one run that meet in one cell; hotter runs are spread over a grid of cells.
CELL = 4096
#: Byte-identical texts of up to this many ids are written out as all their pairs where stars are asked for.
SPELLED = 64
#: Members of a class that are paired in one cell; larger classes are spread over a grid of cells.
PART = 1024


_FULL = 0xFFFFFFFF


def _scale() -> np.ndarray:
    """The counts that a byte of the broadcast sketch stands for: exact up to 16, then an eighth apart."""
    out = list(range(17))
    while out[-1] < _FULL:
        out.append(out[-1] + max(1, out[-1] >> 3))
    return np.array(out, dtype=np.int64)


SCALE = _scale()


class Sketch:
    """How many classes of texts have a run: never too few, an eighth too many by rounding and more by clashes."""

    def __init__(self, counts: np.ndarray):
        self.codes = np.searchsorted(SCALE, counts).astype(np.uint8)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        return SCALE[self.codes[_slot(h, len(self.codes))]]


def slots_for(df: DataFrame) -> int:
    """Size of the sketch for an input: a counter for every 16 bytes of its files or more, by Spark's estimate."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(SLOTS_LEAST, min(SLOTS_MOST, 1 << (size // 16).bit_length()))


def _slot(h: np.ndarray, slots: int) -> np.ndarray:
    return (mix64(h) & np.uint64(slots - 1)).astype(np.int64)


def _fingerprints(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint for each text's set of runs; 0 where it has none."""
    fp = np.zeros(len(n), dtype=np.uint64)
    has = n > 0
    with np.errstate(over="ignore"):
        if len(h):
            fp[has] = mix64(np.add.reduceat(mix64(h + np.uint64(77)), (np.cumsum(n) - n)[has]))
    return fp


class _Fresh:
    """Tells which texts of a partition are the first of their class."""

    def __init__(self):
        self.done: set = set()

    def __call__(self, fp: np.ndarray, n: np.ndarray) -> np.ndarray:
        fresh = np.zeros(len(n), dtype=bool)
        for i in np.flatnonzero(n):
            if fp[i] not in self.done:
                self.done.add(fp[i])
                fresh[i] = True
        if len(self.done) > 1_000_000:
            self.done.clear()
        return fresh


def profile(df: DataFrame, key: str, text: str, width: int, min_words: int, slots: int | None = None) -> tuple[DataFrame, Sketch]:
    """One pass over the texts: `id, fp, n, same` of each row (materialised) and the counting sketch of all runs.

    `fp` identifies the set of runs (64 bits of sum and product mixing over the set, joined with n), `same` the text.
    """
    slots = slots or slots_for(df)
    step = slots // PIECES

    def run(batches):
        sketch = np.zeros(slots, dtype=np.uint32)
        first = _Fresh()
        for pdf in batches:
            doc, h, n = shingles(pdf["_t"].tolist(), width, min_words)
            ids = pdf["_k"].to_numpy()
            has = n > 0
            fp = _fingerprints(h, n)
            if len(h):
                at, times = np.unique(_slot(h[first(fp, n)[doc]], slots), return_counts=True)
                sketch[at] = np.minimum(sketch[at] + times, _FULL)
            yield pd.DataFrame({"id": ids[has], "fp": fp[has].view(np.int64), "n": n[has].astype(np.int32), "same": pdf["_h"].to_numpy()[has], "piece": np.full(has.sum(), -1, np.int32), "counts": np.full(has.sum(), None, dtype=object)})
        rows = [(i, zlib.compress(sketch[i * step : (i + 1) * step].tobytes(), 1)) for i in range(PIECES) if sketch[i * step : (i + 1) * step].any()]
        yield pd.DataFrame({"id": np.full(len(rows), None, dtype=object), "fp": np.zeros(len(rows), np.int64), "n": np.zeros(len(rows), np.int32), "same": np.zeros(len(rows), np.int64), "piece": np.array([r[0] for r in rows], np.int32), "counts": pd.Series([r[1] for r in rows], dtype=object)})

    kt = df.schema[key].dataType.simpleString()
    src = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.xxhash64(text).alias("_h")).where("_k is not null and _t is not null")
    both = cut(spread(src).mapInPandas(run, f"id {kt}, fp bigint, n int, same bigint, piece int, counts binary"))

    def add(batches):
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            for p, c in zip(pdf["piece"], pdf["counts"]):
                v = np.frombuffer(zlib.decompress(c), dtype=np.uint32).astype(np.int64)
                acc[p] = acc[p] + v if p in acc else v
        yield pd.DataFrame({"piece": np.array(list(acc), np.int32), "counts": pd.Series([np.minimum(v, _FULL).astype(np.uint32).tobytes() for v in acc.values()], dtype=object)})

    # the driver receives PIECES pieces, SLOTS_MOST counters in all at most
    sketch = np.zeros(slots, dtype=np.uint32)
    parts = both.where("piece >= 0").select("piece", "counts").repartition(PIECES, "piece").mapInPandas(add, "piece int, counts binary")
    for r in parts.toLocalIterator():
        sketch[r["piece"] * step : (r["piece"] + 1) * step] = np.frombuffer(r["counts"], dtype=np.uint32)
    return both.where("piece < 0").select("id", "fp", "n", "same"), Sketch(sketch)


def _prefixes(doc, h, n, sketch, num, den):
    """Order each text's runs rare first and choose its l; returns posting arrays within the prefixes.

    Result: indices of texts, runs (in order), positions, and for each text its l.
    """
    count = sketch(h)
    o = np.lexsort((h, count, doc))
    doc, h, count = doc[o], h[o], count[o]
    start = np.cumsum(n) - n
    pos = np.arange(len(h)) - start[doc]
    base = n - (num * n + den - 1) // den  # a prefix at l has base + l runs
    total = np.r_[0, np.cumsum(count - 1)]
    best, ell = np.full(len(n), np.inf), np.ones(len(n), dtype=np.int64)
    for k in range(1, MOST + 1):
        reach = np.minimum(base + k, n)
        touched = (total[start + reach] - total[start]).astype(float)
        cost = touched + VERIFY * touched * RATE ** (k - 1)
        better = cost < best
        best[better], ell[better] = cost[better], k
    keep = (pos < (base + ell)[doc]) & (count > 1)
    return doc[keep], h[keep], pos[keep], ell


#: Layout of `at`: runs of the text, position, whether in a mixed cell, and on which side of it, and l.
_N, _POS, _MIXED, _SIDE, _ELL = 36, 9, 1 << 8, 1 << 7, 127


def _cells(run: np.ndarray, tag: np.ndarray, at: np.ndarray, count: np.ndarray, cell: int = CELL):
    """Keys of postings: a run by itself, or, beyond `cell` classes, a grid of cells that each pair meets in once.

    The classes of a hot run fall into `s` parts by their tag; a posting of part i goes to the cells (i, j) of all
    j, lower part first.  The key of a cell is hashed from run and parts: should two cells share a key, some
    pairs meet once too often and become candidates, which are verified like all others.
    """
    parts = -(-count // cell)
    hot = np.flatnonzero(parts > 1)
    if not len(hot):
        return run, tag, at
    s = parts[hot]
    i = (mix64(tag[hot].astype(np.uint64)) % s.astype(np.uint64)).astype(np.int64)
    who = np.repeat(np.arange(len(hot)), s)
    j = np.arange(len(who)) - np.repeat(np.cumsum(s) - s, s)
    me = i[who]
    with np.errstate(over="ignore"):
        grid = np.minimum(me, j).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.maximum(me, j).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        key = (mix64(run[hot][who].view(np.uint64) + mix64(grid + np.uint64(1))) >> np.uint64(1)).astype(np.int64)
    mark = np.where(me != j, _MIXED, 0) | np.where(me > j, _SIDE, 0)
    cold = parts <= 1
    return np.r_[run[cold], key], np.r_[tag[cold], tag[hot][who]], np.r_[at[cold], at[hot][who] | mark]


def _meet(key: np.ndarray, tag: np.ndarray, at: np.ndarray, num: int, den: int):
    """Meetings `a, b, need` of postings (whole groups of equal keys) that lie within both prefixes."""
    o = np.lexsort((at, tag, key))
    key, tag, at = key[o], tag[o], at[o]
    new = np.r_[True, (key[1:] != key[:-1]) | (tag[1:] != tag[:-1]) | (at[1:] != at[:-1])]
    key, tag, at = key[new], tag[new], at[new]  # copies of a text give equal postings
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    follow = np.repeat(first + size, size) - np.arange(len(key)) - 1
    n, pos, ell, side, mixed = at >> _N, (at >> _POS) & 0x7FFFFFF, at & _ELL, (at & _SIDE) > 0, (at & _MIXED) > 0
    ends = np.cumsum(follow)
    lo = 0
    while lo < len(key):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 2_000_000, side="right")))
        f = follow[lo:hi]
        x = np.repeat(np.arange(lo, hi), f)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(f) - f, f)
        lo = hi
        ok = den * np.minimum(n[x], n[y]) >= num * np.maximum(n[x], n[y])
        ok &= ~mixed[x] | (side[x] != side[y])
        x, y = x[ok], y[ok]
        alpha = (num * (n[x] + n[y]) + num + den - 1) // (num + den)
        need = np.minimum(np.minimum(ell[x], ell[y]), alpha)
        ok = (pos[x] < n[x] - alpha + need) & (pos[y] < n[y] - alpha + need)
        # what comes before and after a shared run in both orders bounds what the two can share at all
        ok &= np.minimum(pos[x], pos[y]) + np.minimum(n[x] - pos[x], n[y] - pos[y]) >= alpha
        yield np.minimum(tag[x[ok]], tag[y[ok]]), np.maximum(tag[x[ok]], tag[y[ok]]), need[ok]


def candidates(rows: DataFrame, key: str, text: str, sketch: Sketch, width: int, min_words: int, num: int, den: int, cell: int = CELL) -> DataFrame:
    """Candidate pairs of tags `a <= b` (a tag is the upper 40 bits of a class's fingerprint).

    Every text of a scan partition is posted once for each class; equal postings of copies in other
    partitions meet in one task, where they are made one.
    """
    held = rows.sparkSession.sparkContext.broadcast(sketch)

    def post(batches):
        first = _Fresh()
        for pdf in batches:
            doc, h, n = shingles(pdf["_t"].tolist(), width, min_words)
            if not len(h):
                continue
            fp = _fingerprints(h, n)
            fresh = first(fp, n)
            keep = fresh[doc]
            doc, h, n = doc[keep], h[keep], np.where(fresh, n, 0)
            d, run, pos, ell = _prefixes(doc, h, n, held.value, num, den)
            at = (n[d] << _N) | (pos << _POS) | ell[d]
            tag = (fp >> np.uint64(24)).astype(np.int64)[d]
            k, t, a = _cells((run >> np.uint64(1)).astype(np.int64), tag, at, held.value(run), cell)
            yield pd.DataFrame({"key": k, "tag": t, "at": a})

    def meet(batches):
        kept: list[np.ndarray] = []
        held_rows = 0

        def out(final: bool):
            nonlocal kept, held_rows
            all_rows = np.concatenate(kept) if kept else np.zeros((0, 3), np.int64)
            cut_at = len(all_rows) if final else int(np.searchsorted(all_rows[:, 0], all_rows[-1, 0]))
            ready, rest = all_rows[:cut_at], all_rows[cut_at:]
            kept, held_rows = ([rest] if len(rest) else []), len(rest)
            if len(ready):
                for a, b, need in _meet(ready[:, 0], ready[:, 1], ready[:, 2], num, den):
                    yield pd.DataFrame({"a": a, "b": b, "need": need.astype(np.int32)})

        for pdf in batches:
            kept.append(pdf[["key", "tag", "at"]].to_numpy())
            held_rows += len(pdf)
            if held_rows >= 200_000:
                yield from out(False)
        yield from out(True)

    src = rows.select(F.col(text).alias("_t")).where(F.col(key).isNotNull() & F.col(text).isNotNull())
    posts = spread(src).mapInPandas(post, "key bigint, tag bigint, at bigint")
    met = posts.repartition("key").sortWithinPartitions("key").mapInPandas(meet, "a bigint, b bigint, need int")
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.min("need").alias("need")).where("met >= need").select("a", "b")


def _verified(pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    def run(batches):
        for pdf in batches:
            both, na, nb = overlaps(pdf["ta"].tolist(), pdf["tb"].tolist(), width)
            union = na + nb - both
            ok = (union > 0) & (both * den >= num * union)
            yield pd.DataFrame({"a": pdf["a"][ok], "b": pdf["b"][ok], "similarity": (both / np.maximum(union, 1))[ok]})

    return pairs.mapInPandas(run, "a bigint, b bigint, similarity double")


class NearDuplicates:
    """`rows` (id, fp, same): class and text of each id, possibly repeated; `pairs` (a, b, similarity): similar classes;
    `texts` (id, text): what was joined, rows possibly repeated."""

    def __init__(self, rows: DataFrame, pairs: DataFrame, texts: DataFrame):
        self.rows, self.pairs, self.texts = rows, pairs, texts

    def members(self) -> DataFrame:
        """`id, fp`, one row for each id."""
        return self.rows.groupBy("id").agg(F.min("fp").alias("fp"))


def one_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """`id, text` of `df` with one text for each id, the smallest; rows may still repeat.

    Only ids and hashes are shuffled; texts are compared only for ids that have several.
    """
    src = df.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    h = F.xxhash64("text")
    several = cut(src.groupBy("id").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("id"))
    if several.isEmpty():
        return src
    least = cut(bounded_join(src, several, "id").groupBy("id").agg(F.min("text").alias("text")))
    return bounded_join(src, several, "id", "left_anti").unionByName(least)


def near_duplicates(df: DataFrame, key: str = "chunk_id", text: str = "chunk_text", width: int = 5, num: int = 4, den: int = 5, min_words: int = 0, cell: int = CELL, slots: int | None = None) -> NearDuplicates:
    """Join all texts of `df` at Jaccard similarity num/den on runs of `width` words."""
    src = one_text(df, key, text)
    rows, sketch = profile(src, "id", "text", width, min_words, slots)
    rows = rows.select("id", "fp", "same")
    cand = cut(candidates(src, "id", "text", sketch, width, min_words, num, den, cell))
    sides = cand.select("a", "b", F.posexplode(F.array("a", "b")).alias("side", "tag"))
    tags = sides.select("tag").distinct()
    tagged = rows.withColumn("tag", F.expr("shiftrightunsigned(fp, 24)"))
    docs = bounded_join(tagged, tags, "tag").groupBy("fp", "tag").agg(F.min("id").alias("id"))
    texts = bounded_join(src, docs, "id").dropDuplicates(["fp"])
    near = sides.join(texts.select("tag", "fp", "text"), "tag")
    # both texts of a pair side by side; equal tags of different classes give several
    left, right = near.where("side = 0").select("a", "b", F.col("fp").alias("fa"), F.col("text").alias("ta")), near.where("side = 1").select("a", "b", F.col("fp").alias("fb"), F.col("text").alias("tb"))
    both = left.join(right, ["a", "b"]).where("fa <> fb and (a <> b or fa < fb)")
    full = both.select(F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b"), "ta", "tb")
    return NearDuplicates(rows, cut(_verified(full, width, num, den)), src)


def spelled_pairs(found: NearDuplicates, spelled: int | None = SPELLED) -> DataFrame:
    """Pairs of ids `id_a < id_b, similarity`: every pair of texts that are similar.

    With `spelled` None all pairs of ids are written.  Else byte-identical texts of more than `spelled` ids
    are a star: their smallest id stands for the others, which are linked to it.  Different texts of a
    class (equal sets, other case, punctuation or line breaks) are written in all pairs either way.
    Classes of more than PART members are paired in a grid of cells.
    """
    many = found.rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    paired = found.pairs.select(F.explode(F.array("a", "b")).alias("fp"))
    # ids of classes that have several rows or a similar class; every other id is alone
    m = cut(bounded_join(found.rows, many.unionByName(paired).distinct(), "fp").distinct())
    star = None
    if spelled is not None:
        copies = m.groupBy("fp", "same").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("rep"))
        m = m.join(copies, ["fp", "same"])
        star = m.where(f"size > {spelled} and id <> rep").select(F.col("rep").alias("id_a"), F.col("id").alias("id_b"), F.lit(1.0).alias("similarity"))
        m = m.where(f"size <= {spelled} or id = rep")
    sized = m.groupBy("fp").agg(F.count(F.lit(1)).alias("size"))
    parts = sized.select("fp", "size", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    m = m.join(parts, "fp").select("fp", "id", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    # cells of every two similar classes, and of each class with itself (lower part first)
    pairs = found.pairs.unionByName(parts.where("size > 1").select(F.col("fp").alias("a"), F.col("fp").alias("b"), F.lit(1.0).alias("similarity")))
    pairs = pairs.join(parts.select(F.col("fp").alias("a"), F.col("parts").alias("na")), "a").join(parts.select(F.col("fp").alias("b"), F.col("parts").alias("nb")), "b")
    cells = pairs.withColumn("pa", F.explode(F.expr("sequence(0, na - 1)"))).withColumn("pb", F.explode(F.expr("sequence(0, nb - 1)"))).where("a <> b or pa <= pb")
    left, right = m.select(F.col("fp").alias("a"), F.col("part").alias("pa"), F.col("id").alias("x")), m.select(F.col("fp").alias("b"), F.col("part").alias("pb"), F.col("id").alias("y"))
    met = cells.join(left, ["a", "pa"]).join(right, ["b", "pb"]).where("a <> b or pa < pb or x < y")
    out = met.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")
    return out if star is None else out.unionByName(star)


def memberships(found: NearDuplicates) -> DataFrame:
    """`id, class_id, text_id`: the smallest id of an equal set of runs and of the same text, for each id of the join."""
    ids = cut(found.rows.select("id", "fp", "same").distinct())
    texts = ids.groupBy("fp", "same").agg(F.min("id").alias("text_id"))
    classes = texts.groupBy("fp").agg(F.min("text_id").alias("class_id"))
    return ids.join(texts.join(classes, "fp"), ["fp", "same"]).select("id", "class_id", "text_id")


def groups(found: NearDuplicates) -> DataFrame:
    """`id, group_id, links`: the connected component of each id and its number of similar partners.

    `group_id` is the smallest id of the component; `links` counts other ids of the same class and all
    ids of similar classes.  Components come from alternating large-star and small-star rounds on class
    pairs until nothing changes; every round is checkpointed.  ids without partners form groups of one.
    """
    edges = found.pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = cut(edges.distinct())
    before = None
    while True:
        # large-star: larger neighbours of each node point to the node's smallest neighbour
        sym = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sym.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: smaller neighbours and the node itself point to the smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = cut(small)
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.hash("u", "v").cast("bigint")), F.lit(0))).first()
        if now == before:
            break
        before = now
    root = edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    members = cut(found.members())
    sized = members.groupBy("fp").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first"))
    both = found.pairs.select("a", "b").unionByName(found.pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    out = both.join(sized.select(F.col("fp").alias("b"), "size"), "b").groupBy(F.col("a").alias("fp")).agg(F.sum("size").alias("others"))
    cls = sized.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp")).join(out, "fp", "left")
    name = cls.groupBy("root").agg(F.min("first").alias("group_id"))
    cls = cls.join(name, "root").select("fp", "group_id", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    return members.join(cls, "fp").select("id", "group_id", "links")


def all_groups(found: NearDuplicates, df: DataFrame, key: str = "chunk_id") -> DataFrame:
    """`id, group_id, links` of every id of `df`: `groups`, and the ids that take no part in the join.

    Texts without a run (too few words) are grouped where they are equal; null, empty and blank texts are
    groups of one.
    """
    named = groups(found)
    ids = df.select(F.col(key).alias("id")).where("id is not null").distinct()
    # blank texts have no hash
    hashes = found.texts.where(F.col("text").rlike(r"(?U)\S")).select("id", F.xxhash64("text").alias("h"), F.length("text").alias("len")).distinct()
    rest = cut(ids.join(found.rows.select("id").distinct(), "id", "left_anti").join(hashes, "id", "left"))
    copies = rest.where("h is not null").groupBy("h", "len").agg(F.min("id").alias("group_id"), (F.count(F.lit(1)) - 1).alias("links")).where("links > 0")
    rest = rest.join(copies, ["h", "len"], "left").select("id", F.coalesce("group_id", "id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
    return named.unionByName(rest)
