import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import mix as M
from quire.llm import repeat as R
from quire.llm.shingle import WORD


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000])
def test_permutation(n):
    a, b = (M.permute(np.arange(n), np.full(n, n), np.full(n, s)).tolist() for s in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n)) and (n < 5 or a != b)


def docs(spark):
    rng = random.Random(2)
    rows = [(i, s, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(5, 90)))) for i, s in enumerate(["big"] * 200 + ["mid"] * 40 + ["small"] * 6)]
    rows += [(900, "small", rows[-1][2]), (901, None, "no source"), (902, "big", None), (903, "big", ""), (904, "unlisted", "some text")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, source string, text string")


def test_shares_caps_and_repeats(spark):
    rows, df = docs(spark)
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.15, 3), ("absent", 0.05, 4)], "source string, target_share double, max_repeats int")
    m = M.mix(df, targets, block=8, slots_per_shard=50)
    s = {r.source: r for r in m.shares().collect()}
    assert set(s) == {"big", "mid", "small", "absent"} and s["absent"].actual_share == 0
    for k, want in (("big", 0.5 / 0.95), ("mid", 0.3 / 0.95), ("small", 0.15 / 0.95)):
        assert abs(s[k].actual_share - want) < 0.03
        assert s[k].most_uses <= s[k].max_repeats
    pieces = m.rows().collect()
    text = {i: t for i, _, t in rows}
    used = {}
    for p in pieces:
        for k in range(p.start, p.start + p.length):
            used[text[p.doc_id], k] = used.get((text[p.doc_id], k), 0) + 1
    limit = {"big": 1, "mid": 2, "small": 3}
    source = {t: s for _, s, t in rows}
    assert all(n <= limit[source[t]] for (t, _), n in used.items())
    slots = {(p.shard, p.slot) for p in pieces}
    assert len(slots) == sum(r.slots for r in s.values()) and len({p.shard for p in pieces}) > 1


def test_given_size_reports_what_small_sources_miss(spark):
    rows, df = docs(spark)
    targets = spark.createDataFrame([("big", 0.4, 1), ("mid", 0.3, 2), ("small", 0.3, 2)], "source string, target_share double, max_repeats int")
    m = M.mix(df, targets, block=8, slots_per_shard=50, total_tokens=6000, bucket=200)
    s = {r.source: r for r in m.shares().collect()}
    whole = sum(r.tokens for r in s.values())
    assert s["small"].slots == 2 * -(-s["small"].tokens_available // 8) and s["small"].most_uses == 2 and s["small"].actual_share < 0.2
    assert abs(s["big"].tokens - 0.4 * 6000) < 60 and abs(s["mid"].tokens - 0.3 * 6000) < 60 and s["mid"].most_uses <= 2
    assert abs(sum(r.actual_share for r in s.values()) - 1) < 1e-9 and whole < 6000
    # blocks tile each source whatever the buckets
    for source in s:
        got = m.segments.where(f"source = '{source}'").groupBy("block_no").agg({"length": "sum"}).collect()
        assert sorted(r[0] for r in got) == list(range(len(got))) and all(r[1] == 8 for r in got if r[0] < len(got) - 1)


def test_block_follows_the_smallest_quota():
    use = M.entries_of([{"source": "a", "target_share": 0.9, "max_repeats": 1}, {"source": "b", "target_share": 0.1, "max_repeats": 2}], {"a": 10**9, "b": 10**6})
    assert M.block_for(use, None) == M.LONGEST and M.block_for(use, 100_000) == 512 and M.block_for(use, 100) == 16 and M.block_for([], None) == M.LONGEST


def test_mix_without_anything(spark):
    rows, df = docs(spark)
    targets = spark.createDataFrame([("absent", 1.0, 1), (None, 0.5, 1), ("big", 0.0, 1), ("mid", None, None)], "source string, target_share double, max_repeats int")
    m = M.mix(df, targets)
    assert m.rows().count() == 0 and {r.actual_share for r in m.shares().collect()} == {0.0}
    assert M.mix(df.limit(0), targets.limit(0)).shares().count() == 0


TEXTS = [None, "", "   ", "one two", "a b c d e f " * 10, " ".join(map(str, range(50))), "x y z\nx y z\nx y z. x y z.", "日本 語 " * 30, "w " * 20_000]


def test_repetition_matches_brute_force(spark):
    df = spark.createDataFrame([(i, t, "en", None) for i, t in enumerate(TEXTS)], "doc_id int, text string, lang string, source string")
    for r in R.repetition(df).collect():
        w = WORD.findall((TEXTS[r.doc_id] or "").lower())
        runs = [tuple(w[k : k + 6]) for k in range(len(w) - 5)]
        assert (r.words, r.runs, r.repeated_runs) == (len(w), len(runs), len(runs) - len(set(runs)))
        assert 0 <= r.line_share <= 1 and 0 <= r.sentence_share <= 1


def test_cutoffs_and_heavy(spark):
    rows = [(i, f"t{i}", "en", "a", i / 1000) for i in range(1000)] + [(2000 + i, "t", None, None, 0.9) for i in range(3)]
    s = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, run_share double").selectExpr("*", "100L as words")
    c = {(r.lang, r.source): r.cutoff for r in R.cutoffs(s, "run_share", 0.95, 0.0, 1.0).collect()}
    assert abs(c["en", "a"] - 0.95) < 0.02 and (None, None) in c
    # a small group is drawn towards the corpus, and its own documents count
    assert 0.9 < c[None, None] < 0.97
    low = s.unionByName(s.limit(0)).withColumn("run_share", F.when(F.col("lang").isNull(), 0.2).otherwise(F.col("run_share")))
    assert R.cutoffs(low, "run_share", 0.95, 0.0, 1.0).where("lang is null").first().cutoff < c[None, None] - 0.05
    got = {r.doc_id for r in R.heavy(s, R.cutoffs(s, "run_share", 0.95, 0.1, 0.3)).collect()}
    assert got == {r[0] for r in rows if r[4] >= 0.3}
    assert R.heavy(s.limit(0), R.cutoffs(s.limit(0), "run_share", 0.95, 0.1, 0.3)).count() == 0
