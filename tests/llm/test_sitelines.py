import re

from pyspark.sql import functions as F

from quire.llm import sitelines as S

LEGAL = "This copy is uncontrolled when printed; register 2020"
S_LEGAL = "this copy is uncontrolled when printed; register 0"


def chunks(spark, rows):
    return spark.createDataFrame([(*r, "2020-01-01 00:00:00", "x") for r in rows], "chunk_id string, doc_id string, source string, chunk_text string, created_at string, line string").selectExpr("chunk_id", "doc_id", "source", "chunk_text", "to_timestamp(created_at) as created_at", "line", "'c' as h")


def brute(rows):
    same = lambda x: re.sub(r"\d+", "0", re.sub(r"[ \t]+", " ", x).strip(" \t").lower())
    docs, seen = {}, {}
    for c, d, s, t in rows:
        if s is None or d is None:
            continue
        docs.setdefault(s, set()).add(d)
        for x in (t or "").split("\n"):
            seen.setdefault((s, same(x)), set()).add(d)
    return {(c, i) for c, d, s, t in rows if s and t is not None for i, x in enumerate(t.split("\n"), 1) if sum(ch.isalpha() for ch in x) >= 20 and len(seen.get((s, same(x)), ())) >= 4 and 10 * len(seen[s, same(x)]) >= len(docs[s])}


def test_places_and_cleaning(spark):
    rows = [(f"c{i}", f"d{i}", "a", f"own line number {'xyz'[i % 3] * 12} {i}\n  {LEGAL.upper() if i % 2 else LEGAL[:-4] + str(i)}\n\nshort") for i in range(8)]
    rows += [(f"e{i}", f"f{i}", "b", LEGAL) for i in range(3)] + [("n1", "d1", "a", None), ("n2", "d2", "a", ""), ("n3", None, "a", LEGAL), ("n4", "d9", None, LEGAL), ("c0", "d0", "a", rows[0][3])]
    # one article under ten documents: one cluster, but ten documents
    rows += [(f"r{i}", f"g{i}", "c", "the very same article in every one of these") for i in range(10)]
    s = S.site_lines(chunks(spark, rows))
    got = {(r.chunk_id, r.line_no) for r in s.places().collect()}
    assert got == brute(rows) and ("r3", 1) in got
    found = {(r.source, r.docs, r.clusters) for r in s.found.collect()}
    assert ("c", 10, 1) in found
    clean = {r.chunk_id: (r.clean_text, r.removed) for r in s.cleaned().collect()}
    assert clean["c3"] == ("own line number xxxxxxxxxxxx 3\n\nshort", 1) and clean["n1"] == (None, 0) and clean["n2"] == ("", 0) and clean["r0"] == ("", 1) and clean["n4"] == (LEGAL, 0)
    strict = S.site_lines(chunks(spark, rows), min_clusters=2)
    assert {r.source for r in strict.found.collect()} == {"a"}


def test_clusters_and_dates_tell_republished_from_boilerplate(spark):
    article = "the very same article in every one of these"
    rows = [(f"r{i}", f"g{i}", "c", article) for i in range(10)] + [(f"l{i}", f"h{i}", "c", f"own line {'xyzw'[i] * 3}\n{LEGAL}") for i in range(4)]
    # two texts under one chunk id: documents that differ in the other text only are no copies
    rows += [("m1", "g0", "d", "first text of the chunk"), ("m1", "g0", "d", "second text"), ("m2", "g1", "d", "first text of the chunk"), ("m2", "g1", "d", "other text")]
    dated = chunks(spark, rows).withColumn("created_at", F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, cast(substr(doc_id, 2) as int))"))
    lines = {r.line: (r.docs, r.clusters, r.dates) for r in S.site_lines(dated).report().collect()}
    assert lines[article] == (10, 1, 1) and lines[S_LEGAL] == (4, 4, 4)
    assert {r.line for r in S.site_lines(dated, min_clusters=4).report().collect()} == {S_LEGAL} == {r.line for r in S.site_lines(dated, min_dates=2).report().collect()}
    both = S.site_lines(dated, min_docs=2).lines.where("source = 'd'").collect()
    assert {r.clusters for r in both} == {2}


def test_source_without_dates(spark):
    rows = [(f"c{i}", f"d{i}", "a", f"own line of {i}\n{LEGAL}") for i in range(6)]
    undated = chunks(spark, rows).selectExpr("chunk_id", "doc_id", "source", "chunk_text", "cast(null as timestamp) as created_at")
    s = S.site_lines(undated)
    assert {(r.chunk_id, r.line_no) for r in s.places().collect()} == brute(rows) != set()
    assert {(r.docs, r.dates) for r in s.found.collect()} == {(6, 0)}
    assert {r.clean_text for r in s.cleaned().collect()} == {f"own line of {i}" for i in range(6)}
    assert S.site_lines(undated, min_dates=2).found.count() == 0


def test_empty(spark):
    s = S.site_lines(chunks(spark, [("c", "d", "s", "t")]).limit(0))
    assert s.places().count() == 0 and s.cleaned().count() == 0
