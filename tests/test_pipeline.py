import json
import random

import golden
import pytest

from quire.operators.nested import PAGES
from quire.options import Options
from quire.plans.pipeline import pack


def files(spark, *docs):
    return spark.createDataFrame([(i, f"doc{i}", json.dumps(p) if p is not None else None) for i, p in enumerate(docs, 1)], "file_id bigint, doc_id string, j string").selectExpr("file_id", "doc_id", f"from_json(j, '{PAGES.simpleString()}') as pages", "'x' as key", "'clash' as block_index")


def para(s):
    return {"type": "paragraph", "content": {"paragraph_content": golden.t(s)}}


def test_golden_document(spark):
    listing = spark.createDataFrame([(1, p) for p in golden.IMAGES], "key bigint, path string")
    p = pack(files(spark, golden.PAGES), listing)
    rows = {r.chunk_id: r for r in p.minimal().collect()}
    want = {f"doc1:p{c[1]}:{c[0]}:{i}": c for i, c in enumerate(golden.CHUNKS, 1)}
    assert set(rows) == set(want)
    for k, (kind, page, section, text, image) in want.items():
        r = rows[k]
        assert (r.content_type, r.page_no, r.section_title, r.chunk_text, r.image_path) == (kind, page, section, text, image)
    s = p.stats.first().asDict()
    assert {k: s[k] for k in golden.STATS} == golden.STATS
    cats = {}
    for e in p.events.collect():
        cats[e.category] = cats.get(e.category, 0) + 1
    assert cats == {"skipped_blocks": 7, "missing_images": 1, "unsupported_blocks": 1, "parse_errors": 1}


def test_empty_null_and_odd_documents(spark):
    odd = [[None, {"type": None, "content": None}, {"type": "title", "content": {"level": 0, "title_content": golden.t("Zero")}}], None, [], [para("a text that is long enough")]]
    p = pack(files(spark, None, [], odd))
    chunks = p.chunks.collect()
    assert [(c.key, c.page_no, c.section_title) for c in chunks] == [(3, 4, "Zero")]
    assert {s.key: s.total_chunks for s in p.stats.collect()} == {1: 0, 2: 0, 3: 1}
    assert sorted(e.category for e in p.events.collect() if e.category != "skipped_blocks") == ["parse_errors", "unsupported_blocks", "unsupported_blocks"]


def test_empty_table(spark):
    p = pack(files(spark, []).limit(0))
    assert p.chunks.count() == 0 and p.events.count() == 0 and p.stats.count() == 0


def test_affixes_are_cut_and_emptied_texts_stay(spark):
    head = "A header line that is repeated on every page 12345"
    table = {"type": "table", "content": {"html": "<tr><td>a</td></tr>", "table_caption": golden.t("A caption long enough")}}
    doc = [[x for i in range(4) for x in (para(head + f" and body number {'abcd'[i] * 30}"), table)]]
    same = [[x for _ in range(4) for x in (para("the very same thirty characters"), table)]]
    p = pack(files(spark, doc, same))
    texts = {}
    for c in p.chunks.where("content_type = 'text'").orderBy("seq").collect():
        texts.setdefault(c.key, []).append(c.chunk_text)
    assert texts[1] == [f"and body number {'abcd'[i] * 30}" for i in range(4)]
    assert texts[2] == [""] * 4
    strict = pack(files(spark, doc, same), opts=Options(strict=True))
    assert strict.chunks.where("content_type = 'text' and key = 2").count() == 0


def test_section_depths_match_a_stack(spark):
    from quire.operators.sections import explode_blocks, sectioned

    rng = random.Random(4)
    docs, want = [], []
    for d in range(13):
        # the last document nests forty titles
        titles = [(rng.randint(1, 5), f"t{k}") for k in range(rng.randint(1, 25))] if d < 12 else [(k + 1, f"t{k}") for k in range(40)]
        docs.append([[{"type": "title", "content": {"level": lv, "title_content": golden.t(s)}} for lv, s in titles]])
        want.append(golden.stack_paths(titles))
    f = files(spark, *docs)
    rows = sectioned(f).orderBy("key", "block_index").collect()
    plain = explode_blocks(f).select("key", "page_no", "block_idx", "block_index", "block_id")
    assert sorted(map(tuple, plain.collect())) == sorted((r.key, r.page_no, r.block_idx, r.block_index, r.block_id) for r in rows)
    got = {}
    for r in rows:
        got.setdefault(r.key, []).append(list(r.section_path))
    assert [got[i] for i in range(1, 14)] == want


@pytest.mark.parametrize("caption,nearby,section,kind", [
    ("Top View", "x" * 40, "s", "subfigure"), ("", "see Figure 3 for all of the details", "s", "weak"), ("Fig 1", "s", "s", "formal"),
    ("A caption", "x" * 50, "s", "formal"), ("", "s", "s", "weak"), ("A caption", "s", "s", "weak"), ("A caption of some greater length", "s", "s", "formal"),
])
def test_figure_classes(spark, caption, nearby, section, kind):
    from pyspark.sql import functions as F

    from quire.operators.figures import figure_class

    text = "\n".join([*([f"Figure: {caption}"] if caption else []), *([f"Context: {nearby}"] if nearby else [])])
    df = spark.createDataFrame([(caption, nearby, section, text)], "c string, n string, s string, t string")
    assert df.select(figure_class(F.col("c"), F.col("n"), F.col("s"), F.col("t"))).first()[0] == kind


def test_oversized_table(spark):
    rows = "".join(f"<tr><td>row{i}</td><td>{'y' * 900}</td></tr>" for i in range(10))
    big = {"type": "table", "content": {"html": f"<tr><td>a</td><td>b</td></tr>{rows}<tr><td>{'z' * 5000}</td></tr>", "table_caption": golden.t("Cap $1 (Part 1/1)"), "table_footnote": golden.t("foot")}}
    p = pack(files(spark, [[big]]))
    parts = [c.chunk_text for c in p.chunks.orderBy("seq").collect()]
    n = len(parts)
    assert n > 2 and all(x.startswith(f"Table: Cap $1 (Part {i}/{n}) (Part {i}/{n})\nColumns: a | b\n") for i, x in enumerate(parts, 1))
    assert [x.endswith("Note: foot") for x in parts] == [False] * (n - 1) + [True]
    assert p.stats.first().oversized_table_chunks == 1
    assert sum(x.count("\nRow ") for x in parts) == 11
