import json

import pytest

from quire.operators import nested as N

I = {"type": "text", "content": "x"}


def found(spark, typed, bodies):
    v2 = spark.createDataFrame([(i, json.dumps(p) if p is not None else None, "clash") for i, p in enumerate(typed, 1)], "file_id bigint, j string, dewey string").selectExpr("file_id", "dewey", "j as value", f"from_json(j, '{N.PAGES.simpleString()}') as pages")
    raw = spark.createDataFrame([(100 + i, b) for i, b in enumerate(bodies, 1)], "file_id bigint, body string")
    out = N.located(N.page_nodes(v2, raw, set(N.PATHS.values())))
    return {(r.file_id, r.page_no, r.block_no, r.field, r.list_no, r.item_no) for r in out.collect()}


def block(**content):
    return {"type": "b", "content": content}


def test_positions_count_nulls(spark):
    pages = [None, [], [None, block(paragraph_content=[None, I]), block(list_items=[None, {"item_content": [I, None, I]}], image_source={"path": None})]]
    want = {(1, 3, 2, "paragraph_content", 0, 2), (1, 3, 3, "list_items", 2, 0), (1, 3, 3, "item_content", 2, 1), (1, 3, 3, "item_content", 2, 3), (1, 3, 3, "image_source", 0, 0)}
    assert found(spark, [pages, None, []], []) == want
    assert found(spark, [], [json.dumps(pages)]) == {(101, *w[1:]) for w in want}


@pytest.mark.parametrize("content,want", [
    ({"paragraph_content": I}, {("paragraph_content", 0, 1)}), ({"paragraph_content": "text"}, {("paragraph_content", 0, 1)}), ({"paragraph_content": 7}, set()), ({"paragraph_content": [7, "s", [], I]}, {("paragraph_content", 0, i) for i in (1, 2, 3, 4)}),
    ({"list_items": {"item_content": "s"}}, {("list_items", 1, 0), ("item_content", 1, 1)}), ({"list_items": ["s"]}, {("list_items", 1, 0)}), ({"image_source": "p"}, set()), ({"image_source": {}}, {("image_source", 0, 0)}),
    ({}, set()), (None, set()), ("s", set()),
])
def test_drifting_shapes(spark, content, want):
    body = json.dumps([[{"type": "x", "content": content, "extra": [1, {"a": 2}]}]])
    assert {x[3:] for x in found(spark, [], [body])} == want


@pytest.mark.parametrize("body", [None, "", "[[{bad", "null", "7", '"x"', "[" * 100_000, '{"a": 1}'])
def test_bodies_without_rows(spark, body):
    assert found(spark, [], [body]) == set()


def test_parents_are_cut_labels(spark):
    df = spark.createDataFrame([(1, [{"a": [{"b": ["x", None, "y"]}]}])], "k int, v array<struct<a:array<struct<b:array<string>>>>>")
    rows = {(r.schema_path, tuple(r.dewey)): (tuple(r.parent) if r.parent is not None else None, r.value) for r in N.typed_nodes(df, "k", "v").collect()}
    for (_, label), (parent, _) in rows.items():
        assert parent == (label[:-1] if label else None)
    assert rows[("v[].a[].b[]", (1, 1, 1, 1, 3))][1] == "y" and ("v[].a[].b[]", (1, 1, 1, 1, 2)) not in rows


def test_surrogates_and_long_texts(spark):
    body = '[[{"content": {"paragraph_content": ["\\ud800", "' + "z" * 300_000 + '"]}}]]'
    assert len(found(spark, [], [body])) == 2


def test_every_parent_is_a_row(spark):
    pages = [None, [], [None, block(paragraph_content=[None, I]), block(list_items=[None, {"item_content": [I, None]}, "s"], image_source={"path": "p"})]]
    v2 = spark.createDataFrame([(1, json.dumps(pages).replace(', "s"', "")), (2, None), (3, "[]")], "file_id bigint, j string").selectExpr("file_id", f"from_json(j, '{N.PAGES.simpleString()}') as pages")
    raw = spark.createDataFrame([(101, json.dumps(pages)), (102, "7"), (103, "[[{bad"), (104, '{"a": 1}')], "file_id bigint, body string")
    rows = N.related(N.page_nodes(v2, raw, set(N.TABLES.values())), "file_id", N.TABLES).collect()
    keys = {(r.file_id, r.table_name, r.label) for r in rows}
    assert len(keys) == len(rows) and all((r.file_id, r.parent_table, r.parent) in keys for r in rows if r.table_name != "files")
    count = lambda f: {t: sum(r.table_name == t and r.file_id == f for r in rows) for t in N.TABLES}
    assert count(101) == {"files": 1, "pages": 2, "blocks": 2, "paragraph_items": 1, "list_items": 2, "item_contents": 1, "images": 1}
    assert count(1)["item_contents"] == 1 and count(3) == {t: int(t == "files") for t in N.TABLES} and not any(count(2).values()) and not any(count(102).values()) and not any(count(103).values())
    assert count(104)["blocks"] == 1
    assert {t: df.count() for t, df in N.tables_of(N.related(N.page_nodes(v2, raw), "file_id", N.TABLES), N.TABLES).items()} == {t: sum(r.table_name == t for r in rows) for t in N.TABLES}
