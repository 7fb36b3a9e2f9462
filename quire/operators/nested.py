"""Flat tables out of deeply nested records, by Dewey labels.

Every node of a record gets the list of ordinals on the way to it (`dewey`): the 1-based position of
an array element, the 1-based place of a field in its struct.  The label of the parent is the label
without its last ordinal, that of a row above the label cut shorter, so links need neither a join nor a
generated key.  Nodes are grouped by their schema path (`pages[][].content.list_items[]`), one table for each path.

Two inputs give the same node rows:

* typed columns are walked by built-in higher-order functions built from the column's schema
  (one generate, no shuffle, no Python);
* JSON text of drifting shape is decoded in Arrow batches and walked along the same schema.

Defined results: a null record, array, element or field gives no node but keeps its position; an
empty array gives none; an undecodable or null body gives none; in JSON an object or string where
the schema has an array is that array's only element; any other scalar there gives none; fields that
the schema lacks are ignored; columns of the input beyond `key` and `column` are not looked at, so
their names cannot clash; repeated input rows give repeated nodes.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Inline item and the page/block shape a layout parser writes.
INLINE = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("content", T.StringType())]))
CONTENT = T.StructType(
    [
        T.StructField("level", T.IntegerType()),
        T.StructField("title_content", INLINE),
        T.StructField("paragraph_content", INLINE),
        T.StructField("list_items", T.ArrayType(T.StructType([T.StructField("item_type", T.StringType()), T.StructField("item_content", INLINE)]))),
        T.StructField("table_caption", INLINE),
        T.StructField("table_footnote", INLINE),
        T.StructField("html", T.StringType()),
        T.StructField("image_source", T.StructType([T.StructField("path", T.StringType())])),
        T.StructField("image_caption", INLINE),
        T.StructField("image_footnote", INLINE),
        T.StructField("math_content", T.StringType()),
    ]
)
BLOCK = T.StructType([T.StructField("type", T.StringType()), T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("content", CONTENT)])
PAGES = T.ArrayType(T.ArrayType(BLOCK))

_NODE = "struct<schema_path:string,dewey:array<int>,shape:string,value:string>"


def _complex(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType))


def _leads(path: str, wanted: set[str] | None) -> bool:
    return wanted is None or any(w == path or w.startswith(path + ".") or w.startswith(path + "[") for w in wanted)


def _value(col: Column, t: T.DataType) -> Column:
    """The node's own scalars: text of a leaf, JSON of a struct's scalar fields, null for arrays."""
    if isinstance(t, T.StructType):
        flat = [f for f in t.fields if not _complex(f.dataType)]
        return F.to_json(F.struct(*[col[f.name].alias(f.name) for f in flat])) if flat else F.lit(None).cast("string")
    if isinstance(t, T.ArrayType):
        return F.lit(None).cast("string")
    return col.cast("string")


def _shape(t: T.DataType) -> str:
    return "object" if isinstance(t, T.StructType) else "array" if isinstance(t, T.ArrayType) else "scalar"


def _walk(col: Column, t: T.DataType, path: str, dewey: Column, wanted: set[str] | None) -> Column | None:
    """Array of the nodes at and below `col`; None when nothing below is wanted."""
    parts: list[Column] = []
    if wanted is None or path in wanted:
        node = F.struct(F.lit(path).alias("schema_path"), dewey.alias("dewey"), F.lit(_shape(t)).alias("shape"), _value(col, t).alias("value"))
        parts.append(F.when(col.isNotNull(), F.array(node)))
    if isinstance(t, T.ArrayType) and _leads(path + "[]", wanted):

        def each(x: Column, i: Column) -> Column:
            below = _walk(x, t.elementType, path + "[]", F.concat(dewey, F.array(i + 1)), wanted)
            return below if below is not None else F.array().cast(f"array<{_NODE}>")

        parts.append(F.flatten(F.transform(col, each)))
    elif isinstance(t, T.StructType):
        for k, f in enumerate(t.fields, 1):
            p = f"{path}.{f.name}"
            if not _leads(p, wanted) or (wanted is None and not _complex(f.dataType)):
                continue
            below = _walk(col[f.name], f.dataType, p, F.concat(dewey, F.array(F.lit(k))), wanted)
            if below is not None:
                parts.append(below)
    if not parts:
        return None
    empty = F.array().cast(f"array<{_NODE}>")
    return F.concat(*[F.coalesce(p, empty) for p in parts])


def typed_nodes(df: DataFrame, key: str, column: str, wanted: set[str] | None = None) -> DataFrame:
    """Node rows `key, schema_path, dewey, parent, shape, value` of a typed nested column.

    `wanted` names schema paths; branches that lead to none of them are never visited, which lets the
    scan prune nested columns.  Without it every struct and array node comes out, and struct scalars
    travel in `value` as JSON.
    """
    nodes = _walk(F.col("_v"), df.schema[column].dataType, column, F.array().cast("array<int>"), wanted)
    picked = df.select(F.col(key).alias("_k"), F.col(column).alias("_v"))
    if nodes is None:
        nodes = F.array().cast(f"array<{_NODE}>")
    return picked.select(F.col("_k").alias(key), F.inline(nodes)).select(key, "schema_path", "dewey", parent_of(F.col("dewey")).alias("parent"), "shape", "value")


def parent_of(dewey: Column) -> Column:
    """Label of the parent: the label cut by its last ordinal (null at the root)."""
    return F.when(F.size(dewey) > 0, F.slice(dewey, F.lit(1), F.greatest(F.size(dewey) - 1, F.lit(0))))


def _text(v) -> str | None:
    if v is None:
        return None
    s = v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    return s.encode("utf-8", "replace").decode("utf-8")


def _walk_json(v, t: T.DataType, path: str, dewey: list[int], wanted: set[str] | None, out: list) -> None:
    if v is None:
        return
    if isinstance(t, T.ArrayType):
        if not isinstance(v, (list, dict, str)):
            return
        if wanted is None or path in wanted:
            out.append((path, dewey, "array", None))
        if not isinstance(v, list):
            v = [v]
        p = path + "[]"
        if _leads(p, wanted):
            for i, x in enumerate(v, 1):
                _walk_json(x, t.elementType, p, [*dewey, i], wanted, out)
        return
    if isinstance(t, T.StructType):
        here = wanted is None or path in wanted
        if not isinstance(v, dict):
            # an element of any type is a node; a field that should be an object and is not, is none
            if here and path.endswith("[]"):
                out.append((path, dewey, "array" if isinstance(v, list) else "scalar", _text(v)))
            return
        if here:
            flat = {f.name: v[f.name] for f in t.fields if not _complex(f.dataType) and v.get(f.name) is not None}
            out.append((path, dewey, "object", _text(json.dumps(flat, ensure_ascii=False))))
        for k, f in enumerate(t.fields, 1):
            p = f"{path}.{f.name}"
            if f.name in v and _leads(p, wanted) and not (wanted is None and not _complex(f.dataType)):
                _walk_json(v[f.name], f.dataType, p, [*dewey, k], wanted, out)
        return
    if wanted is None or path in wanted:
        out.append((path, dewey, "scalar", _text(v)))


def json_nodes(df: DataFrame, key: str, body: str, shape: T.DataType, root: str, wanted: set[str] | None = None) -> DataFrame:
    """Node rows of JSON text, walked along `shape`; `root` names the top of the schema paths."""
    want = None if wanted is None else set(wanted)

    def run(batches):
        for pdf in batches:
            keys, paths, labels, shapes, values = [], [], [], [], []
            for k, b in zip(pdf["_k"], pdf["_b"]):
                if b is None:
                    continue
                out: list = []
                try:
                    _walk_json(json.loads(b), shape, root, [], want, out)
                except (ValueError, RecursionError):
                    continue
                for p, d, s, v in out:
                    keys.append(k)
                    paths.append(p)
                    labels.append(d)
                    shapes.append(s)
                    values.append(v)
            yield pd.DataFrame({key: pd.Series(keys, dtype=pdf["_k"].dtype), "schema_path": pd.Series(paths, dtype=object), "dewey": pd.Series(labels, dtype=object), "shape": pd.Series(shapes, dtype=object), "value": pd.Series(values, dtype=object)})

    kt = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(key).alias("_k"), F.col(body).alias("_b")).where("_b is not null")
    nodes = picked.mapInPandas(run, f"`{key}` {kt}, schema_path string, dewey array<int>, shape string, value string")
    return nodes.select(key, "schema_path", "dewey", parent_of(F.col("dewey")).alias("parent"), "shape", "value")


def _ordinals(path: str) -> int:
    """Length of the labels of a schema path."""
    return path.count("[]") + path.count(".")


def related(nodes: DataFrame, key: str, tables: dict[str, str]) -> DataFrame:
    """Rows of the named schema paths as related tables: `key, table_name, label, parent_table, parent, position, shape, value`.

    The parent of a row is the row of the nearest named path above it, found by cutting the label to that
    path's length; a row exists only below rows that exist, so every parent is a row of `parent_table` with the
    same key.  Rows of a topmost path have no parent.  `position` is the last ordinal, null at the root.
    """
    above = {n: max((m for m, q in tables.items() if p.startswith((q + ".", q + "["))), key=lambda m: len(tables[m]), default=None) for n, p in tables.items()}
    at = lambda value: F.coalesce(*[F.when(F.col("schema_path") == p, value(n)) for n, p in tables.items()])
    keep = at(lambda n: F.lit(_ordinals(tables[above[n]]) if above[n] else None).cast("int"))
    d = F.col("dewey")
    return nodes.where(F.col("schema_path").isin(*tables.values())).select(
        key,
        at(F.lit).alias("table_name"),
        F.array_join(d, ".").alias("label"),
        at(lambda n: F.lit(above[n]).cast("string")).alias("parent_table"),
        F.array_join(F.slice(d, F.lit(1), keep), ".").alias("parent"),
        F.try_element_at(d, F.lit(-1)).alias("position"),
        "shape",
        "value",
    )


def tables_of(rows: DataFrame, tables: dict[str, str]) -> dict[str, DataFrame]:
    """One table for each name out of the rows of `related`."""
    return {n: rows.where(F.col("table_name") == n).drop("table_name") for n in tables}


# ---- the page/block records of layout parsers -------------------------------------------------

_C = "pages[][].content"
PATHS = {
    "paragraph_content": f"{_C}.paragraph_content[]",
    "list_items": f"{_C}.list_items[]",
    "item_content": f"{_C}.list_items[].item_content[]",
    "image_source": f"{_C}.image_source",
}
#: The related tables of a parsed file, from the file down.
TABLES = {"files": "pages", "pages": "pages[]", "blocks": "pages[][]", "paragraph_items": PATHS["paragraph_content"], "list_items": PATHS["list_items"], "item_contents": PATHS["item_content"], "images": PATHS["image_source"]}


def page_nodes(v2: DataFrame, raw: DataFrame | None, wanted: set[str] | None = None) -> DataFrame:
    """Nodes of parsed files (`pages`) and of files that only exist as JSON (`body`)."""
    typed = typed_nodes(v2, "file_id", "pages", wanted)
    if raw is None:
        return typed
    return typed.unionByName(json_nodes(raw, "file_id", "body", PAGES, "pages", wanted))


def located(nodes: DataFrame) -> DataFrame:
    """Page, block, list-item and item positions read off the labels.

    A label is `[page, block, content, field, ...]`; the ordinals after `field` are the list item and
    the item below it.
    """
    at = lambda i: F.get(F.col("dewey"), F.lit(i))
    field = F.coalesce(*[F.when(F.col("schema_path") == p, F.lit(n)) for n, p in PATHS.items()])
    inner = F.col("schema_path") == PATHS["item_content"]
    listed = F.col("schema_path").isin(PATHS["list_items"], PATHS["item_content"])
    return nodes.where(F.col("schema_path").isin(*PATHS.values())).select(
        "file_id",
        at(0).alias("page_no"),
        at(1).alias("block_no"),
        field.alias("field"),
        F.when(listed, at(4)).otherwise(F.lit(0)).alias("list_no"),
        F.when(inner, at(6)).when(F.col("schema_path") == PATHS["paragraph_content"], at(4)).otherwise(F.lit(0)).alias("item_no"),
    )
