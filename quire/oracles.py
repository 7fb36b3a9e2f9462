"""DuckDB equivalents of the core queries."""

SQL: dict[str, str] = {}

# Both content tables as rows of one block each: (file_id, page_no, block_no, content as JSON).
_BLOCKS = """
WITH p AS (
  SELECT file_id, to_json(pages) AS j FROM content_list_v2 WHERE pages IS NOT NULL
  UNION ALL
  SELECT file_id, CAST(body AS JSON) AS j FROM content_list_raw WHERE json_valid(body)
),
a AS (SELECT file_id, unnest(CAST(j AS JSON[])) AS page, generate_subscripts(CAST(j AS JSON[]), 1) AS page_no FROM p WHERE json_type(j) = 'ARRAY'),
b AS (SELECT file_id, page_no, unnest(CAST(page AS JSON[])) AS block, generate_subscripts(CAST(page AS JSON[]), 1) AS block_no FROM a WHERE json_type(page) = 'ARRAY'),
c AS (SELECT file_id, page_no, block_no, json_extract(block, '$.content') AS content FROM b WHERE json_type(block) = 'OBJECT')
"""


def _list(column: str) -> str:
    """An array as it is; an object or string as the only element of one; anything else as none."""
    return f"CASE json_type({column}) WHEN 'ARRAY' THEN CAST({column} AS JSON[]) WHEN 'OBJECT' THEN [{column}] WHEN 'VARCHAR' THEN [{column}] END"


SQL["p1_found"] = f"""{_BLOCKS},
para AS (SELECT file_id, page_no, block_no, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM (SELECT *, {_list("json_extract(content, '$.paragraph_content')")} AS l FROM c)),
item AS (SELECT file_id, page_no, block_no, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM (SELECT *, {_list("json_extract(content, '$.list_items')")} AS l FROM c)),
inner_item AS (SELECT file_id, page_no, block_no, i, unnest(l) AS e, generate_subscripts(l, 1) AS k
  FROM (SELECT file_id, page_no, block_no, i, {_list("json_extract(e, '$.item_content')")} AS l FROM item WHERE json_type(e) = 'OBJECT')),
r AS (
  SELECT file_id, page_no, block_no, 'paragraph_content' AS field, 0 AS list_no, i AS item_no FROM para WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT file_id, page_no, block_no, 'list_items', i, 0 FROM item WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT file_id, page_no, block_no, 'item_content', i, k FROM inner_item WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT file_id, page_no, block_no, 'image_source', 0, 0 FROM c WHERE json_type(json_extract(content, '$.image_source')) = 'OBJECT'
)
SELECT DISTINCT file_id, CAST(page_no AS INTEGER) AS page_no, CAST(block_no AS INTEGER) AS block_no, field, CAST(list_no AS INTEGER) AS list_no, CAST(item_no AS INTEGER) AS item_no FROM r
"""

# ---- shared pieces -----------------------------------------------------------------------------

_WS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _clean(x: str) -> str:
    x = f"regexp_replace({x}, ' +', ' ', 'g')"
    x = rf"regexp_replace({x}, '\n[{_WS}]*\p{{Nd}}+[{_WS}]*\n', chr(10), 'g')"
    x = rf"regexp_replace({x}, '\n[{_WS}]*\n[{_WS}]*\n+', chr(10) || chr(10), 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    x = rf"regexp_replace({x}, '(?i)www\.[a-zA-Z0-9.-]+\.(com|cn|net|org)', '', 'g')"
    x = rf"regexp_replace({x}, '(?i)Copyright[{_WS}]*©?[{_WS}]*\p{{Nd}}{{4}}.*', '', 'g')"
    x = rf"regexp_replace({x}, '(?i)All[{_WS}]+rights[{_WS}]+reserved', '', 'g')"
    return _strip(x)


def _title(x: str) -> str:
    return f"regexp_replace({_strip(x)}, '[{_WS}]+', ' ', 'g')"


def _inline(x: str) -> str:
    return f"coalesce(array_to_string(list_transform(list_filter({x}, lambda i: i.type IN ('text', 'equation_inline')), lambda i: coalesce(i.content, '')), ''), '')"


def _list_text(x: str) -> str:
    inner = _inline("j.item_content")
    return f"coalesce(array_to_string(list_filter(list_transform(list_filter({x}, lambda j: j.item_type = 'text'), lambda j: {inner}), lambda t: t <> ''), chr(10)), '')"


_SKIP = rf"(?:contents[{_WS}]*$|table of contents[{_WS}]*$|list of figures[{_WS}]*$|list of tables[{_WS}]*$|rev\.[{_WS}]*[\p{{L}}\p{{N}}_]+|revision[{_WS}]*history[{_WS}]*$|document[{_WS}]*history[{_WS}]*$|change[{_WS}]*history[{_WS}]*$)"


def _skips(x: str) -> str:
    return f"coalesce(regexp_matches(lower({_title(x)}), '^[{_WS}]*{_SKIP}'), false)"


_B = """
pg AS (SELECT file_id, doc_id, unnest(pages) AS page, generate_subscripts(pages, 1) AS page_no FROM content_list_v2),
bl AS (SELECT file_id, doc_id, page_no, unnest(page) AS block, generate_subscripts(page, 1) - 1 AS block_idx FROM pg),
b AS (SELECT file_id, doc_id, CAST(page_no AS INTEGER) AS page_no, CAST(block_idx AS INTEGER) AS block_idx,
  row_number() OVER (PARTITION BY file_id ORDER BY page_no, block_idx) AS block_index, block.type AS type, block.content AS content FROM bl),
bi AS (SELECT *, 'p' || page_no || '_b' || block_index AS block_id FROM b)
"""

_S = f"""
{_B},
t0 AS (SELECT *, coalesce(type = 'title', false) AS is_title, greatest(coalesce(content.level, 1), 1) AS lvl, {_inline("content.title_content")} AS title FROM bi),
t1 AS (SELECT *, coalesce(sum(is_title::int) OVER (PARTITION BY file_id ORDER BY block_index), 0) AS k FROM t0),
stack AS (
  SELECT file_id, CAST(0 AS HUGEINT) AS k, CAST([] AS VARCHAR[]) AS path, false AS skip FROM (SELECT DISTINCT file_id FROM bi)
  UNION ALL
  SELECT t.file_id, t.k, list_concat(stack.path[1:t.lvl - 1], [t.title]), {_skips("t.title")} FROM stack JOIN (SELECT * FROM t1 WHERE is_title) t ON t.file_id = stack.file_id AND t.k = stack.k + 1
),
s AS (SELECT t1.*, len(stack.path) AS depth, array_to_string(stack.path, ' > ') AS section_title, stack.skip,
  CASE WHEN is_title THEN 'title'
       WHEN type IN ('page_header', 'page_footer', 'page_number', 'header', 'footer', 'page_aside_text') THEN 'noise'
       WHEN stack.skip AND type IN ('paragraph', 'list', 'table') THEN 'low_value'
       WHEN type IN ('paragraph', 'list') THEN 'text' WHEN type = 'table' THEN 'table' WHEN type = 'image' THEN 'image'
       WHEN type = 'equation_interline' THEN 'formula' ELSE 'unsupported' END AS route FROM t1 JOIN stack ON stack.file_id = t1.file_id AND stack.k = t1.k)
"""

# ---- nested records ----------------------------------------------------------------------------

_KIDS = f"""{_BLOCKS},
item AS (SELECT file_id, page_no, block_no, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM (SELECT *, {_list("json_extract(content, '$.list_items')")} AS l FROM c)),
kid AS (SELECT file_id, page_no, block_no, i, e, {_list("json_extract(e, '$.item_content')")} AS l FROM item WHERE json_type(e) <> 'NULL')
"""
SQL["p1_children"] = f"""{_KIDS}
SELECT file_id, CAST(page_no AS INTEGER) AS page_no, CAST(block_no AS INTEGER) AS block_no, CAST(i AS INTEGER) AS list_no,
  CAST(CASE WHEN json_type(e) = 'OBJECT' THEN coalesce(len(list_filter(l, lambda x: json_type(x) <> 'NULL')), 0) ELSE 0 END AS BIGINT) AS contents FROM kid
"""

_DEEP = f"""
WITH p AS (
  SELECT file_id, to_json(pages) AS j FROM content_list_v2 WHERE pages IS NOT NULL
  UNION ALL SELECT file_id, CAST(body AS JSON) AS j FROM content_list_raw WHERE json_valid(body)
),
f AS (SELECT file_id, {_list("j")} AS l FROM p),
a AS (SELECT file_id, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM f),
al AS (SELECT *, {_list("e")} AS l FROM a),
b AS (SELECT file_id, i AS p, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM al),
c AS (SELECT *, json_extract(CASE WHEN json_type(e) = 'OBJECT' THEN e END, '$.content') AS c FROM b),
para AS (SELECT file_id, p, b, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM (SELECT file_id, p, i AS b, {_list("json_extract(c, '$.paragraph_content')")} AS l FROM c)),
item AS (SELECT file_id, p, b, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM (SELECT file_id, p, i AS b, {_list("json_extract(c, '$.list_items')")} AS l FROM c)),
inn AS (SELECT file_id, p, b, k, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM (SELECT file_id, p, b, i AS k, {_list("json_extract(CASE WHEN json_type(e) = 'OBJECT' THEN e END, '$.item_content')")} AS l FROM item))
"""


def _scalars(kind: str, text: str) -> str:
    """Kind and text of an element `e`: fields of an object, or the element itself."""
    return f"CASE WHEN json_type(e) = 'OBJECT' THEN {kind} END, CASE WHEN json_type(e) = 'OBJECT' THEN {text} ELSE json_extract_string(e, '$') END"


_TC = _scalars("json_extract_string(e, '$.type')", "json_extract_string(e, '$.content')")
SQL["p1_tables"] = f"""{_DEEP},
r(table_name, file_id, label, parent_table, parent, position, kind, text) AS (
  SELECT 'files', file_id, '', NULL, NULL, NULL, NULL, NULL FROM f WHERE l IS NOT NULL
  UNION ALL SELECT 'pages', file_id, i::VARCHAR, 'files', '', i, NULL, NULL FROM al WHERE l IS NOT NULL
  UNION ALL SELECT 'blocks', file_id, concat_ws('.', p, i), 'pages', p::VARCHAR, i, {_scalars("json_extract_string(e, '$.type')", "NULL")} FROM b WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT 'paragraph_items', file_id, concat_ws('.', p, b, 3, 3, i), 'blocks', concat_ws('.', p, b), i, {_TC} FROM para WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT 'list_items', file_id, concat_ws('.', p, b, 3, 4, i), 'blocks', concat_ws('.', p, b), i, {_scalars("json_extract_string(e, '$.item_type')", "NULL")} FROM item WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT 'item_contents', file_id, concat_ws('.', p, b, 3, 4, k, 2, i), 'list_items', concat_ws('.', p, b, 3, 4, k), i, {_TC} FROM inn WHERE json_type(e) <> 'NULL'
  UNION ALL SELECT 'images', file_id, concat_ws('.', p, i, 3, 8), 'blocks', concat_ws('.', p, i), 8, NULL, json_extract_string(c, '$.image_source.path') FROM c WHERE json_type(json_extract(c, '$.image_source')) = 'OBJECT'
)
SELECT table_name, file_id, label, parent_table, parent, CAST(position AS INTEGER) AS position, kind, text FROM r"""

# ---- sources and identity ----------------------------------------------------------------------

_UUID = "-[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}$"
_DT = rf"regexp_replace(regexp_replace(dir_name, '{_UUID}', ''), '\.pdf$', '')"
SQL["doc_identity"] = f"SELECT file_id, {_DT} || '_' || substring(md5(dir_name), 1, 8) AS made_id, {_DT} AS made_title FROM content_list_v2"
_LISTED = """
m AS (SELECT DISTINCT unnest(map_entries(input_files_all)) AS e FROM kb_manifest),
n AS (SELECT e.key AS role, e.value AS path, regexp_extract(e.value, '([^/]+)/[^/]+$', 1) AS dirname FROM m WHERE e.value IS NOT NULL),
r AS (SELECT dirname, role, CASE role WHEN 'layout' THEN replace(path, 'layout.json', 'x_layout.json') ELSE path END AS path FROM n)
"""
SQL["discovered_files"] = f"""WITH {_LISTED},
v AS (SELECT DISTINCT dirname FROM r WHERE role = 'content_list_v2')
SELECT r.dirname, role, path, role <> 'content_list' OR v.dirname IS NULL AS used FROM r LEFT JOIN v ON v.dirname = r.dirname"""
SQL["content_choice"] = f"""WITH {_LISTED}
SELECT dirname, p AS path, CASE WHEN p IS NULL THEN 'no content list' END AS error
FROM (SELECT dirname, coalesce(max(path) FILTER (WHERE role = 'content_list_v2'), max(path) FILTER (WHERE role = 'content_list')) AS p FROM r GROUP BY 1)"""
_RAWJ = "(SELECT file_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM content_list_raw)"
SQL["loaded_pages"] = f"""SELECT file_id, CASE WHEN json_type(j) = 'ARRAY' THEN CAST(json_array_length(j) AS INTEGER) END AS pages,
  CASE WHEN json_type(j) = 'ARRAY' THEN CAST(coalesce(list_sum(list_transform(CAST(j AS JSON[]), lambda x: CASE WHEN json_type(x) = 'ARRAY' THEN json_array_length(x) ELSE 0 END)), 0) AS INTEGER) END AS blocks FROM {_RAWJ}"""
SQL["load_errors"] = f"SELECT file_id, 'parse_errors' AS category, 'content list is not decodable' AS error FROM {_RAWJ} WHERE coalesce(json_type(j), '') <> 'ARRAY'"
SQL["shared_titles"] = f"SELECT {_DT} AS doc_title, count(DISTINCT file_id) AS docs FROM content_list_v2 WHERE dir_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT file_id) > 1"
_REL = "CASE WHEN starts_with(replace(coalesce({0}, ''), '\\', '/'), 'raw/') THEN substring(replace({0}, '\\', '/'), 5) ELSE replace(coalesce({0}, ''), '\\', '/') END"
SQL["relative_paths"] = f"SELECT doc_id, {_REL.format('source_pdf')} AS pdf, {_REL.format('source_dir')} AS dir FROM kb_manifest"

# ---- blocks, sections, routes --------------------------------------------------------------------

SQL["block_ids"] = f"WITH {_B} SELECT file_id, page_no, block_idx, block_index, block_id, type FROM bi"
SQL["inline_texts"] = f"""WITH {_B} SELECT file_id, block_id, {_inline("content.title_content")} AS title, {_inline("content.paragraph_content")} AS paragraph,
  {_list_text("content.list_items")} AS list, {_inline("content.image_caption")} AS caption FROM bi"""
SQL["clean_texts"] = f"""WITH a AS (SELECT DISTINCT chunk_id AS id, chunk_text AS t FROM kb_chunks UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents)
SELECT id, {_clean("t")} AS clean FROM a"""
SQL["token_counts"] = "SELECT doc_id, length(text) // 4 AS tokens FROM documents"
SQL["section_paths"] = f"WITH RECURSIVE {_S} SELECT file_id, block_id, CAST(depth AS BIGINT) AS depth, section_title FROM s"
SQL["clean_titles"] = f"SELECT DISTINCT chunk_id, {_title('section_title')} AS title, {_skips('section_title')} AS skips FROM kb_chunks"
SQL["routes"] = f"WITH RECURSIVE {_S} SELECT file_id, route, count(*) AS blocks FROM s GROUP BY 1, 2"
SQL["segments"] = f"""WITH RECURSIVE {_S} SELECT file_id, block_id, CAST(coalesce(sum((route IN ('table', 'image', 'formula', 'unsupported'))::int)
  OVER (PARTITION BY file_id ORDER BY block_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS segment FROM s"""

# ---- packing -----------------------------------------------------------------------------------------

SQL["merge_bins"] = """
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, pos, length(line) // 4 AS n FROM l),
r AS (
  SELECT doc_id, pos, 0 AS bin, CASE WHEN n >= 300 THEN 0 ELSE n END AS used, n < 300 AS filled FROM t WHERE pos = 0
  UNION ALL
  SELECT t.doc_id, t.pos, CASE WHEN t.n < 300 AND r.filled AND r.used + t.n <= 700 THEN r.bin ELSE r.bin + 1 END,
    CASE WHEN t.n >= 300 THEN 0 WHEN r.filled AND r.used + t.n <= 700 THEN r.used + t.n ELSE t.n END, t.n < 300
  FROM r JOIN t ON t.doc_id = r.doc_id AND t.pos = r.pos + 1
)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(bin AS INTEGER) AS bin FROM r
"""

def _pieces(src: str, keys: str, name: str) -> str:
    """CTEs that cut the texts `t` of `src` at 900 tokens: `name` has the keys, `piece` and `part`."""
    k = [x.strip() for x in keys.split(",")]
    same = lambda a, b: " AND ".join(f"{a}.{x} = {b}.{x}" for x in k)
    pick = lambda a: ", ".join(f"{a}.{x}" for x in k)
    return rf"""
{name}_p AS (SELECT {keys}, unnest(string_split(t, chr(10) || chr(10))) AS p, generate_subscripts(string_split(t, chr(10) || chr(10)), 1) AS i FROM {src} WHERE length(t) // 4 > 900),
{name}_l AS (SELECT *, length(p) // 4 > 900 AS far, coalesce(lag(length(p) // 4 > 900) OVER (PARTITION BY {keys} ORDER BY i), true) AS was FROM {name}_p),
{name}_r AS (SELECT *, sum((far OR was)::int) OVER (PARTITION BY {keys} ORDER BY i) AS run FROM {name}_l),
{name}_u AS (SELECT {keys}, i, run, far, 0 AS j, p AS u FROM {name}_r WHERE NOT far
  UNION ALL SELECT {keys}, i, run, far, generate_subscripts(l, 1), unnest(l) FROM (SELECT *, string_split(regexp_replace(p, '([.!?。！？])[{_WS}]+', '\1' || chr(1), 'g'), chr(1)) AS l FROM {name}_r WHERE far)),
{name}_n AS (SELECT *, length(u) // 4 AS n, row_number() OVER (PARTITION BY {keys} ORDER BY i, j) AS pos FROM {name}_u),
{name}_b AS (
  SELECT {keys}, pos, run, 0 AS piece, n AS used FROM {name}_n WHERE pos = 1
  UNION ALL
  SELECT {pick("x")}, x.pos, x.run, CASE WHEN x.run <> y.run OR y.used + x.n > 900 THEN y.piece + 1 ELSE y.piece END, CASE WHEN x.run <> y.run OR y.used + x.n > 900 THEN x.n ELSE y.used + x.n END
  FROM {name}_b y JOIN {name}_n x ON {same("x", "y")} AND x.pos = y.pos + 1
),
{name} AS (SELECT {keys}, 0 AS piece, t AS part FROM {src} WHERE length(t) // 4 <= 900
  UNION ALL SELECT {pick("x")}, y.piece, CASE WHEN bool_or(x.far) THEN string_agg(x.u, ' ' ORDER BY x.pos) ELSE string_agg(x.u, chr(10) || chr(10) ORDER BY x.pos) END
  FROM {name}_n x JOIN {name}_b y ON {same("x", "y")} AND x.pos = y.pos GROUP BY {pick("x")}, y.piece)
"""


SQL["split_texts"] = f"WITH RECURSIVE src AS (SELECT doc_id, text AS t FROM documents WHERE text IS NOT NULL), {_pieces('src', 'doc_id', 'pc')} SELECT doc_id, CAST(piece AS INTEGER) AS piece, part FROM pc"

# ---- tables ------------------------------------------------------------------------------------------



def _tb(src: str) -> str:
    """CTEs from table blocks of `src` to `full_text`: cells, row texts and the whole table as text."""
    return rf"""
h AS (SELECT file_id, block_id, content, list_transform(regexp_extract_all(coalesce(content.html, ''), '(?s)<tr>(.*?)</tr>', 1),
    lambda r: list_transform(regexp_extract_all(r, '(?s)<t[dh]>(.*?)</t[dh]>', 1), lambda c: {_strip("regexp_replace(c, '<[^>]+>', '', 'g')")})) AS a FROM {src} WHERE type = 'table'),
tb AS (SELECT file_id, block_id, coalesce(a[1], []) AS headers, a[2:] AS rows, {_inline("content.table_caption")} AS caption, {_inline("content.table_footnote")} AS footnote FROM h),
tt AS (SELECT *, list_transform(rows, lambda r, i: CASE WHEN len(r) > 0 THEN 'Row ' || i || ': ' || array_to_string(r, ' | ') END) AS texts FROM tb),
full_text AS (SELECT *, concat_ws(chr(10), CASE WHEN caption <> '' THEN 'Table: ' || caption END, CASE WHEN len(headers) > 0 THEN 'Columns: ' || array_to_string(headers, ' | ') END,
   CASE WHEN len(list_filter(texts, lambda x: x IS NOT NULL)) > 0 THEN array_to_string(list_filter(texts, lambda x: x IS NOT NULL), chr(10)) END, CASE WHEN footnote <> '' THEN 'Note: ' || footnote END) AS text FROM tt)
"""


_TB = f"{_B}, {_tb('bi')}"
SQL["html_tables"] = f"WITH {_TB} SELECT file_id, block_id, array_to_string(headers, ' | ') AS header, coalesce(array_to_string(list_transform(rows, lambda r: array_to_string(r, ' | ')), chr(10)), '') AS body, caption, footnote FROM tb"
SQL["table_texts"] = f"WITH {_TB} SELECT file_id, block_id, text FROM full_text"


def _parts(cap: int) -> str:
    """CTEs from `full_text` to `o`, the table chunks at a cap."""
    return rf"""
sized AS (SELECT *, (length(CASE WHEN caption <> '' THEN 'Table: ' || caption || ' (Part X/Y)' || chr(10) ELSE '' END || CASE WHEN len(headers) > 0 THEN 'Columns: ' || array_to_string(headers, ' | ') ELSE '' END)) // 4 AS head
  FROM full_text WHERE length(text) // 4 > {cap} AND len(rows) > 0),
r0 AS (SELECT file_id, block_id, head, len(rows) AS n_rows, footnote <> '' AS noted, unnest(list_transform(texts, lambda x: length(coalesce(x, '')) // 4)) AS n, generate_subscripts(texts, 1) AS pos FROM sized),
r1 AS (SELECT *, {cap} - CASE WHEN noted AND pos = n_rows THEN 100 ELSE 50 END AS cap FROM r0),
r AS (
  SELECT file_id, block_id, pos, 1 AS part, head + n AS used FROM r1 WHERE pos = 1
  UNION ALL
  SELECT t.file_id, t.block_id, t.pos, CASE WHEN r.used + t.n > t.cap THEN r.part + 1 ELSE r.part END, CASE WHEN r.used + t.n > t.cap THEN t.head + t.n ELSE r.used + t.n END
  FROM r JOIN r1 t ON t.file_id = r.file_id AND t.block_id = r.block_id AND t.pos = r.pos + 1
),
g AS (SELECT file_id, block_id, part, min(pos) AS lo, max(pos) AS hi, max(max(part)) OVER (PARTITION BY file_id, block_id) AS parts FROM r GROUP BY 1, 2, 3),
x AS (SELECT z.*, g.part, g.parts, g.hi - g.lo + 1 AS n_mine, list_filter(texts[g.lo:g.hi], lambda x: x IS NOT NULL) AS mine,
  CASE WHEN len(headers) > 0 THEN 'Columns: ' || array_to_string(headers, ' | ') END AS columns, CASE WHEN g.part = g.parts AND footnote <> '' THEN 'Note: ' || footnote END AS note
  FROM sized z JOIN g ON z.file_id = g.file_id AND z.block_id = g.block_id),
y AS (SELECT *, CASE WHEN len(mine) > 0 THEN array_to_string(mine, chr(10)) END AS body FROM x),
o AS (
  SELECT file_id, block_id, 0 AS part, 1 AS parts, false AS is_split, text AS chunk_text, CAST(NULL AS BIGINT) AS oversized FROM full_text WHERE length(text) // 4 <= {cap} AND length({_strip("text")}) > 20
  UNION ALL
  SELECT file_id, block_id, part, parts, true, CASE WHEN caption <> '' THEN regexp_replace(concat_ws(chr(10), 'Table: ' || caption || ' (Part ' || part || '/' || parts || ')', columns, body, note), '\(Part \p{{Nd}}+/\p{{Nd}}+\)', '(Part ' || part || '/' || parts || ')', 'g')
     ELSE concat_ws(chr(10), columns, body, note) END,
   nullif(greatest(length(concat_ws(chr(10), CASE WHEN caption <> '' THEN 'Table: ' || caption || ' (Part ' || part || '/' || greatest(2, (len(rows) + n_mine - 1) // n_mine) || ')' END, columns, body, note)) // 4, {cap}), {cap}) FROM y
)
"""


_PART = "CAST(part AS INTEGER) AS part, CAST(parts AS INTEGER) AS parts, is_split, chunk_text"
SQL["table_parts"] = f"WITH RECURSIVE {_TB}, {_parts(900)} SELECT file_id, block_id, {_PART} FROM o"
SQL["table_parts_tight"] = f"WITH RECURSIVE {_TB}, {_parts(120)} SELECT file_id, block_id, {_PART}, oversized FROM o"

# ---- figures -----------------------------------------------------------------------------------------

SQL["image_check"] = rf"""WITH {_B},
l AS (SELECT DISTINCT image_path FROM kb_chunks WHERE image_path <> ''),
i AS (SELECT file_id, block_id, content.image_source.path AS path, coalesce(regexp_matches(content.image_source.path, '(?i)[^/]\.(jpg|jpeg|png|gif|bmp|webp)\z'), false) AS good FROM bi WHERE type IN ('image', 'table'))
SELECT file_id, block_id, good, good AND l.image_path IS NOT NULL AS there, good AND l.image_path IS NULL AS missing FROM i LEFT JOIN l ON l.image_path = i.path
"""
SQL["nearby_texts"] = f"""WITH RECURSIVE {_S},
x AS (SELECT file_id, page_no, block_idx, type, section_title, block_id, CASE WHEN type IN ('paragraph', 'list') THEN {_clean("CASE WHEN type = 'paragraph' THEN " + _inline("content.paragraph_content") + " ELSE " + _list_text("content.list_items") + " END")} END AS t FROM s),
e AS (SELECT file_id, page_no, block_idx, section_title AS sec, left(t, 500) AS t FROM x WHERE length(t) > 20),
i AS (SELECT * FROM x WHERE type = 'image'),
m AS (SELECT i.file_id, i.block_id, e.page_no - i.page_no AS delta, e.block_idx - i.block_idx AS off, e.block_idx AS idx, e.t FROM i JOIN e ON e.file_id = i.file_id AND abs(e.page_no - i.page_no) <= 2
      AND (i.section_title = '' OR e.sec = '' OR e.sec = i.section_title))
SELECT i.file_id, i.block_id,
  arg_min(m.t, m.off) FILTER (WHERE delta = 0 AND off BETWEEN 1 AND 10) AS forward,
  arg_min(m.t, -m.off) FILTER (WHERE delta = 0 AND off BETWEEN -10 AND -1) AS backward,
  arg_min(m.t, abs(delta) * 2000000 + CASE WHEN delta > 0 THEN 1000000 + idx ELSE -idx END) FILTER (WHERE delta <> 0) AS neighbour
FROM i LEFT JOIN m ON m.file_id = i.file_id AND m.block_id = i.block_id GROUP BY 1, 2
"""
_NUM = rf"(?i)(Figure|Fig\.?|图)[{_WS}]*\p{{Nd}}+"
_LAB = rf"(?i)^(?:(?:MLC|TLC|SLC)[{_WS}]+Page|(?:Top|Bottom|Side|Front|Back|Enlarged|Partial)[{_WS}]+View|Left|Right|Detail[{_WS}]*[A-Z]|Zoom[{_WS}]*(?:In|Out)|Close[{_WS}-]*up|Note[{_WS}:]*|Legend)$"
SQL["figure_labels"] = f"""WITH {_B}, c AS (SELECT file_id, block_id, {_inline("content.image_caption")} AS cap FROM bi WHERE type = 'image')
SELECT file_id, block_id, regexp_matches(cap, '{_NUM}') AS numbered, length({_strip("cap")}) < 50 AND NOT regexp_matches(cap, '{_NUM}') AND regexp_matches({_strip("cap")}, '{_LAB}') AS part_label FROM c"""
SQL["formulas"] = f"WITH {_B} SELECT file_id, block_id, coalesce(content.math_content, '') AS formula FROM bi WHERE type = 'equation_interline'"

# ---- affixes, counters, reports ------------------------------------------------------------------------

_AFFIX = f"""
t AS (SELECT DISTINCT source, chunk_id, chunk_text FROM kb_chunks WHERE content_type = 'text' AND chunk_text IS NOT NULL),
a AS (SELECT source, 'prefix' AS side, {_strip("left(chunk_text, 50)")} AS affix FROM t UNION ALL SELECT source, 'suffix', {_strip("right(chunk_text, 50)")} FROM t),
f AS (SELECT source, side, affix, count(*) AS n FROM a WHERE length(affix) > 20 GROUP BY 1, 2, 3 HAVING count(*) > 3)
"""
SQL["affix_frequency"] = f"WITH {_AFFIX} SELECT source, side, affix, n FROM f"
SQL["affix_strip"] = f"""WITH {_AFFIX},
p AS (SELECT t.source, t.chunk_id, t.chunk_text, arg_max(f.affix, length(f.affix)) AS pre FROM t LEFT JOIN f ON f.source IS NOT DISTINCT FROM t.source AND f.side = 'prefix' AND starts_with(t.chunk_text, f.affix) GROUP BY 1, 2, 3),
q AS (SELECT *, CASE WHEN pre IS NULL THEN chunk_text ELSE {_strip("substring(chunk_text, length(pre) + 1)")} END AS u FROM p),
r AS (SELECT q.chunk_id, q.chunk_text, q.u, q.pre, arg_max(f.affix, length(f.affix)) AS suf FROM q LEFT JOIN f ON f.source IS NOT DISTINCT FROM q.source AND f.side = 'suffix' AND ends_with(q.u, f.affix) GROUP BY 1, 2, 3, 4)
SELECT chunk_id, CASE WHEN suf IS NULL THEN u ELSE {_strip("left(u, length(u) - length(suf))")} END AS chunk_text, pre IS NOT NULL AS head_cut, suf IS NOT NULL AS tail_cut FROM r"""
SQL["error_summary"] = "WITH e AS (SELECT DISTINCT * FROM kb_errors) SELECT doc_id, " + ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS {c}" for c in ("missing_images", "skipped_blocks", "unsupported_blocks", "parse_errors")) + " FROM e GROUP BY doc_id"
_COUNTERS = "total_chunks text_chunks table_chunks figure_chunks formula_chunks missing_images unparseable_blocks skipped_noise skipped_empty skipped_low_value_sections skipped_weak_figures aside_noise oversized_table_chunks subfigure_fragments_merged".split()

# ---- the whole packager --------------------------------------------------------------------------------

_RAWTEXT = "CASE WHEN type = 'paragraph' THEN " + _inline("content.paragraph_content") + " WHEN type = 'list' THEN " + _list_text("content.list_items") + " END"
_BT = f"""
bt AS MATERIALIZED (SELECT *, {_clean(_RAWTEXT)} AS t, CAST(coalesce(sum((route IN ('table', 'image', 'formula', 'unsupported'))::int)
  OVER (PARTITION BY file_id ORDER BY block_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS segment FROM s),
ti AS (SELECT file_id, segment, page_no, section_title, block_id, t, length(t) // 4 AS n, row_number() OVER (PARTITION BY file_id, segment ORDER BY block_index) AS pos FROM bt WHERE route = 'text' AND length(t) >= 10),
mb AS (
  SELECT file_id, segment, pos, 0 AS bin, CASE WHEN n >= 300 THEN 0 ELSE n END AS used, n < 300 AS filled FROM ti WHERE pos = 1
  UNION ALL
  SELECT x.file_id, x.segment, x.pos, CASE WHEN x.n < 300 AND m.filled AND m.used + x.n <= 700 THEN m.bin ELSE m.bin + 1 END,
    CASE WHEN x.n >= 300 THEN 0 WHEN m.filled AND m.used + x.n <= 700 THEN m.used + x.n ELSE x.n END, x.n < 300
  FROM mb m JOIN ti x ON x.file_id = m.file_id AND x.segment = m.segment AND x.pos = m.pos + 1
),
mg AS (SELECT ti.file_id, ti.segment, mb.bin, string_agg(t, chr(10) || chr(10) ORDER BY ti.pos) AS t, arg_min(page_no, ti.pos) AS page_no, arg_min(section_title, ti.pos) AS section_title,
  CASE WHEN count(*) > 1 THEN 'merged_' ELSE '' END || arg_min(block_id, ti.pos) AS source_block_id, CASE WHEN count(*) > 1 THEN string_agg(block_id, ',' ORDER BY ti.pos) ELSE '' END AS members
  FROM ti JOIN mb ON ti.file_id = mb.file_id AND ti.segment = mb.segment AND ti.pos = mb.pos GROUP BY 1, 2, 3),
{_pieces("mg", "file_id, segment, bin", "pc")},
tx AS MATERIALIZED (SELECT mg.file_id, mg.segment, CAST(mg.bin AS INTEGER) AS bin, CAST(pc.piece AS INTEGER) AS piece, mg.page_no, mg.section_title, mg.source_block_id, mg.members, pc.part AS chunk_text
  FROM mg JOIN pc ON pc.file_id = mg.file_id AND pc.segment = mg.segment AND pc.bin = mg.bin)
"""
SQL["text_chunks"] = f"WITH RECURSIVE {_S}, {_BT} SELECT * FROM tx"

_GOOD = r"coalesce(regexp_matches(content.image_source.path, '(?i)[^/]\.(jpg|jpeg|png|gif|bmp|webp)\z'), false)"
_IM = f"""
li AS (SELECT DISTINCT v.file_id, k.image_path AS path FROM content_list_v2 v JOIN kb_chunks k ON k.doc_id = v.doc_id WHERE k.image_path <> ''),
wi AS MATERIALIZED (SELECT bt.*, content.image_source.path AS raw, {_GOOD} AS good, {_GOOD} AND li.path IS NOT NULL AS there,
  CASE WHEN {_GOOD} AND li.path IS NOT NULL THEN replace(content.image_source.path, '\\', '/') ELSE '' END AS image_path
  FROM bt LEFT JOIN li ON li.file_id = bt.file_id AND li.path = content.image_source.path WHERE route IN ('table', 'image')),
el AS (SELECT file_id, page_no, block_idx, section_title AS sec, left(t, 500) AS t FROM bt WHERE type IN ('paragraph', 'list') AND length(t) > 20),
nb AS (SELECT i.file_id, i.block_id,
  arg_min(m.t, m.block_idx) FILTER (WHERE m.page_no = i.page_no AND m.block_idx BETWEEN i.block_idx + 1 AND i.block_idx + 10) AS forward,
  arg_max(m.t, m.block_idx) FILTER (WHERE m.page_no = i.page_no AND m.block_idx BETWEEN i.block_idx - 10 AND i.block_idx - 1) AS backward,
  arg_min(m.t, abs(m.page_no - i.page_no) * 2000000 + CASE WHEN m.page_no > i.page_no THEN 1000000 + m.block_idx ELSE -m.block_idx END) FILTER (WHERE m.page_no <> i.page_no) AS neighbour
  FROM wi i LEFT JOIN el m ON m.file_id = i.file_id AND abs(m.page_no - i.page_no) <= 2 AND (i.section_title = '' OR m.sec = '' OR m.sec = i.section_title) WHERE i.route = 'image' GROUP BY 1, 2),
rc AS (SELECT file_id, block_id, CASE WHEN abs(p - page_no) <= 2 THEN left(chunk_text, 500) END AS recent FROM (
  SELECT i.file_id, i.block_id, i.page_no, x.page_no AS p, x.chunk_text, row_number() OVER (PARTITION BY i.file_id, i.block_id ORDER BY x.segment DESC, x.bin DESC, x.piece DESC) AS rn
  FROM wi i JOIN tx x ON x.file_id = i.file_id AND x.segment <= i.segment AND (i.section_title = '' OR x.section_title = i.section_title) WHERE i.route = 'image') WHERE rn = 1),
i1 AS (SELECT wi.*, rc.recent, {_inline("content.image_caption")} AS caption,
  coalesce(nullif(nb.forward, ''), nullif(nb.backward, ''), nullif(rc.recent, ''), nullif(nb.neighbour, ''), section_title) AS nearby
  FROM wi LEFT JOIN nb ON nb.file_id = wi.file_id AND nb.block_id = wi.block_id LEFT JOIN rc ON rc.file_id = wi.file_id AND rc.block_id = wi.block_id WHERE route = 'image'),
i2 AS (SELECT *, {_strip("caption")} AS cap, {_strip("nearby")} AS near,
  coalesce(nullif(concat_ws(chr(10), CASE WHEN caption <> '' THEN 'Figure: ' || caption END, CASE WHEN nearby <> '' THEN 'Context: ' || nearby END), ''), 'Figure (see image)') AS text FROM i1),
i3 AS (SELECT *, CASE WHEN length(cap) < 50 AND NOT regexp_matches(cap, '{_NUM}') AND regexp_matches(cap, '{_LAB}') THEN 'subfigure'
    WHEN starts_with(text, 'Context:') AND length(cap) <= 5 THEN 'weak' WHEN regexp_matches(cap, '{_NUM}') THEN 'formal'
    WHEN length(cap) > 5 AND near <> section_title AND length(cap) + length(near) >= 50 THEN 'formal'
    WHEN length(cap) <= 5 AND near = section_title THEN 'weak' WHEN length(cap) + length(near) < 30 THEN 'weak' ELSE 'formal' END AS class FROM i2),
i4 AS (SELECT *, last_value(CASE WHEN class = 'formal' THEN block_index END IGNORE NULLS) OVER w AS lb, last_value(CASE WHEN class = 'formal' THEN page_no END IGNORE NULLS) OVER w AS lp
  FROM i3 WINDOW w AS (PARTITION BY file_id, k ORDER BY block_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
im AS MATERIALIZED (SELECT *, CASE WHEN class = 'subfigure' AND abs(lp - page_no) <= 1 THEN lb END AS parent FROM i4),
sub AS (SELECT file_id, parent, count(*) AS parts, string_agg(chr(10) || '[Subfigure: ' || caption || ']' || CASE WHEN image_path <> '' THEN ' (Image: ' || image_path || ')' ELSE '' END, '' ORDER BY block_index) AS tail
  FROM im WHERE parent IS NOT NULL GROUP BY 1, 2),
fg AS (SELECT im.file_id, im.doc_id, im.segment, im.block_index, im.page_no, im.section_title, im.block_id, im.image_path, im.text || coalesce(sub.tail, '') AS chunk_text, coalesce(sub.parts, 0) AS parts
  FROM im LEFT JOIN sub ON sub.file_id = im.file_id AND sub.parent = im.block_index WHERE class = 'formal')
"""
SQL["figure_context"] = f"WITH RECURSIVE {_S}, {_BT}, {_IM} SELECT file_id, block_id, recent, nearby, class, CAST(parent AS INTEGER) AS parent, good AND NOT there AS missing FROM im"
SQL["figure_chunks"] = f"WITH RECURSIVE {_S}, {_BT}, {_IM} SELECT file_id, block_id, section_title, chunk_text, image_path, CAST(parts AS INTEGER) AS parts FROM fg"

_TABLES = f"""
t0x AS (SELECT file_id, block_id, content, 'table' AS type, image_path FROM wi WHERE route = 'table'),
{_tb("t0x").replace("full_text AS (SELECT *", "tf AS (SELECT *")},
tw AS (SELECT w.*, tf.headers, tf.rows, len(tf.headers) > 0 OR len(tf.rows) > 0 OR w.image_path <> '' AS filled FROM wi w JOIN tf ON tf.file_id = w.file_id AND tf.block_id = w.block_id),
full_text AS (SELECT tf.* FROM tf JOIN tw ON tf.file_id = tw.file_id AND tf.block_id = tw.block_id WHERE tw.filled),
{_parts(900)}
"""
_ALL = f"""
al AS MATERIALIZED (
  SELECT file_id, segment, 0 AS nt, bin AS a, piece AS b, page_no, 'text' AS content_type, section_title, chunk_text, '' AS image_path FROM tx
  UNION ALL SELECT tw.file_id, tw.segment, 1, tw.block_index, o.part, tw.page_no, 'table', tw.section_title, o.chunk_text, tw.image_path FROM o JOIN tw ON tw.file_id = o.file_id AND tw.block_id = o.block_id
  UNION ALL SELECT file_id, segment, 1, block_index, 0, page_no, 'figure', section_title, chunk_text, image_path FROM fg
  UNION ALL SELECT file_id, segment, 1, block_index, 0, page_no, 'formula', section_title, content.math_content, '' FROM bt WHERE route = 'formula' AND content.math_content <> ''
)
"""
_CHUNKS = f"""
nm AS (SELECT al.*, v.doc_id, row_number() OVER (PARTITION BY al.file_id ORDER BY segment, nt, a, b) AS seq FROM al JOIN content_list_v2 v ON v.file_id = al.file_id),
ax AS (SELECT file_id, 'prefix' AS side, {_strip("left(chunk_text, 50)")} AS affix FROM tx UNION ALL SELECT file_id, 'suffix', {_strip("right(chunk_text, 50)")} FROM tx),
af AS (SELECT file_id, side, affix FROM ax WHERE length(affix) > 20 GROUP BY 1, 2, 3 HAVING count(*) > 3),
p1 AS (SELECT nm.file_id, nm.seq, arg_max(af.affix, length(af.affix)) AS pre FROM nm JOIN af ON af.file_id = nm.file_id AND side = 'prefix' AND starts_with(nm.chunk_text, af.affix) WHERE content_type = 'text' GROUP BY 1, 2),
p2 AS (SELECT nm.*, CASE WHEN p1.pre IS NULL THEN chunk_text ELSE {_strip("substring(chunk_text, length(p1.pre) + 1)")} END AS u FROM nm LEFT JOIN p1 ON p1.file_id = nm.file_id AND p1.seq = nm.seq),
p3 AS (SELECT p2.file_id, p2.seq, arg_max(af.affix, length(af.affix)) AS suf FROM p2 JOIN af ON af.file_id = p2.file_id AND side = 'suffix' AND ends_with(p2.u, af.affix) WHERE content_type = 'text' GROUP BY 1, 2),
ch AS (SELECT p2.*, CASE WHEN p3.suf IS NULL THEN u ELSE {_strip("left(u, length(u) - length(p3.suf))")} END AS final FROM p2 LEFT JOIN p3 ON p3.file_id = p2.file_id AND p3.seq = p2.seq)
"""
_PACK = f"WITH RECURSIVE {_S}, {_BT}, {_IM}, {_TABLES}, {_ALL}"
SQL["packed_chunks"] = f"""{_PACK}, {_CHUNKS}
SELECT file_id, doc_id || ':p' || page_no || ':' || content_type || ':' || seq AS chunk_id, page_no, content_type, {_title("section_title")} AS section_title, final AS chunk_text, image_path FROM ch"""

_EVENTS = f"""
ev AS (
  SELECT file_id, 'skipped_blocks' AS category, block_id, 'title' AS type, CASE WHEN {_skips("title")} THEN 'low-value section' ELSE 'title used for section tracking only' END AS reason, page_no,
    CASE WHEN {_skips("title")} THEN title END AS section_title, NULL AS caption, NULL AS nearby_text_preview, NULL AS expected_path, NULL AS error, NULL::BIGINT AS tokens, NULL::BIGINT AS limit_tokens FROM bt WHERE route = 'title'
  UNION ALL SELECT file_id, 'parse_errors', block_id, 'title', NULL, NULL, NULL, NULL, NULL, NULL, 'title level below 1 read as 1', NULL, NULL FROM bt WHERE route = 'title' AND content.level < 1
  UNION ALL SELECT file_id, 'skipped_blocks', block_id, type, 'page noise', page_no, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM bt WHERE route = 'noise'
  UNION ALL SELECT file_id, 'skipped_blocks', block_id, type, 'content of a low-value section', page_no, section_title, NULL, NULL, NULL, NULL, NULL, NULL FROM bt WHERE route = 'low_value'
  UNION ALL SELECT file_id, 'unsupported_blocks', block_id, type, NULL, page_no, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM bt WHERE route = 'unsupported'
  UNION ALL SELECT file_id, 'missing_images', block_id, CASE route WHEN 'image' THEN 'figure' ELSE 'table' END, NULL, NULL, NULL, NULL, NULL, raw, NULL, NULL, NULL FROM wi WHERE good AND NOT there
  UNION ALL SELECT file_id, 'skipped_blocks', block_id, 'table', 'empty table content and no image', page_no, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM tw WHERE NOT filled
  UNION ALL SELECT o.file_id, 'oversized_table_chunks', o.block_id, NULL, NULL, tw.page_no, NULL, NULL, NULL, NULL, NULL, oversized, 900 FROM o JOIN tw ON tw.file_id = o.file_id AND tw.block_id = o.block_id WHERE oversized IS NOT NULL
  UNION ALL SELECT file_id, 'skipped_blocks', block_id, 'image', 'weak figure', page_no, NULL, left(caption, 100), left(nearby, 100), NULL, NULL, NULL, NULL FROM im WHERE class = 'weak'
  UNION ALL SELECT file_id, 'skipped_blocks', block_id, 'image', 'subfigure without a parent figure', page_no, NULL, left(caption, 100), NULL, NULL, NULL, NULL, NULL FROM im WHERE class = 'subfigure' AND parent IS NULL
  UNION ALL SELECT file_id, 'parse_errors', block_id, 'equation_interline', NULL, NULL, NULL, NULL, NULL, NULL, 'empty formula', NULL, NULL FROM bt WHERE route = 'formula' AND coalesce(content.math_content, '') = ''
)
"""
SQL["packed_events"] = f"{_PACK}, {_EVENTS} SELECT ev.*, v.doc_id FROM ev JOIN content_list_v2 v ON v.file_id = ev.file_id"
SQL["packed_stats"] = f"""{_PACK}, {_EVENTS},
c AS (SELECT file_id, count(*) AS total_chunks, {", ".join(f"count(*) FILTER (WHERE content_type = '{t}') AS {t}_chunks" for t in ("text", "table", "figure", "formula"))} FROM al GROUP BY 1),
e AS (SELECT file_id, count(*) FILTER (WHERE category = 'missing_images') AS missing_images, count(*) FILTER (WHERE reason IN ('page noise', 'title used for section tracking only') AND type <> 'page_aside_text') AS skipped_noise,
  count(*) FILTER (WHERE reason = 'empty table content and no image') AS skipped_empty, count(*) FILTER (WHERE reason = 'low-value section') AS skipped_low_value_sections,
  count(*) FILTER (WHERE reason IN ('weak figure', 'subfigure without a parent figure')) AS skipped_weak_figures, count(*) FILTER (WHERE reason = 'page noise' AND type = 'page_aside_text') AS aside_noise,
  count(*) FILTER (WHERE category = 'oversized_table_chunks') AS oversized_table_chunks FROM ev GROUP BY 1),
f AS (SELECT file_id, count(*) AS subfigure_fragments_merged FROM im WHERE parent IS NOT NULL GROUP BY 1)
SELECT v.file_id, v.doc_id, 0::BIGINT AS unparseable_blocks, {", ".join(f"coalesce({x}, 0) AS {x}" for x in _COUNTERS if x != "unparseable_blocks")}
FROM (SELECT DISTINCT file_id, doc_id FROM content_list_v2) v LEFT JOIN c ON c.file_id = v.file_id LEFT JOIN e ON e.file_id = v.file_id LEFT JOIN f ON f.file_id = v.file_id
"""

# ---- deliveries ----------------------------------------------------------------------------------------

SQL["counter_totals"] = " UNION ALL ".join(f"SELECT '{c}' AS counter, CAST(sum({c}) AS BIGINT) AS total FROM st" for c in _COUNTERS)
SQL["counter_totals"] = f"WITH st AS ({SQL['packed_stats']}) {SQL['counter_totals']}"
SQL["self_check"] = f"SELECT file_id, skipped_low_value_sections, skipped_weak_figures, subfigure_fragments_merged, oversized_table_chunks, aside_noise FROM ({SQL['packed_stats']})"


def _below(x: str) -> str:
    return f"CASE WHEN starts_with({x}, 'inbox/') THEN substring({x}, 7) ELSE coalesce({x}, '') END"


SQL["manifests"] = f"""SELECT m.doc_id, doc_title AS title, {_below("source_dir")} AS dir, {_below("input_files_used['origin_pdf']")} AS pdf, '300-700' AS target_tokens, '900' AS hard_cap, 'figure' AS image_type,
  {_below("source_dir || '/output/kb_chunks.jsonl'")} AS chunks_file, {_below("source_dir || '/output/error_report.json'")} AS report_file,
  CASE WHEN input_files_all['layout'] IS NOT NULL THEN {_below("input_files_all['layout']")} END AS layout, CASE WHEN input_files_used['content_list_v2'] IS NOT NULL THEN {_below("input_files_used['content_list_v2']")} END AS list_used,
  CAST(coalesce(total_chunks, 0) AS VARCHAR) AS total_chunks, CAST(coalesce(aside_noise, 0) AS VARCHAR) AS aside_noise FROM kb_manifest m LEFT JOIN kb_stats s ON s.doc_id = m.doc_id"""
_CATS = ("missing_images", "skipped_blocks", "unsupported_blocks", "parse_errors")
SQL["error_reports"] = f"""WITH e AS (SELECT DISTINCT * FROM kb_errors)
SELECT m.doc_id, {", ".join(f"count(*) FILTER (WHERE category = '{c}') AS total_{c}" for c in _CATS)}, {", ".join(f"count(*) FILTER (WHERE category = '{c}') AS {c}" for c in (*_CATS, "oversized_table_chunks"))}
FROM kb_manifest m LEFT JOIN e ON e.doc_id = m.doc_id GROUP BY 1"""
SQL["readmes"] = """SELECT m.doc_id, '# ' || coalesce(doc_title, '') AS head, concat_ws(',', coalesce(total_chunks, 0), coalesce(text_chunks, 0), coalesce(table_chunks, 0), coalesce(figure_chunks, 0), coalesce(formula_chunks, 0),
  coalesce(missing_images, 0), coalesce(skipped_noise, 0), coalesce(skipped_empty, 0)) AS counts FROM kb_manifest m LEFT JOIN kb_stats s ON s.doc_id = m.doc_id"""
_SENT = f"SELECT DISTINCT k.doc_id, chunk_id, page_no, content_type, section_title, chunk_text, image_path FROM kb_chunks k JOIN kb_manifest m ON m.doc_id = k.doc_id"
SQL["written_chunks"] = f"SELECT chunk_id, page_no, content_type, {_title('section_title')} AS section_title, chunk_text, image_path FROM ({_SENT})"
SQL["shared_chunks"] = f"SELECT replace(doc_title, '/', '_') AS title, count(*) AS lines, count(DISTINCT chunk_id) AS chunks FROM ({_SENT}) k JOIN kb_manifest m ON m.doc_id = k.doc_id WHERE doc_title IS NOT NULL GROUP BY 1"

# The packager over files that exist as JSON text: the same SQL over their decoded pages, every good image path existing.
_I = '[{"type":"VARCHAR","content":"VARCHAR"}]'
_SHAPE = f'[[{{"type":"VARCHAR","bbox":["DOUBLE"],"content":{{"level":"INTEGER","title_content":{_I},"paragraph_content":{_I},"list_items":[{{"item_type":"VARCHAR","item_content":{_I}}}],"table_caption":{_I},"table_footnote":{_I},"html":"VARCHAR","image_source":{{"path":"VARCHAR"}},"image_caption":{_I},"image_footnote":{_I},"math_content":"VARCHAR"}}}}]]'
_RAW = f"""WITH RECURSIVE content_list_v2 AS MATERIALIZED (SELECT file_id, doc_id, CASE WHEN json_type(j) = 'ARRAY' THEN json_transform(j, '{_SHAPE}') END AS pages
  FROM (SELECT file_id, doc_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM content_list_raw)),
kb_chunks AS (SELECT doc_id, unnest(list_transform(flatten(pages), lambda b: b.content.image_source.path)) AS image_path FROM content_list_v2),
"""
SQL["packed_raw"] = SQL["packed_chunks"].replace("WITH RECURSIVE ", _RAW, 1).replace("final AS chunk_text, image_path FROM ch", "final AS chunk_text FROM ch")
