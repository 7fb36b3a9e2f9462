"""A two-page document that takes every branch, as Python values, and a sequential model of the section stack."""


def text(*parts):
    return [{"type": k, "content": v} for k, v in parts]


def t(s):
    return text(("text", s))


PAGES = [
    [
        {"type": "title", "content": {"title_content": t("Overview "), "level": 1}},
        {"type": "paragraph", "bbox": [0.0, 0.0, 100.0, 20.0], "content": {"paragraph_content": text(("text", "The sensor drives "), ("equation_inline", "V_{out}"), ("text", " directly."), ("footnote_ref", "IGNORED"))}},
        {"type": "page_number", "content": {}},
        {"type": "title", "content": {"title_content": t("Limits"), "level": 2}},
        {"type": "list", "content": {"list_items": [{"item_type": "text", "item_content": t("first entry")}, {"item_type": "nested", "item_content": t("IGNORED")}, {"item_type": "text", "item_content": t("second entry")}]}},
        {"type": "table", "content": {"table_caption": t("Ratings"), "table_footnote": [], "html": "<table><tr><td>Name</td><td>Max</td></tr><tr><td><b>Supply</b></td><td>5 V</td></tr></table>", "image_source": {"path": "images/t1.jpg"}}},
        {"type": "image", "content": {"image_source": {"path": "images/f1.png"}, "image_caption": t("Figure 1 Block diagram"), "image_footnote": t("IGNORED")}},
        {"type": "image", "content": {"image_source": {"path": "images/missing.png"}, "image_caption": t("Top View")}},
        {"type": "image", "content": {"image_source": {"path": "images/f2.png"}, "image_caption": []}},
    ],
    [
        {"type": "title", "content": {"title_content": t("Revision History"), "level": 1}},
        {"type": "paragraph", "content": {"paragraph_content": t("Released with corrections.")}},
        {"type": "equation_interline", "content": {"math_content": "E = mc^2"}},
        {"type": "equation_interline", "content": {"math_content": ""}},
        {"type": "code", "content": {}},
        {"type": "page_aside_text", "content": {}},
    ],
]
IMAGES = ["images/t1.jpg", "images/f1.png", "images/f2.png"]

CHUNKS = [
    ("text", 1, "Overview", "The sensor drives V_{out} directly.\n\nfirst entry\nsecond entry", ""),
    ("table", 1, "Overview > Limits", "Table: Ratings\nColumns: Name | Max\nRow 1: Supply | 5 V", "images/t1.jpg"),
    ("figure", 1, "Overview > Limits", "Figure: Figure 1 Block diagram\nContext: first entry\nsecond entry\n[Subfigure: Top View]", "images/f1.png"),
    ("formula", 2, "Revision History", "E = mc^2", ""),
]
STATS = {
    "total_chunks": 4, "text_chunks": 1, "table_chunks": 1, "figure_chunks": 1, "formula_chunks": 1, "missing_images": 1, "unparseable_blocks": 0, "skipped_noise": 3, "skipped_empty": 0,
    "skipped_low_value_sections": 1, "skipped_weak_figures": 1, "aside_noise": 1, "oversized_table_chunks": 0, "subfigure_fragments_merged": 1,
}


def stack_paths(titles):
    """Section paths after each (level, title), kept with a plain stack."""
    stack, out = [], []
    for level, title in titles:
        del stack[level - 1 :]
        stack.append(title)
        out.append(list(stack))
    return out
