"""Constants of the packager and the switches of a run."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values ------------------------------------------------------------------------------
NOISE_TYPES = ("page_header", "page_footer", "page_number", "header", "footer", "page_aside_text")
TYPE_MAPPING = {
    "paragraph": "text",
    "list": "text",
    "table": "table",
    "image": "figure",
    "equation_interline": "formula",
    "title": "title",
    "page_header": "noise",
    "page_footer": "noise",
    "page_number": "noise",
    "header": "noise",
    "footer": "noise",
    "page_aside_text": "noise",
}
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "bmp", "webp")
#: Titles whose sections are skipped; matched against the cleaned, lower-cased title.
SKIP_TITLES = (
    r"^\s*contents\s*$",
    r"^\s*table of contents\s*$",
    r"^\s*list of figures\s*$",
    r"^\s*list of tables\s*$",
    r"^\s*rev\.\s*\w+",
    r"^\s*revision\s*history\s*$",
    r"^\s*document\s*history\s*$",
    r"^\s*change\s*history\s*$",
)
#: Captions that are labels of parts of a figure; matched without case.
SUBFIGURE_LABELS = (
    r"^\s*(MLC|TLC|SLC)\s+Page\s*$",
    r"^\s*Top\s+View\s*$",
    r"^\s*Bottom\s+View\s*$",
    r"^\s*Side\s+View\s*$",
    r"^\s*Front\s+View\s*$",
    r"^\s*Back\s+View\s*$",
    r"^\s*Left\s*$",
    r"^\s*Right\s*$",
    r"^\s*Detail\s*[A-Z]\s*$",
    r"^\s*Zoom\s*(In|Out)\s*$",
    r"^\s*Close[\s-]*up\s*$",
    r"^\s*Enlarged\s+View\s*$",
    r"^\s*Partial\s+View\s*$",
    r"^\s*Note[\s:]*$",
    r"^\s*Legend\s*$",
)
FIGURE_NUMBER = r"(Figure|Fig\.?|图)\s*\d+[\w\-\.]*"
WATERMARKS = (r"www\.[a-zA-Z0-9.-]+\.(com|cn|net|org)", r"Copyright\s*©?\s*\d{4}.*", r"All\s+rights\s+reserved")
FOLDER_UUID = r"-[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}$"
COUNTERS = (
    "total_chunks",
    "text_chunks",
    "table_chunks",
    "figure_chunks",
    "formula_chunks",
    "missing_images",
    "unparseable_blocks",
    "skipped_noise",
    "skipped_empty",
    "skipped_low_value_sections",
    "skipped_weak_figures",
    "aside_noise",
    "oversized_table_chunks",
    "subfigure_fragments_merged",
)
# ---- end of fixed values -----------------------------------------------------------------------


@dataclass(frozen=True)
class Options:
    """Budgets in estimated tokens (characters // 4) and lengths in characters.

    `strict` mends what the plain rules lose: texts emptied by affix removal are dropped and logged,
    and short or row-less tables are logged.
    """

    short_block: int = 300
    merge_cap: int = 700
    hard_cap: int = 900
    min_text: int = 10
    min_table_text: int = 20
    min_nearby: int = 20
    nearby_window: int = 10
    nearby_length: int = 500
    page_reach: int = 2
    affix_length: int = 50
    affix_min: int = 20
    affix_count: int = 3
    project_root: str = ""
    parser: str = "layout-postprocessed"
    strict: bool = False
