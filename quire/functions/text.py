"""Column functions over block texts; all of them built from JVM expressions.

Patterns carry the flags (?Ud) and count the separators U+001C to U+001F as white space, so that they
match what Unicode-aware patterns of other engines match, line ends included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.options import FIGURE_NUMBER, FOLDER_UUID, IMAGE_EXTENSIONS, SKIP_TITLES, SUBFIGURE_LABELS, WATERMARKS

WS = r"[\s\x1c-\x1f]"


def _ws(pattern: str) -> str:
    """`pattern` with its white space made Unicode white space plus separators, inside classes as well."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(r"\s\x1c-\x1f" if inside else WS)
            i += 2
            continue
        if two[0] == "\\":
            out.append(two)
            i += 2
            continue
        inside = two[0] == "[" or inside and two[0] != "]"
        out.append(two[0])
        i += 1
    return "".join(out)


def pattern(p: str, flags: str = "") -> str:
    return f"(?Ud{flags})" + _ws(p)


def bound(value: Column, body) -> Column:
    """`body` of a value that is computed once: lambda variables are bound, while projected columns are inlined again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """White space of any kind cut from both ends."""
    return F.regexp_replace(c, pattern(r"^\s+|\s+\z"), "")


def tokens(c: Column) -> Column:
    """Estimated tokens: code points // 4."""
    return F.floor(F.length(c) / 4).cast("bigint")


def clean_text(c: Column) -> Column:
    """Runs of spaces, number-only lines, surplus blank lines, tags and watermarks removed, in this order."""
    c = F.regexp_replace(c, " +", " ")
    c = F.regexp_replace(c, pattern(r"\n\s*\d+\s*\n"), "\n")
    c = F.regexp_replace(c, pattern(r"\n\s*\n\s*\n+"), "\n\n")
    c = F.regexp_replace(c, "<[^>]+>", "")
    for w in WATERMARKS:
        c = F.regexp_replace(c, pattern(w, "i"), "")
    return strip(c)


def clean_title(c: Column) -> Column:
    return F.regexp_replace(strip(c), pattern(r"\s+"), " ")


def inline_text(items: Column) -> Column:
    """Contents of the text and inline-formula items, joined without separator; '' for a null array."""
    keep = F.filter(items, lambda i: i["type"].isin("text", "equation_inline"))
    return F.coalesce(F.array_join(F.transform(keep, lambda i: F.coalesce(i["content"], F.lit(""))), ""), F.lit(""))


def list_text(items: Column) -> Column:
    """Texts of the text items of a list, empty ones left out, one a line."""
    keep = F.filter(items, lambda i: i["item_type"] == "text")
    texts = F.filter(F.transform(keep, lambda i: inline_text(i["item_content"])), lambda t: t != "")
    return F.coalesce(F.array_join(texts, "\n"), F.lit(""))


def html_rows(html: Column) -> Column:
    """Cells of the plain rows of an HTML table: array of rows, tags with attributes do not match."""
    rows = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?s)<tr>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.regexp_extract_all(r, F.lit(r"(?s)<t[dh]>(.*?)</t[dh]>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(cells(r), lambda c: strip(F.regexp_replace(c, "<[^>]+>", ""))))


def skips_section(title: Column) -> Column:
    """Whether a title opens a section of low value."""
    return F.coalesce(F.lower(clean_title(title)).rlike(pattern("|".join(SKIP_TITLES))), F.lit(False))


def has_figure_number(c: Column) -> Column:
    return F.coalesce(c.rlike(pattern(FIGURE_NUMBER, "i")), F.lit(False))


def is_subfigure_label(caption: Column) -> Column:
    s = strip(caption)
    label = s.rlike(pattern("|".join(SUBFIGURE_LABELS), "i"))
    return F.coalesce((F.length(s) < 50) & ~has_figure_number(s) & label, F.lit(False))


def is_image_path(path: Column) -> Column:
    """A non-empty path with a name and one of the image extensions."""
    return F.coalesce(path.rlike(r"(?i)[^/]\.(" + "|".join(IMAGE_EXTENSIONS) + r")\z"), F.lit(False))


def doc_title(dirname: Column) -> Column:
    """A folder's name without its uuid and without .pdf."""
    return F.regexp_replace(F.regexp_replace(dirname, FOLDER_UUID, ""), r"\.pdf$", "")


def doc_id(dirname: Column) -> Column:
    return F.concat(doc_title(dirname), F.lit("_"), F.substring(F.md5(dirname), 1, 8))


def relative_path(path: Column, root: str) -> Column:
    """`path` below `root`, with forward slashes; unchanged outside of it; '' for null."""
    p = F.replace(F.coalesce(path, F.lit("")), F.lit("\\"), F.lit("/"))
    root = root.rstrip("/") + "/"
    return F.when(F.lit(root != "/") & p.startswith(root), F.substr(p, F.lit(len(root) + 1))).otherwise(p)
