"""Markup residue: wrappers inferred for each host, kinds of markup found, and clean text with structure.

Wrappers are union-free regular expressions over markup tokens with text slots.  Each record's tokens are
read as blocks (an element with all that it holds, or a single mark); a block's own wrapper has adjacent
equal siblings and repeated groups folded into one repeated part.  Blocks of the same host and the same root
are then aligned one after the other: labels on a longest common subsequence are merged, what only one
side has becomes optional, text becomes a slot, and no alternatives are ever formed.  Blocks reach the merge
as distinct shapes in a fixed order, first within salted parts of a host and root, then part by part, so the
same records give the same wrappers however they are partitioned; a hot host never gathers its records, and
a task holds one wrapper and one shape at a time.

Every record is then read again with its host's wrappers.  Wrappers are inferred from the tokens that are
markup beyond doubt.  A token that may be markup or may only look alike counts if the wrapper of the element or
environment around it has that mark at that place, that is if other records of the host have it there beyond doubt;
outside of any element it is text.  Parts that a wrapper repeats are set apart by line breaks in the clean text.

Clean text keeps structure as plain marks: headings `## x`, list items `- x`, code in fences or backticks,
table rows `a | b`, formulas in their own delimiters; emphasis, links, templates, comments, attributes and
stray tags go, character entities are decoded.

Defined results: a null text stays null and has no markup; an empty or blank text is empty; a null host is
a host of its own; texts are read whole; repeated rows give equal rows; only the named columns are read.
"""

from __future__ import annotations

import html as _html
import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.lexer import HINT, VOID, Token, tokens
from quire.runtime import cut, wide

#: Longest sequence of parts a wrapper keeps in order; a longer one becomes a repeated group of optional parts.
LONGEST = 48
#: Wrappers up to this many characters in all are broadcast; beyond it they are joined by host.
BROADCAST_CHARS = 16_000_000

#: Elements nested deeper than this keep their labels in a wrapper but not their nesting.
DEEPEST = 60

SLOT = ("#", "1", ())


# ---- wrappers: (label, quantifier, children) with quantifier 1, ?, + or * ------------------------


def _quant(optional: bool, repeated: bool) -> str:
    return "*" if optional and repeated else "+" if repeated else "?" if optional else "1"


def _with(node, optional: bool = False, repeated: bool = False):
    return (node[0], _quant(optional or node[1] in "?*", repeated or node[1] in "+*"), node[2])


def merge(a, b):
    """The wrapper of what `a` and `b`, of one label, admit."""
    if a == b:
        return a
    return (a[0], _quant(a[1] in "?*" or b[1] in "?*", a[1] in "+*" or b[1] in "+*"), align(a[2], b[2]))


def fold(parts) -> tuple:
    """Adjacent equal labels become one repeated part, adjacent equal groups of 2 to 4 one repeated group."""
    out: list = []
    for p in parts:
        if out and out[-1][0] == p[0]:
            out[-1] = _with(merge(out[-1], p), repeated=p[0] != "#")
        else:
            out.append(p)
    for w in (2, 3, 4):
        i = 0
        while i + 2 * w <= len(out):
            if [p[0] for p in out[i : i + w]] == [p[0] for p in out[i + w : i + 2 * w]]:
                group = [merge(x, y) for x, y in zip(out[i : i + w], out[i + w : i + 2 * w])]
                end = i + 2 * w
                while [p[0] for p in out[end : end + w]] == [p[0] for p in group]:
                    group = [merge(x, y) for x, y in zip(group, out[end : end + w])]
                    end += w
                out[i:end] = [("()", "+", tuple(group))]
            i += 1
    if len(out) > LONGEST:
        out = [("()", "*", loose(out))]
    return tuple(out)


def loose(parts) -> tuple:
    """One optional part for each label, in the order of labels; groups are opened."""
    by: dict = {}
    todo = list(parts)
    while todo:
        p = todo.pop()
        if p[0] == "()":
            todo.extend(p[2])
        else:
            by[p[0]] = merge(by[p[0]], p) if p[0] in by else p
    return tuple(_with(by[k], optional=True) for k in sorted(by))


def align(a: tuple, b: tuple) -> tuple:
    """Parts on a longest common subsequence of labels are merged, the others become optional."""
    if a == b:
        return a
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i][0] == b[j][0]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(_with(a[i], optional=True))
            i += 1
        else:
            out.append(_with(b[j], optional=True))
            j += 1
    out += [_with(p, optional=True) for p in (*a[i:], *b[j:])]
    return fold(out)


def blocks(text: str, toks: list[Token]) -> list[tuple[tuple, int, int]]:
    """`(wrapper, first token, last token)` of each top-level block."""
    partner: dict[int, int] = {}
    stack: list[int] = []
    for i, t in enumerate(toks):
        if t.part not in ("tag", "env", "wikitable") or t.label in VOID:
            continue
        if t.label[0] != "/":
            stack.append(i)
            continue
        for k in range(len(stack) - 1, -1, -1):
            if toks[stack[k]].label == t.label[1:]:
                partner[stack[k]] = i
                del stack[k:]
                break
    out = []
    i = 0
    while i < len(toks):
        j = partner.get(i, i)
        out.append((_shape(text, toks, partner, i), i, j))
        i = j + 1
    return out


def _shape(text: str, toks: list[Token], partner: dict[int, int], first: int) -> tuple:
    """Wrapper of the block that token `first` opens (iterative: nesting may be deep)."""
    frames: list[tuple[str, list, int]] = []
    i = first
    while True:
        t = toks[i]
        if i in partner and len(frames) < DEEPEST:
            frames.append((t.label, [], partner[i]))
        elif not frames:
            return (t.label, "1", ())
        else:
            frames[-1][1].append((t.label, "1", ()))
        after = i + 1
        while frames and frames[-1][2] == after:
            label, parts, close = frames.pop()
            if text[toks[after - 1].end : toks[after].start].strip():
                parts.append(SLOT)
            done = (label, "1", fold(parts) or (SLOT,))
            after = close + 1
            if not frames:
                return done
            frames[-1][1].append(done)
        if text[toks[after - 1].end : toks[after].start].strip():
            frames[-1][1].append(SLOT)
        i = after


def enclosing(toks: list[Token], unsure: list[Token]) -> list[tuple[str, ...]]:
    """Labels of the elements and environments around each unsure token, outermost first; `toks` are the sure ones."""
    out: list[tuple[str, ...]] = [()] * len(unsure)
    todo = sorted(range(len(unsure)), key=lambda k: unsure[k].start)
    closers: dict[int, int] = {}
    stack: list[int] = []
    for i, t in enumerate(toks):
        if t.part not in ("tag", "env", "wikitable") or t.label in VOID:
            continue
        if t.label[0] != "/":
            stack.append(i)
            continue
        for k in range(len(stack) - 1, -1, -1):
            if toks[stack[k]].label == t.label[1:]:
                closers[stack[k]] = i
                del stack[k:]
                break
    open_: list[int] = []
    i = 0
    for k in todo:
        while i < len(toks) and toks[i].start < unsure[k].start:
            if i in closers:
                open_.append(i)
            i += 1
        while open_ and toks[closers[open_[-1]]].start < unsure[k].start:
            open_.pop()
        out[k] = tuple(toks[o].label for o in open_ if toks[closers[o]].start > unsure[k].start)
    return out


def has_mark(wraps: dict, path: tuple[str, ...], label: str) -> bool:
    """Whether the wrapper of `path`'s outermost element has `label` directly below the path."""
    if not path or path[0] not in wraps:
        return False
    level = [wraps[path[0]]]
    for name in (*path[1:], label):
        below = []
        todo = [p for w in level for p in w[2]]
        while todo:
            p = todo.pop()
            if p[0] == "()":
                todo.extend(p[2])
            elif p[0] == name:
                below.append(p)
        level = below
    return bool(level)


def admits(wrapper: tuple, shape: tuple) -> bool:
    """Whether every part of `shape` lies under a parent that `wrapper` has it under."""
    if wrapper[0] != shape[0]:
        return False
    return all(_find(wrapper[2], p) for p in shape[2])


def _find(parts: tuple, p: tuple) -> bool:
    if p[0] == "()":
        return all(_find(parts, x) for x in p[2])
    return p[0] == "#" or any(_find(w[2], p) if w[0] == "()" else w[0] == p[0] and all(_find(w[2], x) for x in p[2]) for w in parts)


def repeated(wrapper: tuple, under: str = "") -> set[str]:
    """Labels that the wrapper repeats below another one, beyond the usual carriers of lists and tables."""
    out = set()
    for p in wrapper[2]:
        inner = p[2] if p[0] == "()" else (p,)
        if p[1] in "+*":
            out |= {x[0] for x in inner if x[0] != "#"}
        out |= repeated(p)
    return out


def _tuple(x):
    return (x[0], x[1], tuple(_tuple(c) for c in x[2]))


# ---- inference over a corpus ---------------------------------------------------------------------


def _wrap_scan(batches):
    """The shapes of a partition's blocks, each about once."""
    seen: set = set()
    for pdf in batches:
        rows = []
        for host, text in zip(pdf["host"], pdf["text"]):
            if not isinstance(text, str):
                continue
            host = host if isinstance(host, str) else None
            for w, _, _ in blocks(text, [t for t in tokens(text) if t.sure]):
                if (host, w) not in seen:
                    if len(seen) > 50_000:
                        seen.clear()
                    seen.add((host, w))
                    rows.append((host, w[0], json.dumps(w, separators=(",", ":"))))
        yield pd.DataFrame(rows, columns=["host", "root", "wrapper"], dtype=object)


def _wrap_merge(batches):
    """One wrapper for each run of rows of one host, root and part; rows come sorted."""
    at, own = None, None

    def row():
        host, root, part = at
        return pd.DataFrame({"host": pd.Series([host], dtype=object), "root": [root], "part": [part], "wrapper": [json.dumps(own, separators=(",", ":"))]})

    for pdf in batches:
        for host, root, part, w in zip(pdf["host"], pdf["root"], pdf["part"], pdf["wrapper"]):
            k = (host if isinstance(host, str) else None, root, int(part))
            w = _tuple(json.loads(w))
            if k != at:
                if at is not None:
                    yield row()
                at, own = k, w
            else:
                own = merge(own, w)
    if at is not None:
        yield row()


_SCHEMA = "host string, root string, wrapper string"


def hinted(records: DataFrame) -> DataFrame:
    """Records that can have markup at all; decided in the JVM, so that plain text never reaches Python."""
    return records.where(F.col("text").rlike(HINT))


def wrappers(records: DataFrame, salts: int = 16) -> DataFrame:
    """`host, root, wrapper` (JSON) inferred from all `records` (host, text), whatever their order."""
    shapes = hinted(records.select("host", "text")).mapInPandas(_wrap_scan, _SCHEMA).distinct()
    salted = shapes.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(salts)).cast("int"))
    first = wide(salted, "host", "root", "part").sortWithinPartitions("host", "root", "part", "wrapper").mapInPandas(_wrap_merge, _SCHEMA + ", part int")
    second = wide(first, "host", "root").sortWithinPartitions("host", "root", "part").withColumn("part", F.lit(0))
    return second.mapInPandas(_wrap_merge, _SCHEMA + ", part int").drop("part")


class Markup:
    """Records (place, record_key, host, text) read with the wrappers of their hosts."""

    def __init__(self, records: DataFrame, wraps: DataFrame):
        self.records, self.wraps = records.select("place", "record_key", "host", "text"), cut(wraps)

    def _read(self, fn, schema: str, source: DataFrame) -> DataFrame:
        """`fn(place, key, text, wrappers of the host)` over `source`; rows as tuples of `schema`."""
        per = self.wraps.groupBy("host").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("root", "wrapper")))).alias("w"))
        size = self.wraps.agg(F.coalesce(F.sum(F.length("wrapper") + 64), F.lit(0))).first()[0]
        held = None
        if size <= BROADCAST_CHARS:
            held = self.records.sparkSession.sparkContext.broadcast({r["host"]: r["w"] for r in per.collect()})
            rows = source.select("place", "record_key", "host", "text")
        else:
            rows = source.join(per.withColumnRenamed("host", "_h"), F.col("host").eqNullSafe(F.col("_h")), "left").select("place", "record_key", "host", "text", "w")
        names = [c.split()[0] for c in schema.split(",")]

        def run(batches):
            known: dict = {}
            for pdf in batches:
                out = []
                given = pdf["w"] if "w" in pdf else [None] * len(pdf)
                for place, key, host, text, w in zip(pdf["place"], pdf["record_key"], pdf["host"], pdf["text"], given):
                    if not isinstance(text, str):
                        out.extend(fn(place, key, None, {}))
                        continue
                    host = host if isinstance(host, str) else None
                    if host not in known:
                        if len(known) > 1000:
                            known.clear()
                        raw = held.value.get(host) if held else w if isinstance(w, str) else None
                        known[host] = {k: _tuple(json.loads(v)) for k, v in json.loads(raw).items()} if raw else {}
                    out.extend(fn(place, key, text, known[host]))
                yield pd.DataFrame(out, columns=names, dtype=object)

        return rows.mapInPandas(run, schema)

    def found(self) -> DataFrame:
        """`place, record_key, markup`: the kinds of markup of each record, distinct."""

        def kinds(place, key, text, wraps):
            return [(place, key, k) for k in sorted({t.kind for t in reading(text, wraps)})]

        return self._read(kinds, "place string, record_key string, markup string", hinted(self.records)).distinct()

    def cleaned(self) -> DataFrame:
        """`place, record_key, clean_text` for every record; text without markup only loses blank edges."""

        def tidy(place, key, text, wraps):
            if text is None:
                return [(place, key, None)]
            apart = set().union(*(repeated(w) for w in wraps.values())) if wraps else set()
            return [(place, key, clean(text, apart, reading(text, wraps)))]

        return self._read(tidy, "place string, record_key string, clean_text string", self.records)


def reading(text: str | None, wraps: dict) -> list[Token]:
    """The tokens of a text that are markup by its host's wrappers, in order."""
    toks = tokens(text) if text else []
    sure, unsure = [t for t in toks if t.sure], [t for t in toks if not t.sure]
    out: list[Token] = []
    for shape, i, j in blocks(text, sure) if sure else []:
        if shape[0] in wraps and admits(wraps[shape[0]], shape):
            out += sure[i : j + 1]
    if unsure:
        out += [t for t, path in zip(unsure, enclosing(sure, unsure)) if has_mark(wraps, path, t.label)]
        out.sort(key=lambda t: t.start)
    return out


# ---- clean text ------------------------------------------------------------------------------------

_SECTION = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5}
_BLOCK = frozenset("p div section article aside header footer main figure figcaption blockquote address form fieldset dl dt dd center hr body html caption details summary".split())
_DROP = frozenset("script style template noscript".split())
#: LaTeX commands whose argument is no text (fixed values).
_NOTEXT = frozenset("ref label cite eqref pageref vspace hspace includegraphics usepackage documentclass bibliography bibliographystyle input".split())
_ARGS = re.compile(r"\s*(?:\[[^\]\n]*\])?\{((?:[^{}]|\{[^{}]*\})*)\}")


def _inner(s: str, mark: int) -> str:
    return s[mark:-mark]


def clean(text: str, apart: set[str] = frozenset(), toks: list[Token] | None = None) -> str:
    """Clean text of one record; `apart` names neutral elements that the host's wrappers repeat, `toks` its markup."""
    if toks is None:
        toks = [t for t in tokens(text) if t.sure]
    out: list[str] = []
    cur = 0
    pre = 0
    cell = False
    lists: list[list] = []
    for k, t in enumerate(toks):
        if t.start < cur:
            continue
        out.append(text[cur : t.start])
        s = text[t.start : t.end]
        cur = t.end
        name = t.label.lstrip("/")
        closing = t.label.startswith("/")
        if t.part == "tag":
            if name in _DROP and not closing:
                end = text.lower().find(f"</{name}", cur)
                cur = end if end >= 0 else cur
            elif len(name) == 2 and name[0] == "h" and name[1].isdigit():
                out.append("\n\n" if closing else "\n\n" + "#" * int(name[1]) + " ")
            elif name == "pre":
                pre = max(0, pre + (-1 if closing else 1))
                out.append("\n```\n")
            elif name == "code":
                out.append("" if pre else "`")
            elif name in ("ul", "ol", "menu", "dir"):
                if closing and lists:
                    lists.pop()
                elif not closing:
                    lists.append([name, 0])
                out.append("\n")
            elif name == "li" and not closing:
                if lists:
                    lists[-1][1] += 1
                out.append(f"\n{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "\n- ")
            elif name == "table":
                out.append("\n\n")
            elif name == "tr":
                cell = False
                out.append("" if closing else "\n")
            elif name in ("td", "th"):
                if not closing:
                    out.append(" | " if cell else "")
                    cell = True
            elif name == "br":
                out.append(" " if cell else "\n")
            elif name == "img":
                alt = re.search(r"""\balt\s*=\s*(?:"([^"]*)"|'([^']*)')""", s)
                out.append((alt.group(1) or alt.group(2) or "") if alt else "")
            elif name in _BLOCK or name in apart and name not in ("b", "i", "em", "strong", "a", "sup", "sub"):
                out.append("\n" if cell is False else " ")
        elif t.part == "entity":
            out.append(_html.unescape(s))
        elif t.part == "heading":
            out.append("#" * s.count("#"))
        elif t.part == "rule":
            cur = min(len(text), cur + 1)  # with its line feed
        elif t.part == "link":
            out.append(s[s.index("[") + 1 : s.rindex("](")])
        elif t.part == "strong":
            out.append(_inner(s, 2))
        elif t.part in ("code", "fence", "inline", "display", "script"):
            out.append(s)
        elif t.part == "verbatim":
            out.append("```\n" + re.sub(r"^\\begin\{\w+\*?\}(?:\[[^\]]*\])?\n?|\n?\\end\{\w+\*?\}$", "", s) + "\n```")
        elif t.part == "wikihead":
            body = s.strip()
            n = len(body) - len(body.lstrip("="))
            out.append("#" * n + " " + body.strip("= \t"))
        elif t.part == "quotes":
            out.append(s.strip("'"))
        elif t.part == "wikilink":
            body = s[2:-2]
            out.append("" if re.match(r"(?i)(file|image|category|datei|bild|fichier):", body) else body.split("|")[-1])
        elif t.part == "template":
            out.append(" ".join(a.split("=", 1)[-1].strip() for a in s[2:-2].split("|")[1:]))
        elif t.part == "env":
            out.append("")
        elif t.part == "command":
            cmd = s[1:].rstrip("*")
            if cmd == "item":
                out.append("- " if text[: t.start].rstrip(" \t").endswith("\n") or t.start == 0 else "\n- ")
                cur += len(text[cur:]) - len(text[cur:].lstrip(" \t"))
            elif m := _ARGS.match(text, cur):
                cur = m.end()
                if cmd in _SECTION:
                    out.append("\n\n" + "#" * _SECTION[cmd] + " " + clean(m.group(1)) + "\n\n")
                elif cmd not in _NOTEXT:
                    out.append(clean(m.group(1)))
            else:
                out.append("")
    out.append(text[cur:])
    return _tidy("".join(out), any(t.label == "wikitable" for t in toks), any(t.part == "rule" for t in toks), any(t.kind == "latex" for t in toks))


def _tidy(s: str, wikitable: bool, rule: bool, latex: bool) -> str:
    lines, fenced, again = [], False, False
    for line in s.split("\n"):
        if line.strip().startswith("```"):
            fenced = not fenced
        elif not fenced:
            if wikitable and re.match(r"[ \t]*(\|-|[|!])", line):
                line = "" if re.match(r"[ \t]*\|-", line) else re.sub(r"[ \t]*(?:\|\||!!)[ \t]*", " | ", line.strip().lstrip("|!").strip())
                if not line:
                    continue
            elif rule and line.strip().startswith("|"):
                line = line.strip().strip("|").strip()
                line = re.sub(r"[ \t]*\|[ \t]*", " | ", line)
            if latex:
                line = re.sub(r"(?<!\\)~", " ", line)
            line = re.sub(r"[ \t ]+", " ", line).strip()
        blank = not line.strip()
        if not (blank and again):
            lines.append(line)
        again = blank and not fenced
    return "\n".join(lines).strip()
