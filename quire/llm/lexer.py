"""Markup tokens of a text: HTML, Markdown, wiki and LaTeX, told apart from text that only looks alike.

What a token's own line cannot settle (quote marks beside quoted literals, backslashes within a path, a table rule
without a header) is left unsure, for the wrappers of the text's host to decide."""

from __future__ import annotations

import re
from html.entities import html5
from typing import NamedTuple

#: Names of HTML elements, current and obsolete (fixed values).
ELEMENTS = frozenset(
    """a abbr acronym address applet area article aside audio b base basefont bdi bdo big blink blockquote
    body br button canvas caption center cite code col colgroup data datalist dd del details dfn dialog dir
    div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head
    header hgroup hr html i iframe img input ins kbd label legend li link main map mark marquee menu meta
    meter nav nobr noframes noscript object ol optgroup option output p param picture pre progress q rb rp
    rt ruby s samp script section select slot small source span strike strong style sub summary sup svg
    table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr""".split()
)
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
#: LaTeX environments whose body is code, and those whose body is a formula (fixed values).
CODE_ENV, MATH_ENV = "verbatim|lstlisting|alltt|minted", "equation|align|aligned|gather|multline|eqnarray|displaymath|math|cases"

_ATTR = r"""(?:\s+[A-Za-z_:@][\w:.\-]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>`]+))?)*"""
_PARTS = {
    "fence": r"^[ \t]*```[^`\n]*\n(?:[\s\S]*?\n)?[ \t]*```[ \t]*$",
    "comment": r"<!--[\s\S]*?-->|<![Dd][Oo][Cc][Tt][Yy][Pp][Ee][^>]*>",
    "verbatim": rf"\\begin\{{(?:{CODE_ENV})\*?\}}[\s\S]*?\\end\{{(?:{CODE_ENV})\*?\}}",
    "display": rf"\\begin\{{(?:{MATH_ENV})\*?\}}[\s\S]*?\\end\{{(?:{MATH_ENV})\*?\}}|\$\$[^$]+\$\$|\\\[[\s\S]*?\\\]",
    "inline": r"\\\([\s\S]*?\\\)|(?<![\\$\w])\$(?=[^\s$])(?:[^$\n\\]|\\.)*?(?<=[^\s$])\$(?![\d$])",
    "env": r"\\(?:begin|end)\{[A-Za-z]+\*?\}",
    "command": r"\\[A-Za-z]{2,}\*?|\\[A-Za-z](?=\{)",
    "script": r"[_^]\{[^{}\n]*\}",
    "tag": rf"</?[A-Za-z][A-Za-z0-9]*{_ATTR}\s*/?>",
    "entity": r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});",
    "heading": r"^[ \t]{0,3}#{1,6}(?=[ \t]+\S)",
    "rule": r"^[ \t]*\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)+\|?[ \t]*$|^[ \t]*\|[ \t]*:?-{2,}:?[ \t]*\|[ \t]*$",
    "link": r"!?\[[^\]\n\[]*\]\([^()\s]+(?:[ \t]+\"[^\"\n]*\")?\)",
    "strong": r"(?<![\w*])\*\*(?=[^\s*])(?:[^*\n]|\*(?!\*))*?(?<=[^\s*])\*\*(?![\w*])",
    "code": r"(?<!`)``(?!`)[^\n]+?(?<!`)``(?!`)|(?<![`\w])`(?!`)[^`\n]+`(?!`)",
    "wikihead": r"^[ \t]*(?P<eqs>={2,6})[ \t]*[^=\s](?:[^=\n]*[^=\s])?[ \t]*(?P=eqs)[ \t]*$",
    "quotes": r"(?<!')'{2,5}(?=[^\s'])[^\n]*?(?<=[^\s'])'{2,5}(?!')",
    "wikilink": r"\[\[[^\[\]\n]+\]\]",
    "template": r"\{\{[^{}]+\}\}",
    "wikitable": r"^[ \t]*\{\|[^\n]*$|^[ \t]*\|\}[ \t]*$",
}
#: Any first character a token can have; most positions of a text fail here.
_FIRST = r"(?=[<&\\$_^#|:!\[*`='{ \t\-])"
MASTER = re.compile(_FIRST + "(?:" + "|".join(f"(?P<{k}>{v})" for k, v in _PARTS.items()) + ")", re.M)

KIND = {
    "comment": "html", "tag": "html", "entity": "html",
    "fence": "markdown", "heading": "markdown", "rule": "markdown", "link": "markdown", "strong": "markdown", "code": "markdown",
    "wikihead": "wiki", "quotes": "wiki", "wikilink": "wiki", "template": "wiki", "wikitable": "wiki",
    "verbatim": "latex", "display": "latex", "inline": "latex", "env": "latex", "command": "latex", "script": "latex",
}

#: What a text must contain to have any token at all; cheap enough for a whole corpus (Java regex).
HINT = r"(?m)<[!/A-Za-z]|&[#A-Za-z]|^[ \t]{0,3}#|\*\*|`|\]\(|^[ \t]*==|''|\[\[|\{\{|\{\||^[ \t]*\|\}|\\[A-Za-z(\[]|\$|[_^]\{|\|[ \t]*:?-+:?[ \t]*\||-:?[ \t]*\|[ \t]*:?-"

_LITERAL = re.compile(r"(?<![\w'])'[^\s'][^'\n]*'(?![\w'])")
_DRIVE = re.compile(r"(?:^|[^\w\\])(?:[A-Za-z]:|\\\\\w[\w.\-]*)(?:\\[^\s\\]*)*$")
_NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9]*)")


class Token(NamedTuple):
    part: str
    kind: str
    label: str  # opening `x`, closing `/x`, or a single mark
    start: int
    end: int
    sure: bool = True  # False: only a wrapper of its host can tell that it is markup


def _label(part: str, s: str) -> str | None:
    """Label of a match, or None where it is no markup after all."""
    if part == "tag":
        name = _NAME.match(s, 1).group(1).lower()
        if name not in ELEMENTS:
            return None
        return "/" + name if s[1] == "/" else name
    if part == "entity":
        return "entity" if s[1] == "#" or s[1:] in html5 else None
    if part == "env":
        return ("/" if s.startswith("\\end") else "") + "env:" + s[s.index("{") + 1 : -1].rstrip("*")
    if part == "wikitable":
        return "/wikitable" if s.strip() == "|}" else "wikitable"
    if part == "heading":
        return "h" + str(s.count("#"))
    return part


def tokens(text: str) -> list[Token]:
    """All markup tokens in order, sure or not.  Inside pre and code elements only HTML counts."""
    out: list[Token] = []
    raw = 0
    at = 0
    match = MASTER.search
    low = text.lower()
    while m := match(text, at):
        part, s, e = m.lastgroup, m.start(), m.end()
        if part == "eqs":
            part = "wikihead"
        at = e if e > s else e + 1
        sure = not (part == "command" and _DRIVE.search(text[max(0, s - 300) : s]))  # else a step of a file path
        label = _label(part, m.group())
        if label is None:
            at = s + 1
            continue
        if raw and KIND[part] != "html":
            at = s + 1
            continue
        if part == "rule" and "|" not in text[text.rfind("\n", 0, max(s - 1, 0)) + 1 : max(s - 1, 0)]:
            sure = False
        if part == "quotes" and not m.group().startswith("'''"):
            a, b = text.rfind("\n", 0, s) + 1, text.find("\n", e)
            line = text[a : b if b >= 0 else len(text)]
            if _LITERAL.search(line.replace(m.group(), " ")):
                sure = False  # quoted literals of program text
        if label in ("pre", "code") and part == "tag" and low.find(f"</{label}", e) >= 0:
            raw += 1
        elif label in ("/pre", "/code") and raw:
            raw -= 1
        out.append(Token(part, KIND[part], label, s, e, sure))
    return out


def kinds(text: str | None) -> set[str]:
    """Kinds of the tokens that need no wrapper."""
    return {t.kind for t in tokens(text) if t.sure} if text else set()
