import pytest

from quire.llm import markup as M
from quire.llm.lexer import kinds, tokens

CASES = [
    ("a <b>x</b> c", {"html"}), ("x<br/>y", {"html"}), ("stray </span> tag", {"html"}), ("<!-- note -->", {"html"}), ("R&amp;D &#176; &nbsp;", {"html"}), ('<td colspan="2">9', {"html"}),
    ("Write <addr> to it", set()), ("if (x == 40 && y != 0) on {0..7}", set()), ("R&D costs &c.", set()), ("a < b and c > d", set()),
    ("# Title", {"markdown"}), ("C# and F#", set()), ("Item #7", set()), ("is **bold** here", {"markdown"}), ("2**10 to its length", set()), ("2**10 and 3**4", set()), ("`x_y`", {"markdown"}), ("```c\nint x;\n```", {"markdown"}),
    ("see [a](#b)", {"markdown"}), ("![a](i.png)", {"markdown"}), ("see [3] and (4)", set()), ("| a | b |\n|:--|:-:|\n| 1 | 2 |", {"markdown"}), ("a | b\nc | d", set()), ("- item\n* item", set()),
    ("== Head ==", {"wiki"}), ("Head\n============", set()), ("'''bold''' word", {"wiki"}), ("an ''italic'' word", {"wiki"}), ("Call it 'default' or ''none''", set()), ("[[A|b]]", {"wiki"}), ("{{unit|5|kB}}", {"wiki"}), ("{| class=x\n|-\n| a || b\n|}", {"wiki"}),
    (r"\textbf{x}", {"latex"}), ("$f = 3$", {"latex"}), ("costs $5 and its spare $7 per", set()), (r"\( a \)", {"latex"}), ("10^{7}", {"latex"}), ("x_{in}", {"latex"}), (r"copy to D:\fw\boot now", set()), (r"\begin{equation}x\end{equation}", {"latex"}), ("cfg_mask = 0x1F0 | 0x20", set()),
    (None, set()), ("", set()), (" \n", set()),
]


@pytest.mark.parametrize("text,want", CASES)
def test_kinds(text, want):
    assert kinds(text) == want


def records(spark, rows):
    return spark.createDataFrame([("p", str(i), h, t, "x") for i, (h, t) in enumerate(rows)], "place string, record_key string, host string, text string, markup string")


def test_operator_finds_what_the_lexer_finds(spark):
    rec = records(spark, [("h" if i % 2 else None, t) for i, (t, _) in enumerate(CASES)])
    m = M.Markup(rec, M.wrappers(rec))
    got = {}
    for r in m.found().collect():
        got.setdefault(int(r.record_key), set()).add(r.markup)
    assert got == {i: w for i, (_, w) in enumerate(CASES) if w}
    clean = {int(r.record_key): r.clean_text for r in m.cleaned().collect()}
    assert len(clean) == len(CASES) and clean[len(CASES) - 3] is None and clean[len(CASES) - 2] == ""


#: Records of two hosts; the last of each is markup only if other records of its host have the like at that place.
UNSURE = [
    ("a", "<ul><li>an ''outer'' ring</li><li>plain</li></ul>"), ("a", "<ul><li>the ''inner'' ring</li></ul>"), ("a", "<ul><li>the ''middle'' ring is 'set' by hand</li></ul>"),
    ("b", "<ul><li>an outer ring</li></ul>"), ("b", "<ul><li>the ''middle'' ring is 'set' by hand</li></ul>"), ("a", "the ''middle'' ring is 'set' by hand"),
    ("c", "<div>\n|a|b|\n|---|---|\n</div>"), ("c", "<div>\nx\n|---|---|\n</div>"), ("d", "<div>\nx\n|---|---|\n</div>"),
]


def test_wrappers_decide_what_the_lexer_leaves_open(spark):
    rec = records(spark, UNSURE)

    def found(wraps):
        got = {i: set() for i in range(len(UNSURE))}
        for r in M.Markup(rec, wraps).found().collect():
            got[int(r.record_key)].add(r.markup)
        return got

    wraps = M.wrappers(rec)
    got = found(wraps)
    assert [("wiki" in got[i], "markdown" in got[i]) for i in range(len(UNSURE))] == [(True, False)] * 3 + [(False, False)] * 3 + [(False, True)] * 2 + [(False, False)]
    # without wrappers the cases are lost, and so is all that they admit
    assert not any(found(wraps.limit(0)).values())
    assert "wiki" not in found(wraps.where("host <> 'a'"))[2]


def test_wrappers_do_not_depend_on_order(spark):
    texts = [f"<div><{a}>x</{a}><{b}>y</{b}>{c}</div>" for a in ("p", "b", "i") for b in ("p", "em", "h1") for c in ("", "<br>", "<hr><br>")]
    rows = [("h", t) for t in texts]
    one = {(r.host, r.root, r.wrapper) for r in M.wrappers(records(spark, rows).repartition(7)).collect()}
    other = {(r.host, r.root, r.wrapper) for r in M.wrappers(records(spark, rows[::-1]).coalesce(1)).collect()}
    assert one == other and len(one) == 1


def test_hint_lets_every_text_with_tokens_through(spark):
    # a text of each part of the lexer alone
    alone = [
        "```\nx\n```", "<!-- x -->", "<!doctype html>", r"\begin{minted}x\end{minted}", r"\begin{cases}x\end{cases}", "$$x$$", r"\[x\]", r"\(x\)", "$x$", r"\begin{x}", r"\end{x}", r"\ab", r"\v{x}", "_{x}", "^{x}",
        "<p>", "</p>", "&amp;", "&#9;", "   # x", "a|b\n-|-", "a|b\n| :--: |", "[a](b)", "![](b)", "**x**", "`x`", "``x``", "\t== x ==", "''x''", "[[x]]", "{{x}}", " {| x", "| a || b\n|}", "x\n \t|} ",
    ]
    texts = alone + [t for t, _ in CASES if t]
    rec = records(spark, [("h", t) for t in texts])
    through = {r.text for r in M.hinted(rec).collect()}
    assert all(tokens(t) for t in alone) and {t for t in texts if tokens(t)} <= through
    got = {r.record_key: r.markup for r in M.Markup(rec, M.wrappers(rec)).found().where("markup = 'wiki'").collect()}
    assert got[str(texts.index("| a || b\n|}"))] == "wiki"


def test_wrappers_generalise():
    def wrapper(*texts):
        w = None
        for t in texts:
            (b, _, _), *_ = M.blocks(t, tokens(t))
            w = b if w is None else M.merge(w, b)
        return w

    w = wrapper("<ul><li>a</li><li>b</li></ul>", "<ul><li>a <b>x</b></li></ul>")
    assert w == ("ul", "1", (("li", "+", (("#", "1", ()), ("b", "?", (("#", "1", ()),)))),))
    t = wrapper("<table><tr><th>a</th></tr><tr><td>1</td><td>2</td></tr></table>", "<table><tr><td>1</td></tr></table>")
    assert t[2][0][1] == "+" and {c[0] for c in t[2][0][2]} == {"th", "td"}
    g = wrapper("<dl>" + "<dt>a</dt><dd>b</dd>" * 5 + "</dl>")
    assert g[2] == (("()", "+", (("dt", "1", (("#", "1", ()),)), ("dd", "1", (("#", "1", ()),)))),)
    odd = wrapper("<div>" + "".join(f"<{x}>a</{x}>" for x in ["p", "b", "i", "u", "a"] * 3 + ["em", "h1", "p", "b", "h2"] * 20) + "</div>")
    assert len(odd[2]) <= M.LONGEST


def test_deep_and_long_texts(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    long = "<p>" + "word " * 60_000 + "</p>"
    rec = records(spark, [("h", deep), ("h", long)])
    m = M.Markup(rec, M.wrappers(rec))
    assert {r.markup for r in m.found().collect()} == {"html"}
    clean = [r.clean_text for r in m.cleaned().collect()]
    assert {len(c.split()) for c in clean} == {1, 60_000}


@pytest.mark.parametrize("text,want", [
    ("<h2>Head</h2><p>Some &lt;text&gt;</p><ul><li>a<li>b</ul>", "## Head\n\nSome <text>\n\n- a\n- b"),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2<br>3</td></tr></table>", "a | b\n1 | 2 3"),
    ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"), ("<pre><code>x = 1\n  y</code></pre>", "```\nx = 1\n  y\n```"),
    ("see [link](u) **b** `c`", "see link b `c`"), ("| a | b |\n|---|---|\n| 1 | 2 |", "a | b\n1 | 2"), ("=== H ===\n'''x''' [[A|b]] {{unit|5|kB}}", "### H\nx b 5 kB"),
    ("{| class=x\n! a !! b\n|-\n| 1 || 2\n|}", "a | b\n1 | 2"), (r"\section{H} \emph{x}~\ref{y} $a_{1}$", "## H\n\nx $a_{1}$"),
    ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", "- a\n- b"), ("\\begin{verbatim}\nx=1\n\\end{verbatim}", "```\nx=1\n```"), ("plain text", "plain text"),
])
def test_clean(text, want):
    assert M.clean(text) == want
