import random

from quire.llm import editor as E
from quire.llm import scan as S

NOUNS = "connector bandwidth terminal controller impedance register harness luminance oscillator bracket spindle firmware journal detector humidity attenuation".split()
MORE = """window supply clearance valve battery vertical wireless mechanical cylinder module interrupt recorder keyboard membrane turbidity fixture
gearbox frequency headroom backplane schedule quickly brightness delivery circuit drawing white switch hollow click clamp clutch bundle burner turning morning
kernel hybrid number chamber bubble quality request square zero fuzzy zone horizon grip single length rising tilted list filter silicon hinge shield limit alignment
cluster include close cyclic recycle handle ladder middle vacuum skiing radii continuum""".split()
VERBS = "measures reduces monitors suspends protects enables schedules restores".split()


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    return [" ".join(f"the {rng.choice(NOUNS)} {rng.choice(VERBS)} the stand-alone {rng.choice(NOUNS)}." for _ in range(6)) for _ in range(n)]


def pages(n=80, seed=4):
    """Documents whose title interrupts sentences, and headings of like typography that stand between paragraphs."""
    rng = random.Random(seed)
    cap = lambda: rng.choice(NOUNS).title()
    say = lambda: f"the {rng.choice(NOUNS)} {rng.choice(VERBS)} the {rng.choice(NOUNS)}"
    out = []
    for i in range(n):
        title = f"Velmar {cap()} {cap()} Book"
        out.append((f"pg{i}", f"pages{i}", title, f"{say()} and then\n{title}\n{say()}.\n\n{cap()} {cap()} {cap()} Part\nThe last {say()}. {say()}."))
    return out


def records(spark, texts, title="Hovnar X12AB Service Manual"):
    rows = [("p", f"bg{i}", "other_00000000", None, t) for i, t in enumerate(corpus())] + [("p", k, d, n, t) for k, d, n, t in pages()] + [("p", k, "doc_1", title, t) for k, t in texts.items()]
    df = spark.createDataFrame(rows, "place string, record_key string, doc_id string, title string, text string")
    return df.selectExpr("*", "1 as page_no", "cast(null as double) as top", "cast(null as double) as bottom", "cast(null as int) as edge", "'clash' as kind")


NOISY = {
    "broken": ("the con-\nnector measures the bandwidth", {"broken_word"}),
    "soft": ("the imped­\nance reduces the bandwidth", {"broken_word"}),
    "over": ("the lumi-\nPage 4\nnance reduces the bandwidth", {"broken_word", "page_number"}),
    "compound": ("the register enables the stand-\nalone harness", set()),
    "misread": ("the bandwidtb measures the terrninal", {"misread"}),
    "digit": ("the c0ntroller measures the humidity", {"misread"}),
    "spaced": ("the d e t e c t\no r measures the humidity", {"misread"}),
    "page": ("the detector measures\n— 12 —\nthe humidity", {"page_number"}),
    "roman": ("xiv\nthe detector measures the humidity", {"page_number"}),
    "running": ("the detector measures\nHovnar X12AB Service Manual, issue 3\nthe humidity", {"running_line"}),
    "ocr_head": ("HOVNAR X12AB SERVlCE MANUAL | 4\nthe detector measures the humidity".replace("l", "1", 1), {"running_line"}),
    # a line of the document alone, no title: furniture where it interrupts sentences, text where it is a heading
    "chapter1": ("the connector measures the bandwidth and\nChapter Four Safety Notes\nthe humidity.", {"running_line"}),
    "chapter2": ("the register enables the harness and\nChapter Four Safety Notes\nthe journal.", {"running_line"}),
    "heading1": ("the connector measures the bandwidth.\n\nMounting And Safety Part\nThe spindle reduces the humidity.", set()),
    "heading2": ("the register enables the harness.\n\nMounting And Safety Part\nThe firmware suspends the journal.", set()),
    "column": ("the values are\n12\n15\n22\n40\nin this order", set()),
    "twice": ("the 1uminarice is here", {"misread"}),
    "plain": ("the detector measures the humidity", set()),
    "code": ("see `c0ntroller` and <a href=terrninal>detector</a>", set()),
    "null": (None, set()),
    "empty": ("", set()),
    "blank": (" \n ", set()),
}


PLAIN = {k: v[0] for k, v in NOISY.items()}


def read(found):
    got = {k: set() for k in NOISY}
    for r in found.collect():
        if r.record_key in got:
            got[r.record_key].add(r.kind)
        else:
            assert r.record_key.startswith("pg") and r.kind == "running_line", r
    return got


def test_kinds_and_repair(spark):
    s = S.Scanned(records(spark, PLAIN))
    want = {k: v[1] for k, v in NOISY.items()}
    assert read(s.found()) == want
    text = {r.record_key: r.clean_text for r in s.repaired().collect()}
    assert text["over"] == "the luminance reduces the bandwidth"
    assert text["misread"] == "the bandwidth measures the terminal" and text["twice"] == "the luminance is here"
    assert text["spaced"].startswith("the detector measures") and text["running"] == "the detector measures the humidity"
    assert text["null"] is None and text["empty"] == "" and len(text) == len(NOISY) + 480

    # verdicts beyond the bound are joined to their records instead
    s.broadcast_bytes = 0
    assert read(s.found()) == want
    s.broadcast_bytes = 1 << 20

    # each step decides: without it, cases are lost
    def lost(kinds):
        got = read(s.found())
        return {k for k in want if want[k] & kinds and not got[k] & kinds}

    place = {f: i for f, i in s.lines.index.items() if f.startswith("P")}
    kept = s.lines.weights.copy()
    for i in place.values():
        s.lines.weights[i] = 0
    got = read(s.found())
    assert any(got[k] != want[k] for k in ("chapter1", "chapter2", "heading1", "heading2"))
    s.lines.weights = kept
    moves = s.editor.moves.weights.copy()
    s.editor.moves.weights[:] = 0
    assert lost({"misread"}) >= {"misread", "digit", "twice"} and lost({"broken_word"}) == {"broken", "soft", "over"}
    s.editor.moves.weights = moves
    s.editor.allowed = {}
    assert lost({"misread"}) >= {"misread", "digit", "twice"}


def test_held_out_accuracy():
    """Words that neither the labels nor the decisions were trained on, damaged; all words have counts as a corpus gives them."""
    rng = random.Random(5)
    words = sorted({w for t in corpus() for w in S.WORD.findall(t)} | set(MORE))
    held = [w for w in words if len(w) >= 6][::3]
    counts = lambda w: 500 if w in words else 0
    taught = [w for w in words if w not in held and len(w) >= 4]
    ed = E.train_chars(taught, rng)
    moves, ends, _ = E.wanted_counts(ed, taught, ["stand-alone"], lambda w: w in taught, rng)
    ed = E.train_moves(ed, moves, ends, counts, rng)

    def correct(w):
        best = max(((ed.accepts(E.edit_features(w, counts(w), counts(o), c, n)), o) for o, c, n in ed.proposals(w, lambda x: x in words)), default=(0, None))
        return best[1] if best[0] > 0 else None

    tried = [(E.damage(w, rng, t)[0], w) for w in held for t in (1, 1, 1, 2) for _ in range(6)]
    tried = [(r, w) for r, w in tried if r != w and r not in words]
    right = sum(correct(r) == w for r, w in tried)
    assert len(tried) > 50 and right / len(tried) >= 0.9
    assert all(correct(w) is None for w in words)


def test_damage_and_labels_agree():
    rng = random.Random(1)
    for w in [*NOUNS, *VERBS]:
        for times in (1, 2, 3):
            read_, labels = E.damage(w, rng, times)
            undone = "".join("" if g == E.DELETE else c if g == E.KEEP else c + g[1:] if g[0] == "+" else g[1:] for c, g in zip(read_, labels))
            assert len(labels) == len(read_) and undone == w


def test_page_number_styles():
    for s in "7|Page 7|PAGE 7|p. 7|- 7 -|— 7 —|• 7 •|[7]|7 / 9|Page 7 of 9|3-4|A-7|xiv|  12".split("|"):
        assert S.PAGE_NUMBER.match(s.strip()), s
    for s in "7 V.|12 mm|```c|BR-12.|x = 7|Page of notes|7.5 kB|I agree|GH-3721|MIX".split("|"):
        assert not S.PAGE_NUMBER.match(s), s


def test_empty(spark):
    s = S.Scanned(records(spark, {}).limit(0))
    assert s.found().count() == 0 and s.repaired().count() == 0
