import random
import sys
import unicodedata
from itertools import combinations

import numpy as np
import pytest

from quire.llm import neardup as N
from quire.llm.shingle import WORD, shingles


def test_words_are_letters_and_numbers():
    for cp in range(0, sys.maxunicode + 1):
        c = chr(cp)
        if unicodedata.category(c) in ("Cs", "Cn"):
            continue
        assert bool(WORD.fullmatch(c)) == (unicodedata.category(c)[0] in "LN"), hex(cp)


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(n):
        if i and rng.random() < 0.5:
            words = texts[rng.randrange(i)].split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        else:
            words = [rng.choice(vocab) for _ in range(rng.randint(18, 60))]
        texts[i] = " ".join(words)
    return texts


def brute(texts, width, num, den, min_words):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.lower()) if t else []
        if len(w) >= max(min_words, width):
            sets[i] = frozenset(zip(*[w[k:] for k in range(width)]))
    return {(a, b) for a, b in combinations(sorted(sets), 2) if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])}


@pytest.mark.parametrize("width,num,den", [(3, 3, 5), (5, 4, 5), (2, 1, 2)])
def test_join_finds_what_brute_force_finds(spark, width, num, den):
    texts = corpus()
    rows = [(i, t, "x") for i, t in texts.items()] + [(900, None, "x"), (901, "", "x"), (902, "too short", "x"), (0, texts[0], "again")]
    df = spark.createDataFrame(rows, "id int, text string, fp string").repartition(5)
    found = N.near_duplicates(df, "id", "text", width, num, den, 20)
    got = {(r.id_a, r.id_b) for r in N.spelled_pairs(found).collect()}
    want = brute(texts, width, num, den, 20)
    assert want and got == want


def test_large_classes_become_stars_and_lose_no_link(spark):
    base = " ".join(f"word{i}" for i in range(30))
    near = base.replace("word29", "other")
    rows = [(f"c{i:03}", base) for i in range(80)] + [("n1", near), ("n2", near)]
    found = N.near_duplicates(spark.createDataFrame(rows, "id string, text string"), "id", "text", 3, 3, 5, 20)
    got = {(r.id_a, r.id_b) for r in N.spelled_pairs(found).collect()}
    assert {("c000", f"c{i:03}") for i in range(1, 80)} | {("c000", "n1"), ("c000", "n2"), ("n1", "n2")} == got
    g = {r.id: (r.group_id, r.links) for r in N.groups(found).collect()}
    assert {v[0] for v in g.values()} == {"c000"} and g["n1"][1] == 81 and g["c000"][1] == 81


def test_large_classes_of_different_texts_keep_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(N, "PART", 16)
    words = [f"word{i}" for i in range(30)]
    texts = {f"v{i:03}": " ".join(words[:i % 29 + 1]) + [" - ", "\n", ". "][i % 3] + " ".join(words[i % 29 + 1 :]) for i in range(87)}
    assert len(set(texts.values())) == 87
    texts |= {f"x{i}": " ".join(words[:-1] + ["other"]) for i in range(3)}
    found = N.near_duplicates(spark.createDataFrame(list(texts.items()), "id string, text string"), "id", "text", 3, 3, 5, 20)
    for spelled in (None, N.SPELLED):
        got = [(r.id_a, r.id_b) for r in N.spelled_pairs(found, spelled).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(texts, 3, 3, 5, 20)


def test_all_pairs_of_copies_and_memberships(spark):
    base = " ".join(f"word{i}" for i in range(30))
    texts = {f"c{i:03}": base for i in range(80)} | {"d1": base.upper(), "n1": base.replace("word29", "other")}
    found = N.near_duplicates(spark.createDataFrame(list(texts.items()), "id string, text string"), "id", "text", 3, 3, 5, 20)
    got = [(r.id_a, r.id_b) for r in N.spelled_pairs(found, None).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(texts, 3, 3, 5, 20)
    of = {r.id: (r.class_id, r.text_id) for r in N.memberships(found).collect()}
    assert of == {i: ("c000", "c000") for i in texts if i[0] == "c"} | {"d1": ("c000", "d1"), "n1": ("n1", "n1")}


def test_smallest_text_of_an_id_counts(spark):
    words = [f"word{i}" for i in range(30)]
    base, far = " ".join(words), " ".join(["zz"] + words[::-1])
    # a0 has two texts; its smaller one is near b1 and in the class of b2, its other one is that of c1
    rows = [("a0", far), ("a0", base), ("a0", None), ("b1", " ".join(words[:-1] + ["other"])), ("b2", base.upper()), ("c1", far)]
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, "id string, text string").coalesce(1)
        found = N.near_duplicates(df, "id", "text", 3, 3, 5, 20)
        assert sorted((r.id_a, r.id_b) for r in N.spelled_pairs(found, None).collect()) == [("a0", "b1"), ("a0", "b2"), ("b1", "b2")]
        assert {r.id: r.group_id for r in N.groups(found).collect()} == {"a0": "a0", "b1": "a0", "b2": "a0", "c1": "c1"}


def test_groups_are_components(spark):
    texts = corpus(60, 7)
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    found = N.near_duplicates(df, "id", "text", 3, 3, 5, 0)
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = brute(texts, 3, 3, 5, 0)
    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    got = {r.id: (r.group_id, r.links) for r in N.groups(found).collect()}
    assert got == {i: (min(j for j in texts if top(j) == top(i)), sum(i in p for p in pairs)) for i in texts}


def test_every_id_has_a_group(spark, tmp_path):
    from quire.llm.queries import p2_groups

    long = "one two three four five six seven"
    rows = [("a1", long), ("a2", long.upper()), ("s1", "too short"), ("s2", "too short"), ("s2", "too short"), ("s3", "Too short"), ("w1", "-"), ("n1", None), ("n2", None), ("e1", ""), ("e2", ""), ("b1", " \n"), ("b2", " \n"), (None, "too short")]
    spark.createDataFrame(rows, "chunk_id string, chunk_text string").write.parquet(f"{tmp_path}/kb_chunks.parquet")
    got = sorted((r.chunk_id, r.group_id, r.links) for r in p2_groups(spark, str(tmp_path)).collect())
    assert got == [("a1", "a1", 1), ("a2", "a1", 1)] + [(i, i, 0) for i in ("b1", "b2", "e1", "e2", "n1", "n2")] + [("s1", "s1", 1), ("s2", "s1", 1), ("s3", "s3", 0), ("w1", "w1", 0)]


def test_cells_let_every_pair_meet_once():
    n = 40
    tag, at = np.arange(n), np.full(n, (10 << 36) | (0 << 9) | 1)
    key, tag, at = N._cells(np.full(n, 5), tag, at, np.full(n, n), 3)
    seen = []
    for a, b, _ in N._meet(key, tag, at, 3, 5):
        seen += list(zip(a.tolist(), b.tolist()))
    assert sorted(seen) == list(combinations(range(n), 2))


def test_a_run_of_very_many_texts_is_split_evenly():
    n = 300_000
    key, tag, at = N._cells(np.full(n, 5), np.arange(n), np.zeros(n, np.int64), np.full(n, n))
    parts = -(-n // N.CELL)
    assert len(key) == n * parts and np.bincount(np.unique(key, return_inverse=True)[1]).max() < 2.3 * N.CELL
    cells = {}
    for k, t, a in zip(key.tolist(), tag.tolist(), at.tolist()):
        if t < 60:
            cells.setdefault(t, {})[k] = a
    for x, y in combinations(range(60), 2):
        common = [k for k in cells[x] if k in cells[y] and (not cells[x][k] & N._MIXED or (cells[x][k] ^ cells[y][k]) & N._SIDE)]
        assert len(common) == 1


def test_sketch_never_counts_too_few():
    counts = np.array([0, 1, 2, 15, 16, 17, 100, 65_535, 65_536, 10**7, 4_294_967_295])
    got = N.SCALE[N.Sketch(counts).codes]
    assert len(N.SCALE) <= 256 and (got >= counts).all() and (got[:5] == counts[:5]).all() and (got <= counts * 1.13 + 1).all()


def test_hot_runs_lose_no_pair(spark):
    texts = corpus(90, 3)
    texts = {i: f"all of these texts start alike {t}" for i, t in texts.items()}
    df = spark.createDataFrame(list(texts.items()), "id int, text string").repartition(4)
    found = N.near_duplicates(df, "id", "text", 3, 3, 5, 20, cell=4, slots=1 << 10)
    assert {(r.id_a, r.id_b) for r in N.spelled_pairs(found, None).collect()} == brute(texts, 3, 3, 5, 20)


def test_empty(spark):
    df = spark.createDataFrame([], "id string, text string")
    found = N.near_duplicates(df, "id", "text")
    assert N.spelled_pairs(found).count() == 0 and N.groups(found).count() == 0


def test_shingles_of_odd_texts():
    doc, h, n = shingles([None, "", "a b", "a a a a a a", "x y z x y z"], 3)
    assert n.tolist() == [0, 0, 0, 1, 3] and len(h) == 4
