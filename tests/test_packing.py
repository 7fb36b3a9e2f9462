from hypothesis import given, settings
from hypothesis import strategies as st

from quire.operators.packing import bins_of, pieces_of


def model(tokens, cap, alone):
    """The budget fold written as lists of lists."""
    groups, open_group = [], []
    for t in tokens:
        if t >= alone:
            if open_group:
                groups.append(open_group)
            groups.append([t])
            open_group = []
        elif open_group and sum(open_group) + t > cap:
            groups.append(open_group)
            open_group = [t]
        else:
            open_group = [*open_group, t]
    return [*groups, open_group] if open_group else groups


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=40))
def test_bins_match_the_list_model(tokens):
    bins = bins_of(tokens, [700] * len(tokens), alone=300)
    got = {}
    for t, b in zip(tokens, bins):
        got.setdefault(b, []).append(t)
    assert list(got.values()) == model(tokens, 700, 300)


def test_bins_cases():
    assert bins_of([299, 299, 299], [700] * 3, alone=300) == [0, 0, 1]
    assert bins_of([100, 300, 100], [700] * 3, alone=300) == [0, 1, 2]
    assert bins_of([], [], alone=300) == []
    assert bins_of([5000], [900]) == [0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab. \n", max_size=60), max_size=8))
def test_pieces_keep_every_letter(parts):
    text = "\n\n".join(parts)
    pieces = pieces_of(text, 5)
    assert "".join("".join(pieces).split()) == "".join(text.split())


def test_long_sentence_stays_whole():
    s = "x" * 4000
    assert pieces_of(s, 900) == [s]
    assert pieces_of("短句。" * 4, 2) == ["短句。" * 4]  # no white space after the stops


def test_folded_bins_agree(spark):
    from pyspark.sql import functions as F

    from quire.operators.packing import folded_bins, greedy_bins

    rows = [([100, 300, 100, 250, 250, 250],), ([],), ([299, 299, 299, 700, 0, 0],)]
    df = spark.createDataFrame(rows, "t array<bigint>")
    for r in df.select(greedy_bins(F.col("t"), 700, 300).alias("a"), folded_bins(F.col("t"), 700, 300).alias("b")).collect():
        assert list(r.a) == list(r.b)
