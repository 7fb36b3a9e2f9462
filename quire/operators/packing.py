"""Greedy budget bins: the one fold behind merging short texts, splitting long ones and splitting tables.

Items are put into the open bin while its tokens plus theirs stay within their cap; otherwise a new bin
opens.  An empty bin takes any item.  Items of `alone` tokens or more close the open bin and stand by
themselves.  The fold is sequential within one segment of one document and independent between segments.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bins_of(tokens, caps, start: int = 0, alone: int | None = None) -> list[int]:
    """Bin number of each item, from 0."""
    out: list[int] = []
    number, filled, used = -1, False, 0
    for t, cap in zip(tokens, caps):
        if alone is not None and t >= alone:
            number += 1
            filled, used = False, 0
        elif filled and used + t > cap:
            number += 1
            used = start + t
        elif filled:
            used += t
        else:
            number += 1
            filled, used = True, start + t
        out.append(number)
    return out


def greedy_bins(tokens: Column, cap: int, alone: int | None = None) -> Column:
    """Bin of each element of an array of token counts (Arrow batches, linear time)."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(arrays: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else bins_of(a, [cap] * len(a), alone=alone) for a in arrays])

    return run(tokens)


def folded_bins(tokens: Column, cap: int, alone: int) -> Column:
    """The same by built-in functions: quadratic in the array's length, without Python."""
    state = F.struct(F.lit(-1).alias("n"), F.lit(False).alias("filled"), F.lit(0).cast("bigint").alias("used"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        solo = t >= alone
        new = solo | ~s["filled"] | (s["used"] + t > cap)
        n = F.when(new, s["n"] + 1).otherwise(s["n"])
        return F.struct(n.alias("n"), (~solo).alias("filled"), F.when(solo, F.lit(0).cast("bigint")).when(new, t).otherwise(s["used"] + t).alias("used"), F.concat(s["out"], F.array(n)).alias("out"))

    return F.aggregate(tokens, state, step, lambda s: s["out"])


_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+")


def pieces_of(text: str, cap: int) -> list[str]:
    """A text over `cap` tokens cut at paragraphs, and paragraphs over it at sentences.

    Neighbouring short paragraphs share bins; a long paragraph's sentences have bins of their own.
    """
    size = lambda s: len(s) // 4
    if size(text) <= cap:
        return [text]
    runs: list[tuple[str, list[str]]] = []
    for p in text.split("\n\n"):
        if size(p) > cap:
            runs.append((" ", _SENTENCE.split(p)))
        elif runs and runs[-1][0] == "\n\n":
            runs[-1][1].append(p)
        else:
            runs.append(("\n\n", [p]))
    out: list[str] = []
    for sep, parts in runs:
        groups: dict[int, list[str]] = {}
        for p, b in zip(parts, bins_of([size(p) for p in parts], [cap] * len(parts))):
            groups.setdefault(b, []).append(p)
        out += [sep.join(g) for g in groups.values()]
    return out


def split_pieces(text: Column, cap: int) -> Column:
    """Pieces of a text as an array; null for null."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else pieces_of(t, cap) for t in texts])

    return run(text)


def row_bins(tokens: Column, start: Column, footnote: Column, cap: int) -> Column:
    """Bin of each table row: bins start with the header's tokens, the last row leaves room for a footnote."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(arrays: pd.Series, first: pd.Series, noted: pd.Series) -> pd.Series:
        out = []
        for a, s, f in zip(arrays, first, noted):
            n = len(a)
            caps = np.full(n, cap - 50)
            if n and f:
                caps[-1] = cap - 100
            out.append(bins_of(a, caps, start=int(s)))
        return pd.Series(out)

    return run(tokens, start, footnote)
