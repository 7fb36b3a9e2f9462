"""Noise in text from scanned pages: what noise each record has, and continuous readable paragraphs.

One pass over all texts counts every word exactly (partial counts in each partition, summed by shuffle), and
gathers the hyphens at line ends, the words spaced out letter by letter, the short lines that may be page
furniture, and a bounded sample of lines to train on.  An averaged-perceptron character editor (editor.py) is
trained on frequent words.  It then reads the vocabulary, not the texts: for every word it proposes words by
its labels, and decides on each proposal from its scores and both words' counts; likewise on every
distinct hyphen at a line end.  What it decided is one table of verdicts, with which a second pass reads every text:

* page numbers: lines with nothing but a number in any style (digits, roman, `3-4`, `A-13`, `Page 2 of 9`),
  unless they stand in a column of three or more such lines;
* running lines: lines that are little more than their document's title (read through misreadings); and lines
  that stand in several records of one document and of no other, where a perceptron over the places of the line on
  its pages and its typography takes them for furniture.  It is trained on title lines as furniture and on the
  other lines of like shape as text, without seeing the titles;
* broken words: a hyphen or like sign at a line end whose lines the editor joins, furniture between skipped;
* misread words: words that the editor changes (several misreadings in a word, too), and words spaced out.

Scale: words are shuffled as partial counts, texts never.  Which words are frequent enough to be proposed is
asked of a Bloom filter sized from their number; a filter too full only proposes more, as the counts are joined
afterwards.  The verdicts are broadcast within a bound of bytes, beyond it joined to their records by shuffle.
The driver gets the filter, bounded samples to train on, and the verdicts within their bound.

Defined results: null, empty and blank texts have no noise and stay as they are; a null title is read off the
document's id; a null place on the page is a place of its own; rows without a record key have no result;
repeated rows give one row of noise; texts are read whole; only the named columns are used.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.editor import Perceptron, edit_features, join_features, train_chars, train_moves, wanted_counts
from quire.runtime import BROADCAST_BYTES, bounded_join, cut, small_enough, spread, wide

#: Words and compounds the editor is trained on, and lines of either kind the line reader is, at most.
TRAIN_WORDS, TRAIN_COMPOUNDS, TRAIN_LINES = 2000, 400, 3000
#: A word that the corpus has less often is never proposed.
LEAST = 4
#: Bits of the filter for each frequent word, and in all at most.
FILTER_BITS, FILTER_MOST = 32, 1 << 29
#: Furniture is a short line; a longer one is text.
SHORT = 120

_MARKED = frozenset("-‐¬­")
MARKS = "-‐¬­"
WORD = re.compile(r"[^\W_]+(?:\|[^\W_]+)*|\|[^\W\d_]+(?:\|[^\W_]+)*")
_BREAK = re.compile(rf"([^\W\d_|]*[^\W_|](?:\|[^\W_]+)*|[^\W_]+)([{MARKS}])[ \t]*$")
_SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[ \n][^\W_]){3,}(?![^\W_])")
_ROMAN = r"(?=[ivxl])(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
_NUMBER = rf"(?:\d{{1,4}}|{_ROMAN})"
PAGE_NUMBER = re.compile(
    rf"^[^\w`#|=$]*(?:(?:pa[g9][ec]|pg|p|seite|s|folio)\b[ .:]*{_NUMBER}(?:\s*(?:of|/|von|de|sur)\s*{_NUMBER})?|{_NUMBER}(?:\s*(?:of|/)\s*{_NUMBER})?|[a-z]-\d{{1,3}}|\d{{1,3}}-\d{{1,3}})[^\w.]*$", re.I
)
_FOLD = str.maketrans("01|i59cf", "olllsget")
_PAIRS = (("rn", "m"), ("ii", "u"), ("cl", "d"), ("ri", "n"), ("vv", "w"))


_GAP = re.compile(r"[ \n]")
_NOLETTER = re.compile(r"[^\w|]+|_+")


_EDGES = " \t-–—−_*•·.,:;()[]{}<>~/"


def _is_number(s: str) -> bool:
    """Whether a stripped line holds only a page number; without its ornaments none is longer than 30 characters."""
    return len(s.strip(_EDGES)) <= 30 and PAGE_NUMBER.match(s) is not None


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) - (1 << 63)


def skeleton(s: str) -> str:
    """Letters and digits of a line, lower-cased, with what scanning confuses made equal."""
    s = _NOLETTER.sub("", s.lower())
    for a, b in _PAIRS:
        s = s.replace(a, b)
    return s.translate(_FOLD)


def title_of(title, doc_id) -> str:
    """A document's title; without one, its id without the hash at its end."""
    if isinstance(title, str) and title.strip():
        return title
    return re.sub(r"_[0-9a-f]{8}$", "", doc_id).replace("_", " ") if isinstance(doc_id, str) else ""


def _headed(line: str) -> bool:
    """Whether a line has the shape of a running line: starting large or with a number, no sentence."""
    s = line.strip()
    return 5 <= len(s) <= SHORT and s[-1] not in ".,;:!?。" and (s[0].isupper() or s[0].isdigit())


_LONE_NUMBER = re.compile(r"(?<![^\W_])\d+(?![^\W_])")


def _line_key(line: str, bare: str | None = None) -> int:
    """Hash of a line's skeleton without its lone numbers; `bare` is its skeleton, if known."""
    rest = _LONE_NUMBER.sub("", line)
    return _hash(bare if bare is not None and rest == line else skeleton(rest))


_HEAD = re.compile(r"[^\W\d_]+")


def _compounds(low: str) -> list[str]:
    """`a-b` of every hyphen between two words of letters."""
    out = []
    parts = low.split("-")
    for a, b in zip(parts, parts[1:]):
        if a and b and a[-1].isalpha() and b[0].isalpha():
            # the word before the hyphen, found backwards
            i = len(a)
            while i and a[i - 1].isalpha():
                i -= 1
            if not (i and a[i - 1].isalnum()):
                out.append(a[i:] + "-" + _HEAD.match(b).group())
    return out


def _plain(s: str) -> str:
    """A skeleton in which only single characters are made equal, as a pair may have come about by misreading one."""
    return _NOLETTER.sub("", s.lower()).translate(_FOLD)


def title_keys(title: str) -> tuple[str, str]:
    return skeleton(title), _plain(title)


def _titled(line: str, bare: str, title: tuple[str, str]) -> bool:
    """Whether a line (with its skeleton `bare`) is little more than the title, by either skeleton."""
    own, plain = title
    return len(own) >= 6 and len(bare) <= len(own) + 14 and (own in bare or plain in _plain(line))


# ---- lines of a page ---------------------------------------------------------------------------------


_AT, _BEFORE, _AFTER = ("first", "last", "second", "secondlast", "inside"), ("none", "blank", "closed", "open"), ("none", "blank", "lower", "large", "other")


def line_code(lines: list[str], i: int, lo: int, hi: int, page: tuple) -> int:
    """What the line reader sees of line `i`, in one number: typography, its place among the lines `lo` to `hi` that
    are not blank, what stands before and after it, and where its block stands on the page."""
    s = lines[i].strip()
    letters = [w for w in s.split() if w.upper() != w.lower()]
    share = sum(w != w.lower() for w in letters) / max(1, len(letters))
    large = share >= 0.55
    signs = (s.upper() == s) | (any(c in "|•–—·" for c in s) or "   " in s) << 1 | s[0].isdigit() << 2
    at = 0 if i == lo else 1 if i == hi else 2 if i == lo + 1 else 3 if i == hi - 1 else 4
    p = lines[i - 1].strip() if i else None
    n = lines[i + 1].strip() if i + 1 < len(lines) else None
    before = 0 if p is None else 1 if not p else 2 if p[-1] in ".!?:;。" else 3
    after = 0 if n is None else 1 if not n else 2 if n[0].islower() else 3 if n[0].isupper() else 4
    number, top, bottom, edge = page
    height = top if at == 0 else bottom if at == 1 else None
    height = 15 if height is None else max(0, min(14, int(height) // 200))
    edge = 4 if edge is None else int(edge)
    number = 0 if number is None else 1 if number == 1 else 2
    return int(large) | signs << 3 | at << 6 | before << 9 | after << 12 | height << 15 | edge << 19 | number << 22


@lru_cache(maxsize=100_000)
def line_features(code: int) -> tuple[str, ...]:
    """The features in a line's number: T for typography, P for the place on the page."""
    large, signs, height, edge, number = code & 7, code >> 3 & 7, code >> 15 & 15, code >> 19 & 7, code >> 22 & 3
    at, before, after = _AT[code >> 6 & 7], _BEFORE[code >> 9 & 7], _AFTER[code >> 12 & 7]
    out = ["L", f"Tc{large}", f"Tu{signs & 1}", f"Ts{signs >> 1 & 1}", f"Tn{signs >> 2}", "Pa" + at, "Pb" + before, "Pn" + after, f"Pbn{before}/{after}", f"Pabn{at}/{before}/{after}", f"PTc{large}/{before}/{after}"]
    if height < 15:
        out.append(f"Ph{height}/{at}")
    if edge < 4:
        out.append(f"Pe{edge}/{at}")
    if number:
        out.append(f"Pp{number}/{at}")
    return tuple(out)


def furniture(lines: list[str], title: tuple[str, str], known=None) -> list[str | None]:
    """`running_line`, `page_number` or None for each line; `known` tells by a line's key whether the line reader took it for furniture of its document."""
    out: list[str | None] = [None] * len(lines)
    filled = [i for i, x in enumerate(lines) if x and not x.isspace()]
    if not filled:
        return out
    number = [False] * len(lines)
    for i in filled:
        s = lines[i].strip()
        if len(s) <= SHORT:
            if _is_number(s):
                number[i] = True
            elif _headed(s):
                if len(s) >= len(title[0]) and _titled(s, skeleton(s), title):
                    out[i] = "running_line"
                elif known and known(_line_key(s)):
                    out[i] = "running_line"
    for k, i in enumerate(filled):
        if number[i]:
            a = k
            while a and number[filled[a - 1]]:
                a -= 1
            b = k
            while b + 1 < len(filled) and number[filled[b + 1]]:
                b += 1
            if b - a < 2:
                out[i] = "page_number"
    return out


_APART = re.compile(r"</?[A-Za-z][^<>]*>|&#?\w+;|\]\([^()\s]*\)|`[^`\n]*`|\\[A-Za-z]+|[A-Za-z]+://\S+|\S*[_\\=@]\S*")
_APART_SIGN = re.compile(r"[<&`\\_=@]|\]\(|://")
_STUB = re.compile(rf"[^\W_]+[{MARKS}][ \t]*$", re.M)


def _running(text: str) -> str:
    """The text without tags, link targets, code, commands, addresses and identifiers."""
    return _APART.sub(" ", text) if _APART_SIGN.search(text) else text


def _may_be_spaced(words: list[str]) -> bool:
    """Whether there are four words of one character, as a word spaced out by letters has."""
    return sum(len(w) == 1 for w in words) >= 4


def _break(line: str, following: str) -> str | None:
    """Key of a word broken between two lines: what stands before the sign, the sign, what follows."""
    line = line.rstrip(" \t")
    if not line or line[-1] not in MARKS:
        return None
    m, rest = _BREAK.search(line), WORD.match(following.lstrip(" \t"))
    if not m or not rest:
        return None
    return "\n".join((m.group(1).lower(), m.group(2), rest.group().lower(), "1" if rest.group()[:1].islower() else "0"))


class Reader:
    """Reads texts with the verdicts of their corpus: for each kind a dict of keys to verdicts."""

    def __init__(self, verdicts: dict[str, dict[str, str]]):
        self.words, self.ends, self.apart = verdicts.get("w", {}), verdicts.get("j", {}), verdicts.get("s", {})
        self.docs, self.furniture = verdicts.get("d", {}), verdicts.get("f", {})

    def marks(self, lines: list[str], title: tuple[str, str], doc) -> list[str | None]:
        known = None
        if self.docs and isinstance(doc, str):
            d = _hash(doc)
            if str(d) in self.docs:
                known = lambda k: f"{d}:{k}" in self.furniture
        return furniture(lines, title, known)

    def breaks(self, lines: list[str]) -> tuple[list[int], bool]:
        """Indices of lines that end in a broken word whose rest starts the next line, and whether other lines end in a sign."""
        out, stubs = [], False
        for i, line in enumerate(lines):
            if line.rstrip(" \t")[-1:] in _MARKED:
                key = _break(line, lines[i + 1]) if i + 1 < len(lines) else None
                if key and key in self.ends:
                    out.append(i)
                else:
                    stubs = True
        return out, stubs

    def spaced(self, text: str) -> list[tuple[int, int, str]]:
        """Words spaced out letter by letter: start, end, the word, mended."""
        out = []
        for m in _SPACED.finditer(text):
            w = _GAP.sub("", m.group())
            better = self.apart.get(w.lower())
            if better:
                out.append((m.start(), m.end(), w if better == w.lower() else better))
        return out

    def kinds(self, text: str, title: tuple[str, str], doc) -> set[str]:
        lines = text.split("\n")
        marks = self.marks(lines, title, doc)
        got = {k for k in marks if k}
        own = [x for x, k in zip(lines, marks) if not k] if got else lines
        ends, stubs = self.breaks(own)
        if ends:
            got.add("broken_word")
        body = self._unbroken(own, set(ends))
        # a stub before a sign at a line end, its rest elsewhere, is no word
        words = WORD.findall(_running(_STUB.sub(" ", body) if stubs else body).lower())
        if not self.words.keys().isdisjoint(words) or _may_be_spaced(words) and self.spaced(body):
            got.add("misread")
        return got

    @staticmethod
    def _unbroken(lines: list[str], broken: set[int]) -> str:
        if not broken:
            return "\n".join(lines)
        out = []
        for i, line in enumerate(lines):
            s = line.lstrip(" \t") if i - 1 in broken else line
            out.append(s.rstrip(" \t")[:-1] if i in broken else s + "\n")
        return "".join(out).removesuffix("\n")

    def repair(self, text: str, title: tuple[str, str], doc) -> str:
        """The text without furniture, its words mended, its wrapped lines joined into paragraphs."""
        lines = text.split("\n")
        marks = self.marks(lines, title, doc)
        own = [x for x, k in zip(lines, marks) if not k]
        broken = set(self.breaks(own)[0])
        wrapped = bool(broken) or len(own) < len(lines) or _wrapped(own)
        body = self._unbroken(own, broken)
        last, parts = 0, []
        for s, e, w in self.spaced(body):
            parts += [body[last:s], w]
            last = e
        body = "".join(parts) + body[last:]
        body = WORD.sub(lambda m: self._fix(m.group()), body)
        return _paragraphs(body) if wrapped else body

    def _fix(self, word: str) -> str:
        better = self.words.get(word.lower())
        if better is None:
            return word
        letters = [c for c in word if c.isalpha()]
        if len(letters) > 1 and all(c.isupper() for c in letters):
            return better.upper()
        return better[0].upper() + better[1:] if word[0].isupper() else better


def _wrapped(lines: list[str]) -> bool:
    full = [x.strip() for x in lines if x.strip()]
    loose = [x for x in full[:-1] if 35 <= len(x) <= 95 and x[-1] not in ".!?:;|>。"]
    return len(full) >= 3 and len(loose) * 2 >= len(full)


_ITEM = re.compile(r"\s*(?:[-*•#|>]|\d+[.)]\s|Row \d+:|Table:|Columns:|Figure:|Context:)")


def _paragraphs(text: str) -> str:
    out: list[str] = []
    for line in text.split("\n"):
        s = line.strip(" \t")
        if out and out[-1] and s and not _ITEM.match(s) and (out[-1][-1] not in ".!?:。" or len(out[-1]) > 40 and s[0].islower() or len(s) > 30 and len(out[-1]) > 30):
            out[-1] += s if out[-1][-1] in MARKS else " " + s
        else:
            out.append(s)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")


# ---- over a corpus -----------------------------------------------------------------------------------

_SEEN = "kind int, s string, n bigint, a bigint, b bigint, c bigint"


def _page(pdf: pd.DataFrame):
    none = lambda x: None if x is None or x != x else x
    return [(none(p), none(t), none(b), none(e)) for p, t, b, e in zip(pdf["page_no"], pdf["top"], pdf["bottom"], pdf["edge"])]


_LARGE = (1 << 63) - 1


class _Sample:
    """The `size` examples with the smallest hashes."""

    def __init__(self, size: int):
        self.size, self.rows, self.limit = size, [], 1 << 63

    def add(self, h: int, make) -> None:
        if h < self.limit:
            self.rows.append((h, make()))
            if len(self.rows) >= 2 * self.size:
                self.cut()

    def cut(self) -> None:
        self.rows = sorted(self.rows)[: self.size]
        if len(self.rows) == self.size:
            self.limit = self.rows[-1][0]


def _count_scan(batches):
    """One partition: word counts (1), line ends (2), spaced words (3), lines that may be furniture (0), lines to train on (4)."""
    words: Counter = Counter()
    ends: set = set()
    apart: set = set()
    titles: dict = {}
    samples = {"furniture": _Sample(TRAIN_LINES), "text": _Sample(TRAIN_LINES)}

    def rows(kind, keys, numbers):
        return pd.DataFrame({"kind": kind, "s": pd.Series(keys, dtype=object), "n": numbers, "a": 0, "b": 0, "c": 0})

    def flush():
        for site in ends:
            a, _, b, _ = site.split("\n")
            words[a + b] += 0
        for w in apart:
            words[w] += 0
        yield rows(1, list(words), list(words.values()))
        yield rows(2, list(ends), 1)
        yield rows(3, list(apart), 1)
        words.clear()
        ends.clear()
        apart.clear()

    for pdf in batches:
        docs, keys, recs, codes = [], [], [], []
        for rec, doc, title, text, page in zip(pdf["record_key"], pdf["doc_id"], pdf["title"], pdf["text"], _page(pdf)):
            if not text:
                continue
            low = text.lower()
            found = WORD.findall(low)
            words.update(found)
            if "-" in low:
                words.update(_compounds(low))
            if _may_be_spaced(found):
                apart.update(_GAP.sub("", m.group()) for m in _SPACED.finditer(low))
            lines = text.split("\n")
            filled = [i for i, x in enumerate(lines) if x and not x.isspace()]
            name = title_of(title, doc)
            bare = titles.get(name)
            if bare is None:
                if len(titles) > 100_000:
                    titles.clear()
                bare = titles[name] = title_keys(name)
            d, r = (_hash(doc), _hash(rec)) if isinstance(doc, str) else (0, 0)
            short = set()
            for i in filled:
                s = lines[i].strip()
                if len(s) > SHORT:
                    continue
                if _is_number(s):
                    short.add(i)
                elif d and _headed(s):
                    short.add(i)
                    plain = skeleton(s)
                    k = _line_key(s, plain)
                    titled = _titled(s, plain, bare)
                    if not titled:
                        docs.append(d)
                        keys.append(k)
                        recs.append(r)
                        codes.append(line_code(lines, i, filled[0], filled[-1], page))
                    samples["furniture" if titled else "text"].add(((k ^ r) + i) * 0x9E3779B97F4A7C15 & _LARGE, lambda: (line_code(lines, i, filled[0], filled[-1], page), d, k))
            for k, i in enumerate(filled[:-1]):
                if lines[i].rstrip(" \t")[-1:] in _MARKED:
                    # lines between that may prove to be furniture are stepped over
                    for j in filled[k + 1 :]:
                        if site := _break(lines[i], lines[j]):
                            ends.add(site)
                        if j not in short:
                            break
        if len(words) > 500_000:
            yield from flush()
        if docs:
            yield pd.DataFrame({"kind": 0, "s": None, "n": codes, "a": docs, "b": keys, "c": recs})
    yield from flush()
    for label, sample in samples.items():
        sample.cut()
        if sample.rows:
            out = rows(4, [label] * len(sample.rows), [code for _, (code, _, _) in sample.rows])
            out["c"] = [h for h, _ in sample.rows]
            out["a"], out["b"] = [d for _, (_, d, _) in sample.rows], [k for _, (_, _, k) in sample.rows]
            yield out


class Filter:
    """Bloom filter over words; bits are found by the two halves of a 64-bit hash."""

    def __init__(self, bits: bytes | bytearray, mask: int):
        self.bits, self.mask = bits, mask

    def __contains__(self, word: str) -> bool:
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 42)
        a, b = h & self.mask, (h >> 32) & self.mask
        return bool(self.bits[a >> 3] >> (a & 7) & 1 and self.bits[b >> 3] >> (b & 7) & 1)

    @classmethod
    def over(cls, words: DataFrame) -> Filter:
        """Filter of the column `s` (distinct); made by bitmap aggregation, FILTER_MOST bits at most."""
        need = max(1 << 16, min(FILTER_MOST, FILTER_BITS * words.count()))
        mask = (1 << (need - 1).bit_length()) - 1
        h = F.xxhash64("s")
        p = words.select(F.explode(F.array(h.bitwiseAND(F.lit(mask)) + 1, F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(mask)) + 1)).alias("p"))
        bits = bytearray((mask + 1) // 8)
        for r in p.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("v")).toLocalIterator():
            v = bytes(r["v"])
            start = (r["k"] - 1) * 4096
            bits[start : start + len(v)] = v[: len(bits) - start]
        return cls(bytes(bits), mask)


def _by_kind(rows) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for r in rows:
        out.setdefault(r["kind"], {})[r["key"]] = r["value"]
    return out


class Scanned:
    """Records (place, record_key, doc_id, title, text, page_no, top, bottom, edge) with their corpus' editor and verdicts.

    `top` and `bottom` are the heights of the record's block on its page, `edge` tells whether it is the first (1), the
    last (2), the only (3) or another block (0) of the page; all three and the page may be null.
    """

    def __init__(self, records: DataFrame, broadcast_bytes: int = BROADCAST_BYTES):
        spark = records.sparkSession
        self.broadcast_bytes = broadcast_bytes
        self.records = spread(records.select("place", "record_key", "doc_id", "title", "text", "page_no", "top", "bottom", "edge").where("record_key is not null"))
        seen = cut(self.records.where("text is not null").mapInPandas(_count_scan, _SEEN))
        self.counts = counts = cut(seen.where("kind = 1").groupBy("s").agg(F.sum("n").alias("n")))
        letters = F.col("s").rlike(r"^\p{L}+$")
        known = Filter.over(counts.where((F.col("n") >= LEAST) & letters & (F.length("s") >= 3)).select("s"))
        rng = random.Random(11)
        top = lambda where, n: [r["s"] for r in counts.where(where).orderBy(F.desc("n"), "s").limit(n).collect()]
        words = top(letters & F.length("s").between(4, 40) & (F.col("n") >= LEAST), TRAIN_WORDS)
        compounds = top(F.col("s").contains("-") & (F.col("n") >= LEAST), TRAIN_COMPOUNDS)
        chars = train_chars(words, rng)
        moves, ends, need = wanted_counts(chars, words, compounds, known.__contains__, rng)
        # the words asked for stem from at most TRAIN_WORDS + TRAIN_COMPOUNDS words
        asked = F.broadcast(spark.createDataFrame([(w,) for w in sorted(need)], "s string"))
        got = {r["s"]: r["n"] for r in counts.join(asked, "s").collect()}
        self.editor = train_moves(chars, moves, ends, lambda w: got.get(w, 0), rng)
        lines = seen.where("kind = 0").groupBy("a", "b").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
        lines = lines.groupBy("b").agg(F.count(F.lit(1)).alias("docs"), F.first("a").alias("a"), F.max(F.col("lo") != F.col("hi")).alias("many"))
        self.alone = cut(lines.where("docs = 1 and many").select("a", "b"))
        lines = []
        for label in ("furniture", "text"):
            picked = seen.where((F.col("kind") == 4) & (F.col("s") == label)).orderBy("c", "n").limit(TRAIN_LINES)
            # what recurs in one document may be furniture without a title, and is no example of text
            picked = picked.join(self.alone, ["a", "b"], "left_anti").select("c", "n").orderBy("c", "n").collect()
            lines += [(list(line_features(r["n"])), label) for r in picked]
        self.lines = Perceptron.fit(lines, ["text", "furniture"], rng, epochs=10)
        self.seen, self.known = seen, known

    def fixes(self) -> DataFrame:
        """`s, better, n`: every word that the editor changes, what into, and how often that is seen."""
        held = self.records.sparkSession.sparkContext.broadcast((self.editor, self.known.bits, self.known.mask))

        def propose(batches):
            editor, bits, mask = held.value
            known = Filter(bits, mask)
            for pdf in batches:
                out = [(w, own, other, cost, edits) for w, own in zip(pdf["s"], pdf["n"]) for other, cost, edits in editor.proposals(w, lambda x: len(x) >= 3 and x in known)]
                yield pd.DataFrame(out, columns=["s", "own", "other", "cost", "edits"])

        def decide(batches):
            editor = held.value[0]
            for pdf in batches:
                lead = [editor.accepts(edit_features(*x)) for x in zip(pdf["s"], pdf["own"], pdf["n"], pdf["cost"], pdf["edits"])]
                keep = pd.Series(lead, index=pdf.index, dtype=float) > 0
                yield pdf.assign(lead=lead)[keep][["s", "other", "n", "lead"]]

        mixed = ~F.col("s").rlike(r"^\p{L}+$")
        words = self.counts.where(F.col("s").rlike(r"\p{L}") & ~F.col("s").contains("-") & ((F.length("s") >= 4) | mixed & (F.length("s") >= 3)))
        pairs = wide(words, "s").mapInPandas(propose, "s string, own bigint, other string, cost double, edits int")
        both = pairs.join(self.counts.select(F.col("s").alias("other"), "n"), "other").where((F.col("n") >= LEAST) & (F.col("n") > F.col("own")))
        good = both.select("s", "own", "other", "n", "cost", "edits").mapInPandas(decide, "s string, other string, n bigint, lead double")
        best = good.groupBy("s").agg(F.max(F.struct("lead", "n", "other")).alias("m"))
        return best.select("s", F.col("m.other").alias("better"), F.col("m.n").alias("n"))

    def recurring(self) -> DataFrame:
        """`a, b`: document and key of lines that recur in their document alone and that the line reader, over all the
        places they stand at, takes for furniture."""
        held = self.records.sparkSession.sparkContext.broadcast(self.lines)

        def lead(batches):
            for pdf in batches:
                yield pdf[["a", "b"]].assign(lead=[held.value.lead(line_features(int(n)), "furniture", "text") for n in pdf["n"]])

        at = bounded_join(self.seen.where("kind = 0").select("a", "b", "n"), self.alone, ["a", "b"])
        return at.mapInPandas(lead, "a bigint, b bigint, lead double").groupBy("a", "b").agg(F.avg("lead").alias("lead")).where("lead > 0").select("a", "b")

    def verdicts(self) -> DataFrame:
        """`kind, key, value`: words to change (w), line ends to join (j), spaced words (s), lines that recur in one document (f), and these documents (d)."""
        fixes = cut(self.fixes())
        held = self.records.sparkSession.sparkContext.broadcast(self.editor)
        sites = self.seen.where("kind = 2").select(F.col("s").alias("site")).distinct()
        part = lambda i: F.get(F.split("site", "\n"), F.lit(i))
        asked = sites.select("site", F.posexplode(F.array(F.concat(part(0), part(2)), F.concat_ws("-", part(0), part(2)), part(0), part(2))).alias("i", "s"))
        found = asked.join(self.counts, "s", "left").groupBy("site").agg(*[F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(c) for i, c in enumerate(("whole", "dashed", "left", "right"))])
        found = found.withColumn("s", F.concat(part(0), part(2))).join(fixes.select("s", F.col("n").alias("mended")), "s", "left")
        found = found.withColumn("whole", F.when((F.col("whole") == 0) & (F.col("dashed") == 0), F.coalesce("mended", F.lit(0))).otherwise(F.col("whole")))

        def join(batches):
            for pdf in batches:
                ok = []
                for site, w, d, a, b in zip(pdf["site"], pdf["whole"], pdf["dashed"], pdf["left"], pdf["right"]):
                    _, mark, _, lower = site.split("\n")
                    ok.append(held.value.joins(join_features(mark, w, d, a, b, lower == "1")))
                yield pd.DataFrame({"kind": "j", "key": pdf["site"][ok], "value": "1"})

        joined = found.select("site", "whole", "dashed", "left", "right").mapInPandas(join, "kind string, key string, value string")
        spaced = self.seen.where("kind = 3").select("s").distinct().join(self.counts, "s").join(fixes.select("s", "better"), "s", "left")
        spaced = spaced.where((F.col("n") >= LEAST) | F.col("better").isNotNull()).select(F.lit("s").alias("kind"), F.col("s").alias("key"), F.when(F.col("n") >= LEAST, F.col("s")).otherwise(F.col("better")).alias("value"))
        words = fixes.select(F.lit("w").alias("kind"), F.col("s").alias("key"), F.col("better").alias("value"))
        lines = cut(self.recurring())
        docs = lines.select(F.lit("d").alias("kind"), F.col("a").cast("string").alias("key"), F.lit("1").alias("value")).distinct()
        return words.unionByName(joined).unionByName(spaced).unionByName(docs).unionByName(lines.select(F.lit("f").alias("kind"), F.concat_ws(":", "a", "b").alias("key"), F.lit("1").alias("value")))

    def _read(self, fn, schema: str) -> DataFrame:
        verdicts = cut(self.verdicts())
        sc = self.records.sparkSession.sparkContext
        names = [c.split()[0] for c in schema.split(",")]
        if small_enough(verdicts, self.broadcast_bytes):
            held = sc.broadcast(_by_kind(verdicts.toLocalIterator()))
            source = self.records
        else:
            held, source = None, self._with_verdicts(verdicts)

        def run(batches):
            titles: dict = {}
            reader = Reader(held.value) if held else None
            for pdf in batches:
                out = []
                own = pdf["verdicts"] if held is None else [None] * len(pdf)
                for place, rec, doc, title, text, given in zip(pdf["place"], pdf["record_key"], pdf["doc_id"], pdf["title"], pdf["text"], own):
                    if not text:
                        out.extend(fn(None, place, rec, text, ("", ""), doc))
                        continue
                    name = title_of(title, doc)
                    if name not in titles:
                        if len(titles) > 100_000:
                            titles.clear()
                        titles[name] = title_keys(name)
                    own_reader = reader or Reader(_by_kind(given if given is not None else ()))
                    out.extend(fn(own_reader, place, rec, text, titles[name], doc))
                yield pd.DataFrame(out, columns=names, dtype=object)

        return source.mapInPandas(run, schema)

    def _with_verdicts(self, verdicts: DataFrame) -> DataFrame:
        """Records with the verdicts on their own words, line ends and lines, by shuffle joins on these and on the record."""

        def keys(batches):
            for pdf in batches:
                out = []
                for rec, doc, text in zip(pdf["h"], pdf["doc_id"], pdf["text"]):
                    lines = text.split("\n")
                    got = {("w", w) for w in WORD.findall(text.lower())} | {("s", _GAP.sub("", m.group()).lower()) for m in _SPACED.finditer(text)}
                    d = _hash(doc) if isinstance(doc, str) else 0
                    filled = [x for x in lines if x and not x.isspace()]
                    got |= {("d", str(d))} | {("f", f"{d}:{_line_key(x.strip())}") for x in filled if _headed(x)}
                    for k, x in enumerate(filled):
                        if x.rstrip(" \t")[-1:] in _MARKED:
                            sites = {_break(x, y) for y in filled[k + 1 :]} - {None}
                            got |= {("j", s) for s in sites} | {("w", "".join(s.split("\n")[0:3:2])) for s in sites}
                    out += [(rec, k, v) for k, v in got]
                yield pd.DataFrame(out, columns=["h", "kind", "key"])

        named = self.records.withColumn("h", F.xxhash64("place", "record_key", "doc_id", "text"))
        asked = named.where("text is not null").select("h", "doc_id", "text").mapInPandas(keys, "h bigint, kind string, key string").distinct()
        per = asked.join(verdicts, ["kind", "key"]).groupBy("h").agg(F.collect_list(F.struct("kind", "key", "value")).alias("verdicts"))
        return named.join(per, "h", "left").drop("h")

    def found(self) -> DataFrame:
        """`place, record_key, kind`, distinct."""

        def kinds(reader, place, rec, text, title, doc):
            return [(place, rec, k) for k in sorted(reader.kinds(text, title, doc))] if reader else []

        return self._read(kinds, "place string, record_key string, kind string").distinct()

    def repaired(self) -> DataFrame:
        """`place, record_key, clean_text` for every record."""

        def mend(reader, place, rec, text, title, doc):
            return [(place, rec, reader.repair(text, title, doc) if reader else text)]

        return self._read(mend, "place string, record_key string, clean_text string")
