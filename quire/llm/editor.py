"""An averaged-perceptron character editor, and the line reader that finds page furniture.

The editor labels every character of a word read: keep it, replace it, delete it, or insert after it; and every
hyphen at a line end: join the lines or keep them.  It is trained on clean words of the corpus that are
damaged the way scanning damages them, so the true labels are known.  Which labels a character can get, and
which labels can follow each other, is what training has seen; words are proposed by the label sequences
that can be built from these, with any number of edits up to `MOST`.  A proposal is made, or refused, by the same
perceptron from its scores for the labels and from how often the corpus has both words.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

import numpy as np

#: What scanning reads for what is printed (fixed values: printed, read).
CONFUSIONS = (
    ("e", "c"), ("c", "e"), ("t", "f"), ("f", "t"), ("i", "1"), ("l", "1"), ("l", "|"), ("i", "|"), ("o", "0"), ("s", "5"),
    ("g", "9"), ("q", "9"), ("b", "6"), ("b", "8"), ("z", "2"), ("h", "b"), ("b", "h"), ("m", "rn"), ("rn", "m"), ("n", "ri"),
    ("ri", "n"), ("u", "ii"), ("ii", "u"), ("d", "cl"), ("cl", "d"), ("w", "vv"), ("vv", "w"), ("h", "li"), ("li", "h"),
)
KEEP, DELETE, JOIN, EDIT = "keep", "delete", "join", "edit"
#: Misreadings in one word that are undone together, at most.
MOST = 2
#: A word of the corpus is not learned from if it may be a misreading of one so many times as frequent.
SUSPECT = 8


class Perceptron:
    """Averaged perceptron over named features."""

    def __init__(self, labels: list[str], index: dict[str, int], weights: np.ndarray):
        self.labels, self.index, self.weights = labels, index, weights
        self.at = {x: k for k, x in enumerate(labels)}

    @classmethod
    def fit(cls, data: list[tuple[list[str], str]], labels: list[str], rng: random.Random, epochs: int = 3) -> Perceptron:
        at = {x: k for k, x in enumerate(labels)}
        index: dict[str, int] = {}
        coded = [(np.array([index.setdefault(f, len(index)) for f in feats]), at[y]) for feats, y in data]
        weights = np.zeros((max(1, len(index)), len(labels)), np.float32)
        past = np.zeros_like(weights)
        step = 1
        for _ in range(epochs):
            rng.shuffle(coded)
            for rows, y in coded:
                guess = int(weights[rows].sum(axis=0).argmax())
                if guess != y:
                    weights[rows, y] += 1
                    weights[rows, guess] -= 1
                    past[rows, y] += step
                    past[rows, guess] -= step
                step += 1
        return cls(labels, index, weights - past / step)

    def scores(self, feats: list[str]) -> np.ndarray:
        rows = [self.index[f] for f in feats if f in self.index]
        return self.weights[rows].sum(axis=0) if rows else np.zeros(len(self.labels), np.float32)

    def lead(self, feats: list[str], label: str, over: str) -> float:
        """How far `label` scores above `over`."""
        s = self.scores(feats)
        return float(s[self.at[label]] - s[self.at[over]])


def damage(word: str, rng: random.Random, times: int = 1) -> tuple[str, list[str]]:
    """A misreading of `word` and the labels that undo it, one for each character read."""
    sites = [(i, p, r) for p, r in CONFUSIONS for i in range(len(word)) if word.startswith(p, i)]
    rng.shuffle(sites)
    picked: list[tuple[int, str, str]] = []
    for i, p, r in sites:
        if len(picked) < times and all(i + len(p) < j or j + len(q) < i for j, q, _ in picked):
            picked.append((i, p, r))
    out, labels, at = "", [], 0
    for i, printed, read in sorted(picked):
        out += word[at:i] + read
        labels += [KEEP] * (i - at)
        if len(printed) == 2 and printed[0] == read:
            labels.append("+" + printed[1])
        else:
            labels += ["=" + printed] + [DELETE] * (len(read) - 1)
        at = i + len(printed)
    return out + word[at:], labels + [KEEP] * (len(word) - at)


def features(word: str, i: int) -> list[str]:
    at = lambda k: word[k] if 0 <= k < len(word) else "^" if k < 0 else "$"
    c, p, n, pp, nn = at(i), at(i - 1), at(i + 1), at(i - 2), at(i + 2)
    kind = lambda x: "9" if x.isdigit() else "a" if x.isalpha() else x
    return [c, "p" + p + c, "n" + c + n, "b" + p + c + n, "l" + pp + p + c, "r" + c + n + nn, "w" + pp + p + c + n + nn, "k" + kind(p) + kind(c) + kind(n), "s" + pp + p + "." + n + nn]


def join_features(mark: str, joined: int, dashed: int, left: int, right: int, lower: bool) -> list[str]:
    """What the editor sees at a hyphen that ends a line; counts come in powers of two."""
    size = lambda x: str(min(int(x).bit_length(), 16))
    more = "joined" if joined > dashed else "dashed" if dashed > joined else "even"
    hard = "hard" if mark in "-‐" else "soft"
    return ["J", "Jm" + hard, "Jc" + more, "Jcm" + more + hard, "Jj" + str(joined > 0), "Jd" + str(dashed > 0), "Jjd" + size(joined) + "/" + size(dashed), "Jl" + str(lower), "Jw" + str(left > joined) + str(right > joined) + more]


def edit_features(word: str, own: int, other: int, cost: float, edits: int) -> list[str]:
    """What the editor sees of a proposal: counts of both words, its own scores against it, and how much is changed."""
    gap = (other + 1).bit_length() - (own + 1).bit_length()
    mixed = "m" if not word.isalpha() else "a"
    dear = int(min(12, max(-4, cost // 4)))
    out = ["E", "Ek" + mixed, f"Ee{edits}{mixed}", f"El{min(len(word), 9)}{mixed}"]
    # thermometers, so that more evidence never counts for less
    out += [f"Eg{mixed}{t}" for t in range(-3, 11) if gap >= t] + [f"Ec{mixed}{t}" for t in range(-4, 13) if dear >= t] + [f"Ew{t}" for t in range(1, 12) if other.bit_length() >= t]
    return out


class Editor:
    """The character labels (`chars`), line joins and proposals (`moves`) of one corpus."""

    def __init__(self, chars: Perceptron, moves: Perceptron | None, allowed: dict[str, list[str]], follow: set[tuple[str, str]]):
        self.chars, self.moves, self.allowed, self.follow = chars, moves, allowed, follow

    def joins(self, feats: list[str]) -> bool:
        return self.moves.lead(feats, JOIN, KEEP) > 0

    def accepts(self, feats: list[str]) -> float:
        """Above 0 if the proposal is to be made; larger is better."""
        return self.moves.lead(feats, EDIT, KEEP)

    def _sites(self, word: str) -> list[tuple[int, int, str, list[tuple[int, str]]]]:
        """Edits that stand for themselves: first character, end, what replaces them, labels."""
        out = []
        for i, c in enumerate(word):
            for a in self.allowed.get(c, ()):
                if a == DELETE:
                    continue
                new = c + a[1:] if a[0] == "+" else a[1:]
                if (a, KEEP) in self.follow:
                    out.append((i, i + 1, new, [(i, a)]))
                if (a, DELETE) in self.follow and i + 1 < len(word) and DELETE in self.allowed.get(word[i + 1], ()):
                    out.append((i, i + 2, new, [(i, a), (i + 1, DELETE)]))
        return out

    def proposals(self, word: str, wanted: Callable[[str], bool]) -> Iterator[tuple[str, float, int]]:
        """`(proposed word, cost, edits)`: label sequences of up to MOST edits whose words are `wanted`.

        The cost is what the scores for keeping exceed those of the labels by, summed over the characters.
        """
        sites = self._sites(word)
        scored: dict[int, np.ndarray] = {}

        def cost(labels) -> float:
            total = 0.0
            for i, a in labels:
                if i not in scored:
                    scored[i] = self.chars.scores(features(word, i))
                total += float(scored[i][self.chars.at[KEEP]] - scored[i][self.chars.at[a]])
            return total

        for k, (s, e, new, labels) in enumerate(sites):
            one = word[:s] + new + word[e:]
            if wanted(one):
                yield one, cost(labels), 1
            if MOST > 1 and len(word) >= 6:
                for s2, e2, new2, labels2 in sites[k + 1 :]:
                    if s2 > e:
                        two = word[:s] + new + word[e:s2] + new2 + word[e2:]
                        if wanted(two):
                            yield two, cost(labels + labels2), 2


def train_chars(words: list[str], rng: random.Random) -> Editor:
    """Labels of characters from `words`, each undamaged once, damaged twice, and twice in one reading."""
    labels = [KEEP, DELETE]
    samples = []
    for w in words:
        samples += [(w, [KEEP] * len(w)), damage(w, rng), damage(w, rng)]
        if len(w) >= 6:
            samples.append(damage(w, rng, 2))
    allowed: dict[str, set[str]] = {}
    follow: set[tuple[str, str]] = set()
    data = []
    for read, gold in samples:
        for i, (c, g) in enumerate(zip(read, gold)):
            data.append((features(read, i), g))
            if g != KEEP:
                allowed.setdefault(c, set()).add(g)
                follow.add((g, gold[i + 1] if i + 1 < len(gold) else KEEP))
    labels += sorted({g for gs in allowed.values() for g in gs} - {DELETE})
    return Editor(Perceptron.fit(data, labels, rng), None, {c: sorted(g) for c, g in allowed.items()}, follow)


def wanted_counts(editor: Editor, words: list[str], compounds: list[str], known: Callable[[str], bool], rng: random.Random) -> tuple[list, list, set[str]]:
    """Examples of proposals and of line ends still without counts, and every word whose count they need."""
    moves, ends, need = [], [], set()
    taught = set(words)
    for w in words:
        readings = [(w, w)] + [(damage(w, rng)[0], w) for _ in range(2)] + ([(damage(w, rng, 2)[0], w)] if len(w) >= 6 else [])
        for read, true in readings:
            if read != w and read in taught:
                continue  # two words of the language; no telling them apart without context
            for other, cost, edits in editor.proposals(read, known):
                moves.append((read, true, other, cost, edits))
                need |= {read, true, other}
        if len(w) >= 5:
            k = rng.randint(2, len(w) - 2)
            ends.append((rng.choice("-‐¬­"), w[:k], w[k:], JOIN))
    ends += [(mark, *c.split("-", 1), KEEP) for c in compounds for mark in "--‐¬"]
    need |= {x for _, a, b, _ in ends for x in (a + b, a + "-" + b, a, b)}
    return moves, ends, need


def train_moves(editor: Editor, moves: list, ends: list, counts: Callable[[str], int], rng: random.Random) -> Editor:
    """The editor with its decisions on proposals and line ends.

    A word that a proposal turns into one SUSPECT times as frequent may itself be a frequent misreading; it teaches nothing.
    """
    suspects = {t for r, t, o, _, _ in moves if r == t and counts(o) >= SUSPECT * counts(t)}
    data = []
    for r, t, o, cost, n in moves:
        if t not in suspects:
            label = EDIT if o == t and r != t else KEEP
            data.append((edit_features(r, counts(r), counts(o), cost, n), label))
            if label == EDIT and counts(r):
                data.append((edit_features(r, 0, counts(o), cost, n), label))
    data += [(join_features(m, counts(a + b), counts(a + "-" + b), counts(a), counts(b), True), y) for m, a, b, y in ends]
    return Editor(editor.chars, Perceptron.fit(data, [KEEP, JOIN, EDIT], rng, 5), editor.allowed, editor.follow)
