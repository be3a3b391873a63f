"""Toxicity: a weighted lexicon found by Aho-Corasick in folded text, normalised by length.

Folding lowers the case, drops invisible characters, maps look-alike letters of other scripts
and digits or signs standing for letters to one skeleton (``l``, ``i`` and ``1`` share one);
those behind a letter count both as letters and as what they are.
The lexicon is learned from labelled rows with different texts: terms are words and word beginnings whose share of
toxic rows can't be chance (a bound on the binomial tail, corrected for the number of words looked at, so a rare insult
counts as soon as its rows prove it, on any size of table), that stand behind many different words and stay out of
clean rows, with the log odds of their row counts as weights.  Two-word phrases with an entry in it that clean
rows use are exceptions; a hit inside one does not count.  A logistic curve over the weight found and the
weight per word turns hits into a score.

Fitting reads at most ``FIT_ROWS`` rows of each label, the ones with the smallest hash of their
key; scoring reads every whole text.  The model, terms and phrases of those rows, is all that
reaches the tasks.

Defined results: NULL text is the empty text and has the score of a text without hits; labels
other than 0 and 1 are ignored, rows labelled both ways count as toxic, a NULL id has no label; without both labels
among the rows to learn from, every score is 0.  Rows that repeat an id or text are scored alike.  Columns of the
input that are called like an added one are replaced, any other column is kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FIT_ROWS = 8000
#: Lengths of word beginnings that may become terms.
STEMS = range(4, 10)
#: A term needs that many toxic rows, that part of its rows toxic, words before it that differ in that share of its
#: rows, and a chance below that to be as toxic if it were any of the words looked at.
MIN_ROWS, MIN_PURITY, DIVERSITY, DOUBT = 5, 0.98, 0.1, 0.01
REJECT = 0.7
#: Rows that a task turns into Python strings at once.
PIECE = 256

#: Letters of other scripts by the Latin letter they look like.
LOOKALIKES = {
    "a": "аα", "b": "вβ", "c": "сϲ", "d": "ԁ", "e": "еε", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј", "k": "кκ",
    "m": "м", "n": "ո", "o": "оοσ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υ", "v": "ν", "w": "ԝω",
    "x": "хχ", "y": "уγ", "z": "ᴢ",
}
#: Digits and signs standing for letters.
STANDINS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
            "@": "a", "$": "s", "|": "i", "+": "t", "!": "i"}
INVISIBLE = "­​‌‍⁠﻿"
_MAP = {ord(c): latin for latin, cs in LOOKALIKES.items() for c in cs} | {ord(c): None for c in INVISIBLE}
_MAP |= {0xFF41 + i: chr(97 + i) for i in range(26)} | {ord("l"): "i"}
_MAP |= {k: "i" for k, v in _MAP.items() if v == "l"}
#: Characters that the map changes but ``l``: few texts hold one.
_MAPPED = re.compile("[" + "".join(re.escape(chr(k)) for k in _MAP if k != ord("l")) + "]")
#: Before a letter; behind one, where signs may also be what they are, so terms are looked for in all forms.
_STANDIN = re.compile(r"[0-9@$|]+(?=[^\W\d_])")
_BEHIND, _SIGNS = re.compile(r"[0-9@$|+]+"), re.compile(r"[0-9@$|+!]+")
_STANDIN_MAP = str.maketrans(STANDINS)
_LETTER, _WORD = re.compile(r"[^\W\d_]"), re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    t = text.lower()
    if not t.isascii():
        t = _MAPPED.sub(lambda m: _MAP[ord(m[0])] or "", t)
    return _STANDIN.sub(lambda m: m[0].translate(_STANDIN_MAP), t.replace("l", "i"))


def _beside_letters(m: re.Match) -> str:
    """A run of stand-ins: all of it behind a letter, else its last + and ! before one."""
    t, run = m.string, m[0]
    if m.start() and _LETTER.match(t[m.start() - 1]):
        return run.translate(_STANDIN_MAP)
    keep = run.rstrip("+!")
    if len(keep) < len(run) and m.end() < len(t) and _LETTER.match(t[m.end()]):
        return keep + run[len(keep):].translate(_STANDIN_MAP)
    return run


def forms(folded: str) -> list[str]:
    """The folded text, and what else it may stand for when a word's last letters are written as digits
    or signs.  All are equally long; digits and signs without a letter beside them stay."""
    out = [folded]
    signs = _SIGNS.sub(_beside_letters, folded)
    if signs != folded:  # whatever the shorter pattern changes, this one does
        for t in (_BEHIND.sub(_beside_letters, folded), signs):
            if t not in out:
                out.append(t)
    return out


@dataclass
class Model:
    """Terms with weights (a trailing ``$``: the whole word), exception phrases, curve."""
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    fitted: bool = False


class Matcher:
    """The automaton of a model."""

    def __init__(self, model: Model):
        import ahocorasick
        self.model = model
        self.automaton = ahocorasick.Automaton()
        words: dict[str, list] = {}
        for term in model.terms:
            words.setdefault(term.rstrip("$"), []).append(term)
        for phrase in model.exceptions:
            words.setdefault(phrase, []).append(None)
        for word, kinds in words.items():
            self.automaton.add_word(word, (len(word), kinds))
        if words:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, term) in the folded text; the longest term at every word, outside exceptions."""
        if not len(self.automaton):
            return []
        best, spared = {}, []
        for form in forms(text):
            for last, (n, kinds) in self.automaton.iter(form):
                start, end = last - n + 1, last + 1
                if start and form[start - 1].isalpha():
                    continue
                ends = end == len(form) or not form[end].isalpha()
                for term in kinds:
                    if term is None:
                        if ends:
                            spared.append((start, end))
                    elif ends or term[-1] != "$":
                        if start not in best or best[start][0] < end:
                            best[start] = (end, term)
        return [(s, e, t) for s, (e, t) in sorted(best.items())
                if not any(a <= s and e <= b for a, b in spared)]

    def features(self, text: str) -> tuple[float, int, int]:
        """(weight of the hits, number of hits, characters)."""
        found = self.hits(text)
        return sum(self.model.terms[t] for _, _, t in found), len(found), len(text)


def _inputs(weight: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Weight found and weight per 1000 characters, both damped."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(1000 * weight / (chars + 200.0))], axis=1)


def score_texts(matcher: Matcher, texts: list) -> tuple[np.ndarray, np.ndarray]:
    found = [matcher.features(fold(t)) if t else (0.0, 0, 0) for t in texts]
    w, n, chars = (np.array([f[i] for f in found], dtype=np.float64) for i in range(3))
    if not matcher.model.fitted:
        return np.zeros(len(texts)), n.astype(np.int64)
    z = _inputs(w, chars) @ np.array(matcher.model.curve)
    return 1 / (1 + np.exp(-np.clip(z, -50, 50))), n.astype(np.int64)


def _term_sets(text: str) -> tuple[set, set]:
    """Candidate terms of a folded text, and its two-word phrases."""
    words = _WORD.findall(text)
    terms = {w + "$" for w in words}
    for w in set(words):
        terms.update(w[:n] for n in STEMS if len(w) >= n)
    return terms, words


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: a batch's texts are not all turned into Python strings at once."""
    for b in batches:
        for at in range(0, b.num_rows, PIECE):
            yield b.slice(at, PIECE)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = [Counter(), Counter()]

    def flush():
        names = list(count[0].keys() | count[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([count[1][x] for x in names], pa.int64()),
             pa.array([count[0][x] for x in names], pa.int64())], names=["term", "bad", "good"])
        count[0].clear()
        count[1].clear()
        return out
    for b in _pieces(batches):
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if text:
                count[toxic].update(_term_sets(fold(text))[0])
            if len(count[0]) + len(count[1]) > 200_000:
                yield flush()
    yield flush()


def _term_words(terms: set[str]):
    """Words of toxic rows that some candidate covers, each with the word before it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            rows = []
            for text in b.column(0).to_pylist():
                words = _WORD.findall(fold(text)) if text else []
                pairs = dict(zip(words, [""] + words))
                rows.append([f"{w} {before}" for w, before in pairs.items()
                             if w + "$" in terms or any(w[:n] in terms for n in STEMS)])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["words"])
    return work


def _phrases(model: Model):
    """Two-word phrases around hits, per label."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for b in _pieces(batches):
            out = []
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = fold(text or "")
                seen = set()
                for start, _, _ in matcher.hits(t):
                    for m in (re.compile(r"[^\W\d_]+ [^\W\d_]+").match(t, start),
                              re.compile(r"[^\W\d_]+ [^\W\d_]+").match(t, t.rfind(" ", 0, max(start - 1, 0)) + 1)):
                        if m and m.start() <= start < m.end():
                            seen.add(m[0])
                out += [(p, toxic) for p in seen]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()),
                                              pa.array([x for _, x in out], pa.int32())], names=["phrase", "toxic"])
    return work


def _features(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for b in _pieces(batches):
            found = [matcher.features(fold(t)) if t else (0.0, 0, 0) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([f[0] for f in found], pa.float64()),
                 pa.array([float(f[2]) for f in found], pa.float64())], names=["toxic", "weight", "chars"])
    return work


def _evidence(bad: float, good: float, n_bad: int, n_good: int) -> float:
    """Bound on minus the log of the chance of so large a part of toxic rows, if the word fell into rows of
    either label alike (Chernoff)."""
    n, p = bad + good, n_bad / (n_bad + n_good)
    x = bad / n if n else 0.0
    if x <= p:
        return 0.0
    return n * (x * math.log(x / p) + ((1 - x) * math.log((1 - x) / (1 - p)) if x < 1 else 0.0))


def _choose(rows: list[list[str]], counts: dict[str, tuple[int, int]], n_bad: int, n_good: int, least: float) -> dict[str, float]:
    """Terms by falling evidence.  A term counts only words that no chosen term covers; it needs evidence of
    ``least`` and many different words before it, so that near copies of one toxic text do
    not make all of its words terms."""
    where: dict[str, list[tuple[int, str, str]]] = {}
    for i, words in enumerate(rows):
        for pair in words:
            w, _, before = pair.partition(" ")
            for t in [w + "$"] + [w[:n] for n in STEMS if len(w) >= n]:
                if t in counts:
                    where.setdefault(t, []).append((i, w, before))

    def weight(bad: int, good: int) -> float:
        return math.log((bad + 0.5) / (n_bad + 1)) - math.log((good + 0.5) / (n_good + 1))
    order = sorted(where, key=lambda t: (-counts[t][0] * weight(*counts[t]), t[-1] == "$", -len(t), t))
    out: dict[str, float] = {}
    for t in order:
        left = [(i, w, before) for i, w, before in where[t]
                if w + "$" not in out and not any(w[:n] in out for n in STEMS)]
        bad, good = len({i for i, _, _ in left}), counts[t][1]
        pure = bad / n_bad >= MIN_PURITY * (bad / n_bad + good / n_good)
        various = len({before for _, _, before in left}) >= max(MIN_ROWS, DIVERSITY * bad)
        if bad >= MIN_ROWS and various and pure and _evidence(bad, good, n_bad, n_good) >= least:
            out[t] = weight(bad, good)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps, classes weighted alike; slopes are not negative."""
    w = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (p - y)) + ridge * b
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        b -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        b[1:] = np.maximum(b[1:], 0)
    return tuple(float(v) for v in b)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        rows: int = FIT_ROWS) -> Model:
    """Learn a model from the labelled rows of ``docs`` (``labels`` holds only rows to learn from)."""
    one = labels.filter(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    pick = lambda v: one.filter(F.col("toxic") == v).orderBy(F.xxhash64(key), key).limit(rows)
    chosen = pick(0).unionByName(pick(1))  # at most 2 * rows keys: safe to broadcast
    sample = stored(docs.select(F.col(key), F.col(text).alias("t")).join(F.broadcast(chosen), key)
                    .select("t", "toxic").distinct(), "tox-fit")  # copies of a text prove nothing more
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model()
    n_bad, n_good = n[1], n[0]
    counted = stored(sample.mapInArrow(_count_terms, "term string, bad long, good long").groupBy("term").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(F.col("bad") + F.col("good") >= MIN_ROWS), "tox-terms")
    least = math.log(max(counted.count(), 1) / DOUBT)
    # rows of a label are weighed by its sample
    rate = F.col("bad") / n_bad
    pure = rate >= MIN_PURITY * (rate + F.col("good") / n_good)
    top = counted.filter((F.col("bad") >= MIN_ROWS) & pure).collect()  # words of at most 2 * ``rows`` texts
    counts = {r["term"]: (r["bad"], r["good"]) for r in top if _evidence(r["bad"], r["good"], n_bad, n_good) >= least}
    found = (sample.filter("toxic = 1").select("t").mapInArrow(_term_words(set(counts)), "words array<string>")
             .collect())
    model = Model(terms=_choose([r["words"] for r in found], counts, n_bad, n_good, least))
    phrases = (sample.mapInArrow(_phrases(model), "phrase string, toxic int").groupBy("phrase")
               .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
               .filter((F.col("good") >= MIN_ROWS) & (F.col("good") / n_good > 9 * F.col("bad") / n_bad))
               .orderBy(F.desc("good"), "phrase").collect())
    model.exceptions = [r["phrase"] for r in phrases]
    x = sample.mapInArrow(_features(model), "toxic int, weight double, chars double").toArrow()
    y, w, c = (x[k].to_numpy().astype(np.float64) for k in ("toxic", "weight", "chars"))
    model.curve, model.fitted = _logistic(_inputs(w, c), y), True
    return model


def with_scores(docs: DataFrame, model: Model, text: str = "text", score: str = "score",
                hits: str = "n_hits") -> DataFrame:
    """``docs`` with the score (0 to 1) and the number of lexicon hits of every whole text."""
    matcher = {}

    @F.arrow_udf("struct<score: double, hits: long>")
    def scored(texts: pa.Array) -> pa.Array:
        if not matcher:
            matcher[0] = Matcher(model)
        made = [score_texts(matcher[0], texts.slice(at, PIECE).to_pylist()) for at in range(0, max(len(texts), 1), PIECE)]
        return pa.StructArray.from_arrays([pa.array(np.concatenate([m[i] for m in made])) for i in range(2)],
                                          names=["score", "hits"])
    # the text goes in under a name of its own, so the added column clashes with none
    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), scored(F.col(f"`{text}`")).alias("made"))
    return both.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in (score, hits)],
                       F.col("made.score").alias(score), F.col("made.hits").alias(hits))
