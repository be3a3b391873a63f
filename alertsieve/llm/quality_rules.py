"""Quality rules with risk-controlled thresholds.

1. Every text yields counts (words, characters in words, symbols, repeated lines, words in repeated
   5-word windows, capitals, signs, words without a letter, ...), and from them one level per rule: how many cutoffs of the rule's
   fixed grid its value reaches.
2. Labelled documents are dealt by the crc32 of their id into a tuning half and a holdout.  On the tuning half every
   stratum (language) gets a ladder of settings: at step k a rule's cutoff sinks as long as it
   rejects at most ``STEPS[k]`` of the stratum's good tuning documents and what it adds to the rejected is ``LIFT`` times
   as large a share of the bad documents as of the good ones; a rule that finds no such cutoff is off.  A higher step rejects whatever a lower one does.
3. The holdout certifies.  A setting passes where the chance of so few false rejections among the
   stratum's good holdout documents, were the true rate ``RISK``, is at most ``DOUBT`` over the number of
   strata (exact binomial tail, Bonferroni over strata).  Steps are tested from the lowest up, ending at the first that
   fails, so the steps of a stratum need no further correction (fixed-sequence testing).  With chance
   1 - DOUBT, no stratum's rules reject more than ``RISK`` of its good documents.
4. Documents are rejected by the base rules or by the highest certified setting of their stratum.

Only counts by (stratum, rule, level) and (stratum, step) are gathered, in Spark; strata are never brought to the
driver but for their number.

Defined results: a NULL or empty text has no words and fails the base rules; a NULL language is a
stratum of its own; a stratum without a certified setting keeps what the base rules keep.  Labels other
than 0 and 1 aren't used; of repeated labels of an id the least counts, and a document whose id is NULL has
none.  Rows that repeat an id or text are judged alike.  Columns of the input that are called like an
added one are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import stored

WINDOW = 5
#: Base rules: fewest words, and the greatest share of words in repeated windows.
MIN_WORDS, MAX_REPEATED = 10, (20, 100)
#: Limit of false rejections, chance of breaking it in any stratum, ladder of the tuning half.
RISK, DOUBT = 0.02, 0.05
STEPS = (0.0, 0.0005, 0.001, 0.0015, 0.002, 0.003, 0.004, 0.005, 0.006, 0.008)
LIFT = 5
#: Cutoffs of a rule whose value is a share, from high to low, and of the mean word length.
SHARES = tuple(round(2.0 ** (-k / 4), 6) for k in range(37))
LENGTHS = tuple(range(60, 8, -2))
#: Rule -> (count, of which, cutoffs): its value is their quotient, high values are bad.
RULES = {
    "symbols": ("n_symbols", "word_chars", SHARES),
    "repeated_windows": ("n_repeat_words", "n_words", SHARES),
    "repeated_lines": ("n_dup_lines", "n_lines", SHARES),
    "capitals": ("n_capitals", "n_letters", SHARES),
    "shouts": ("n_shouts", "n_words", SHARES),
    "bare_words": ("n_bare_words", "n_words", SHARES),
    "digits": ("n_digits", "word_chars", SHARES),
    "long_words": ("word_chars", "n_words", LENGTHS),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals",
          "n_shouts", "n_digits", "n_bare_words")

_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_FIRST = np.array([not 0x80 <= b <= 0xBF for b in range(256)])  # first byte of a character
_RANDOM = W.mix(np.arange(1, 257, dtype=W.U) * W.U(0xB5297A4D3F84D5A5)) | W.U(1)
#: Words are compared as they stand; lines with their white space.
_WORDS = np.where(_SPACE, W.U(0), _RANDOM)
_LINES = np.where(np.arange(256) == 0x0A, W.U(0), _RANDOM)
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_SHOUT = np.isin(np.arange(256), list(b"!?"))
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_CAPITAL = np.array([0x41 <= b <= 0x5A for b in range(256)])
#: Letters: A-Z, a-z and every character beyond ASCII.
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0xC0 for b in range(256)])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a key occurs before in its text, and whether it occurs there twice or more."""
    order = np.lexsort((np.arange(len(keys)), keys, text))
    k, t = keys[order], text[order]
    same = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    later, twice = np.zeros((2, len(keys)), dtype=bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return later, twice


def _runs(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the runs of true flags begin; a run ends with its text."""
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(inside)]
    begins[heads] = inside[heads]
    return np.flatnonzero(begins)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every text of a piece (UTF-8 bytes, offsets of texts)."""
    n = len(offsets) - 1
    space = _SPACE[data]
    out = {"word_chars": _per_text(_FIRST[data] & ~space, offsets)}
    for name, table in (("n_symbols", _SYMBOL), ("n_letters", _LETTER), ("n_capitals", _CAPITAL), ("n_shouts", _SHOUT),
                        ("n_digits", _DIGIT)):
        out[name] = _per_text(table[data], offsets)

    words, first = W.words(data, offsets, _WORDS)
    out["n_words"] = first[1:] - first[:-1]
    text = np.repeat(np.arange(n), out["n_words"])
    windows = W.ngrams(words, WINDOW)
    whole = np.flatnonzero(text[:len(windows)] == text[WINDOW - 1:]) if len(windows) else np.zeros(0, np.int64)
    _, twice = _repeats(windows[whole], text[whole])
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, whole[twice], 1)
    np.add.at(steps, whole[twice] + WINDOW, -1)
    out["n_repeat_words"] = _per_text(np.cumsum(steps[:-1]) > 0, first)

    inside = ~space
    begin = _runs(inside, offsets)
    letters = np.add.reduceat(_LETTER[data], begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
    out["n_bare_words"] = _per_text(letters == 0, first)

    # lines with a word: bytes other than \n whose run holds one that isn't white space
    lines, of = W.words(data, offsets, _LINES)
    begin = _runs(data != 0x0A, offsets)
    solid = np.add.reduceat(inside, begin, dtype=np.int64) > 0 if len(begin) else np.zeros(0, bool)
    text = np.repeat(np.arange(n), of[1:] - of[:-1])[solid]
    later, _ = _repeats(lines[solid], text)
    out["n_lines"] = np.bincount(text, minlength=n).astype(np.int64)
    out["n_dup_lines"] = np.bincount(text[later], minlength=n).astype(np.int64)
    return out


def _levels(counts: dict[str, np.ndarray]) -> np.ndarray:
    """texts x rules: how many cutoffs a value reaches (level 1: the lowest one)."""
    out = []
    for part, whole, cutoffs in RULES.values():
        value = counts[part] / np.maximum(counts[whole], 1)
        out.append((value[:, None] >= np.array(cutoffs)[None, :]).sum(axis=1))
    return np.stack(out, axis=1).astype(np.int8)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns but the text, which is last, the counts, and a level per rule."""
    for b in batches:
        for at, data, offsets in W.chunks(b.column(b.num_columns - 1)):
            counts = measure(data, offsets)
            levels = _levels(counts)
            rows = b.slice(at, len(levels))
            yield pa.RecordBatch.from_arrays(
                rows.columns[:-1] + [pa.array(counts[c], pa.int64()) for c in COUNTS]
                + [pa.FixedSizeListArray.from_arrays(pa.array(levels.ravel(), pa.int8()), levels.shape[1]).cast(pa.list_(pa.int8()))],
                names=rows.schema.names[:-1] + list(COUNTS) + ["levels"])


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but its text, the counts, and ``levels``."""
    names = [c for c in docs.columns if c != text and c not in (*COUNTS, "levels")]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{text}`").alias("t"))
    fields = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(names))
    made = rows.mapInArrow(_count_rows, f"{fields}{', '.join(f'{c} long' for c in COUNTS)}, levels array<tinyint>")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *COUNTS, "levels")


def base_failed():
    """The base rules, over the counts."""
    num, den = MAX_REPEATED
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * den > F.col("n_words") * num)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n draws at rate p, exact up to rounding."""
    if k >= n:
        return 1.0
    term = n * math.log1p(-p)
    logs = [term]
    for i in range(1, k + 1):
        term += math.log((n - i + 1) / i) + math.log(p) - math.log1p(-p)
        logs.append(term)
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def ladder(good: np.ndarray, bad: np.ndarray, steps=STEPS, lift: float = LIFT) -> np.ndarray:
    """steps x rules: the level from which a rule rejects (0: never), from tuning counts rules x levels."""
    deep = good.shape[1]
    # documents at or above a level
    over = [np.cumsum(x[:, ::-1], axis=1)[:, ::-1] / max(1, x[0].sum()) for x in (good, bad)]
    out = np.zeros((len(steps), len(good)), dtype=np.int64)
    for rule in range(len(good)):
        for k, share in enumerate(steps):
            wrong = right = 0.0
            for v in range(deep - 1, 0, -1):
                more_wrong, more_right = over[0][rule, v] - wrong, over[1][rule, v] - right
                if over[0][rule, v] <= share and more_right > 0 and more_right >= lift * more_wrong:
                    out[k, rule], wrong, right = v, over[0][rule, v], over[1][rule, v]
    # a step rejects whatever an earlier one does
    for k in range(1, len(steps)):
        before = out[k - 1]
        out[k] = np.where(before == 0, out[k], np.where(out[k] == 0, before, np.minimum(before, out[k])))
    return out


def certify(wrong: np.ndarray, good: int, strata: int, risk: float = RISK, doubt: float = DOUBT) -> int:
    """How many steps are certified: ``wrong[k]`` of ``good`` holdout documents are rejected at step k."""
    for k, w in enumerate(wrong):
        if binomial_tail(int(w), int(good), risk) > doubt / strata:
            return k
    return len(wrong)


def _ladders(steps, lift, deep: int):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        counts = np.zeros((2, len(RULES), deep), dtype=np.int64)
        for quality, rule, level, n in zip(*[table.column(c).to_pylist() for c in ("quality", "rule", "level", "n")]):
            counts[quality, rule, level] += n
        out = ladder(counts[1], counts[0], steps, lift)
        return pa.table({"stratum": pa.array([key[0].as_py()], pa.string()),
                         "ladder": pa.array([out.tolist()], pa.list_(pa.list_(pa.int64())))})
    return work


def _settings(strata: int, steps, risk, doubt):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        wrong = np.zeros(len(steps) + 1, dtype=np.int64)
        for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist()):
            wrong[at] += n
        passed = certify(np.cumsum(wrong[:-1]), int(wrong.sum()), strata, risk, doubt)
        chosen = table.column("ladder")[0].as_py()[passed - 1] if passed else [0] * len(RULES)
        return pa.table({"stratum": pa.array([key[0].as_py()], pa.string()), "steps": pa.array([passed], pa.int64()),
                         "holdout": pa.array([int(wrong.sum())], pa.int64()),
                         "wrong": pa.array([int(wrong[:passed].sum())], pa.int64()),
                         "cutoffs": pa.array([chosen], pa.list_(pa.int64()))})
    return work


def _rejects(levels: str, cutoffs) -> F.Column:
    """Any rule at or above its cutoff."""
    return F.exists(F.zip_with(levels, cutoffs, lambda v, c: (c > 0) & (v >= c)), lambda x: x)


def fit(rows: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", quality: str = "quality",
        steps=STEPS, lift: float = LIFT, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """(stratum, steps, holdout, wrong, cutoffs) of every stratum with good labelled documents in the holdout.

    ``rows`` are ``counted`` documents.  Documents that fail the base rules are no one's holdout."""
    marks = (labels.filter(F.col(quality).isin(0, 1)).groupBy(F.col(key).alias("_key"))
             .agg(F.min(quality).cast("int").alias("_quality")))
    known = stored(rows.filter(~base_failed())
                   .select(F.col(key).alias("_key"), F.col(stratum).cast("string").alias("stratum"), "levels")
                   .join(marks, "_key")
                   .select("stratum", "levels", F.col("_quality").alias("quality"),
                           (F.crc32(F.col("_key").cast("string").cast("binary")) % 2 == 0).alias("tuning")), "quality-known")
    deep = 1 + max(len(c) for _, _, c in RULES.values())
    counts = (known.filter("tuning").select("stratum", "quality", F.posexplode("levels").alias("rule", "level"))
              .groupBy("stratum", "quality", "rule", "level").agg(F.count(F.lit(1)).alias("n")))
    ladders = stored(counts.groupBy("stratum").applyInArrow(
        _ladders(steps, lift, deep), "stratum string, ladder array<array<bigint>>"), "quality-ladders")
    good = known.filter("NOT tuning AND quality = 1").withColumnRenamed("stratum", "_stratum")
    met = good.join(ladders, F.col("_stratum").eqNullSafe(F.col("stratum")))
    # the first step at which a document is rejected
    at = F.coalesce(*[F.when(_rejects("levels", F.col("ladder")[k]), k) for k in range(len(steps))], F.lit(len(steps)))
    wrong = stored(met.groupBy("stratum", at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.first("ladder").alias("ladder")),
                   "quality-wrong")
    strata = wrong.select("stratum").distinct().count()
    return stored(wrong.groupBy("stratum").applyInArrow(
        _settings(max(1, strata), steps, risk, doubt),
        "stratum string, steps long, holdout long, wrong long, cutoffs array<bigint>"), "quality-settings")


def judge(rows: DataFrame, settings: DataFrame, stratum: str = "lang") -> DataFrame:
    """``rows`` (``counted`` documents) and base_failed, kept, rejected_by (rules, in their order)."""
    own = settings.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs"))
    met = (rows.drop("base_failed", "kept", "rejected_by")
           .join(own, F.col(stratum).cast("string").eqNullSafe(F.col("_stratum")), "left"))
    hits = F.zip_with("levels", "_cutoffs", lambda v, c: (c > 0) & (v >= c))
    names = F.array(*map(F.lit, RULES))
    hit_names = F.filter(F.zip_with(names, hits, lambda n, h: F.when(h, n)), lambda x: x.isNotNull())
    return (met.withColumn("base_failed", base_failed())
            .withColumn("rejected_by", F.coalesce(hit_names, F.array().cast("array<string>")))
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("_stratum", "_cutoffs"))
