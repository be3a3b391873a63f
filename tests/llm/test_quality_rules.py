"""Quality rules: counts against plain Python, bounds against exact sums, limits on held-out labels."""

import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from alertsieve.llm import quality_rules as R
from alertsieve.llm import queries as Q
from conftest import SF01
from llm_helpers import DOCS, docs_df, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(body):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    body = body or ""
    w = WORD.findall(body)
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    repeated = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    lines = [x for x in body.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", body)), len(lines) - len(set(lines)), len(repeated),
            len(w) < 10 or 100 * len(repeated) > 20 * len(w))


ODD = [None, "", " \n\t ", "one", "a b c d e", "x\nx\nx \n\n x", "Été été\nÉté été\n" * 4, "# * $ % & | < > ~",
       "a b c d e " * 6, "a b c d e f\n\x0b\x0c\ra b c d e", "dernière ligne 中文 " * 3, "A b\nA b\na b\nA b ",
       "\x00 \x01", "word " * 5000, "1 2 3 4 5 6 7 8 9 10 11 12 3 4 5 6 7", "!!! ??? \n!!! ???\n"]


def run(spark, docs, labels, path):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return Q.op13_quality_rules(spark, str(path)).collect()


def test_counts_of_odd_texts(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "one"), (None, "a null id " * 9)]
    rows += [(100 + k, text(k, 400) + "\n" + text(k // 2, 60)) for k in range(20)]
    docs = docs_df(spark, rows)
    got = run(spark, docs, [], tmp_path)
    want = sorted(((i, *base(t)) for i, t in rows), key=str)
    assert sorted((tuple(r)[:7] for r in got), key=str) == want
    assert all(r.kept == (not r.base_failed) for r in got)  # nothing is certified without labels


def test_extra_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    docs = docs_df(spark, [(1, text(1, 50))]).withColumn("levels", F.lit("x")).withColumn("kept", F.lit("y"))
    docs = docs.withColumn("n_words", F.create_map(F.lit(1), F.lit(2))).withColumn("stratum", F.lit(3))
    rows = R.counted(docs)
    labels = spark.createDataFrame([(1, 1, "z")], "doc_id long, quality int, levels string")
    out = R.judge(rows, R.fit(rows, labels)).collect()
    assert len(out) == 1 and out[0].n_words == 50 and out[0].kept is True and out[0].stratum == 3


def test_empty_tables(spark, tmp_path):
    assert run(spark, spark.createDataFrame([], DOCS), [], tmp_path) == []


@pytest.mark.parametrize("k, n, p", [(0, 1, 0.5), (0, 300, 0.02), (3, 200, 0.02), (17, 900, 0.03), (5, 5, 0.1)])
def test_binomial_tail_is_exact(k, n, p):
    q = Fraction(p)
    want = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
    assert math.isclose(R.binomial_tail(k, n, p), float(want), rel_tol=1e-9)


def test_steps_end_at_the_first_failure():
    n = 1000
    most = max(k for k in range(60) if R.binomial_tail(k, n, R.RISK) <= R.DOUBT / 4)
    assert R.certify(np.array([0, most, most + 1, 0]), n, 4) == 2
    assert R.certify(np.array([0, 0]), 10, 1) == 0  # too few labels for any claim


def test_ladder_grows_and_leaves_out_useless_rules():
    r = np.random.default_rng(1)
    good, bad = r.integers(0, 9, (2, 3, 12))
    good[0, 4:] = 0
    bad[1] = good[1]
    steps = R.ladder(good, bad)
    assert (steps[:, 1] == 0).all()  # rejects good and bad documents alike
    used = np.where(steps == 0, 99, steps)
    assert (np.diff(used, axis=0) <= 0).all()


def test_false_rejections_stay_below_the_limit(spark, tmp_path):
    """Strata of their own noise; the rate on fresh good documents is near or below RISK."""
    r = random.Random(5)

    def one(i, lang, good):
        w = text(i, 30).split()
        marks = r.random() ** (8 if lang == "en" else 3) * 10 if good else 8 + r.random() * 12
        for at in r.sample(range(30), int(marks)):
            w[at] += "###"
        return (i, " ".join(w), lang, "s")
    rows, labels = [], []
    for i in range(6000):
        lang, good = r.choice(["en", "de", None]), r.random() < 0.8
        rows.append(one(i, lang, good))
        if i < 4000:
            labels += [(i, int(good), 0)] * (1 + (i % 50 == 0))
        elif not good:
            labels.append((i, None, 0))
    docs = docs_df(spark, rows)
    got = {x.doc_id: x for x in run(spark, docs, labels, tmp_path)}
    bad = {i for i, q, _ in labels if q != 1}
    for lang in ("en", "de", None):
        fresh = [i for i, _, la, _ in rows if i >= 4000 and la == lang]
        good = [i for i in fresh if i not in bad]
        wrong = sum(not got[i].kept for i in good) / len(good)
        caught = [not got[i].kept for i in fresh if i in bad]
        assert wrong <= R.RISK + 3 * math.sqrt(R.RISK / len(good))
        assert sum(caught) / len(caught) > 0.25


def test_whole_table(spark):
    got = {r.doc_id: r for r in Q.op13_quality_rules(spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    assert {d.doc_id: base(d.text) for d in docs} == {i: tuple(r)[1:7] for i, r in got.items()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    held = [i for i in got if quality.get(i) == 1 and zlib.crc32(str(i).encode()) % 2]
    assert sum(not got[i].kept for i in held) <= 0.05 * len(held)
