"""Exact and near duplicates against brute force, and their odd cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute

from alertsieve.llm import exact_dedup as E
from alertsieve.llm import near_dedup as N
from alertsieve.llm.components import components
from llm_helpers import docs_df, text, words

SF001 = "/root/testdata/sf0.001"


def test_exact_groups(spark, odd_rows, odd_docs):
    rows = odd_rows + [(None, ""), (16, "one two"), (16, "one two")]
    got = E.exact_duplicates(docs_df(spark, rows)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = next(g for g in groups.values() if r.doc_id in g)
        assert r.group_size == len(ids) and r.keep_id == max(i for i in ids if i is not None)
        assert r.kept == (r.doc_id == r.keep_id)
        if len(ids) > 1:
            t = dict(rows)[r.doc_id] or ""
            assert r.full_hash == hashlib.sha256(t.encode()).hexdigest()


def test_exact_prefix_collision_is_resolved_by_the_full_hash(spark):
    same = "x" * 300
    got = E.exact_duplicates(docs_df(spark, [(1, same + "ab"), (2, same + "ba"), (3, same + "ab")])).collect()
    assert {r.doc_id: r.keep_id for r in got} == {1: 3, 2: 2, 3: 3}


def test_drop_exact_keeps_columns_and_one_row(spark, odd_rows, no_docs):
    docs = docs_df(spark, odd_rows + [(9, odd_rows[8][1]), (None, None)]).withColumn("_key", F.lit(1)).withColumn("kept", F.lit("x"))
    out = E.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    ids = sorted(r.doc_id for r in out.collect())
    assert ids == [2, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13, 14, 15]
    assert E.drop_exact_duplicates(no_docs).count() == 0 and E.exact_duplicates(no_docs).count() == 0


def near(docs, **kw):
    return {r.doc_id: (r.n, r.component_id) for r in N.near_duplicates(docs, **kw).collect()}


def test_near_equals_brute_force(spark, odd_rows, odd_docs, no_docs):
    assert near(odd_docs) == brute.near_components(odd_rows)
    assert N.near_duplicates(no_docs).count() == 0


def test_near_on_test_data(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    assert near(docs) == brute.near_components([tuple(r) for r in docs.collect()])


def _cluster(n):
    """One text with more and more changed words, and a chain of small steps away from it."""
    base = words(3, 150)
    rows = []
    for i in range(n):
        w = base[:]
        for j in range(i % 7):
            w[(i * 13 + j * 29) % 150] = f"w{i}x{j}"
        rows.append((i, " ".join(w)))
    w = base[:]
    for i in range(20):
        w[i * 7] = f"step{i}"
        rows.append((1000 + i, " ".join(w)))
    return rows


def test_near_large_group_in_blocks(spark):
    rows = _cluster(120)
    want = brute.near_components(rows)
    assert near(docs_df(spark, rows)) == want
    assert near(docs_df(spark, rows), block=8) == want  # the group is cut by size and into block pairs
    assert len({c for _, c in want.values()}) > 1


def test_near_threshold_border(spark):
    # 17 of 20 shingles shared: exactly 0.85; 16 of 19 is below
    a = words(8, 22)
    at = a + ["new1", "new2"]
    rows = [(1, " ".join(a)), (2, " ".join(at)), (3, text(77, 40))]
    s1, s2 = (brute.shingles(t) for _, t in rows[:2])
    assert 100 * len(s1 & s2) >= 85 * len(s1 | s2)
    assert near(docs_df(spark, rows)) == brute.near_components(rows)


def test_near_repeated_and_null_ids(spark):
    t, u = text(4, 60), text(6, 60)
    rows = [(5, t), (5, t), (5, u), (None, t), (None, u + " more"), (7, u)]
    got = N.near_duplicates(docs_df(spark, rows)).collect()
    assert len(got) == 6 and {r.component_id for r in got} == {5}


def test_components_of_chains_and_stars(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(0, 60)] + [("200", f"{i}") for i in range(201, 230)] + [("300", "300")]
    df = spark.createDataFrame(links, "a string, b string")
    got = {r.node: r.root for r in components(df).collect()}
    assert all(got[f"{i:03}"] == "000" for i in range(61)) and all(got[f"{i}"] == "200" for i in range(200, 230))
    assert components(df.limit(0)).count() == 0


def test_near_copies_of_a_class_meet_once(spark, monkeypatch):
    made = N._verify

    def once(*args):
        work = made(*args)

        def checked(group):
            ids = group.column("class").to_pylist()
            assert len(ids) == len(set(ids)), "copies of a class in one task"
            return work(group)
        return checked
    monkeypatch.setattr(N, "_verify", once)
    monkeypatch.setattr(N, "BITMAP_BITS", 6)  # a full map: every row passes
    rows = _cluster(20)
    rows += [(2000 + i, rows[0][1]) for i in range(60)]
    docs = docs_df(spark, rows)
    assert near(docs) == brute.near_components(rows)
    assert N.near_duplicates(docs.unionByName(docs)).count() == 2 * len(rows)


def test_links_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """Near copies of one text in one group of many blocks: every step returns links in proportion to the copies."""
    made, kept = {}, N.stored

    def counted(df, label):
        out = kept(df, label)
        if label.startswith("near-links"):
            made[label] = out.count()
        return out
    monkeypatch.setattr(N, "stored", counted)
    base, total = words(3, 150), {}
    for n in (150, 600):
        rows = []
        for i in range(n):
            w = base[:]
            for j in range(1 + i % 4):
                w[(i * 13 + j * 29) % 150] = f"w{i}x{j}"
            rows.append((i, " ".join(w)))
        made.clear()
        got = near(docs_df(spark, rows), block=32)
        roots = [c for _, c in got.values()]
        assert max(map(roots.count, set(roots))) >= n // 4
        if n == 150:
            assert got == brute.near_components(rows)
        assert {"near-links-a", "near-links-c"} <= set(made)
        total[n] = sum(made.values())
    assert total[600] < 6 * total[150] and total[600] < 8 * 600, total


def test_union_sketch_estimate():
    """Exact for sets that fit a sketch; near the similarity for larger ones."""
    r = np.random.default_rng(1)
    pool = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    for size, k in ((30, 48), (1500, 48), (1500, 400)):
        a = np.sort(pool[:size])
        b = np.sort(np.concatenate([pool[:int(size * 0.9)], pool[3000:3000 + size - int(size * 0.9)]]))
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = N._estimates([a[:k], b[:k]], np.array([size <= k] * 2))[0, 1]
        assert got == pytest.approx(j, abs=1e-12 if size <= k else 4 * np.sqrt(j * (1 - j) / k))


@pytest.mark.parametrize("low, high", [(0.85, 0.9)])
def test_recall_of_sets_beyond_the_sketch(spark, low, high):
    """Pairs of 300-word texts (296 shingles against a sketch of 48) just over the threshold: all are found."""
    r, rows = random.Random(9), []
    for i in range(150):
        w = words(5000 + i, 300)
        v, j = w[:], 1.0
        while True:
            u = v[:]
            u[r.randrange(300)] = f"n{i}x{len(rows)}x{r.randrange(10**6)}"
            s, t = brute.shingles(" ".join(w)), brute.shingles(" ".join(u))
            if len(s & t) / len(s | t) < low:
                break
            v = u
        s, t = brute.shingles(" ".join(w)), brute.shingles(" ".join(v))
        j = len(s & t) / len(s | t)
        assert low <= j <= high
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    got = near(docs_df(spark, rows))
    assert all(got[2 * i + 1][1] == 2 * i for i in range(150))


def test_edited_copies_are_not_paired_by_blocks(spark, monkeypatch):
    """A large group of copies with edits of their own: sets handed to tasks grow with the texts, not with their square."""
    seen, verify = spark.sparkContext.accumulator(0), N._verify

    def counted(*args):
        work = verify(*args)

        def run(group):
            seen.add(group.num_rows)
            return work(group)
        return run
    monkeypatch.setattr(N, "_verify", counted)
    base, sizes = words(5, 120), {}
    for n in (100, 400):
        r, docs = random.Random(4), []
        for i in range(n):
            t = list(base)
            for k in range(8):
                t[r.randrange(15 * k, 15 * k + 12)] = f"e{i}n{k}"
            docs.append((2 * i, " ".join(t)))
            if i % 10 == 0:
                docs.append((2 * i + 1, " ".join(t + [f"z{i}"])))  # a linked twin
        before = seen.value
        assert near(docs_df(spark, docs), block=16) == brute.near_components(docs)
        sizes[n] = seen.value - before
    assert sizes[400] < 6 * sizes[100], sizes
