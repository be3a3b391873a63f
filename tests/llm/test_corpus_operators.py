"""Toxicity, line dedup, mixing, language-model scores: brute force, SQL, held-out quality, odd cases."""

import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

import brute
from alertsieve.llm import attention as A
from alertsieve.llm import line_dedup as L
from alertsieve.llm import lm_scoring as LM
from alertsieve.llm import mixing as M
from alertsieve.llm import oracle as O
from alertsieve.llm import queries as Q
from alertsieve.llm import toxicity as T
from llm_helpers import docs_df, text, words

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def same(df, sql, sf):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in res.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=str) == want


@pytest.mark.parametrize("name", sorted(O.SQL))
def test_query_matches_sql(spark, name):
    same(Q.Q[name](spark, SF001), O.SQL[name], SF001)


# --- toxicity -------------------------------------------------------------------------------

def _labelled(spark, n=400):
    r = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        w = words(1000 + i, 60)
        bad = i % 4 == 0
        if bad:
            for term in r.sample(["scumbag", "morons", "loserly"], 2):
                w.insert(r.randrange(len(w)), term)
        if i % 8 == 3:
            w[10:10] = ["white", "scumbag"]  # an exception: clean rows say it
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs_df(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = _labelled(spark)
    return T.fit(docs, labels.unionByName(labels.limit(3)).unionByName(
        spark.createDataFrame([(1, None), (9999, 1), (2, 7)], "doc_id long, toxic int")))


def scores(spark, model, texts):
    out = T.with_scores(docs_df(spark, list(enumerate(texts))).withColumn("score", F.lit("x")), model)
    return [r.score for r in out.orderBy("doc_id").collect()]


def test_lexicon_finds_folded_words(spark, model):
    assert {t.rstrip("$") for t in model.terms} >= {T.fold("morons"), T.fold("loserly")}
    clean = text(1, 50)
    bad = ["morons", "MORONS!", "m0r0ns", "mоrоns", "mo​rons", "1oserly", "ｍｏｒｏｎｓ"]
    got = scores(spark, model, [f"{clean} {b} {clean}" for b in bad] + [clean, "", None, "xmorons", "100 200 7$ @"])
    assert min(got[:len(bad)]) >= T.REJECT and max(got[len(bad):]) < 0.5
    assert all(0 <= s <= 1 for s in got)


def test_lexicon_finds_word_ends_written_as_digits_or_signs(spark, model):
    clean = text(1, 50)
    bad = ["moron5", "MORON$", "m0r0n5", "moron5!", "m0r0n$.", "!oserly", "morons!", "morons+"]
    good = ["100 200 7$ @", "55 $$ +! 8", "moro 5", "xmoron5"]
    got = scores(spark, model, [f"{clean} {b} {clean}" for b in bad] + [f"{clean} {g} {clean}" for g in good])
    assert min(got[:len(bad)]) >= T.REJECT and max(got[len(bad):]) < 0.5
    words = ["idiot", "worthless", "bastard", "bigot", "crazy"]
    m = T.Matcher(T.Model(terms={T.fold(w) + "$": 1.0 for w in words}))
    for t in ("idiot", "idio7", "idi07", "idi0+", "idi0+!", "!diot", "worthles$", "worthle55", "8astard", "ba5tard",
              "bi90t", "bi6ot", "cra2y", "you idio7, yes", "idiot!you", "worthless!"):
        assert len(m.hits(T.fold(t))) == 1, t
    for t in ("", "7", "1d10 7", "idio 7", "1 2 $ +!", "worthle 55"):
        assert m.hits(T.fold(t)) == [], t


def test_exception_phrases_spare_a_hit(spark, model):
    clean = text(2, 50)
    got = scores(spark, model, [f"{clean} white scumbag {clean}", f"{clean} morons scumbag {clean}"])
    assert got[0] < 0.5 <= got[1]


def test_score_falls_with_length_and_long_texts_are_read_whole(spark, model):
    clean = text(7, 20_000)
    a, b, c = scores(spark, model, ["morons " + text(1, 20), "morons " + clean, clean + " morons"])
    assert a > b and b == pytest.approx(c, abs=1e-3) and b > scores(spark, model, [clean])[0]


def test_without_labels_nothing_is_toxic(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(6, 1)], "doc_id long, toxic int")):
        m = T.fit(odd_docs, labels)
        assert all(r.score == 0 for r in T.with_scores(odd_docs, m).collect())
    assert T.with_scores(no_docs, T.Model()).count() == 0


def test_held_out_rows(spark):
    got = {r.doc_id: r for r in Q.op1_toxicity(spark, SF01).collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()]
    held = [(got[i], t) for i, t in labels if brute.crc_mod(i, 3) == 1]
    assert all(r.held_out == (brute.crc_mod(i, 3) == 1) and r.predicted == int(r.score >= 0.7) for i, r in got.items())
    assert np.mean([r.predicted == t for r, t in held]) > 0.9  # 34 toxic rows to learn from


# --- line dedup -----------------------------------------------------------------------------

def test_boilerplate_lines(spark):
    pages = [(i, f"https://Big.example.org:8080/p{i}?x", f"<p>menu</p><p>page {i} &amp; more</p><div>half {i % 2}</div>") for i in range(12)]
    pages += [(100 + i, "http://small.org/", "<p>menu</p>") for i in range(3)]
    pages += [(200, None, None), (201, "no url", ""), (202, "http://big.example.org/x", "<script>var a='<p>menu</p>'</script><p>menu<p>menu<br> new  line")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r for r in L.drop_boilerplate(df).collect()}
    assert got[3].host == "big.example.org" and got[3].text == "page 3 & more" and got[3].n_dropped == 2
    assert got[202].text == "new line" and got[202].n_lines == 3
    assert got[101].text == "menu" and got[200].text == got[201].text == "" and got[200].host == ""
    assert L.drop_boilerplate(df.limit(0)).count() == 0
    rows = df.drop("text")
    rows.createOrReplaceTempView("pages_probe")
    con = duckdb.connect()
    con.register("pages", rows.toPandas())
    want = sorted((r[0], r[5]) for r in con.execute(L.oracle_sql()).fetchall())
    assert sorted((r.page_id, r.text) for r in got.values()) == want


# --- mixing ---------------------------------------------------------------------------------

def test_budget_shares(spark):
    rows = [("r", "a", 100, 10, 6), ("r", "b", 100, 1000, 3), ("r", "c", 100, 1000, 1), ("r", "zero", 100, 50, 0),
            ("s", "a", 100, 20, 1), ("s", "b", 100, 30, 1), ("t", "a", 0, 30, 1)]
    df = spark.createDataFrame(rows, "p string, x string, budget long, cap long, weight int")
    got = {(r.p, r.x): r.alloc for r in M.share(df, ["p"]).collect()}
    # a takes all it has; what it leaves goes to b and c at 3 : 1
    assert got == {("r", "a"): 10, ("r", "b"): 67, ("r", "c"): 22, ("s", "a"): 20, ("s", "b"): 30, ("t", "a"): 0}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("web", "en", "x", 1000), ("web", "de", "x", 10), ("reference", "en", "y", 1000),
                                    ("forum", "en", "z", 1000)], "domain string, lang string, source string, tokens long")
    got = {r.domain + r.lang: r.alloc for r in M.leaf_budgets(leaves, budget=(1, 3), max_epochs=1).collect()}
    # web gets 5 of 10 parts of 1003; its German has 10 only, English takes the rest of web's share
    assert got["webde"] == 10 and got["weben"] == 501 - 10 and got["referenceen"] == 300 and got["forumen"] == 200


def test_mix_odd_rows(spark, odd_rows, no_docs):
    rows = [(i, t, "en" if (i or 0) % 2 else None, "src0" if (i or 0) % 3 else None) for i, t in odd_rows + [(4, "one two"), (None, "x y z")]]
    docs = docs_df(spark, rows).withColumn("mix_epoch", F.lit(9)).withColumn("domain", F.lit("d")).withColumn("tokens", F.lit(1))
    out = M.mix(docs, budget=(1, 1), max_epochs=3)
    got = out.collect()
    assert got and all(r.mix_tokens > 0 for r in got) and {r.domain for r in got} == {"d"}
    assert out.columns[:5] == docs.columns[:5]
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source", "n_chars").toPandas().astype({"doc_id": "Int64"}))
    sql = M.oracle_sql("documents", "doc_id, tokens::BIGINT, epoch", budget=(1, 1), max_epochs=3)
    assert sorted(map(str, con.execute(sql).fetchall())) == sorted(str((r.doc_id, r.mix_tokens, r.mix_epoch)) for r in got)
    assert M.mix(no_docs).count() == 0
    assert M.mix(docs_df(spark, [(1, None), (2, " ")])).count() == 0


def test_epochs_and_budget(spark):
    docs = docs_df(spark, [(i, text(i, 50)) for i in range(200)])
    one = M.mix(docs, budget=(1, 4)).collect()
    assert 0.9 < sum(r.mix_tokens for r in one) / (200 * 50 / 4) <= 1 and {r.mix_epoch for r in one} == {1}
    two = M.mix(docs, budget=(3, 2), max_epochs=2).collect()
    assert sum(r.mix_epoch == 1 for r in two) == 200 and 90 < sum(r.mix_epoch == 2 for r in two) <= 100
    assert {r.doc_id for r in M.mix(docs, budget=(1, 4), seed="other").collect()} != {r.doc_id for r in one}


# --- language model -------------------------------------------------------------------------

def test_base_scores_equal_brute_force(spark, odd_rows, no_docs):
    rows = odd_rows + [(20 + i, text(i, 80)) for i in range(20)]
    docs = docs_df(spark, rows).withColumn("score", F.lit("x"))
    got = LM.score_documents(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0).collect()
    want = brute.base_scores(rows)
    for r in got:
        n, k, t, b = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, k, t) and r.base_score == pytest.approx(b, rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0
    assert LM.score_documents(no_docs, F.lit(True)).count() == 0
    alone = LM.score_documents(docs_df(spark, [(1, "a b"), (None, None)]), F.lit(False)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in alone} == {(3, 0, 0), (1, 0, 0)}


def _blocks(texts, end):
    ids = np.concatenate([np.asarray(t, np.int32) for t in texts])
    return LM._layout(ids, np.array([len(t) for t in texts]), end)


def _probabilities(score, z, target, pad):
    out = np.zeros(z.shape)
    out[1:] = score(z, np.where(target == pad, 0, target))
    return out


def test_windows_score_every_id_once_and_see_no_future():
    r = np.random.default_rng(0)
    end, texts = 40, [r.integers(0, 40, n) for n in (0, 1, 15, 16, 17, 100)]
    z, target, where = _blocks(texts, end)
    flat = target.ravel()[where]
    assert list(flat[:149]) == list(np.concatenate(texts)) and set(flat[149:]) == {end} and len(flat) == 149 + 6
    assert (target != end + 1).sum() == len(flat) and len(set(where)) == len(where)
    score = A.Scorer(A.new_params(np.full(41, 1 / 41)))
    full = _probabilities(score, z, target, end + 1).ravel()[where]
    # a changed id changes nothing before it, and a text nothing in another
    texts[5][60] = (texts[5][60] + 1) % 40
    z, target, where = _blocks(texts, end)
    new = _probabilities(score, z, target, end + 1).ravel()[where]
    at = 49 + 60
    assert np.allclose(new[:at], full[:at]) and not np.allclose(new[at + 1:at + 20], full[at + 1:at + 20])
    assert np.allclose(new[149:154], full[149:154])


def test_inputs_are_the_ids_before():
    texts = [[5, 6], list(range(16)), []]
    z, target, where = _blocks(texts, 30)
    for row, goal in zip(z, target):
        for a, b, c in zip(row[1:], goal[:-1], goal[1:]):
            assert a == b or c == 31  # an input is the target before it
    assert list(z[1][:3]) == [30, 5, 6] and list(target[1][:3]) == [5, 6, 30]


def test_word_hashes_tell_words_apart_anywhere():
    enc = LM._Encoder(LM.read_vocabulary())
    odd = "a b a thonre the thonre\u00a0 x \u00a0 y\u00a0z \u3000 a é中 a"
    ids = enc.ids(odd.encode())
    words = odd.encode().split()
    first = np.flatnonzero(enc.begins[ids])
    assert len(first) == len(words)
    h = LM._word_hashes(ids, first)
    assert {w: set(h[[i for i, x in enumerate(words) if x == w]]) for w in words}.keys() == set(words)
    assert len(set(h)) == len(set(words))
    other = enc.ids(b"zz zz a thonre")
    assert LM._word_hashes(other, np.flatnonzero(enc.begins[other]))[2] == h[0]


def test_distribution_sums_to_one():
    score = A.Scorer(A.new_params(np.full(30, 1 / 30)))
    rows = np.random.default_rng(1).integers(0, 30, (5, 16))
    total = sum(score(rows, np.full((5, 16), v)) for v in range(30))
    assert np.allclose(total, 1, atol=1e-4)


def test_gradients_match_differences():
    uni = np.full(12, 1 / 12)
    r = np.random.default_rng(2)
    prev, cur, target = (r.integers(0, 12, (3, 16)) for _ in range(3))
    prev[0] = 12  # padding
    rows = np.stack([prev, cur], axis=1).reshape(-1, 16)
    goal = np.stack([target, target], axis=1).reshape(-1, 16)
    weight = (r.random((3, 16)) < 0.8).astype(np.float32)

    def loss(p):
        prob = A.Scorer(p)(rows, goal)[0::2]
        return -float((np.log(prob) * weight).sum() / weight.sum())
    seen = {}
    tr = A.Trainer(A.new_params(uni), uni)
    tr._adam = lambda g, rows: seen.update(g, rows=rows) or setattr(tr, "t", tr.t + 1)
    tr.step(prev, cur, target, weight)
    base = A.new_params(uni)
    for name in ("wq", "wk", "wv", "wr", "wo", "wp", "bp", "b1", "dist", "x"):
        a = getattr(base, name)
        at = tuple(int(v) for v in np.unravel_index(r.integers(a.size), a.shape)) if name != "x" else (int(cur[1, 3]), 5)
        g = seen[name][at] if name != "x" else seen[name][list(seen["rows"]).index(at[0])][5]
        old = a[at]
        a[at] = old + 1e-2
        up = loss(base)
        a[at] = old - 1e-2
        down = loss(base)
        a[at] = old
        assert g == pytest.approx((up - down) / 2e-2, abs=2e-3), name


def test_logarithms_of_many_are_summed_without_underflow():
    x = np.concatenate([10.0 ** np.random.default_rng(1).uniform(-290, 0, 2000), np.full(1500, 1e-285), [1.0, 0.5]])
    assert LM._log10_sum(x) == pytest.approx(np.log10(x).sum(), rel=1e-12) and LM._log10_sum(x[:0]) == 0


def test_rows_of_equal_ids_are_summed():
    r = np.random.default_rng(5)
    for top in (50, 1 << 20):  # also ids of more than 16 bits
        ids, rows = r.integers(0, top, 400), r.random((400, 3)).astype(np.float32)
        u, total = A._sum_rows(ids, rows)
        want = np.zeros((top, 3))
        np.add.at(want, ids, rows)
        assert list(u) == sorted(set(ids.tolist())) and np.allclose(total, want[u], atol=1e-4)


def test_training_beats_unigram():
    r = np.random.default_rng(3)
    n = 20
    chain = r.permutation(n)
    seq = [0]
    for _ in range(60_000):
        seq.append(int(chain[seq[-1]]) if r.random() < 0.9 else int(r.integers(n)))
    ids = np.array(seq)[:59_200].reshape(-1, 16)
    prev, cur, target = ids[:-1], ids[1:], np.roll(ids.ravel(), -1).reshape(-1, 16)[1:]
    uni = np.bincount(ids.ravel(), minlength=n) / ids.size
    tr = A.Trainer(A.new_params(uni), uni)
    for _ in range(3):
        for at in range(0, 3000, 64):
            tr.step(prev[at:at + 64], cur[at:at + 64], target[at:at + 64], np.ones((len(cur[at:at + 64]), 16), np.float32))
    held = np.log(A.Scorer(tr.p)(ids[3000:], np.roll(ids.ravel(), -1).reshape(-1, 16)[3000:])).mean()
    assert held > np.log(uni[target[3000:]]).mean() + 1.0


def test_frequent_table_and_rare_words():
    r = np.random.default_rng(4)
    h = r.integers(1, 2**63, 300_000).astype(np.uint64)
    n = r.integers(1, 1000, len(h))
    t = LM._Frequent(h, n)
    got = t.counts(h)
    assert ((got == n) | (got == 0)).all() and (got > 0).mean() > 0.9
    assert (t.counts(r.integers(1, 2**63, 1000).astype(np.uint64)) == 0).all()


class _Sent:
    """Stands for a broadcast value in this process."""

    def __init__(self, value):
        self.value = value


def test_every_block_of_every_training_text_is_trained_on(monkeypatch):
    vocab = LM.read_vocabulary()
    end = max(vocab.values()) + 1
    texts = [text(i, n) for i, n in enumerate([1] * 40 + [3, 15, 16, 200, 3000])] + [None, ""]
    learn = [i % 10 != 0 for i in range(len(texts))]
    m = len(texts)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(m), pa.int64()), pa.array(range(m), pa.int64()), pa.array(learn),
         pa.array(np.random.default_rng(0).integers(-2**62, 2**62, m)), pa.array(texts, pa.string())], names=list("kuldt"))
    rows = list(LM._gather(_Sent(vocab), end, np.uint16)(iter([batch])))
    encoder = LM._Encoder(vocab)
    want = np.zeros(end + 1, np.int64)
    for t, use in zip(texts, learn):
        if use:
            want[:end] += np.bincount(encoder.ids((t or "").encode().lower()), minlength=end)[:end]
            want[end] += 1
    ids = LM._Ids(want)
    seen = []

    class Recorder:
        def __init__(self, *args, **kw):
            self.seen = 0

        def step(self, prev, cur, target, weight):
            assert len(target) <= LM.STEP
            seen.append(target[weight > 0])
    monkeypatch.setattr(A, "Trainer", Recorder)
    docs = [b.filter((pc.field("kind") == LM._DOC) & (pc.field("n") >= 0)) for b in rows]
    for r in range(len(LM.ROUNDS)):
        mine = [b.filter(pc.field("n") == r).select(["ids"]) for b in docs]
        list(LM._local_steps(_Sent(A.new_params(ids.unigram)), _Sent(ids), r, np.uint16)(iter(mine)))
    got = np.bincount(np.concatenate(seen), minlength=LM.MODEL_IDS)
    assert (got == np.bincount(ids.to[:end + 1], want, LM.MODEL_IDS)).all()


def test_word_probabilities_share_one_in_every_context():
    """Words 'a' and 'ab' of equal chance, 0 and 1 the ids of ' a' and 'b', and the exact model of them."""
    end, a, b = 2, 0, 1
    ids = LM._Ids(np.array([8.0, 4.0, 2.0]))
    assert list(ids.to[:3]) == [a, b, end]
    p = A.new_params(ids.unigram)
    for name in ("x", "wq", "wk", "wv", "wr", "wo", "wp"):
        getattr(p, name)[:] = 0
    p.comp[:] = 0
    for i, after in ((a, {a: 0.4, b: 0.5, end: 0.1}), (b, {a: 0.8, end: 0.2}), (end, {a: 0.8, end: 0.2})):
        p.x[i, i] = p.wr[i, i] = 1
        p.wp[i, i] = 50
        for j, chance in after.items():
            p.comp[j, i] = chance
    texts = [()]
    for n in range(1, 13):
        texts += [(a, *t) for t in np.ndindex(*[2] * (n - 1))]
    begins = np.array([True, False])
    words = [LM._word_hashes(np.array(w), np.array([0])) for w in ([a], [a, b], [a, b, b])]
    table = LM._Frequent(np.concatenate(words), np.array([40, 40, 1]))

    def total(counts, n, n_texts):
        rows = pa.RecordBatch.from_arrays(
            [pa.array(range(len(texts))), pa.array(range(len(texts))),
             pa.array([np.array(t, np.uint16).tobytes() for t in texts], pa.binary())], names=["k", "uid", "ids"])
        out = next(LM._score(_Sent(p), _Sent(ids), _Sent(counts), _Sent(begins), n, end, n_texts, np.uint16)(iter([rows])))
        lp = dict(zip(texts, out.column("score").to_numpy()))
        known = [not x for x in out.column("later").to_pylist()]
        return lp, sum(10 ** v for (t, v), k in zip(lp.items(), known) if k)
    lp, mass = total(table, 101, 20)
    assert 0.7 < mass <= 1 + 1e-6
    half = lambda x, c: np.log10(0.5 * x + 0.5 * c / 101)
    assert lp[()] == pytest.approx(half(0.2, 20), abs=1e-4)
    assert lp[(a,)] == pytest.approx(half(0.4, 40) + half(0.2, 20), abs=1e-4)
    assert lp[(a, b, a)] == pytest.approx(2 * half(0.4, 40) + half(0.2, 20), abs=1e-4)


def test_weight_is_learned_from_every_training_text(spark, monkeypatch):
    weighed, likelihoods = spark.sparkContext.accumulator(0), LM._likelihoods

    def counted(*args):
        work = likelihoods(*args)

        def run(batches):
            def each():
                for b in batches:
                    weighed.add(b.num_rows)
                    yield b
            return work(each())
        return run
    monkeypatch.setattr(LM, "_likelihoods", counted)
    docs = docs_df(spark, [(i, " ".join(words(i, 30))) for i in range(90)])
    got = LM.score_documents(docs, F.col("doc_id") % 3 != 0).collect()
    assert len(got) == 90 and weighed.value == 60


def _gathered(texts, learn):
    vocab, m = LM.read_vocabulary(), len(texts)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(m), pa.int64()), pa.array(range(m), pa.int64()), pa.array(learn), pa.array(range(m), pa.int64()),
         pa.array(texts, pa.string())], names=list("kuldt"))
    return pa.Table.from_batches(LM._gather(_Sent(vocab), max(vocab.values()) + 1, np.uint16)(iter([batch])))


def test_equal_words_are_encoded_once(monkeypatch):
    texts = ["a thonre b " * 40, "Thonre c\u00a0 \u00a0d a\u3000 b", None, "", "a b zzqx\n\tthonre 中a"]
    learn = [True, True, True, False, False]
    plain = LM._Encoder(LM.read_vocabulary())
    want = [plain.ids(b) for b in [(t or "").encode().lower() for t in texts]]
    encoded, ids = [], LM._Encoder.ids
    monkeypatch.setattr(LM._Encoder, "ids", lambda self, raw: encoded.extend(raw.split()) or ids(self, raw))
    for known in (1 << 19, 1):  # also when the words kept are forgotten
        monkeypatch.setattr(LM, "KNOWN_WORDS", known)
        monkeypatch.setattr(LM.W, "CHUNK_BYTES", 500 if known == 1 else 1 << 20)
        del encoded[:]
        rows = _gathered(texts, learn)
        if known > 1:
            assert len(encoded) == len(set(encoded)) == len({w for t in texts for w in (t or "").encode().lower().split()})
        docs = rows.filter(pc.field("kind") == LM._DOC)
        assert [list(np.frombuffer(x, np.uint16)) for x in docs["ids"].to_pylist()] == [list(x) for x in want]
        words = rows.filter(pc.field("kind") == LM._WORD)
        got = Counter()
        for h, n in zip(words["key"].to_pylist(), words["n"].to_pylist()):
            got[h] += n
        of = lambda w: int(LM._word_hashes(ids(plain, w), np.array([0])).view(np.int64)[0])
        assert got == Counter(of(w) for t, use in zip(texts, learn) if use for w in (t or "").encode().lower().split())


def test_texts_are_weighed_in_the_step_that_trains_on_them(monkeypatch):
    texts = [text(i, n) for i, n in enumerate([1, 3, 15, 16, 40, 300])] + [None]
    rows = _gathered(texts, [True] * len(texts))
    raw = rows.filter(pc.field("kind") == LM._DOC).select(["ids"])
    vocab = LM.read_vocabulary()
    end, begins, counts = max(vocab.values()) + 1, LM._Encoder(vocab).begins, np.zeros(max(vocab.values()) + 2)
    some = rows.filter(pc.field("kind") == LM._ID)
    counts[some["key"].to_numpy()] = some["n"].to_numpy()
    ids, n_texts = LM._Ids(counts), len(texts)
    model = A.new_params(ids.unigram)
    found = rows.filter(pc.field("kind") == LM._WORD)
    table, total = LM._Frequent(found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()), int(sum(found["n"].to_numpy())) + n_texts
    h, _, lp, ends = LM._Words(model, ids, begins, end, np.uint16)(raw["ids"].to_pylist())
    share = np.concatenate([table.counts(h) - 1, np.full(n_texts, n_texts - 1)]) / (total - 1)
    want = [np.log10(w * 10 ** np.concatenate([lp, ends]) + (1 - w) * share).sum() for w in LM.TRUSTS]

    def twice(*args):
        raise AssertionError("a text goes through the model a second time")
    monkeypatch.setattr(A, "Scorer", twice)
    monkeypatch.setattr(LM, "RATE", 0.0)  # the model stays what it is
    out = list(LM._likelihoods(_Sent(model), _Sent(ids), 0, np.uint16, _Sent(table), _Sent(begins), total, n_texts)(
        iter(raw.combine_chunks().to_batches())))
    assert out[-1]["part"].to_pylist() == [-1]
    assert np.allclose(np.frombuffer(out[-1]["v"][0].as_py()), want, rtol=1e-5)
    trained = np.concatenate([np.frombuffer(x) for b in out[:-1] for x in b["v"].to_pylist()])
    assert trained[-2] == counts.sum() and np.allclose(trained[:len(model.flat())] / trained[-2], model.flat())


def test_parts_of_all_tasks_are_added():
    values = np.random.default_rng(3).random((3, 2 * LM.PART + 5))
    rows = pa.Table.from_batches([LM._parts(v) for v in values])
    parts = [LM._added(rows.filter(pc.field("part") == k)) for k in range(3)]
    assert np.allclose(np.concatenate([np.frombuffer(p["v"][0].as_py()) for p in parts]), values.sum(axis=0))


def test_products_in_pieces_are_the_products():
    r = np.random.default_rng(9)
    for n in (0, 3, A._ROWS, 2 * A._ROWS + 7):
        a, c, w = r.random((n, 5)).astype(np.float32), r.random((n, 3)).astype(np.float32), r.random((3, 5)).astype(np.float32)
        assert np.allclose(A._times(a, w.T), a @ w.T, atol=1e-5) and np.allclose(A._across(a, c), a.T @ c, atol=1e-3)
