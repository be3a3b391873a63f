"""Registered queries without SQL against brute force, on whole small tables."""

import math

import numpy as np
import pytest
import tiktoken

import brute
from alertsieve.llm import pii as P
from alertsieve.llm import queries as Q
from alertsieve.llm import token_counts as T
from alertsieve.llm import toxicity as X
from conftest import SF001, SF01
from llm_helpers import docs_df, text


def _docs(spark, path):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd_folder(spark, odd_rows, tmp_path_factory):
    """A data folder whose documents are odd: the tables of a given one, and odd rows besides."""
    path = tmp_path_factory.mktemp("odd")
    given = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows = [(10_000 + i, t) for i, t in odd_rows] + given + [(20_000, text(5, 400)), (20_001, text(5, 400))]
    docs_df(spark, rows).write.parquet(f"{path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    return str(path)


@pytest.mark.parametrize("folder", ["given", "odd"])
def test_op4_near_dedup(spark, odd_folder, folder):
    path = SF001 if folder == "given" else odd_folder
    want = brute.near_components(list(_docs(spark, path).items()))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in Q.op4_near_dedup(spark, path).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


@pytest.mark.parametrize("folder", ["given", "odd"])
def test_op10_pii(spark, odd_folder, folder):
    path = SF001 if folder == "given" else odd_folder
    docs = _docs(spark, path)
    for r in Q.op10_pii(spark, path).collect():
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256] == brute.pii_row(docs[r.doc_id])
        base = [x for x in r.spans.split(",") if x.split(":")[0] in P.BASE]
        assert base == [f"{k}:{a}:{b}" for a, _, b, k in brute.base_pii(docs[r.doc_id])]


def test_secrets_need_a_context_word_and_entropy(spark):
    key = "a8bbeeb08a385de42c3ee7cd437fc51b3b4445e9"
    rows = [(1, f'the token = "{key}" end'), (2, f"commit {key} end"), (3, "password: aaaaaaaaaaaaaaaaaaaa1"), (4, f"API_KEY={key}"),
            (5, f"token {key}"), (6, "secret = " + "x1" * 300), (7, "token = short1a"), (8, "key " + "b" * 60_000)]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "secret"] for r in P.find_pii(docs_df(spark, rows)).collect()}
    at = {i: (t.index(key), t.index(key) + 40) for i, t in rows if key in t}
    assert got == {1: [at[1]], 2: [], 3: [], 4: [at[4]], 5: [at[5]], 6: [], 7: [], 8: []}


@pytest.mark.parametrize("folder", ["given", "odd"])
def test_op9_token_counts(spark, odd_folder, folder):
    path = SF001 if folder == "given" else odd_folder
    encode = tiktoken.Encoding("all", pat_str=T.PATTERN, mergeable_ranks=T.read_vocabulary(), special_tokens={}).encode_ordinary
    docs = {i: t or "" for i, t in _docs(spark, path).items()}
    rows = Q.op9_token_counts(spark, path).collect()
    assert len(rows) == len(docs)
    for r in rows:
        t = docs[r.doc_id]
        n = len(t)
        after = brute.edited(t, [(n // 3, 7, t.split(" ")[0]), (n * 2 // 3, 0, t[-40:])])
        assert (r.n_chars, r.n_before, r.n_after, r.n_chars_after) == (n, len(encode(t)), len(encode(after)), len(after))
        assert 0 <= r.n_encoded_again <= 2 * (n + len(after))  # either edit at most the whole text


def _plain_hits(model, folded):
    """Hits by comparing every term at every word, without an automaton."""
    best, spared = {}, []
    for form in X.forms(folded):
        for at in range(len(form)):
            if at and form[at - 1].isalpha():
                continue
            for term in list(model.terms) + [(p,) for p in model.exceptions]:
                word = term[0] if isinstance(term, tuple) else term.rstrip("$")
                end = at + len(word)
                if form[at:end] != word:
                    continue
                whole = end == len(form) or not form[end].isalpha()
                if isinstance(term, tuple):
                    spared += [(at, end)] * whole
                elif (whole or term[-1] != "$") and (at not in best or best[at][0] < end):
                    best[at] = (end, term)
    return [t for s, (e, t) in best.items() if not any(a <= s and e <= b for a, b in spared)]


def test_op1_toxicity(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = Q.toxicity_model(spark, docs, SF01)
    assert model.fitted and model.terms
    texts = _docs(spark, SF01)
    some = sorted(texts, key=lambda i: (len(texts[i] or ""), i))[:250]
    got = {r.doc_id: r for r in Q.op1_toxicity(spark, SF01).collect()}
    assert set(got) == set(texts)
    for i in some:
        folded = X.fold(texts[i] or "")
        hits = _plain_hits(model, folded)
        z = float((X._inputs(np.array([sum(model.terms[t] for t in hits)]), np.array([float(len(folded))])) @ np.array(model.curve))[0])
        assert got[i].n_hits == len(hits) and math.isclose(got[i].score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)
        assert got[i].predicted == int(got[i].score >= 0.7) and got[i].held_out == (brute.crc_mod(i, 3) == 1)


def test_op5_lm_scoring(spark):
    docs = _docs(spark, SF01)
    want = brute.base_scores([(i, t or "") for i, t in docs.items()])
    rows = Q.op5_lm_scoring(spark, SF01).collect()
    assert len(rows) == len(docs)
    score = base = 0.0
    for r in rows:
        n, known, train, least = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train) and math.isclose(r.base_score, least, rel_tol=1e-9)
        assert r.held_out == (brute.crc_mod(r.doc_id, 10) == 0) and math.isfinite(r.score) and r.score <= 0
        if r.held_out and known == n:  # the base gives every unknown word the chance of one word, so its chances add up to more than 1
            score, base = score + r.score, base + r.base_score
    assert score > 1.02 * base  # on 1,000 documents about as good as word counts; better on 10,000 (README)
