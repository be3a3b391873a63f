"""A phrase of 12 words that every text and item shares inside different surroundings: no hit, and no pairs."""

import brute
from alertsieve.llm import decontaminate as D
from llm_helpers import docs_df, words

ITEM = "item_id long, text string"


def test_shared_kgrams_are_not_paired(spark, monkeypatch):
    phrase, made, kept = words(1, 12), {}, D.stored

    def counted(df, label):
        out = kept(df, label)
        made[label] = out.count()
        return out
    monkeypatch.setattr(D, "stored", counted)
    sizes = {}
    for n in (40, 160):
        own = lambda kind, i: [f"{kind}{i}n{k}" for k in range(20)]
        docs = [(i, " ".join(own("a", i) + phrase + own("b", i))) for i in range(n)]
        items = [(i, " ".join(own("c", i) + phrase + own("d", i))) for i in range(n)]
        out = D.contamination(docs_df(spark, docs).select("doc_id", "text"), spark.createDataFrame(items, ITEM))
        got = {r.doc_id: (r.n_words, r.n_hit) for r in out.collect()}
        assert got == {i: v[:2] for i, v in brute.decontaminate(docs, items).items()}
        assert all(hit == 0 for _, hit in got.values())
        sizes[n] = dict(made)
    assert sizes[160]["doc-spans"] == 0 and sizes[160]["bench-windows"] < 5 * sizes[40]["bench-windows"]
