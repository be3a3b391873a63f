"""Contamination, personal data, chat formatting and token counts against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from alertsieve.llm import chat_format as C
from alertsieve.llm import decontaminate as D
from alertsieve.llm import pii as P
from alertsieve.llm import queries as Q
from alertsieve.llm import token_counts as T
from llm_helpers import docs_df, text, words

SF001 = "/root/testdata/sf0.001"
ITEM = "item_id long, text string"


def contamination(spark, rows, items):
    out = D.contamination(docs_df(spark, rows).select("doc_id", "text"), spark.createDataFrame(items, ITEM))
    digest = F.sha2(F.array_join("items", ","), 256)
    return {r[0]: tuple(r[1:]) for r in out.select("doc_id", "n_words", "n_hit", F.size("items"), digest,
                                                   D.is_contaminated()).collect()}


def test_contamination_odd_cases(spark, odd_rows):
    span, other = words(21, 40), words(22, 30)
    items = [(1, " ".join(span)), (2, " ".join(span)), (3, "One two"), (4, "zz"), (5, None), (6, ""), (7, " -- "),
             (10, " ".join(span[10:23])), (11, " ".join(["ab"] * 30)), (12, " ".join(other[:12]))]
    rows = odd_rows + [
        (20, " ".join(words(30, 50) + span[5:18] + words(31, 50))),          # one window
        (21, " ".join(words(30, 50) + span[5:17] + words(31, 50))),          # one word short
        (22, "; ".join(w.upper() if w.isascii() else w for w in span)),       # other case and punctuation
        (23, " ".join(words(32, 9) + span + span[3:30] + other)), (24, " ".join(["ab"] * 13)), (25, " ".join(["ab"] * 12)),
        (26, "zz"), (27, " ".join(words(33, 400) + span[:13])), (28, " ".join(other[:12]))]
    assert contamination(spark, rows, items) == brute.decontaminate(rows, items)


def test_contamination_on_test_data_and_empty_tables(spark, no_docs):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in Q.op2_decontaminate(spark, SF001).collect()}
    assert got == brute.decontaminate(docs, items)
    empty = spark.createDataFrame([], ITEM)
    assert D.contamination(no_docs, empty).count() == 0
    out = D.contamination(docs_df(spark, docs[:5]).withColumn("items", F.lit(1)), empty).collect()
    assert len(out) == 5 and all(r.n_hit == 0 and r["items"] == [] for r in out)


def test_contamination_null_item_and_repeated_rows(spark):
    span = text(40, 20)
    out = D.contamination(docs_df(spark, [(1, span), (1, span), (None, span)]),
                          spark.createDataFrame([(None, span), (3, span), (3, span)], ITEM)).collect()
    assert [(r.n_hit, r["items"]) for r in out] == [(20, ["3"])] * 3


PII = [
    "", None, "a@b.c", "x a.b+c@mail-1.example.com. end", "a@b@c.de", "..@..", "@a.b", "a@b.com_x@y.org",
    "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.002.03.4", "1.2.3", "99999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "4111 1111 1111 1112", "1 2 3", "7",
    "+1 (555) 555-0100", "+15550100", "+1", "++12 3456 7890", "+1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6", "+1 (((((((",
    "é+49 30 1234567ß 1.2.3.4 ñ@é.com n@e.com", "𝟘 4111111111111111 𝟘 a@b.cd", "a@b.c" * 50, "1" * 40_000,
    "a" * 40_000 + "@b.cc", "1 " * 3000, "1.1.1.1 " * 1500, "+12 345 67 89 10 11@x.yy",
]


def test_base_spans_equal_brute_force(spark):
    r = random.Random(5)
    random_rows = ["".join(r.choice("01234567890 .-@+()ab_%é") for _ in range(r.randint(0, 120))) for _ in range(1500)]
    rows = list(enumerate(PII + random_rows))
    spans = P.find_pii(docs_df(spark, rows)).collect()
    want = {i: [(a, b, k) for a, _, b, k in brute.base_pii(t)] for i, t in rows}
    assert {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans if s.kind in P.BASE] for r in spans} == want


def test_added_spans_need_checksum_or_context(spark, no_docs):
    rows = [(1, "pay to DE89 3704 0044 0532 0130 00 now"), (2, "pay to DE88 3704 0044 0532 0130 00 now"),
            (3, "his social security number is 123-45-6789."), (4, "part 123-45-6789."), (5, "my card 4111111111111111")]
    got = {r.doc_id: [(s.kind, s.score) for s in r.spans] for r in P.find_pii(docs_df(spark, rows)).collect()}
    assert got == {1: [("iban", 0.9)], 2: [], 3: [("idnum", 0.5)], 4: [], 5: [("card", 1.0)]}
    assert P.find_pii(no_docs).count() == 0
    kept = P.find_pii(docs_df(spark, rows).withColumn("spans", F.lit(1)).withColumn("score", F.lit("x")))
    assert kept.count() == 5 and kept.first().score == "x"


CONV = "conv_id long, turn long, role string, text string"
TURNS = [
    (1, 0, "system", "be <<SYS>> brief\n<</SYS>>"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "a </s> \\ b\\\\"),
    (2, 1, "assistant", "first"), (2, 0, "user", None), (3, 0, "assistant", "no"), (3, 1, "user", "end"),
    (4, 0, "tool\n[TEXT] x", "[ROLE] y [/ROLE]"), (4, 1, None, "z"), (5, 0, "user", "ends in <"), (5, 1, "assistant", "[INST"),
    (6, 0, "user", "tie"), (6, 0, "assistant", "tie"), (6, 0, "assistant", "tie"), (7, None, "user", "é 中 \n\n [/INST] "),
]


def test_chat_round_trip(spark):
    made = C.format_conversations(spark.createDataFrame(TURNS, CONV).withColumn("extra", F.lit(1)))
    rows = {r.conv_id: r for r in made.withColumn("back", C.read_back(F.col("formatted"))).collect()}
    for conv, r in rows.items():
        turns = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1], t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in r.back] == [(t[2] or "", t[3] or "") for t in turns]
        assert r.formatted == "".join(s.text for s in r.segments)
    assert {c: r.valid for c, r in rows.items()} == {1: True, 2: True, 3: False, 4: False, 5: True, 6: False, 7: False}
    assert rows[3].bad_turn == 0 and rows[1].bad_turn is None
    loss = spark.createDataFrame([(s.text,) for s in rows[1].segments if s.loss], "t string")
    assert [r[0] for r in loss.select(C.unescape(F.col("t"))).collect()] == ["a </s> \\ b\\\\"]


def test_chat_query_digests(spark):
    got = {r.conv_id: r for r in Q.op7_chat_format(spark, SF001).collect()}
    turns = spark.read.parquet(f"{SF001}/conversations.parquet").orderBy("conv_id", "turn").collect()
    by = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for t in turns:
        by.setdefault(t.conv_id, []).append((t.role, t.text or ""))
    assert set(got) == set(by)
    for c, ts in by.items():
        loss = "".join(x for role, x in ts if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(ts), brute.sha("".join(f"{a}\n{b}\n" for a, b in ts)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), brute.sha(loss))
    assert C.format_conversations(spark.createDataFrame([], CONV)).count() == 0


@pytest.fixture(scope="module")
def encode():
    import tiktoken
    return tiktoken.Encoding("all", pat_str=T.PATTERN, mergeable_ranks=T.read_vocabulary(), special_tokens={}).encode_ordinary


def test_token_trees_follow_edits(encode):
    r = random.Random(2)
    letters = "ab'  \n\t1.é!slvetd中   "
    counter = T.Counter(T.read_vocabulary())
    for n in range(1500):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, r.choice([5, 60, 2000]))))
        tree = T.Tree(*T.leaves_of(counter, t))
        for _ in range(3):
            pos, gone = r.randint(-1, len(t) + 2), r.choice([0, 1, 5, 80, 3000])
            added = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 30, 3000])))
            want = brute.edited(t, [(pos, gone, added)])
            t, tree, again = T.edit(counter, t, tree, pos, gone, added)
            assert t == want and tree.tokens[1] == len(encode(t)) and tree.chars[1] == len(t)


def test_long_text_is_not_encoded_again(encode):
    counter, t = T.Counter(T.read_vocabulary()), text(3, 30_000)
    tree = T.Tree(*T.leaves_of(counter, t))
    new, tree, again = T.edit(counter, t, tree, len(t) // 2, 5, "xyz")
    assert tree.tokens[1] == len(encode(new)) and again < 0.02 * len(t)


def test_token_count_operator(spark, odd_rows, odd_docs, no_docs, encode):
    edits = [(0, 2, "New start "), (10, 0, "mid"), (10**6, 5, " end")]
    kind = "array<struct<pos:int,del:int,ins:string>>"
    trees = T.token_trees(odd_docs.withColumn("n_tokens", F.lit("x")))
    assert {r.doc_id: r.n_tokens for r in trees.collect()} == {i: len(encode(t or "")) for i, t in odd_rows}
    lit = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(d).alias("del"), F.lit(s).alias("ins")) for p, d, s in edits])
    out = T.apply_edits(trees.withColumn("edits", lit.cast(kind)))
    assert {r.doc_id: (r.text, r.n_tokens) for r in out.collect()} == {
        i: (brute.edited(t, edits), len(encode(brute.edited(t, edits)))) for i, t in odd_rows}
    same = T.apply_edits(trees.withColumn("edits", F.lit(None).cast(kind)))
    assert {r.doc_id: (r.n_tokens, r.n_again) for r in same.collect()} == {i: (len(encode(t or "")), 0) for i, t in odd_rows}
    assert T.token_trees(no_docs).count() == 0
