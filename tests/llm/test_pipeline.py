"""The corpus pipeline against a brute-force version, and its odd cases."""

import os
import sys

import brute
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402
from alertsieve.llm import mixing as M  # noqa: E402
from alertsieve.llm import queries as Q  # noqa: E402
from alertsieve.llm.common import stored, table  # noqa: E402
from llm_helpers import docs_df, text  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF01, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in table(spark, SF01, "benchmark").collect()]
    columns = docs.columns

    toxic = {r.doc_id for r in Q.op1_toxicity(spark, SF01).collect() if r.predicted == 1}
    left = {i: t for i, t in rows.items() if i not in toxic}
    docs = stored(P.STAGES[0][1](spark, docs, SF01), "t")
    assert ids(docs) == sorted(left) and docs.columns == columns

    keep = {}
    for i, t in left.items():
        keep[t] = max(i, keep.get(t, i))
    left = {i: t for i, t in left.items() if keep[t] == i}
    docs = stored(P.STAGES[1][1](spark, docs, SF01), "t")
    assert ids(docs) == sorted(left) and docs.columns == columns

    left = {i: left[i] for i, (_, c) in brute.near_components(list(left.items())).items() if i == c}
    docs = stored(P.STAGES[2][1](spark, docs, SF01), "t")
    assert ids(docs) == sorted(left) and docs.columns == columns

    bad = {i for i, r in brute.decontaminate(list(left.items()), items).items() if r[4]}
    left = {i: t for i, t in left.items() if i not in bad}
    docs = stored(P.STAGES[3][1](spark, docs, SF01), "t")
    assert ids(docs) == sorted(left) and docs.columns == columns and bad

    import duckdb
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = sorted(con.execute(M.oracle_sql("documents", "doc_id, epoch")).fetchall())
    out = P.STAGES[4][1](spark, docs, SF01)
    assert sorted((r.doc_id, r.mix_epoch) for r in out.collect()) == want
    assert {r.doc_id: r.text for r in out.collect()}.items() <= rows.items()


def test_run_is_registered_and_takes_each_epoch_once(spark):
    import __spark_entry__ as E
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    out = E.queries()["pipeline"](spark, SF001)
    rows = [(r.doc_id, r.mix_epoch) for r in out.collect()]
    assert rows and len(rows) == len(set(rows)) and out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_odd_rows(spark, odd_rows):
    near = text(50, 80)
    rows = odd_rows + [(None, None), (None, near), (30, near), (30, near), (30, near + " x"), (31, near + " y"), (4, "one two")]
    docs = docs_df(spark, rows).withColumn("class", F.lit("c")).withColumn("kept", F.lit(1)).withColumn("n_words", F.lit(2))
    for name, stage in P.STAGES[:4]:
        out = stored(stage(spark, docs, SF001), "t")
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF001).count() == 0, name
    kept = [(r.doc_id, r.text) for r in P.drop_near_copies(spark, docs, SF001).collect()]
    assert sum((t or "").startswith(near) for _, t in kept) == 1      # one row of the whole group
    assert sum(t is None or not t.split() for _, t in kept) == 4      # texts without words are not copies
    assert len([1 for i, _ in kept if i == 4]) == 1                    # a repeated row stays once
    assert P.mix_sources(spark, docs.limit(0), SF001).count() == 0


def test_map_columns_and_clashing_names(spark):
    docs = table(spark, SF001, "documents").limit(80)
    docs = docs.unionByName(docs.limit(20))  # repeated rows
    for name in ("_tox", "row", "made", "score", "n_hits", "levels", "_hash", "n_words"):
        docs = docs.withColumn(name, F.lit("x"))
    docs = stored(docs.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))), "t")
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF001), "t")
        assert {"m", "_tox", "score", "row"} <= set(docs.columns), name
    rows = docs.collect()
    assert rows and all(r.m == {"k": r.doc_id} and r.score == "x" for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
