"""Mixing sources to target weights over a tree domain > language > source.

Budgets go down the tree: every node shares its budget among its children by their weights, a
child that has too few tokens gets all it has, and what it leaves is shared among its siblings
again.  A node never gets more than its subtree holds, so a shortage reaches the next level up
only when no sibling can take it.  A leaf reads its documents in seeded random epochs: whole
epochs first, then the longest prefix of the next epoch that fits.

The prefix is cut without ordering a leaf in one task: documents are dealt to buckets by the
leading digits of their random key, bucket sums give every bucket its offset, and the running
sum is taken inside buckets.  The cut is one key per leaf, so the documents themselves are
filtered where they are read.

Defined results: NULL domain, lang or source is the value '' of its level; a text without tokens
(NULL, empty, white space) is never taken; a child of weight 0 gets nothing; budgets are whole
tokens, rounded down; rows that repeat id and text share their place in an epoch and are taken
together or not at all.  Tokens are runs of characters other than white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEVELS = ["domain", "lang", "source"]
#: Domain of a source, as SQL over the columns of the documents.
DOMAIN = """CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7') THEN 'web'
     WHEN source IN ('src8', 'src9', 'src10', 'src11') THEN 'reference' ELSE 'forum' END"""
#: Weight of a child by level and value; 1 where nothing is said.
WEIGHTS = {"domain": {"web": 5, "reference": 3, "forum": 2}, "lang": {"en": 6, "de": 2}, "source": {"src0": 2}}
#: Budget as a part of all tokens, the most epochs of a leaf, the seed of the epochs.
BUDGET, MAX_EPOCHS, SEED = (1, 2), 2, "mix-1"
#: Leading hexadecimal digits of the random key that make a bucket.
BUCKET_DIGITS = 3
TOKEN = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("long")


def _weight(level: str, weights) -> Column:
    out = F.lit(1)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, w).otherwise(out)
    return out


def share(children: DataFrame, parent: list[str], budget: str = "budget", cap: str = "cap",
          weight: str = "weight") -> DataFrame:
    """``children`` with ``alloc``: the parent's budget by weights, capped, shortages shared again.

    Sorted by capacity per weight, the children that get all they have come first; a child is
    among them while its capacity is at most its share of what the ones before have left.
    """
    big = lambda c: F.col(c).cast("decimal(20,0)")
    by = Window.partitionBy(*parent).orderBy(F.col(cap).cast("double") / F.col(weight), *[
        c for c in children.columns if c not in (budget, cap, weight)])
    rows = (children.filter(F.col(weight) > 0)
            .withColumn("_before", F.coalesce(F.sum(cap).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_rest", F.sum(weight).over(by.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("_left", F.col(budget) - F.col("_before"))
            .withColumn("_full", F.min((big(cap) * F.col("_rest") <= big("_left") * F.col(weight)).cast("int"))
                        .over(by.rowsBetween(Window.unboundedPreceding, 0))))
    whole = Window.partitionBy(*parent)
    given = F.col(budget) - F.coalesce(F.sum(F.when(F.col("_full") == 1, F.col(cap))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(F.col("_full") == 0, F.col(weight))).over(whole)
    rows = rows.withColumn("_given", given).withColumn("_open", open_weight)
    part = F.expr(f"cast(cast({weight} AS decimal(20,0)) * cast(greatest(_given, 0) AS decimal(18,0)) div _open"
                  " AS bigint)")
    return (rows.withColumn("alloc", F.when(F.col("_full") == 1, F.col(cap)).otherwise(F.least(F.col(cap), part)))
            .drop("_before", "_rest", "_left", "_full", "_given", "_open", budget))


def leaf_budgets(leaves: DataFrame, weights=WEIGHTS, budget: tuple[int, int] = BUDGET,
                 max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per leaf (domain, lang, source, tokens): ``alloc`` tokens."""
    cap = (F.sum("tokens") * max_epochs).alias("cap")
    total = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * budget[0] / budget[1]).cast("long")
                       .alias("budget"))
    level = leaves.groupBy("domain").agg(cap).withColumn("budget", total.scalar()).withColumn("_root", F.lit(0))
    done = None
    for depth, name in enumerate(LEVELS):
        parent = LEVELS[:depth]
        if depth:
            level = leaves.groupBy(*LEVELS[:depth + 1]).agg(cap).join(
                done.select(*parent, F.col("alloc").alias("budget")), parent).withColumn("_root", F.lit(0))
        done = share(level.withColumn("weight", _weight(name, weights)), ["_root", *parent])
    return done.select(*LEVELS, "alloc")


def _order_key(seed: str) -> Column:
    """Random place of a document in an epoch: bytes of id, text and seed."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.col("_epoch").cast("string"), F.col("_id")).cast("binary"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", domain: str = DOMAIN, weights=WEIGHTS,
        budget: tuple[int, int] = BUDGET, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The taken documents, one row for each epoch that has them: the columns of ``docs``, and
    mix_domain, mix_tokens, mix_epoch (columns of ``docs`` with these names are replaced)."""
    docs = docs.drop("mix_domain", "mix_tokens", "mix_epoch")
    blank = lambda c: F.coalesce(c, F.lit(""))
    ident = F.concat_ws("|", blank(F.col(key).cast("string")), F.md5(blank(F.col(text)).cast("binary")))
    leaf = [blank(F.expr(domain)).alias("domain"), blank(F.col("lang")).alias("lang"),
            blank(F.col("source")).alias("source")]
    slim = stored(docs.select(*leaf, n_tokens(F.col(text)).alias("tokens"), ident.alias("_id"))
                  .filter("tokens > 0"), "mix-rows")

    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    plan = leaves.join(leaf_budgets(leaves, weights, budget, max_epochs), LEVELS)
    plan = stored(plan.select(*LEVELS, F.expr("alloc div tokens").alias("whole"),
                              F.expr("alloc % tokens").alias("part")), "mix-plan")

    last = (slim.join(plan, LEVELS).withColumn("_epoch", F.col("whole") + 1)
            .withColumn("_order", _order_key(seed)).drop("_id", "_epoch", "whole")
            .withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS)))
    sums = last.groupBy(*LEVELS, "_bucket").agg(F.sum("tokens").alias("_sum"))
    before = Window.partitionBy(*LEVELS).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sums.select(*LEVELS, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")),
                     "mix-buckets")
    inside = Window.partitionBy(*LEVELS, "_bucket").orderBy("_order")
    cuts = (last.join(offsets, [*LEVELS, "_bucket"])
            .withColumn("_upto", F.col("_offset") + F.sum("tokens").over(inside))
            .filter("_upto <= part").groupBy(*LEVELS).agg(F.max("_order").alias("_cut")))
    plan = stored(plan.join(cuts, LEVELS, "left"), "mix-cuts")

    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], *leaf,
                       n_tokens(F.col(text)).alias("tokens"), ident.alias("_id")).filter("tokens > 0")
    taken = (rows.join(plan, LEVELS).withColumn("_epoch", F.col("whole") + 1)
             .withColumn("_n", F.col("whole") + F.coalesce((_order_key(seed) <= F.col("_cut")).cast("long"), F.lit(0)))
             .filter("_n > 0").withColumn("mix_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))))
    return taken.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)],
                        F.col("domain").alias("mix_domain"), F.col("tokens").alias("mix_tokens"), "mix_epoch")


def oracle_sql(docs: str, columns: str, weights=WEIGHTS, budget=BUDGET, max_epochs=MAX_EPOCHS, seed=SEED,
               domain: str = DOMAIN) -> str:
    """The same rows as DuckDB SQL; ``docs`` names a table or view, ``columns`` what to return."""
    def weight(level):
        whens = " ".join(f"WHEN '{v}' THEN {w}" for v, w in weights.get(level, {}).items())
        return f"CASE {level} {whens} ELSE 1 END" if whens else "1"

    def level(depth):
        cols, name = LEVELS[:depth + 1], LEVELS[depth]
        c, parent = ", ".join(cols), ", ".join(["0", *LEVELS[:depth]])
        frm = (f"(SELECT {c}, sum(tokens) * {max_epochs} AS cap FROM leaves GROUP BY ALL) x, "
               f"(SELECT (coalesce(sum(tokens), 0) * {budget[0]}) // {budget[1]} AS budget FROM leaves) b" if depth == 0 else
               f"(SELECT {c}, sum(tokens) * {max_epochs} AS cap FROM leaves GROUP BY ALL) x "
               f"JOIN (SELECT {', '.join(LEVELS[:depth])}, alloc AS budget FROM d{depth - 1}) b USING ({', '.join(LEVELS[:depth])})")
        return f"""
w{depth} AS (SELECT {c}, cap::HUGEINT AS cap, budget::HUGEINT AS budget, ({weight(name)})::HUGEINT AS weight FROM {frm}),
f{depth} AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior,
  sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w{depth} WHERE weight > 0
  WINDOW o AS (PARTITION BY {parent} ORDER BY cap::DOUBLE / weight::DOUBLE, {c})),
g{depth} AS (SELECT *, min((cap * rest <= (budget - prior) * weight)::INT) OVER (PARTITION BY {parent}
  ORDER BY cap::DOUBLE / weight::DOUBLE, {c} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS full_ FROM f{depth}),
d{depth} AS (SELECT {c}, CASE WHEN full_ = 1 THEN cap ELSE least(cap, weight
  * greatest(budget - coalesce(sum(CASE WHEN full_ = 1 THEN cap END) OVER (PARTITION BY {parent}), 0), 0)
  // sum(CASE WHEN full_ = 0 THEN weight END) OVER (PARTITION BY {parent})) END::HUGEINT AS alloc FROM g{depth})"""
    leaf = ", ".join(LEVELS)
    token = r"[^\x20\x09-\x0D]+"
    return f"""
WITH rows_ AS (SELECT * REPLACE (coalesce(lang, '') AS lang, coalesce(source, '') AS source),
  lang AS lang_in, source AS source_in, coalesce({domain}, '') AS domain,
  length(regexp_extract_all(coalesce(text, ''), '{token}'))::HUGEINT AS tokens,
  concat(coalesce(doc_id::VARCHAR, ''), '|', md5(coalesce(text, ''))) AS ident FROM {docs}),
leaves AS (SELECT {leaf}, sum(tokens) AS tokens FROM rows_ WHERE tokens > 0 GROUP BY ALL),
{','.join(level(i) for i in range(3)).strip()},
plan_ AS (SELECT {leaf}, alloc // tokens AS whole, alloc % tokens AS part FROM leaves JOIN d2 USING ({leaf})),
run_ AS (SELECT *, sum(tokens) OVER (PARTITION BY {leaf} ORDER BY ord) AS upto FROM (
  SELECT rows_.*, whole, part, md5(concat('{seed}|', (whole + 1)::VARCHAR, '|', ident)) AS ord
  FROM rows_ JOIN plan_ USING ({leaf}) WHERE tokens > 0))
SELECT {columns} FROM (SELECT *, unnest(generate_series(1, (whole + CASE WHEN upto <= part THEN 1 ELSE 0 END)::BIGINT)) AS epoch
  FROM run_)
"""
