"""Near duplicates: bottom-k sketches, inverted lists, estimate, exact Jaccard, components.

1. Every text becomes its set of word n-gram hashes; texts with the same set form one class, and
   only classes go on, so copies cost nothing further.
2. The sketch of a class is the k smallest hashes of its set (one hash function).  Its retained
   values go to inverted lists by runs of ``RUN`` neighbours in the sketch, so that unrelated
   texts with a common passage rarely meet; two sets over the threshold share a run but for a
   chance of about 1e-10 at k = 48 (sets of up to k hashes: never missed).
3. Every list names its smallest class as its pivot; the distinct (pivot, member) rows of all
   lists make the groups.  Classes that share any list share a group, and a group is written as
   its rows, never as pairs.
4. Two members of a group are compared by the estimate from their union sketch (the values of both that are not above
   the smaller of their largest retained values: the k smallest of the union at least); what passes is verified
   on the full sets.  A task gets classes with the component that they are known to belong to, looks only at pairs of
   different components, and returns one link for each component that it joins to another: never a pair twice over.
5. Groups over ``BLOCK`` members go first.  They are cut by set size (sets that can be linked have similar
   sizes) and into blocks; ``HUBS`` members that share most list entries with others join every block, so a block
   is linked to the rest of its group through them (A).  What is left open is not paired group by group: classes of the groups that
   still have several components are listed anew by the rarest hashes of their full sets, so many that two linked sets
   share one (prefix filter, nothing is missed).  Edited copies whose rare hashes are their own are in no list.  The groups of
   these lists that have two components or more are compared; of one over ``BLOCK``, members outside its chief component
   meet all blocks (B).  What is left of the small groups, those with two components or more, comes last (C).  No task
   holds more than two blocks of sets.
6. Components of the links, in Spark, after each of these steps.

Defined results: NULL, empty and word-free texts have the empty set and are linked with nothing;
a text of fewer words than the n-gram is one shingle; rows that repeat an id count as documents
of their own; a NULL id is larger than any other and never names a component that has another id.
Shingles are taken by 64-bit hashes, classes by 128 bits of their set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import KeyFilter, stored
from .components import components, relabel

WORDS, SKETCH, RUN = 5, 48, 3
#: Jaccard similarity of a link, as a fraction of integers.
THRESHOLD = (85, 100)
#: A pair is verified when its estimate lies at most so many standard deviations of the estimate of a pair at the
#: threshold below the threshold (0.46 at k = 48).
SPREAD = 7.5
BLOCK, HUBS = 512, 16
BITMAP_BITS = 22
#: Slots in which hashes are counted to tell rare ones.
SLOT_BITS = 20
_RANDOM = W.mix(np.arange(1, 3, dtype=W.U) * W.U(0x632BE59BD9B4E019))


def _sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a piece."""
    h, first = W.words(data, offsets, W.SPACED)
    g = W.ngrams(h, words)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            out.append(np.unique(g[a:b - words + 1]))
        else:
            out.append(W.ngrams(h[a:b], int(b - a)) if b > a else g[:0])
    return out


def _class_id(s: np.ndarray) -> bytes:
    return b"".join(int(np.add.reduce(W.mix(s * r + W.U(len(s))))).to_bytes(8, "big") for r in _RANDOM)


def _run_keys(s: np.ndarray, sketch: int, run: int) -> np.ndarray:
    low = s[:sketch]
    return W.ngrams(low, run if len(low) >= run else max(len(low), 1)).view(np.int64)


def _class_rows(words: int, sketch: int, run: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in W.chunks(b.column(b.num_columns - 1)):
                sets = _sets(data, offsets, words)
                rows = b.slice(at, len(sets))
                yield pa.RecordBatch.from_arrays(
                    rows.columns[:-1]
                    + [pa.array([_class_id(s) if len(s) else None for s in sets], pa.binary()),
                       pa.array([len(s) for s in sets], pa.int64()),
                       pa.array([_run_keys(s, sketch, run) for s in sets], pa.list_(pa.int64()))],
                    names=rows.schema.names[:-1] + ["class", "n", "keys"])
    return work


def _list_rows(listed: KeyFilter):
    """(key, class, n, of) of the keys that more than one class has."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("keys")
            flat = keys.flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), keys.value_lengths().to_numpy())
            at = np.flatnonzero(listed.passes(flat))
            row = pa.array(row[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[at]), b.column("class").take(row), b.column("n").take(row), b.column("of").take(row)],
                names=["key", "class", "n", "of"])
    return work


def _set_rows(words: int, wanted: KeyFilter):
    """(of, class, hashes) of the texts whose key hash is wanted."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.take(pa.array(np.flatnonzero(wanted.passes(b.column(0).to_numpy()))))
            for at, data, offsets in W.chunks(b.column(1)):
                sets = _sets(data, offsets, words)
                some = [i for i, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([at + i for i in some], pa.int64())),
                     pa.array([_class_id(sets[i]) for i in some], pa.binary()),
                     pa.array([sets[i].tobytes() for i in some], pa.binary())], names=["of", "class", "hashes"])
    return work


def _class_sets(texts: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(class, hashes), one row of every class of ``members``, from texts (key hash, text).

    The bitmap only thins the texts.  Rows that repeat a key are merged in tasks before the shuffle,
    and the join keeps one key hash of every class, so copies of a class go no further."""
    one = members.select("of", "class").distinct()
    sets = texts.mapInArrow(_set_rows(words, KeyFilter(one, "of", BITMAP_BITS)), "of long, class binary, hashes binary")
    return (sets.groupBy("of", "class").agg(F.first("hashes").alias("hashes"))
            .join(one, ["of", "class"], "left_semi").select("class", "hashes"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets, from the hashes that two or more of them have."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    count = np.bincount(column)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    out = np.zeros((n, n), dtype=np.float32)
    if len(column) == 0:
        return out.astype(np.int64)
    column = np.cumsum(np.concatenate(([0], (column[1:] != column[:-1]).astype(np.int64))))
    width = 2048
    for at in range(0, int(column[-1]) + 1, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        x = np.zeros((n, width), dtype=np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _estimates(sketches: list[np.ndarray], whole: np.ndarray) -> np.ndarray:
    """Jaccard estimates of all pairs from their union sketches; exact where both sketches are ``whole`` sets."""
    both = _overlaps(sketches)
    last = np.array([s[-1] for s in sketches])
    last[whole] = np.iinfo(np.uint64).max
    upto = np.minimum(last[:, None], last[None, :])
    # how many retained values of i are at most upto[i, j]: all that both keep are among them
    within = np.stack([np.searchsorted(s, upto[i], side="right") for i, s in enumerate(sketches)])
    return both / np.maximum(within + within.T - both, 1)


def _joins(sets: list[np.ndarray], root: np.ndarray, ask: np.ndarray, sketch: int,
           threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links between components: (first root, another root) for every further root that linked pairs of sets join
    to it.  ``ask`` says which pairs count."""
    num, den = threshold
    size = np.array([len(s) for s in sets])
    same = root[:, None] == root[None, :]
    may = ask & ~same & (den * np.minimum(size[:, None], size[None, :]) >= num * np.maximum(size[:, None], size[None, :]))
    if not may.any():
        return []
    j = num / den
    least = j - SPREAD * math.sqrt(j * (1 - j) / sketch)
    may &= _estimates([s[:sketch] for s in sets], size <= sketch) >= least
    some = np.flatnonzero(may.any(axis=1))
    if len(some) == 0:
        return []
    both = _overlaps([sets[i] for i in some])
    union = size[some][:, None] + size[some][None, :] - both
    linked = may[np.ix_(some, some)] & (den * both >= num * union)
    near = linked | same[np.ix_(some, some)]
    out, todo = [], set(range(len(some)))
    while todo:
        first = min(todo)
        todo.remove(first)
        stack, roots = [first], {int(root[some[first]])}
        while stack:
            for k in np.flatnonzero(near[stack.pop()]):
                if k in todo:
                    todo.remove(k)
                    stack.append(int(k))
                    roots.add(int(root[some[k]]))
        low = min(roots)
        out += [(low, r) for r in sorted(roots) if r != low]
    return out


def _verify(sketch: int, threshold: tuple[int, int]):
    """Rows (class, root, asks, hashes) -> links (a, b) of roots.  A row that ``asks`` meets all, any other only
    those that do."""
    def work(group: pa.Table) -> pa.Table:
        root, asks, sets = {}, {}, {}
        for c, r, q, h in zip(*[group.column(x).to_pylist() for x in ("class", "root", "asks", "hashes")]):
            root[c], sets[c], asks[c] = r, h, q or asks.get(c, False)
        ids = sorted(sets)
        names = sorted(set(root.values()))  # the first root of a component is its smallest
        number = {r: i for i, r in enumerate(names)}
        who = np.array([asks[i] for i in ids])
        pairs = []
        if len(names) > 1 and who.any():
            pairs = _joins([np.frombuffer(sets[i], dtype=W.U) for i in ids], np.array([number[root[i]] for i in ids]),
                           who[:, None] | who[None, :], sketch, threshold)
        return pa.table({"a": pa.array([names[i] for i, _ in pairs], pa.binary()),
                         "b": pa.array([names[j] for _, j in pairs], pa.binary())})
    return work


def classes(docs: DataFrame, text: str = "text", words: int = WORDS, sketch: int = SKETCH,
            run: int = RUN) -> DataFrame:
    """The columns of ``docs`` but its text, and: class (NULL for the empty set), n, keys."""
    names = [c for c in docs.columns if c != text]
    fields = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(names))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{text}`").alias("t"))
    made = rows.mapInArrow(_class_rows(words, sketch, run), f"{fields}class binary, n long, keys array<long>")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "class", "n", "keys")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    sketch: int = SKETCH, run: int = RUN, threshold: tuple[int, int] = THRESHOLD,
                    block: int = BLOCK, carry: list | None = None) -> DataFrame:
    """One row per document: key, the columns ``carry``, class, n (shingles), component (the
    smallest class reachable; NULL for the empty set) and component_id (the smallest key of the
    component, its own included)."""
    base = docs.select(F.col(f"`{key}`").alias("_key"), *(carry or []), F.col(f"`{text}`").alias("_text"))
    rows = stored(classes(base, "_text", words, sketch, run), "near-rows")
    one = stored(rows.filter("class IS NOT NULL").groupBy("class")
                 .agg(F.first("keys").alias("keys"), F.first("n").alias("n"), F.min("_key").alias("_low"))
                 .withColumn("of", F.xxhash64("_low")), "near-classes")

    # inverted lists: which keys more than one class has, and the smallest class of each
    lists = stored(one.select("class", F.explode("keys").alias("key")).groupBy("key")
                   .agg(F.count(F.lit(1)).alias("c"), F.min("class").alias("pivot")).filter("c > 1"), "near-lists")
    members = (one.select("keys", "class", "n", "of")
               .mapInArrow(_list_rows(KeyFilter(lists, "key", BITMAP_BITS)), "key long, class binary, n long, of long")
               .join(lists, "key").groupBy("pivot", "class")
               .agg(F.first("n").alias("n"), F.first("of").alias("of"), F.sum("c").alias("shared")))
    members = stored(members, "near-groups")  # a pivot is a member of its own group

    # full sets of the classes that are in a group, read again from one document of each
    sets = _class_sets(base.select(F.xxhash64("_key").alias("of"), "_text"), members, words)
    roots = _linked(members, sets, sketch, threshold, block)

    # the smallest key of every component of more than one class, then of every class
    linked = one.select("class", "_low").join(roots.withColumnRenamed("node", "class"), "class")
    lows = linked.groupBy("root").agg(F.min("_low").alias("_least"))
    linked = linked.drop("_low").join(lows, "root")
    named = stored(one.select("class", "_low").join(linked, "class", "left")
                   .select("class", F.coalesce("root", "class").alias("component"),
                           F.when(F.col("root").isNull(), F.col("_low")).otherwise(F.col("_least"))
                           .alias("component_id")), "near-named")
    return (rows.drop("keys").join(named, "class", "left")
            .withColumn("component_id", F.coalesce("component_id", "_key")).withColumnRenamed("_key", key))


def _linked(members: DataFrame, sets: DataFrame, sketch: int, threshold: tuple[int, int], block: int) -> DataFrame:
    """(node, root) of every class that is linked with another, from the groups (pivot, class, n, shared)."""
    def links(rows: DataFrame, by: list[str], label: str) -> DataFrame:
        found = (rows.join(sets, "class").groupBy(*by)
                 .applyInArrow(_verify(sketch, threshold), "a binary, b binary"))
        return stored(found.distinct(), label)

    count = stored(members.groupBy("pivot").agg(F.count(F.lit(1)).alias("c")), "near-counts")
    small, roots, found = members, None, None
    if not count.filter(F.col("c") > block).isEmpty():
        sets = stored(sets, "near-sets")  # read by every step
        small = members.join(count.filter(F.col("c") <= block), "pivot").drop("c")
        large = stored(_cut(members.join(count.filter(F.col("c") > block), "pivot"), threshold, block, ["shared", "n"]), "near-cut")
        by = ["pivot", "size", "block"]
        hubs = _hubs(large)
        own = large.select(*by, "class").union(hubs.select(*by, "class")).distinct()
        found = links(own.withColumn("root", F.col("class")).withColumn("asks", F.lit(True)), by, "near-links-a")
        roots = stored(components(found), "near-roots-a")

        # groups that still have several components, listed anew by the rarest hashes of their classes
        known = stored(relabel(large, roots), "near-known")
        left = _open(known, ["pivot", "size"], "near-rests")
        left = stored(known.join(left, ["pivot", "size"]).select("class", "n", "root").distinct(), "near-left")
        if not left.isEmpty():
            more = _rare_links(left, sets, links, sketch, threshold, block)
            roots = stored(components(_stars(roots).union(more)), "near-roots-b")
    if roots is None:
        rows = small.select("pivot", "class").withColumn("root", F.col("class"))
    else:
        rows = relabel(small.select("pivot", "class"), roots)
        rows = rows.join(_open(rows, ["pivot"], "near-open"), "pivot")
    last = links(rows.withColumn("asks", F.lit(True)), ["pivot"], "near-links-c")
    return components(last if roots is None else _stars(roots).union(last))


def _open(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """The groups whose members are of two components or more."""
    return stored(rows.groupBy(*by).agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select(*by), label)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a task's sets by slot."""
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for b in batches:
        for x in b.column(0).to_pylist():
            counts += np.bincount(_slots(np.frombuffer(x, dtype=W.U)), minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["slot", "c"])


def _slots(s: np.ndarray) -> np.ndarray:
    return (s >> W.U(64 - SLOT_BITS)).astype(np.int64)


def _rare_keys(counts, threshold: tuple[int, int]):
    """(class, n, root, keys) of sets (class, n, root, hashes): the rarest hashes, by slot count and then by the hash, one more than
    a linked set can do without.  Two linked sets share one: the order is the same for all, and the counts only serve it."""
    num, den = threshold

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for b in batches:
            keys = []
            for x in b.column(3).to_pylist():
                s = np.frombuffer(x, dtype=W.U)
                order = np.lexsort((s, table[_slots(s)]))
                keys.append(s[order[:len(s) + 1 + -num * len(s) // den]].view(np.int64))
            yield pa.RecordBatch.from_arrays(b.columns[:3] + [pa.array(keys, pa.list_(pa.int64()))], names=["class", "n", "root", "keys"])
    return work


def _rare_links(left: DataFrame, sets: DataFrame, links, sketch: int, threshold: tuple[int, int], block: int) -> DataFrame:
    """Links between the components of ``left`` (class, n, root): all pairs of linked sets are looked at."""
    spark = left.sparkSession
    mine = stored(left.join(sets, "class").select("class", "n", "root", "hashes"), "near-left-sets")
    found = (mine.select("hashes").mapInArrow(_slot_counts, "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow())
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    counts[found["slot"].to_numpy()] = found["c"].to_numpy()
    keyed = stored(mine.mapInArrow(_rare_keys(spark.sparkContext.broadcast(counts), threshold),
                                   "class binary, n long, root binary, keys array<long>"), "near-rare")
    listed = keyed.select("class", "n", "root", F.explode("keys").alias("key"))
    lists = stored(listed.groupBy("key").agg(F.min("class").alias("pivot"), F.min("root").alias("x"), F.max("root").alias("y"))
                   .filter("x != y").select("key", "pivot"), "near-rare-lists")
    rows = stored(listed.join(lists, "key").select("pivot", "class", "n", "root").distinct(), "near-rare-groups")
    count = stored(rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("c")), "near-rare-counts")
    more = links(rows.join(count.filter(F.col("c") <= block), "pivot").withColumn("asks", F.lit(True)), ["pivot"], "near-links-s")
    large = count.filter(F.col("c") > block)
    if large.isEmpty():
        return more
    known = stored(_cut(rows.join(large, "pivot"), threshold, block, ["root"]), "near-rare-cut")
    by = ["pivot", "size"]
    chief = known.groupBy(*by, "root").agg(F.count(F.lit(1)).alias("c")).groupBy(*by).agg(F.max_by("root", F.struct("c", "root")).alias("chief"))
    known = stored(known.join(chief, by).withColumn("asks", F.col("root") != F.col("chief")), "near-rare-known")
    rests = stored(known.filter("asks").groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("rests")), "near-rare-rests")
    known = known.join(rests, by)
    rest = F.pmod(F.xxhash64("class", F.lit(1)), F.col("rests")).cast("int")
    columns = [*by, "block", "rest", "class", "root", "asks"]
    asking = (known.filter("asks").withColumn("rest", rest)
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    asked = (known.withColumn("rest", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)))
             .withColumn("asks", F.lit(False)))
    return more.union(links(asking.select(*columns).union(asked.select(*columns)), [*by, "block", "rest"], "near-links-b"))


def _stars(roots: DataFrame) -> DataFrame:
    return roots.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def _cut(members: DataFrame, threshold: tuple[int, int], block: int, carry: list[str]) -> DataFrame:
    """Members of large groups by (pivot, size, block), each in two size steps: sets whose sizes allow a link are in the
    same step or in neighbouring ones.  ``parts`` is the number of blocks of a step."""
    step = math.log(threshold[1] / threshold[0]) * (1 + 1e-9)
    level = F.floor(F.log(F.col("n").cast("double")) / step).cast("int")
    rows = members.select("pivot", "class", *carry, F.explode(F.array(level, level + 1)).alias("size"))
    parts = stored(rows.groupBy("pivot", "size")
                   .agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts")), "near-parts")
    return (rows.join(parts, ["pivot", "size"])
            .withColumn("block", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")))


def _hubs(large: DataFrame) -> DataFrame:
    """(pivot, size, class) of the ``HUBS`` hubs of every step, one row for each block: the members that share most list entries,
    the best of every hash bucket."""
    best = F.max(F.struct("shared", "class", "parts")).alias("h")
    bucket = F.pmod(F.xxhash64("class", F.lit(2)), F.lit(HUBS)).alias("bucket")
    some = large.groupBy("pivot", "size", bucket).agg(best).select("pivot", "size", "h.*")
    return some.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
