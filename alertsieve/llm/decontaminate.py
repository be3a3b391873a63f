"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the smallest is kept as a fingerprint, so any two
texts that share ``SPAN`` words in a row share a fingerprint at the same place of that span.
A fingerprint is extended to every span of ``SPAN`` words around it.  Spans of the benchmark are reduced to
distinct (fingerprint, span hash) rows, so a document's span meets at most one of them: a k-gram that many
texts share inside different surroundings joins nothing.  Spans that meet are hits, and hits that
touch or overlap grow together.  The ids of items come last, joined to distinct (document, span) rows.
Items shorter than a span count as one window and are found by the hash of the whole item.

Documents send a span to the join only if a bitmap of fixed size (``BITMAP_BITS``),
built over the benchmark's spans, lets it pass; that bitmap is all that is broadcast, whatever the
size of the benchmark, and a larger benchmark only lets more spans through.

Defined results: NULL and word-free texts have no words and no hits; an item without words
never occurs; items with a NULL id hit words but are not listed; rows that repeat an item or a
document each get the full answer.  Equal words and k-grams are taken by their 64-bit hashes, equal spans by that
of all their words and that of the k-gram in them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import KeyFilter, stored

#: Words of a window; K-grams; K-grams per winnowing window (K + WINDOW - 1 = SPAN).
SPAN, K = 13, 8
WINDOW = SPAN - K + 1
SIDE = SPAN - K
BITMAP_BITS = 24

_HIT = pa.struct([("fp", pa.int64()), ("span", pa.int64()), ("start", pa.int32()), ("size", pa.int32())])


def _winnow(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k-gram hashes, which of them are fingerprints) for all texts of a piece."""
    g = W.ngrams(h, K)
    n = len(g)
    if n < WINDOW:
        return g, np.zeros(n, bool)
    low = g[:n - WINDOW + 1].copy()
    for i in range(1, WINDOW):
        np.minimum(low, g[i:n - WINDOW + 1 + i], out=low)
    # a window must lie inside one text
    word_text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.arange(len(low))
    inside = word_text[starts] == word_text[starts + SPAN - 1]
    low[~inside] = 0
    high = np.zeros(n, W.U)
    for i in range(WINDOW):
        np.maximum(high[i:i + len(low)], low, out=high[i:i + len(low)])
    return g, (high == g) & (high != 0)


def _spans(h: np.ndarray, first: np.ndarray, text: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the k-grams at ``pos``, first word) of all spans around them inside their texts."""
    which = np.repeat(np.arange(len(pos)), SIDE + 1)
    start = (pos[:, None] - np.arange(SIDE + 1)[None, :]).ravel()
    inside = (start >= first[text[which]]) & (start + SPAN <= first[text[which] + 1])
    return which[inside], start[inside]


def _short_hash(g: np.ndarray, n: int) -> np.ndarray:
    return W.mix(g ^ W.U(0xC2B2AE3D27D4EB4F * n % (1 << 64)))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0)
        for at, data, offsets in W.chunks(b.column(1)):
            h, first = W.words(data, offsets, W.ALNUM)
            n_words = np.diff(first)
            text_of = np.repeat(np.arange(len(n_words)), n_words)
            g, keep = _winnow(h, first)
            pos = np.flatnonzero(keep)
            which, start = _spans(h, first, text_of[pos], pos)
            whole = W.ngrams(h, SPAN)
            parts = [(text_of[pos[which]], _signed(g[pos[which]]), _signed(whole[start]), np.full(len(start), SPAN))]
            for t in np.flatnonzero((n_words > 0) & (n_words < SPAN)):
                n = int(n_words[t])
                f = _signed(_short_hash(W.ngrams(h[first[t]:first[t + 1]], n), n))
                parts.append((np.array([t]), f, f, np.array([n])))
            text, fp, span, size = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at + text)), pa.array(fp), pa.array(span), pa.array(size.astype(np.int32))],
                names=["item_id", "fp", "span", "size"])


def _candidates(known: KeyFilter, shorts: list[int]):
    """Word counts and the spans that the benchmark may have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in W.chunks(b.column(b.num_columns - 1)):
                h, first = W.words(data, offsets, W.ALNUM)
                n_words = np.diff(first)
                text_of = np.repeat(np.arange(len(n_words)), n_words)
                g, keep = _winnow(h, first)
                pos = np.flatnonzero(keep)
                which, start = _spans(h, first, text_of[pos], pos)
                span = _signed(W.ngrams(h, SPAN)[start])
                some = known.passes(span)
                which, start, span = which[some], start[some], span[some]
                parts = [(text_of[start], _signed(g[pos[which]]), span, start, np.full(len(start), SPAN))]
                for n in shorts:
                    f = _signed(_short_hash(W.ngrams(h, n), n))
                    p = np.flatnonzero(known.passes(f))
                    p = p[text_of[p] == text_of[p + n - 1]]
                    parts.append((text_of[p], f[p], f[p], p, np.full(len(p), n)))
                text, fp, span, start, size = (np.concatenate(x) for x in zip(*parts))
                start = (start - first[text]).astype(np.int32)
                order = np.argsort(text, kind="stable")
                hits = pa.StructArray.from_arrays(
                    [pa.array(fp[order]), pa.array(span[order]), pa.array(start[order]),
                     pa.array(size[order].astype(np.int32))], fields=list(_HIT))
                ends = np.searchsorted(text[order], np.arange(len(n_words) + 1)).astype(np.int32)
                rows = b.slice(at, len(n_words))
                yield pa.RecordBatch.from_arrays(
                    rows.columns[:-1] + [pa.array(n_words.astype(np.int64)),
                                         pa.ListArray.from_arrays(pa.array(ends), hits)],
                    names=rows.schema.names[:-1] + ["n_words", "hits"])
    return run


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """One row per document: the columns of ``docs`` but its text, ``n_words``, ``n_hit`` (words
    inside an occurrence of a window), ``items`` (ids, sorted as strings) and ``spans``
    array<struct<start, end>> (word positions, merged).  A column of ``docs`` with one of these
    names is replaced."""
    docs = docs.drop("n_words", "n_hit", "items", "spans")
    id_type = items.schema[item_key].dataType.simpleString()
    fps = stored(items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("t"))
                 .mapInArrow(_item_rows, f"item_id {id_type}, fp long, span long, size int"), "bench-fp")
    known = KeyFilter(fps, "span", BITMAP_BITS)
    shorts = sorted(r[0] for r in fps.filter(F.col("size") < SPAN).select("size").distinct().collect())

    names = [c for c in docs.columns if c != text]
    fields = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                       F.monotonically_increasing_id().alias("uid"), F.col(f"`{text}`").alias("t"))
    found = stored(rows.mapInArrow(
        _candidates(known, shorts),
        f"{fields}{', ' if fields else ''}uid long, n_words long, hits array<struct<fp:long,span:long,start:int,size:int>>"), "doc-fp")

    keys = ["fp", "span", "size"]
    windows = stored(fps.select(*keys).distinct(), "bench-windows")  # a document's span meets one of them at most
    hits = stored(found.filter(F.size("hits") > 0).select("uid", F.inline("hits")).join(windows, keys, "left_semi")
                  .select("uid", "span", "size", "start").distinct(), "doc-spans")
    runs = hits.groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end"))))
                                   .alias("runs"))
    named = stored(fps.filter("item_id IS NOT NULL").groupBy("span", "size")
                   .agg(F.collect_set(F.col("item_id").cast("string")).alias("items")), "bench-items")
    listed = (hits.select("uid", "span", "size").distinct().join(named, ["span", "size"])
              .groupBy("uid").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    merged = stored(runs.join(listed, "uid", "left").select("uid", "items", _union(F.col("runs")).alias("spans")), "doc-hits")
    none = F.array().cast("array<struct<start:int,end:int>>")
    out = found.drop("hits").join(merged, "uid", "left").withColumn("spans", F.coalesce("spans", none))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def _union(runs):
    """Sorted runs merged where they touch or overlap."""
    kind = "array<struct<start:int,end:int>>"

    def step(acc, r):
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        return (F.when(F.size(acc) == 0, F.array(r))
                .when(r["start"] <= last["end"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown)))
                .otherwise(F.concat(acc, F.array(r))))
    return F.aggregate(runs, F.array().cast(kind), step)


def is_contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """The share rule: some hit, and one word in twenty or more."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))
