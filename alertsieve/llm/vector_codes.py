"""Vector code compression (product codes): k-means per part of the vectors, on anchors-hierarchy trees.

1. Vectors become integers (``SCALE`` times a component, floored) in blocks of rows.  Every block
   builds one metric tree per part, middle-out: about sqrt(n) anchors, each taking over the points
   that are nearer to it than to their anchor (those within half the distance of two anchors are
   never looked at); anchors that are large are split the same way; then the two balls whose union
   is smallest are merged until one is left.  A ball caches the count and the sum of its points, its
   centre and radius.  The blocks are written to the shared folder.
2. A round of k-means walks every block's balls from the root with the list of codebook entries
   that can still own a point of the ball: an entry stays unless it is farther than the nearest one
   by more than the ball's diameter.  A child begins with its parent's list.  A ball with one entry left is
   owned whole and adds its cached count and sum; only the points of leaves with several entries
   are compared, exactly, in integers.  Spark adds up the sums; the codebook (``ENTRIES`` entries, whatever the
   number of rows) is all that the driver holds.
3. After the last round every part gets its code, and every vector the sum of its squared distances.

Defined results: rows whose vector is NULL or holds a NULL or a component that isn't finite are
dropped.  Vectors are as long as the longest, filled up with zeros to a multiple of ``PARTS``.
Integers stop at +-2**27, so squared distances fit a long.  The first codebook comes from the rows that are smallest by
(id, vector), NULL ids last; a table of fewer rows has fewer entries.  Repeated ids are rows of their own.
Labels are equal when not distinct: NULLs together.  An empty table gives no rows.  Columns beside the
three named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 27
#: Rows of a block, and points of a leaf.
BLOCK, LEAF = 1024, 24
#: Arrays of a block's trees: name -> numpy type.  A node is a row of the last seven.
ARRAYS = {"points": np.int32, "order": np.int32, "part": np.int8, "parent": np.int32, "level": np.int32,
          "begin": np.int32, "end": np.int32, "leaf": np.int8, "sums": np.int64, "radius": np.float64}


def to_integers(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.float64(SCALE) * x.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def _anchors(x: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor that owns each point; fewer than ``wanted`` where points coincide."""
    owner = np.zeros(len(x), dtype=np.int64)
    far = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    at = [0]
    while len(at) < wanted:
        new = int(far.argmax())
        if far[new] == 0:
            break
        half = np.sqrt(((x[at] - x[new]) ** 2).sum(axis=1)) / 2
        ask = np.flatnonzero(far > half[owner])  # all others are nearer to their anchor
        d = np.sqrt(((x[ask] - x[new]) ** 2).sum(axis=1))
        won = d < far[ask]
        owner[ask[won]] = len(at)
        far[ask[won]] = d[won]
        owner[new], far[new] = len(at), 0
        at.append(new)
    return owner


def _merged(balls: list) -> tuple:
    """One ball of (tree, centre, radius, count) balls: the two with the smallest union first."""
    trees = [b[0] for b in balls]
    centre = np.array([b[1] for b in balls])
    radius = np.array([b[2] for b in balls])
    count = np.array([b[3] for b in balls], dtype=np.float64)

    def unions(i: int) -> np.ndarray:
        apart = np.sqrt(((centre - centre[i]) ** 2).sum(axis=1))
        return np.maximum(np.maximum(radius, radius[i]), (apart + radius + radius[i]) / 2)
    size = np.array([unions(i) for i in range(len(trees))])
    np.fill_diagonal(size, np.inf)
    for _ in range(len(trees) - 1):
        i, j = divmod(int(size.argmin()), len(trees))
        new = unions(i)[j]
        trees[i] = (trees[i], trees[j])
        centre[i] = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
        radius[i] = new + 0.0
        count[i] += count[j]
        size[j, :] = size[:, j] = np.inf
        live = np.isfinite(size[i])
        live[i] = live[j] = False
        row = np.where(live, unions(i), np.inf)
        size[i, :], size[:, i] = row, row
        last = i
    return trees[last if len(trees) > 1 else 0]


def _ball(x: np.ndarray, rows: np.ndarray) -> tuple:
    """(tree, centre, radius, count) of some points; a tree is an array of rows or a pair of trees."""
    mine = x[rows]
    centre = mine.mean(axis=0)
    radius = float(np.sqrt(((mine - centre) ** 2).sum(axis=1).max()))
    tree = rows
    if len(rows) > LEAF and radius > 0:
        owner = _anchors(mine, int(np.ceil(np.sqrt(len(rows)))))
        tree = _merged([_ball(x, rows[owner == k]) for k in range(int(owner.max()) + 1)])
    return tree, centre, radius, len(rows)


def build(whole: np.ndarray) -> dict[str, np.ndarray]:
    """The trees of one block: ``whole`` is rows x parts x components, integers."""
    n, parts, d = whole.shape
    out: dict[str, list] = {k: [] for k in ARRAYS}
    nodes = 0
    for part in range(parts):
        x = np.ascontiguousarray(whole[:, part])
        tree = _ball(x.astype(np.float64), np.arange(n))[0]
        order, todo, mine = [], [(tree, -1, 0)], []
        place = 0
        while todo:
            t, parent, level = todo.pop()
            here = nodes + len(mine)
            if isinstance(t, tuple):
                mine.append([part, parent, level, place, -1, 0])
                todo += [(t[1], here, level + 1), (t[0], here, level + 1)]
            else:
                mine.append([part, parent, level, place, place + len(t), 1])
                order.append(t)
                place += len(t)
        for k in range(len(mine) - 1, -1, -1):  # a ball ends where its last child ends
            up = mine[k][1] - nodes
            if up >= 0:
                mine[up][4] = max(mine[up][4], mine[k][4])
        order = np.concatenate(order)
        x = x[order]
        total = np.vstack([np.zeros((1, d), np.int64), np.cumsum(x, axis=0)])
        for row in mine:
            begin, end = row[3], row[4]
            s = total[end] - total[begin]
            out["sums"].append(s)
            out["radius"].append(float(np.sqrt(((x[begin:end] - s / (end - begin)) ** 2).sum(axis=1).max())))
            for k, v in zip(("part", "parent", "level", "begin", "end", "leaf"), row):
                out[k].append(v)
        out["points"].append(x)
        out["order"].append(order)
        nodes += len(mine)
    return {k: np.ascontiguousarray(np.array(v, dtype=ARRAYS[k])) for k, v in out.items()}


def owners(trees: dict[str, np.ndarray], codebook: np.ndarray, stats: dict | None = None):
    """(entry of every point, counts, sums) for a codebook of parts x entries x components.

    Entries are per part in tree order; counts and sums per part and entry."""
    part, parent, level = trees["part"].astype(np.int64), trees["parent"], trees["level"]
    begin, end, points, radius = trees["begin"], trees["end"], trees["points"], trees["radius"]
    parts, n, d = points.shape
    count = (end - begin).astype(np.int64)
    entry = np.zeros((parts, n), dtype=np.int64)
    counts = np.zeros((parts, codebook.shape[1]), dtype=np.int64)
    sums = np.zeros((parts, codebook.shape[1], d), dtype=np.int64)
    centre = trees["sums"] / count[:, None]
    far = np.sqrt(((centre[:, None, :] - codebook[part]) ** 2).sum(axis=2))
    may = np.ones(far.shape, dtype=bool)
    done = np.zeros(len(part), dtype=bool)  # owned whole, or inside a ball that is
    whole = np.zeros(len(part), dtype=bool)
    for lv in range(int(level.max()) + 1):
        at = np.flatnonzero(level == lv)
        if lv:
            done[at] = done[parent[at]]
            at = at[~done[at]]
            may[at] = may[parent[at]]
        nearest = np.where(may[at], far[at], np.inf).min(axis=1)
        reach = nearest + 2 * radius[at]
        may[at] &= far[at] <= (reach + 1e-9 * (1 + reach))[:, None]
        one = at[may[at].sum(axis=1) == 1]
        whole[one] = done[one] = True
    own = np.flatnonzero(whole)
    best = may[own].argmax(axis=1)
    np.add.at(counts, (part[own], best), count[own])
    np.add.at(sums, (part[own], best), trees["sums"][own])
    for k, e in zip(own, best):
        entry[part[k], begin[k]:end[k]] = e
    open_ = np.flatnonzero(~done & (trees["leaf"] == 1))
    if len(open_):
        which = np.repeat(open_, count[open_])
        place = np.arange(len(which)) - np.repeat(np.cumsum(count[open_]) - count[open_], count[open_]) + begin[which]
        x = points[part[which], place].astype(np.int64)
        apart = ((x[:, None, :] - codebook[part[which]]) ** 2).sum(axis=2)
        e = np.where(may[which], apart, np.iinfo(np.int64).max).argmin(axis=1)  # of ties the first
        entry[part[which], place] = e
        np.add.at(counts, (part[which], e), 1)
        np.add.at(sums, (part[which], e), x)
    if stats is not None:
        stats["compared"] = int(count[open_].sum())
    return entry, counts, sums


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """rows x width integers of a column of vectors without NULLs."""
    size = column.value_lengths().to_numpy()
    x = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    x[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy()
    return to_integers(x)


def _block_rows(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                piece = b.slice(at, BLOCK)
                trees = build(_matrix(piece.column(2), width).reshape(piece.num_rows, PARTS, width // PARTS))
                ids, labels = [pa.ListArray.from_arrays([0, piece.num_rows], pa.concat_arrays([piece.column(k)]))
                               for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels] + [pa.array([trees[k].tobytes()], pa.binary()) for k in ARRAYS],
                    names=["ids", "labels", *ARRAYS])
    return work


def _read(b: pa.RecordBatch, row: int, d: int) -> dict[str, np.ndarray]:
    trees = {k: np.frombuffer(b.column(k)[row].as_buffer(), dtype=t) for k, t in ARRAYS.items()}
    trees["order"] = trees["order"].reshape(PARTS, -1)
    trees["points"] = trees["points"].reshape(PARTS, -1, d)
    trees["sums"] = trees["sums"].reshape(-1, d)
    return trees


def _sum_rows(codebook: np.ndarray):
    """(slot, value): counts, then sums, of every part and entry over a task's blocks."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*codebook.shape[:2], codebook.shape[2] + 1), dtype=np.int64)
        for b in batches:
            for row in range(b.num_rows):
                _, counts, sums = owners(_read(b, row, codebook.shape[2]), codebook)
                total[:, :, 0] += counts
                total[:, :, 1:] += sums
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.int64())],
                                         names=["slot", "value"])
    return work


def _code_rows(codebook: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                trees = _read(b, row, codebook.shape[2])
                entry, _, _ = owners(trees, codebook)
                codes = np.zeros(entry.shape, dtype=np.uint8)
                error = np.zeros(entry.shape[1], dtype=np.int64)
                for part in range(PARTS):
                    order = trees["order"][part]
                    codes[part, order] = entry[part]
                    error[order] += ((trees["points"][part] - codebook[part][entry[part]]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[row].values, b.column("labels")[row].values,
                     pa.array([c.tobytes().hex() for c in np.ascontiguousarray(codes.T)], pa.string()),
                     pa.array(error, pa.int64())], names=["id", "label", "code", "error"])
    return work


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """id, label, vector of the rows that are kept."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"),
                          F.col(f"`{embedding}`").alias("vector")).filter(x.isNotNull() & finite)


def first_codebook(rows: DataFrame, width: int, entries: int = ENTRIES) -> np.ndarray:
    """Parts x entries x components, from the smallest ids."""
    head = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    x = np.zeros((len(head), width))
    for k, r in enumerate(head):
        x[k, :len(r.vector)] = r.vector
    return np.ascontiguousarray(to_integers(x).reshape(len(head), PARTS, width // PARTS).transpose(1, 0, 2))


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of every kept vector, and the last codebook."""
    rows = usable(vectors, vec_id, embedding, label)
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    width = -(-max(longest or 0, 1) // PARTS) * PARTS
    codebook = first_codebook(rows, width, entries)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    arrays = ", ".join(f"{k} binary" for k in ARRAYS)
    blocks = stored(rows.select("id", "label", "vector").mapInArrow(
        _block_rows(width), f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, {arrays}"), "vector-blocks")
    trees = blocks.select(*ARRAYS)
    for _ in range(rounds if longest is not None else 0):
        total = np.zeros((*codebook.shape[:2], codebook.shape[2] + 1), dtype=np.int64)
        sums = trees.mapInArrow(_sum_rows(codebook), "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value"))
        for r in sums.collect():  # at most PARTS * entries * (components of a part + 1) rows
            total.ravel()[r.slot] = r.value
        used = total[:, :, 0] > 0
        codebook = codebook.copy()
        codebook[used] = total[:, :, 1:][used] // total[:, :, :1][used]
    fields = f"id {kinds[0]}, label {kinds[1]}, code string, error long"
    return stored(blocks.mapInArrow(_code_rows(codebook), fields), "vector-codes"), codebook


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` and label_error, the errors of equal labels added up; the sums are written, so that Spark
    knows their size."""
    sums = stored(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def codebook_digest(codebook: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebook.ravel().tolist())).encode()).hexdigest()


def oracle_sql() -> str:
    """DuckDB SQL of the same codes: every round compares every part with every entry."""
    ctes = [f"""kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""parts AS (SELECT r, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS x
  FROM kept, range({PARTS}) AS t(p))""",
            f"book0 AS (SELECT p, r - 1 AS e, x FROM parts WHERE r <= {ENTRIES})"]
    apart = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(ROUNDS + 1):
        ctes.append(f"""near{k} AS (SELECT r, a.p, a.x, min(struct_pack(d := {apart.format('a.x', 'b.x')}::BIGINT, e := b.e)) AS m
  FROM parts a JOIN book{k} b ON a.p = b.p GROUP BY r, a.p, a.x)""")
        if k < ROUNDS:
            ctes.append(f"""mean{k} AS (SELECT p, e, list(CAST(floor(s::DOUBLE / c) AS BIGINT) ORDER BY i) AS x FROM
  (SELECT p, m.e AS e, i, sum(x[i]) AS s, count(*) AS c FROM near{k}, range(1, 1 + len(x)) AS t(i) GROUP BY ALL) GROUP BY p, e),
book{k + 1} AS (SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} n ON b.p = n.p AND b.e = n.e)""")
    return "WITH " + ",\n".join(ctes) + f""",
coded AS (SELECT r, string_agg(lpad(lower(hex(m.e)), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""
