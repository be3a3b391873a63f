"""Token counts that follow edits: a segment tree of pre-tokens per document.

A text is cut into pre-tokens, runs of ``LEAF`` pre-tokens make a leaf, and a tree over the
leaves holds the characters and tokens of every subtree.  An edit finds its leaf by descending
the tree, cuts and encodes again from the last leaf that the edit can't have changed, stops at
the first old leaf border behind the edit where the new cut meets the old one, and updates the
sums above the touched leaves.  The pre-token pattern looks at most two characters beyond a
border, which is the context taken along.

Defined results: NULL text is the empty text (no tokens); edits are applied from the last
position to the first, each on the text as it then is, clipped to its ends; NULL edits are
none.  Token counts of pre-tokens are remembered per task up to ``MEMORY`` of them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: File of byte-pair ranks; read by the driver, sent to the tasks as one broadcast.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF, CONTEXT, MEMORY = 64, 2, 400_000


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex
        import tiktoken
        self.cut = regex.compile(PATTERN)
        self.encode = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    def of(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encode(piece))
            if len(piece) <= 64:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[piece] = n
        return n

    def total(self, pieces: list[str]) -> int:
        known = self.known
        try:
            return sum([known[p] for p in pieces])
        except KeyError:
            return sum([self.of(p) for p in pieces])


class Tree:
    """Characters and tokens of the leaves and of all subtrees (node 1 is the root)."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = 1
        while self.size < len(chars):
            self.size *= 2
        self.leaves = len(chars)
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        self.chars[self.size:self.size + len(chars)] = chars
        self.tokens[self.size:self.size + len(tokens)] = tokens
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, its first character)."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.size
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def leaf_lists(self) -> tuple[list[int], list[int]]:
        a, b = self.size, self.size + self.leaves
        return self.chars[a:b], self.tokens[a:b]


def leaves_of(counter: Counter, text: str) -> tuple[list[int], list[int]]:
    """(characters, tokens) of the leaves of a whole text."""
    pieces = counter.cut.findall(text)
    chars, tokens = [], []
    for i in range(0, len(pieces), LEAF):
        part = pieces[i:i + LEAF]
        chars.append(len("".join(part)))
        tokens.append(counter.total(part))
    return chars, tokens


def edit(counter: Counter, text: str, tree: Tree, pos: int, gone: int, added: str) -> tuple[str, Tree, int]:
    """(text, tree, characters encoded again) after one edit."""
    pos = min(max(pos, 0), len(text))
    gone = min(max(gone, 0), len(text) - pos)
    if tree.leaves == 0:
        chars, tokens = leaves_of(counter, added)
        return added, Tree(chars, tokens), len(added)
    first, start = tree.find(min(max(pos - CONTEXT, 0), len(text) - 1))
    last, border = first, start + tree.chars[tree.size + first]
    new = text[:pos] + added + text[pos + gone:]
    shift = len(new) - len(text)
    pieces, at = [], start
    while True:
        # old borders before the end of the edit can't be met again
        while border < pos + gone and last + 1 < tree.leaves:
            last += 1
            border += tree.chars[tree.size + last]
        while at < border + shift or at < pos + len(added):
            m = counter.cut.match(new, at)
            if m is None:
                break
            pieces.append(m[0])
            at = m.end()
        if at >= len(new):
            last = tree.leaves - 1
            break
        if at == border + shift and border >= pos + gone:
            break
        if last + 1 < tree.leaves:
            last += 1
            border += tree.chars[tree.size + last]
    slots = last - first + 1
    per = -(-len(pieces) // slots) if pieces else 0
    for k in range(slots):
        part = pieces[k * per:(k + 1) * per]
        tree.put(first + k, len("".join(part)), counter.total(part))
    if per > 4 * LEAF:  # the region grew much: cut its leaves anew
        chars, tokens = tree.leaf_lists()
        parts = [pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF)]
        chars[first:last + 1] = [len("".join(p)) for p in parts]
        tokens[first:last + 1] = [counter.total(p) for p in parts]
        tree = Tree(chars, tokens)
    return new, tree, at - start


def _task(ranks, work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):  # small steps: texts may be long
                yield work(counter, b.slice(at, 256))
    return run


def _build(counter: Counter, b: pa.RecordBatch) -> pa.RecordBatch:
    made = [leaves_of(counter, t) if t else ([], []) for t in b.column(b.num_columns - 1).to_pylist()]
    kind = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        b.columns + [pa.array([x[0] for x in made], kind), pa.array([x[1] for x in made], kind),
                     pa.array([sum(x[1]) for x in made], pa.int64())],
        names=b.schema.names + ["leaf_chars", "leaf_tokens", "n_tokens"])


def _edit(counter: Counter, b: pa.RecordBatch) -> pa.RecordBatch:
    texts, chars, tokens, edits = (b.column(n).to_pylist() for n in ("t", "leaf_chars", "leaf_tokens", "edits"))
    out = []
    for text, c, k, todo in zip(texts, chars, tokens, edits):
        text, tree, again = text or "", Tree(c, k), 0
        for e in sorted((e for e in todo or [] if e and e["pos"] is not None), key=lambda e: -e["pos"]):
            text, tree, n = edit(counter, text, tree, e["pos"], e["del"] or 0, e["ins"] or "")
            again += n
        out.append((text, *tree.leaf_lists(), tree.tokens[1], again))
    kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    rest = [i for i, n in enumerate(b.schema.names) if n not in ("t", "leaf_chars", "leaf_tokens", "n_tokens", "edits")]
    return pa.RecordBatch.from_arrays(
        [b.column(i) for i in rest] + [pa.array([x[j] for x in out], kind) for j, kind in enumerate(kinds)],
        names=[b.schema.names[i] for i in rest] + ["t", "leaf_chars", "leaf_tokens", "n_tokens", "n_again"])


_TREE = "leaf_chars array<long>, leaf_tokens array<long>, n_tokens long"


def _safe(df: DataFrame, names: list[str]) -> tuple[list, str]:
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    return cols, "".join(f"c{i} {df.schema[c].dataType.simpleString()}, " for i, c in enumerate(names))


def token_trees(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with leaf_chars, leaf_tokens (the leaves of the tree) and n_tokens."""
    names = [c for c in docs.drop("leaf_chars", "leaf_tokens", "n_tokens").columns if c != text]
    cols, fields = _safe(docs, names)
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    made = docs.select(*cols, F.col(f"`{text}`").alias("t")).mapInArrow(_task(ranks, _build), f"{fields}t string, {_TREE}")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("t").alias(text),
                       "leaf_chars", "leaf_tokens", "n_tokens")


def apply_edits(trees: DataFrame, edits: str = "edits", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``trees`` after its edits (array<struct<pos int, del int, ins string>>): the new text, leaves
    and n_tokens, and n_again, the characters that were encoded again."""
    own = ("leaf_chars", "leaf_tokens", "n_tokens", "n_again", text, edits)
    names = [c for c in trees.columns if c not in own]
    cols, fields = _safe(trees, names)
    ranks = trees.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    made = trees.select(*cols, F.col(f"`{text}`").alias("t"), "leaf_chars", "leaf_tokens", F.col(f"`{edits}`").alias("edits"))
    made = made.mapInArrow(_task(ranks, _edit), f"{fields}t string, {_TREE}, n_again long")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("t").alias(text),
                       "leaf_chars", "leaf_tokens", "n_tokens", "n_again")
