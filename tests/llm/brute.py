"""Plain Python versions of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib


def crc_mod(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def base_pii(text):
    """[(start, rank, end, kind)] of the base kinds."""
    text = text or ""
    out = []
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19
            and _luhn(re.sub("[^0-9]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    for rank, (kind, pattern, ok) in enumerate(rules):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if ok(m[0])]
    return sorted(out)


def pii_row(text):
    spans = base_pii(text)
    n = [sum(s[3] == k for s in spans) for k in ("email", "ip", "card", "phone")]
    return n + [sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans))]


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lower(text):
    return (text or "").encode().translate(_LOWER).decode()


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def decontaminate(docs, items):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}; ids unique."""
    windows = {}
    for item, text in items:
        w = alnum_words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = sorted({len(x) for x in windows})
    out = {}
    for doc, text in docs:
        w = alnum_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out[doc] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))),
                    len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def shingles(text, n=5):
    w = spaced_words(text)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}


def near_components(docs):
    """{doc_id: (n_shingles, component_id)}; ids unique."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(text, edits):
    """The text after edits (pos, del, ins), from the last position to the first."""
    text = text or ""
    for pos, gone, added in sorted(edits, key=lambda e: -e[0]):
        pos = min(max(pos, 0), len(text))
        text = text[:pos] + added + text[pos + max(gone, 0):]
    return text


def base_scores(docs):
    """{doc_id: (n_tokens, n_known, train_tokens, base_score)}; ids unique."""
    import math
    from collections import Counter
    tokens = {i: spaced_words(t) + [None] for i, t in docs}
    c = Counter()
    for i, w in tokens.items():
        if crc_mod(i, 10) != 0:
            c.update(w)
    n, v = sum(c.values()), len(c)
    return {i: (len(w), sum(c[x] > 0 for x in w), n,
                sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in tokens.items()}
