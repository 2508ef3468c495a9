"""Plain versions of the operators' contracts, over lists of (doc_id, text)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def words(text):
    return (text or "").encode().split()


def sha(x):
    return hashlib.sha256(x).hexdigest()


def substring_dedup(docs, size=50):
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def quality_base(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w = words(t)
        lines = [x for x in t.split("\n") if x.encode().split()]
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        n = Counter(windows)
        covered = {j for k, x in enumerate(windows) if n[x] > 1 for j in range(k, k + 8)}
        out.append((i, len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)))
    return out


def roots(nodes, links):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(docs, radius=3):
    fp = {i: fingerprint(t) for i, t in docs}
    ids = sorted(fp)
    v = np.array([fp[i] for i in ids], np.uint64)
    links = [(ids[a], ids[b]) for a in range(len(ids)) for b in np.flatnonzero(np.bitwise_count(v[a] ^ v) <= radius)]
    root = roots(ids, links)
    return [(i, f"{fp[i]:016x}", root[i]) for i in ids]


def vectors(rows, least=0.95):
    good = {i: np.array(v, np.float64) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a in good for b in good if a != b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= least]
    root = roots([i for i, _ in rows], links)
    n = Counter(a for a, _ in links)
    return [(i, n[i], root[i], root[i] == i) for i, _ in rows]


def pieces(docs, encode, capacity=2048):
    out = []
    for i, t in docs:
        ids = np.array([*encode(t or ""), 0], "<u4")
        head = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(head, len(ids), capacity), len(ids)]
        out += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


def sequences(rows, capacity=2048):
    """Asserts that (length, sequence, offset) fill sequences gapless from 0; returns their number."""
    by = defaultdict(list)
    for length, s, at in rows:
        by[s].append((at, length))
    for places in by.values():
        at = 0
        for start, length in sorted(places):
            assert start == at
            at += length
        assert at <= capacity
    return len(by)


def fewest_bins(pieces, capacity):
    """Over all sets of pieces: fewest bins, then the least used of the last one."""
    best = [(1, 0)] + [None] * ((1 << len(pieces)) - 1)
    for got in range(1, 1 << len(pieces)):
        ways = []
        for i, x in enumerate(pieces):
            if got >> i & 1:
                bins, used = best[got ^ 1 << i]
                ways.append((bins, used + x) if used + x <= capacity else (bins + 1, x))
        best[got] = min(ways)
    return best[-1][0] if pieces else 0


def ftrl(rows, l1, l2, alpha, beta, epochs, positive):
    """FTRL-proximal over (features to values, label) in turn: weights other than zero, and the bias."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        if f != "bias" and abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - (l1 if z[f] > 0 else -l1 if z[f] < 0 else 0.0) * (f != "bias")) / ((beta + n[f] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for x, y in rows:
            x = {**x, "bias": 1.0}
            w = {f: weight(f) for f in x}
            g = (1 / (1 + np.exp(-sum(w[f] * v for f, v in x.items()))) - y) * (positive if y else 1.0)
            for f, v in x.items():
                sigma = ((n[f] + (g * v) ** 2) ** 0.5 - n[f] ** 0.5) / alpha
                z[f] += g * v - sigma * w[f]
                n[f] += (g * v) ** 2
    found = {f: weight(f) for f in z}
    return {f: w for f, w in found.items() if w and f != "bias"}, found.get("bias", 0.0)


def skip_features(text, marks, stems):
    w = [x for x in text.lower().encode().translate(None, marks).split()]
    out = {("word", x) for x in w} | {("pair", *p) for p in zip(w, w[1:], strict=False)} | {("skip", *p) for p in zip(w, w[2:], strict=False)}
    return dict.fromkeys(out | {("stem", m, x[:m]) for m in stems for x in w if len(x) > m}, 1.0)


def shape_features(text):
    def shape(x):
        return "".join(sorted("0" if c.isdigit() else c for c in x if not c.isalpha() and c.isascii()))

    w = text.lower().split()
    found = Counter(("word", x) for x in w) + Counter(("shape", shape(x)) for x in w)
    for a, b in zip(w, w[1:], strict=False):
        found.update([("pair", a, b), ("shapes", shape(a), shape(b)), ("same", a == b)])
    return {f: float(np.float32((c / len(w)) ** 0.5)) for f, c in found.items()}


def secrets(text):
    """Base spans of a text: kind, start, end, by start and then kind."""
    assign = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", m) for m in re.finditer(assign, text) if len(m[1]) >= 12]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18] + [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], order.index(s[0])))
