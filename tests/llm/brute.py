"""Plain-Python versions of the corpus operators, straight from their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WS = "\x20\t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def secrets(text):
    t = text or ""
    pats = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
            ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile(r"[0-9a-f]+"), 0, 24)]
    out = []
    for n, (kind, p, g, least) in enumerate(pats):
        out += [(m.start(), n, kind, m.end()) for m in p.finditer(t) if len(m.group(g)) >= least]
    out.sort()
    c = Counter(k for _, _, k, _ in out)
    return c["assign"], c["access"], c["hex"], sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in out))


def line_dedup(docs, min_chars=20, min_docs=3):
    docs = [(d, (t or "").split("\n")) for d, t in docs]
    holders = defaultdict(set)
    key = lambda x: x.strip(WS).translate(A_Z)
    order = lambda d: (-1, 0) if d is None else (0, d)
    for d, lines in docs:
        for x in lines:
            if len(key(x)) >= min_chars:
                holders[key(x)].add(d)
    last = {k: max(v, key=order) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, lines in docs:
        kept = [x for x in lines if key(x) not in last or last[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))
    base = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    places, labels = [], set()
    for p, label in base.items():
        q = p.split()
        for i in range(len(w) - len(q) + 1):
            if w[i:i + len(q)] == q:
                places.append(i)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def quality_counts(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if grams[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


def fingerprint(text):
    w = (text or "").translate(A_Z)
    w = WORD.findall(w)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    bits = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(sh))


def simhash(docs, most=3):
    fps = [(d, fingerprint(t)) for d, t in docs]
    parent = list(range(len(fps)))
    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= most:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(fps)]


def substring_dedup(docs, size=20):
    words = {d: WORD.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i:i + size]), (d, i))
    out = []
    for d, _ in docs:
        w, gone = words[d], set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < (d, i):
                gone |= set(range(i, i + size))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def jaccard(rows, percent=80):
    """(doc_id, n, component_id) per row, by all shared shingles."""
    sets, holders = [], defaultdict(list)
    for i, (_, t) in enumerate(rows):
        w = [x.decode() for x in (t or "").encode().lower().split()]
        sets.append(set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set())
        for x in sets[i]:
            holders[x].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)]


def divergence(docs, min_docs=10, top=10):
    """(lang, source, part, item, value, rank) from (text, lang, source) rows."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(term.findall((t or "").translate(A_Z)), a or "", s or "") for t, a, s in docs]
    out = []
    for lang in {a for _, a, _ in docs}:
        mine = [(w, s) for w, a, s in docs if a == lang]
        df = Counter(x for w, _ in mine for x in set(w))
        kept = {x for x, k in df.items() if k >= min_docs}
        count = {s: Counter() for _, s in mine}
        for w, s in mine:
            count[s].update(x for x in w if x in kept)
        whole = sum(count.values(), Counter())
        p = lambda c, x: 1 + 10**9 * (c[x] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        own = {s: {x: p(count[s], x) for x in kept} for s in count}
        base = {x: p(whole, x) for x in kept}
        for s in count:
            pair = [(o, sum(f(own[s][x], own[o][x]) for x in kept)) for o in count if o != s]
            best = [(x, f(own[s][x], base[x])) for x in kept if count[s][x] and own[s][x] > base[x]]
            for part, items, limit in (("pair", pair, None), ("term", best, top)):
                items.sort(key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(items[:limit])]
    return sorted(out)


def vector_codes(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label_error, digest) by looking at every entry."""
    from math import floor, isfinite
    rows = [(i, lab, [floor(1024 * x) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and isfinite(x) for x in v)]
    width = -(-max((len(v) for _, _, v in rows), default=0) // parts)
    rows = [(i, lab, v + [0] * (parts * width - len(v))) for i, lab, v in rows]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, _, v in rows:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for j, xs in held.items():
                books[p][j] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[near(cut(v, p), books[p]) for p in range(parts)] for _, _, v in rows]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, lab, _), e in zip(rows, errors):
        by_label[lab] += e
    digest = sha(",".join(str(c) for book in books for e in book for c in e))
    return [(i, "".join(f"{j:02x}" for _, j in f), e, by_label[lab], digest) for (i, lab, _), f, e in zip(rows, found, errors)]


def bm25(items, passage, k1=1.2, b=0.75):
    """item_id → score of a passage (list of words), scaled by the item's own score."""
    from math import log
    bags = {i: Counter(w) for i, w in items.items() if w}
    mean = max(1.0, sum(sum(x.values()) for x in bags.values()) / max(1, len(bags)))
    df = Counter(w for x in bags.values() for w in x)
    out = {}
    for i, bag in bags.items():
        size = sum(bag.values())
        weight = {w: log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * n * (k1 + 1) / (n + k1 * (1 - b + b * size / mean))
                  for w, n in bag.items()}
        out[i] = sum(x for w, x in weight.items() if w in set(passage)) / sum(weight.values())
    return out
