"""Plain Python answers that the operators are held against; small inputs only."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def simhash(text, k=4):
    ws = WORD.findall(lower(text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near_duplicates(docs, radius=4):
    """docs: (doc_id, text) -> sorted (doc_id, fingerprint, component)."""
    fps = [simhash(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(docs)]


def mix_targets(sizes, weights=(3, 1, 2)):
    from fractions import Fraction
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, total, out = set(order), Fraction(3, 2) * sum(sizes.values()), {}
    while left:
        part = total / sum(w[s] for s in left)
        over = {s for s in left if part * w[s] > 2 * sizes[s]}
        if not over:
            return out | {s: float(part * w[s]) for s in left}
        for s in over:
            out[s] = float(2 * sizes[s])
            total -= 2 * sizes[s]
        left -= over
    return out


def quality(text):
    text = text or ""
    ws = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(ws) - 4):
        at[tuple(ws[i:i + 5])].append(i)
    hit = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit),
            len(ws) < 10 or 100 * len(hit) > 20 * len(ws))


def repeats(texts, length=35):
    docs = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(d[i:i + length]) for d in docs for i in range(len(d) - length + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[tuple(d[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = " ".join(w for w, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host):])[0]


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def rule(host, path):
    fit = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def crc(text):
    return zlib.crc32((text or "").encode())
