"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

import xxhash

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def decontaminate(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORDS.findall(lower(text or ""))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = ITEM_WORDS.findall(lower(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return out


def fingerprint(text):
    w = SPACE_WORDS.findall(lower(text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def near_duplicates(docs):
    prints = [fingerprint(t) for _, t in docs]
    roots = groups(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for (doc, _), r in zip(docs, roots):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [(doc, f, least.get(r)) for (doc, _), f, r in zip(docs, prints, roots)]


def line_key(line):
    return lower(line.strip(" \t\n\v\f\r"))


def dedup_lines(docs):
    owner, last = {}, {}
    for doc, text in docs:
        for line in (text or "").split("\n") if doc is not None else []:
            k = line_key(line)
            if len(k) >= 10:
                owner[k] = min(doc, owner.get(k, doc))
                last[k] = max(doc, last.get(k, doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or not (len(line_key(x)) >= 10 and owner[line_key(x)] < doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def remove_repeats(docs):
    first = {}
    rank = lambda d: -(2**63) if d is None else d
    for doc, text in docs:
        w = SPACE_WORDS.findall(text or "")
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            first[k] = min((rank(doc), i), first.get(k, (rank(doc), i)))
    out = []
    for doc, text in docs:
        w = SPACE_WORDS.findall(text or "")
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (rank(doc), i):
                gone |= set(range(i, i + 20))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def top_k(vectors, k=5):
    from math import floor, isfinite

    good = [(i, [floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return out
