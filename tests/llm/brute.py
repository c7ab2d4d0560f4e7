"""Plain Python versions of the operators for small tables."""
import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, len(t or "")))
    out = {}
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0]))[0]
        for i, _ in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


def word_sets(rows, n=2):
    out = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    return out


def near(rows, n=2, percent=80):
    sets = word_sets(rows, n)
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    places = Counter(r[p:p + length] for r in raw for p in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for p in range(len(r) - length + 1):
            if places[r[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def leaks(text, items, n=5, similarity=0.8):
    words = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
    w = words.findall((text or "").lower())
    found = set()
    for i, item in items:
        v = words.findall((item or "").lower())
        if not v:
            continue
        k = min(n, len(v))
        of = Counter(tuple(v[j:j + k]) for j in range(len(v) - k + 1))
        sh = [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]
        m = min(sum(of.values()), len(sh))
        for p in range(len(sh) - m + 1 if m else 0):
            win = Counter(sh[p:p + m])
            both = sum((win & of).values())
            if both >= similarity * (sum(win.values()) + sum(of.values()) - both):
                found.add(i)
                break
    return found
