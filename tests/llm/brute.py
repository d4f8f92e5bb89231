"""Plain Python versions of what the operators compute, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def id_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def quality_counts(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def line_dedup(rows):
    """{row index: (n_lines, n_dropped, kept sha)} for (doc_id, text) rows."""
    order = lambda d: (d is not None, d or 0)
    holders = {}
    split = [(d, (t or "").split("\n")) for d, t in rows]
    for d, lines in split:
        for line in lines:
            key = line.strip(SPACE).translate(LOWER)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(d)
    out = []
    for d, lines in split:
        kept = []
        for line in lines:
            found = holders.get(line.strip(SPACE).translate(LOWER), ())
            if not (len(found) >= 3 and d != max(found, key=order)):
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    top, bottom = sum((a & b).values()), sum((a | b).values())
    return top / bottom if bottom else 0.0


def near_classes(rows, threshold=0.8):
    """{doc_id: class_id} of rows with an id."""
    rows = [(d, t) for d, t in rows if d is not None]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def union(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    sets = [(d, tuple(words(t)), shingles(t)) for d, t in rows]
    for i, (a, wa, sa) in enumerate(sets):
        for b, wb, sb in sets[:i]:
            if wa == wb or similarity(sa, sb) >= threshold:
                union(a, b)
    return {d: find(d) for d in parent}


def repeats_removed(rows, size=20):
    """[(doc_id, n_words, n_removed, kept sha)]; rows of one id are one document."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    for d, t in order:
        w = words(t)
        for i in range(len(w) - size + 1):
            at = ((d is not None, d or 0), i)
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, at), at)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] != ((d is not None, d or 0), i):
                gone[i : i + size] = [True] * size
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out
