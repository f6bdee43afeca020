"""The contracts in plain Python, one document at a time."""

import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SHINGLE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCHMARK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"
    r"|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def words(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text, SHINGLE_WORD)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def linked(rows):
    """doc_id -> (size, component) of (doc_id, text)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    seen = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in seen[s])
        for s in sets[i]:
            seen[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def contaminated(text, items):
    """(words, hit words, item ids) of one text."""
    windows = defaultdict(set)
    for i, t in items:
        w = words(t, BENCHMARK_WORD)
        if i is not None and w:
            for k in range(max(1, len(w) - 9)):
                windows[tuple(w[k : k + 10])].add(i)
    w = words(text, BENCHMARK_WORD)
    hit, found = set(), set()
    for n in {len(k) for k in windows}:
        for k in range(len(w) - n + 1):
            if (own := tuple(w[k : k + n])) in windows:
                hit.update(range(k, k + n))
                found |= windows[own]
    return len(w), len(hit), sorted(found)


def secrets(text):
    """Base findings as (kind, start, end), by start and kind."""
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    return sorted(found, key=lambda f: (f[1], kinds.index(f[0])))


def best_fit_decreasing(lengths, capacity):
    """What is left in each bin."""
    left = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, k) for k, room in enumerate(left) if room >= length]
        if fits:
            left[min(fits)[1]] -= length
        else:
            left.append(capacity - length)
    return sorted(left)
