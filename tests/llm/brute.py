"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def simhash(text, k=3):
    w = words(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i: i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, ids, radius):
    """Smallest id reachable for each position, linking fingerprints within radius."""
    n = len(fps)
    label = [i for i in range(n)]

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    best = defaultdict(list)
    for i in range(n):
        if ids[i] is not None:
            best[find(i)].append(ids[i])
    return [min(best[find(i)], default=None) for i in range(n)]


def remove_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i: i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        left = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    """(kind, start, end) of the base kinds, by start, then kind."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(("email", "ip", "card", "phone")[k], s, e) for s, k, e in sorted(out)]


def quality_counts(text):
    text = text or ""
    w = words(text, lower=False)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    win = Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))
    hit = [False] * len(w)
    for i in range(len(w) - 4):
        if win[tuple(w[i: i + 5])] > 1:
            hit[i: i + 5] = [True] * 5
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(hit))


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def license_base(text):
    w = license_words(text)
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i: i + len(p)] == p]
    at = [i for i, _ in found]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def item_matches(text, item, size=5, at=0.8):
    """Best similarity of the item with any window of its own size, if high enough."""
    w, t = words(text), words(item)
    if not t or not w:
        return None
    if len(t) < size:
        return 1.0 if w == t else None
    sh = [tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1))]
    it = Counter(tuple(t[i: i + size]) for i in range(len(t) - size + 1))
    if not set(sh) & set(it):
        return None
    n = sum(it.values())
    best = max(weighted_jaccard(Counter(sh[i: i + n]), it) for i in range(max(1, len(sh) - n + 1)))
    return best if best >= at else None


def license_spans(text, templates, word, k=3, drift=4, cover=0.8):
    """(label, last word, cover) of each verified span: hits by diagonal,
    near diagonals together, then the longest chain by the quadratic recurrence."""
    w, out = word(text), []
    for label, notice in templates:
        own = word(notice)
        at = defaultdict(list)
        for q in range(len(own) - k + 1):
            at[tuple(own[q: q + k])].append(q)
        runs = {}
        for p in range(len(w) - k + 1):
            for q in at.get(tuple(w[p: p + k]), ()):
                a, b = runs.get(p - q, (q, q))
                runs[p - q] = (min(a, q), max(b, q))
        groups = []
        for d in sorted(runs):
            if groups and d - groups[-1][-1] <= drift:
                groups[-1].append(d)
            else:
                groups.append([d])
        for g in groups:
            points = sorted({(q, q + d) for d in g for q in range(runs[d][0], runs[d][1] + k) if w[q + d] == own[q]})
            best = [1] * len(points)
            for i, (q, p) in enumerate(points):
                best[i] += max((best[j] for j in range(i) if points[j][0] < q and points[j][1] < p), default=0)
            n = max(best)
            if n / len(own) >= cover:
                out.append((label, min(p for b, (_, p) in zip(best, points) if b == n), n / len(own)))
    return sorted(out)
