"""Plain loops that state what the operators have to give."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rest(identifier, modulus):
    return zlib.crc32(("" if identifier is None else str(identifier)).encode()) % modulus


def shingles(text, n):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(docs, percent=85, n=4):
    """Per row: size of its set and least identifier of its component."""
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(docs):
        least[find(i)].append(d)
    return [(len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i in range(len(docs))]


def leaks(docs, items, window=13, different=2, shortest=5):
    """Per row: the (item, start) of every window that matches."""
    out = []
    tests = [(i, words(t, lower=True)) for i, t in items if i is not None]
    for _, text in docs:
        w, found = words(text, lower=True), set()
        at = collections.defaultdict(list)
        for s, x in enumerate(w):
            at[x].append(s)
        for i, b in tests:
            size = min(window, len(b))
            k = different if len(b) >= window else size // 5 if size >= 6 else 0
            if size < shortest:
                continue
            diagonals = collections.Counter(s - q for q, x in enumerate(b) for s in at.get(x, ()))
            for d, n in diagonals.items():
                if n < size - k:
                    continue
                for q in range(len(b) - size + 1):
                    s = q + d
                    if 0 <= s <= len(w) - size and sum(x != y for x, y in zip(w[s : s + size], b[q : q + size])) <= k:
                        found.add((i, s))
        out.append(found)
    return out


def dedup_words(docs, window=20):
    """Per row (number of words, removed, digest of the rest); rows rank by identifier, null last."""
    seen, out = set(), {}
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    for i in order:
        w = words(docs[i][1])
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), len(w) - len(kept), sha(" ".join(kept)))
    return [out[i] for i in range(len(docs))]


def dedup_bytes(docs, window=200):
    """Per row (bytes, removed, spans, digest of the rest)."""
    texts = [(t or "").encode() for _, t in docs]
    count = collections.Counter(b[s : s + window] for b in texts for s in range(len(b) - window + 1))
    out = []
    for b in texts:
        gone = [False] * len(b)
        for s in range(len(b) - window + 1):
            if count[b[s : s + window]] > 1:
                gone[s : s + window] = [True] * window
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, sha(kept)))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def personal(text):
    """Counts by kind and the listed spans."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if passes(kind, m.group())]
    counts = collections.Counter(x[3] for x in found)
    return [counts[k] for k in PATTERNS], ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


class Katz:
    """The bigram model, with dictionaries."""

    def __init__(self, texts, share):
        texts = [[*words(t, lower=True), None] for t in texts]
        self.count = collections.Counter(w for t in texts for w in t)
        self.n = sum(self.count.values())
        self.own = {w for w, c in self.count.items() if c * share >= self.n}
        d = self.discounts(self.count)
        self.p1 = {w: d.get(self.count[w], 1) * self.count[w] / self.n for w in self.own}
        least, total = 1 / (self.n + 1), sum(self.p1.values())
        if total > 1 - least:
            self.p1 = {w: p * (1 - least) / total for w, p in self.p1.items()}
        self.p1["rare"] = 1 - sum(self.p1.values())
        self.rare = self.n - sum(self.count[w] for w in self.own) + len(self.count) - len(self.own) + 1
        pairs = collections.Counter(p for t in texts for p in self.pairs(t))
        self.d = self.discounts(pairs)
        self.after = collections.defaultdict(dict)
        for (h, w), c in pairs.items():
            self.after[h][w] = c

    def pairs(self, tokens):
        classes = [w if w in self.own else "rare" for w in tokens]
        return list(zip(["start", *classes], classes))

    @staticmethod
    def discounts(counter):
        n = collections.Counter(counter.values())
        out = {}
        for r in range(1, 6):
            d = 0
            if n[1] and n[r] and 6 * n[6] < n[1]:
                common = 6 * n[6] / n[1]
                d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            out[r] = d if 0 < d < 1 else 1 - 0.5 / r
        return out

    def p(self, w, h):
        seen = self.after.get(h)
        if not seen:
            return self.p1[w]
        total = sum(seen.values())
        mass = sum(self.d.get(c, 1) * c for c in seen.values())
        unseen = 1 - sum(self.p1[x] for x in seen)
        scale = total if total - mass > 1e-9 * total else total + 1
        if unseen < 1e-9:
            return self.d.get(seen.get(w, 0), 1) * seen.get(w, 0) / mass
        if w in seen:
            return self.d.get(seen[w], 1) * seen[w] / scale
        return (1 - mass / scale) / unseen * self.p1[w]

    def score(self, text):
        tokens = [*words(text, lower=True), None]
        base = sum(math.log10((self.count[w] + 1) / (self.n + len(self.count) + 1)) for w in tokens)
        score = 0.0
        for token, (h, w) in zip(tokens, self.pairs(tokens)):
            score += math.log10(self.p(w, h))
            if w == "rare":
                score += math.log10((self.count[token] + 1) / self.rare)
        return len(tokens), sum(w in self.count for w in tokens), base, score
