"""Plain versions of the operators for small inputs, written from the contracts alone."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

BLANK = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def secret_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return sorted(out)


def private_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), "phone", m.end()))
    return sorted(out)


def rule_counts(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {i + d for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def substring(texts, window):
    """[(n_words, n_removed, kept_sha256)] of a list of texts."""
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {i + d for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for d in range(window)}
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def simhash_words(text, shingle=3):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    if not w:
        return 0
    grams = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def link_components(ids, prints, bits=2):
    """component id of each document: least id reachable over fingerprints within the given number of bits."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = defaultdict(lambda: None)
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = d if least[root(i)] is None else min(least[root(i)], d)
    return [least[root(i)] for i in range(len(ids))]


def weighted_simhash(text):
    w = words(text)
    votes, total = [0] * 64, 0
    for i, a in enumerate(w):
        b = w[i + 1] if i + 1 < len(w) else None
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        if b is not None:
            h = xxhash.xxh64_intdigest(b.encode(), h)
        weight = len(a) + len(b or "")
        total += weight
        for k in range(64):
            votes[k] += weight * (h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * votes[k] > total)
