"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def first(doc_id):
    """A null id is smaller than all others."""
    return float("-inf") if doc_id is None else doc_id


def line_dedup(rows, min_chars=10, min_docs=2):
    """rows: (doc_id, text); a list of (n_lines, n_dropped, kept)."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UP)
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or i == min(holders[key(x)], key=first)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def repeats(rows, window):
    """A list of (n_words, n_removed, kept) after removing all repeated windows."""
    texts = [words(t) for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text, n):
    w = words((text or "").translate(UP))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(rows, n, percent):
    """A list of (n_shingles, smallest id of the component)."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min([least.get(r, d), d], key=first) if r in least else d
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def benchmark_hits(rows, items, window):
    """A list of (n_words, n_hit, sorted item ids)."""
    wins = defaultdict(set)
    for i, t in items:
        w = ITEM_WORD.findall((t or "").translate(UP))
        for k in ([tuple(w)] if 0 < len(w) < window else [tuple(w[j:j + window]) for j in range(len(w) - window + 1)]):
            wins[k].add(None if i is None else str(i))
    out = []
    for _, t in rows:
        w = ITEM_WORD.findall((t or "").translate(UP))
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in wins:
                    hit.update(range(j, j + n))
                    found |= wins[tuple(w[j:j + n])]
        out.append((len(w), len(hit), sorted(x for x in found if x is not None)))
    return out


def greedy_pieces(word: bytes, first_pieces, inner):
    """Number of greedy longest-match pieces; 1 if the word can't be covered."""
    n, pos, known = 0, 0, first_pieces
    while pos < len(word):
        size = next((s for s in range(len(word) - pos, 0, -1) if word[pos:pos + s] in known), 0)
        if not size:
            return 1
        n, pos, known = n + 1, pos + size, inner
    return n


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_pii(text):
    """(start, kind's place, end) of the pattern kinds."""
    text, out = text or "", []
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])

    def luhn(d):
        double = [int(x) * 2 for x in d[-2::-2]]
        return (sum(int(x) for x in d[-1::-2]) + sum(x - 9 if x > 9 else x for x in double)) % 10 == 0

    checks = ((EMAIL, lambda m: True), (IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
              (CARD, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
              (PHONE, lambda m: 9 <= len(digits(m)) <= 15))
    for k, (pattern, ok) in enumerate(checks):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if ok(m)]
    return sorted(out)
