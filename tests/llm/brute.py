"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def exact(rows):
    """rows: (doc_id, text) -> list of (doc_id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        key = SPACE.sub("", t or "")
        keep = min(groups[key], key=lambda g: g[:3])[3]
        out.append((i, keep, len(groups[key]), i == keep, sha(key)))
    return out


def near(rows, least=0.8):
    """rows: (doc_id, text) -> {doc_id: class_id}, by all pairs."""
    sets, parent = defaultdict(list), {}
    for i, t in rows:
        w = WORD.findall(t or "")
        n = min(5, len(w))
        sets[i].append((tuple(w), {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()))
        parent[i] = i

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x in range(len(ids)):
        for y in range(x):
            for w, a in sets[ids[x]]:
                for v, b in sets[ids[y]]:
                    if w == v or a and b and len(a & b) / len(a | b) >= least:
                        p, q = find(ids[x]), find(ids[y])
                        parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """sizes: {source: words} -> {source: target}, dealing the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        rest = left - sum(full.values())
        over = [s for s in open_ if rest * weight[s] / total > most * sizes[s] - 1e-9]
        if not over:
            return full | {s: rest * weight[s] / total for s in open_}
        full |= {s: most * sizes[s] for s in over}


def repeated(words, size=8):
    n = Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    on = [False] * len(words)
    for k in range(len(words) - size + 1):
        if n[tuple(words[k : k + size])] > 1:
            on[k : k + size] = [True] * size
    return sum(on)


def statistics(text):
    w, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeated(w)


RULES = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def secrets(text):
    found = sorted((m.start(), k, r[0], m.end()) for k, r in enumerate(RULES) for m in r[1].finditer(text) if len(m[r[2]]) >= r[3])
    return [f"{kind}:{a}:{b}" for a, _, kind, b in found]
