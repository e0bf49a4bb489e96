"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, n=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_components(rows, pct):
    """doc_id -> (set size, least linked id)."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def dedup_lines(rows, pct=80):
    """doc_id -> text without the lines that an earlier line matches."""
    seen, out = [], {}
    for i, text in sorted(rows):
        if text is None:
            out[i] = None
            continue
        kept = []
        for line in text.split("\n"):
            s = set(words(line))
            match = any(100 * len(s & t) >= pct * len(s | t) for t in seen) if s else False
            seen += [s] if s else []
            kept += [] if match else [line]
        out[i] = "\n".join(kept)
    return out


def repeated_words(rows, n):
    """doc_id -> set of word places inside an n-word run that another document has."""
    where = defaultdict(set)
    texts = {i: words(t) for i, t in rows}
    for i, w in texts.items():
        for k in range(len(w) - n + 1):
            where[tuple(w[k : k + n])].add(i)
    out = defaultdict(set)
    for i, w in texts.items():
        for k in range(len(w) - n + 1):
            if len(where[tuple(w[k : k + n])]) > 1:
                out[i].update(range(k, k + n))
    return dict(out)


def mix(rows, weights=(1, 2, 3), most=3):
    """doc_id -> (size, source size, target, taken)."""
    sizes = {i: len(words(t)) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    total = defaultdict(int)
    for i, s in source.items():
        total[s] += sizes[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        left = sum(total.values()) - sum(target.values())
        share = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / share > most * total[s]]
        if not over:
            target |= {s: left * weight[s] / share for s in open_}
            break
        target |= {s: most * total[s] for s in over}
        open_ -= set(over)
    out = {}
    for s in order:
        start, wanted = 0, round(target[s])
        for i in sorted((i for i in source if source[i] == s), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)):
            full = wanted // total[s] if total[s] else 0
            rest = wanted - full * total[s]
            out[i] = (sizes[i], total[s], target[s], full * sizes[i] + min(sizes[i], max(0, rest - start)))
            start += sizes[i]
    return out
