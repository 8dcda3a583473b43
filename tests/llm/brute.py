"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_components(rows):
    """{id: (set size, component)} of (id, text)."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    posts = defaultdict(list)
    pairs = set()
    for k, (_, s) in enumerate(sets):
        for g in s:
            pairs.update((j, k) for j in posts[g])
            posts[g].append(k)
    for a, b in pairs:
        x, y = sets[a][1], sets[b][1]
        if 100 * len(x & y) >= 80 * len(x | y):
            p, q = find(sets[a][0]), find(sets[b][0])
            root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i) if s else i) for i, s in sets}


def removed_lines(rows):
    """{id: [line numbers]} of lines that an earlier line matches."""
    seen, out = [], {}
    posts = defaultdict(list)
    for i, text in rows:
        lines = (text or "").split("\n")
        if lines[-1] == "":
            lines.pop()
        out[i] = []
        for k, line in enumerate(lines):
            s = frozenset(words(line))
            shared = defaultdict(int)
            for w in s:
                for j in posts[w]:
                    shared[j] += 1
            if any(100 * c >= 80 * (len(s) + len(seen[j]) - c) for j, c in shared.items()):
                out[i].append(k)
            for w in s:
                posts[w].append(len(seen))
            seen.append(s)
    return out


def repeated_spans(rows, length=50):
    """{id: [(start, end)]} of maximal spans whose runs of ``length`` words other ids hold too."""
    holders, text = defaultdict(set), {}
    for i, t in rows:
        text[i] = w = words(t)
        for p in range(len(w) - length + 1):
            holders[tuple(w[p:p + length])].add(i)
    out = {}
    for i, w in text.items():
        spans = []
        for p in range(len(w) - length + 1):
            if len(holders[tuple(w[p:p + length])]) > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        if spans:
            out[i] = [tuple(s) for s in spans]
    return out
