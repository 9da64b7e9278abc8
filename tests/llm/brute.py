"""Plain-Python forms of the contracts, over lists of rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(_LOWER)


def exact(docs):
    """{doc_id: (keep_id, group_size, kept, sha256)} from (doc_id, text)."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[lower(t)].append(i)
    return {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest())
            for t, g in groups.items() for i in g}


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near(docs, k, percent):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    inverted = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverted[x].append(i)
    common = Counter()
    for members in inverted.values():
        for a, i in enumerate(members):
            for j in members[:a]:
                common[i, j] += 1
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = WORD.findall(text)
    lines = [l for l in text.split("\n") if WORD.search(l)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def normal_line(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line.lower())).strip(" ")


def line_rules(docs, max_share, min_docs, min_left):
    """{doc_id: (kept, n_left)} from (doc_id, text, host), unique ids."""
    hosts = Counter(h for _, _, h in docs)
    seen = Counter()
    parts = {}
    for i, t, h in docs:
        parts[i] = [(normal_line(l), len(WORD.findall(l))) for l in (t or "").split("\n") if WORD.search(l)]
        seen.update({(h, l) for l, _ in parts[i]})
    out = {}
    for i, t, h in docs:
        n, _, _, _, repeat = base_rules(t)
        left = n - sum(w for l, w in parts[i] if seen[h, l] > min_docs and seen[h, l] > max_share * hosts[h])
        failed = n < 10 or 100 * repeat > 20 * n
        out[i] = (failed, not failed and left >= min_left * n, left)
    return out


def interleave(docs, shards, seed):
    """{doc_id: (size, crc, shard, slot)} from (doc_id, text, source), unique ids."""
    groups = defaultdict(list)
    for i, t, s in docs:
        groups[s].append((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    order = []
    for s, g in groups.items():
        for rank, (h, i) in enumerate(sorted(g), 1):
            order.append(((2 * rank - 1) / (2 * len(g)), s is not None, s or "", h, i))
    order.sort()
    text = {i: t or "" for i, t, _ in docs}
    out, slots = {}, Counter()
    for at, (*_, i) in enumerate(order):
        shard = at * shards // len(order)
        raw = text[i].encode()
        out[i] = (len(raw) + 16, zlib.crc32(raw), shard, slots[shard])
        slots[shard] += 1
    return out


def targets(sizes, weights, share, cap):
    """{source: target}: shares by weight, the excess above the cap dealt out again and again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal = share * sum(sizes.values())
    full = set()
    while True:
        rest = goal - sum(cap * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        above = {s for s in order if s not in full and weight[s] * rest > cap * sizes[s] * total}
        if not above:
            return {s: float(cap * sizes[s]) if s in full else weight[s] * rest / total if total else 0.0 for s in order}
        full |= above


def squares(counts):
    return sum(n * n for n in counts.values())


def entropy_rates(sizes, target, cap, bins):
    """{size: rate} of one source by bisection on the multiplier."""
    groups = defaultdict(list)
    for s in sizes:
        groups[math.floor(math.log2(s + 1.0) * bins)].append(s)
    z = {b: math.log(1 + sum(g) / len(g)) for b, g in groups.items()}

    def total(x):
        return sum(sum(g) * min(cap, math.exp(x * z[b])) for b, g in groups.items())

    lo, hi = -60.0, 60.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if total(mid) < target else (lo, mid)
    return {s: min(cap, math.exp(lo * z[math.floor(math.log2(s + 1.0) * bins)])) for s in set(sizes)}
