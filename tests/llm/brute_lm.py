"""The bigram model from its formula, with dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def discounts(counts):
    n = [sum(c == k for c in counts) for k in range(5)]
    if not (n[1] and n[2] and n[3]):
        return [0, 0.5, 1, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3)]


def scores(rows):
    """(doc_id, text) rows -> doc_id -> (held_out, n_tokens, n_known, train_tokens, base, score)."""
    pairs = Counter()
    for i, t in rows:
        if not held(i):
            words = ["<s>"] + [w if w is not None else 0 for w in tokens(t)]
            pairs.update(zip(words, words[1:]))
    single, kinds, follow = Counter(), Counter(), defaultdict(list)
    for (h, w), n in pairs.items():
        single[w] += n
        kinds[w] += 1
        follow[h].append(n)
    total, distinct = sum(single.values()), len(single)
    d, dt, types = discounts(pairs.values()), discounts(kinds.values()), len(pairs)
    spread = sum(dt[min(k, 3)] for k in kinds.values()) / types if types else 0

    def low(w):
        return (kinds[w] - dt[min(kinds[w], 3)]) / types + spread / (distinct + 1) if types else 1 / (distinct + 1)

    rest = {h: sum(d[min(n, 3)] for n in ns) / sum(ns) for h, ns in follow.items()}
    sums = {h: sum(ns) for h, ns in follow.items()}
    out = {}
    for i, t in rows:
        words = ["<s>"] + [w if w is not None else 0 for w in tokens(t)]
        base = score = 0.0
        for h, w in zip(words, words[1:]):
            base += math.log10((single[w] + 0.1) / (total + 0.1 * (distinct + 1)))
            n = pairs[h, w]
            p = max(n - d[min(n, 3)], 0) / sums[h] + rest[h] * low(w) if h in sums else low(w)
            score += math.log10(p)
        out[i] = (held(i), len(words) - 1, sum(single[w] > 0 for w in words[1:]), total, base, score)
    return out
