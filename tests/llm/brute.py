"""Plain versions of the corpus operators: all pairs, one process, no tricks."""

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BOILER = re.compile(
    r"(?i)all rights reserved|terms of (use|service)|privacy policy|cookie policy|use of cookies|enable javascript|"
    r"lorem ipsum|^ *(this work is )?(licensed|released) under |^ *(copyright|©|\(c\)) "
)


def words(text):
    return WORD.findall(text or "")


def repeated_words(text):
    w = words(text)
    spots = {}
    for i in range(len(w) - 2):
        spots.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len({i + k for at in spots.values() if len(at) > 1 for i in at for k in range(3)})


def line_fails(line):
    n = len(words(line))
    return n > 0 and (
        100 * len(re.findall(r"[#*$%&|<>]", line)) > 30 * n
        or 100 * len(re.findall(r"[!?]{2,}", line)) > 20 * n
        or 100 * len(re.findall(r"(?:^|[\x20\x09-\x0D])[|›»•·]", line)) > 20 * n
        or (n <= 25 and bool(BOILER.search(line)))
    )


def judge(text):
    """(kept, cleaned text)"""
    text = text or ""
    n = len(words(text))
    clean = "\n".join(x for x in text.split("\n") if not line_fails(x))
    base_failed = n < 50 or 100 * repeated_words(text) > 50 * n
    return not base_failed and 100 * (n - len(words(clean))) <= 30 * n, clean


def groups(n, linked):
    """Smallest member reachable, over all pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i + 1, n):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(features, seed):
    if not features:
        return 0
    hashes = [xxhash.xxh64_intdigest(f.encode(), seed) for f in features]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def shingle_hash(text, width=4):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return simhash([" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else [], 42)


def edits(a, b):
    row = np.arange(len(b) + 1)
    codes = np.array([ord(c) for c in b])
    steps = np.arange(len(b) + 1)
    for i, c in enumerate(a, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))
        row = np.minimum.accumulate(np.concatenate([[i], best]) - steps) + steps
    return int(row[-1])


def near(a, b, radius):
    return bin(a ^ b).count("1") <= radius


def normal(line):
    return re.findall(r"\w+", re.sub(r"\d+", "0", line.lower().replace("_", " ")))


def row_key(doc_id, text):
    """Signed xxHash64 of id and text, chained as Spark chains columns."""
    first = xxhash.xxh64_intdigest(("" if doc_id is None else str(doc_id)).encode(), 42)
    return int(np.uint64(xxhash.xxh64_intdigest((text or "").encode(), first)).astype(np.int64))


def dedup_lines(docs, radius=64, similarity=0.8):
    """[(doc_id, text)] -> cleaned texts in the same order."""
    forms, seen = {}, []
    for doc_id, text in docs:
        key = row_key(doc_id, text)
        for number, line in enumerate((text or "").split("\n")):
            if w := normal(line):
                form = " ".join(w)
                forms.setdefault(form, simhash(w, 0))
                seen.append(((doc_id is None, doc_id or 0, key, number), form))
    names = list(forms)
    fps = np.array([forms[f] for f in names], np.uint64)
    signs = np.array([np.bincount([ord(c) & 63 for c in f], minlength=64) for f in names]).reshape(-1, 64)
    length = signs.sum(1)
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(names)):
        close = np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= radius
        # as many edits at least as signs that only one of both has
        more = signs[i + 1 :] - signs[i]
        least = np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1))
        close &= least <= (1 - similarity) * np.maximum(length[i + 1 :], length[i]) + 1e-9
        for j in np.flatnonzero(close) + i + 1:
            a, b = names[i], names[j]
            if edits(a, b) <= int((1 - similarity) * max(len(a), len(b)) + 1e-9):
                x, y = find(i), find(int(j))
                root[max(x, y)] = min(x, y)
    at, first = {f: i for i, f in enumerate(names)}, {}
    for place, form in seen:
        g = find(at[form])
        first[g] = min(first.get(g, place), place)
    stay = {place[2:] for place in first.values()}
    out = []
    for doc_id, text in docs:
        key = row_key(doc_id, text)
        kept = [x for n, x in enumerate((text or "").split("\n")) if (key, n) in stay or not normal(x)]
        out.append(None if text is None else "\n".join(kept))
    return out


def near_groups(texts, radius=4):
    fps = [shingle_hash(t) for t in texts]
    return fps, groups(len(fps), lambda i, j: near(fps[i], fps[j], radius))


def jaccard_groups(texts, width=5, least=0.8):
    """Groups of texts by the Jaccard similarity of their shingle sets; texts without words are one group."""
    sets = []
    for t in texts:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append(frozenset(" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset())
    like = lambda a, b: a == b or bool(a and b) and len(a & b) >= least * len(a | b)
    return groups(len(sets), lambda i, j: like(sets[i], sets[j]))


def mix_times(docs, weights=(5, 2, 1), percent=150, repeats=2, seed=17):
    """[(doc_id, text, source)] -> (targets by source, copies taken per document)."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    names = sorted({s for *_, s in docs if s is not None}) + ([None] if any(s is None for *_, s in docs) else [])
    size = [len(words(t)) for _, t, _ in docs]
    total = {n: sum(z for z, d in zip(size, docs) if d[2] == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    budget, target = sum(size) * percent / 100, dict.fromkeys(names, 0.0)
    free = set(names)
    while free:
        left = budget - sum(target[n] for n in names if n not in free)
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] >= repeats * total[n]}
        target |= {n: float(repeats * total[n]) for n in over} if over else share
        free -= over or free
    queue = []
    for rank, n in enumerate(names):
        mine = sorted((md5(f"{seed}|{'' if d is None else d}|{md5(t or '')}"), i)
                      for i, (d, t, s) in enumerate(docs) if s == n and size[i])
        for turn in range(repeats):
            upto = turn * total[n]
            for key, i in mine:
                upto += size[i]
                queue.append((upto / weight[n], rank, turn, key, i))
    times, served = [0] * len(docs), 0
    for *_, i in sorted(queue):
        served += size[i]
        if served > budget:
            break
        times[i] += 1
    return target, times
