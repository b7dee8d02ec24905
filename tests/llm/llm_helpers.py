"""What several tests of the training-data operators use."""

from __future__ import annotations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = [w.decode() for w in (text or "").translate(LOWER).encode().split()]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(texts, size, percent):
    """doc_id -> component, by comparing all pairs of a small fixture."""
    sets = {d: shingles(t, size) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}
