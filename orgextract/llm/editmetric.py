"""Levenshtein distance (a true metric) and a BK-tree over it."""

from __future__ import annotations


def peq(pattern: str) -> dict[str, int]:
    """Bit masks of a pattern's characters, reusable over many texts."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def levenshtein(pattern: str, text: str, masks: dict[str, int] | None = None) -> int:
    """Myers' bit-parallel algorithm: one column of the matrix per character, held in an integer."""
    m = len(pattern)
    if not m:
        return len(text)
    masks = peq(pattern) if masks is None else masks
    full, last = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    get = masks.get
    for ch in text:
        eq = get(ch, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | (full & ~(d0 | vp))
        hn = d0 & vp
        if hp & last:
            score += 1
        elif hn & last:
            score -= 1
        hp = (hp << 1) | 1
        vp = ((hn << 1) | (full & ~(d0 | hp))) & full
        vn = hp & d0 & full
    return score


def within(a: str, b: str, k: int) -> bool:
    """Banded check that levenshtein(a, b) <= k: only the 2k+1 diagonals around the main one are filled."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > k or k == 0:
        return False
    big = k + 1
    prev = {j: j for j in range(0, min(lb, k) + 1)}
    for i in range(1, la + 1):
        lo, hi = max(0, i - k), min(lb, i + k)
        cur, best = {}, big
        for j in range(lo, hi + 1):
            if j == 0:
                v = i
            else:
                v = min(
                    prev.get(j - 1, big) + (a[i - 1] != b[j - 1]),
                    prev.get(j, big) + 1,
                    cur.get(j - 1, big) + 1,
                )
            cur[j] = v
            best = min(best, v)
        if best > k:
            return False
        prev = cur
    return prev.get(lb, big) <= k


class BKTree:
    """Children are filed under their distance to the node; a subtree at distance d can hold a
    match within k only if |d - distance(query, node)| <= k (triangle inequality)."""

    def __init__(self, items: dict[str, list]):
        self.values: dict[str, list] = {}
        self.root: list | None = None
        for text, value in items.items():
            self.add(text, value)

    def add(self, text: str, value: list) -> None:
        if text in self.values:
            self.values[text].extend(value)
            return
        self.values[text] = list(value)
        if self.root is None:
            self.root = [text, {}]
            return
        node, masks = self.root, peq(text)
        while True:
            d = levenshtein(text, node[0], masks)
            nxt = node[1].get(d)
            if nxt is None:
                node[1][d] = [text, {}]
                return
            node = nxt

    def query(self, text: str, k: int) -> list[tuple[int, str]]:
        """Every stored text within k of the query, with its distance, nearest first."""
        if self.root is None:
            return []
        found, stack, masks = [], [self.root], peq(text)
        while stack:
            node = stack.pop()
            d = levenshtein(text, node[0], masks)
            if d <= k:
                found.append((d, node[0]))
            for at, child in node[1].items():
                if d - k <= at <= d + k:
                    stack.append(child)
        return sorted(found)
