"""Plain versions of the operators for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


UNSPACED = (
    "\u0e00-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u302f\u3031-\u303c\u3040-\u309f\u30a1-\u30fa\u30fc-\u312f"
    "\u3190-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)


def words(text):
    """Runs of letters and digits; characters of scripts written without spaces stand alone."""
    return re.findall(rf"[{UNSPACED}]|(?:(?![{UNSPACED}])[^\W_])+", (text or "").lower())


def shingles(text, width=5):
    w = words(text)
    return Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else Counter({("", text or ""): 1})


def classes(texts, threshold=0.8):
    """Smallest index of the component of each text under weighted Jaccard similarity of its shingles."""
    sets, holders, root = [shingles(t) for t in texts], defaultdict(list), list(range(len(texts)))
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        if sum((sets[a] & sets[b]).values()) >= threshold * sum((sets[a] | sets[b]).values()):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(texts))]
