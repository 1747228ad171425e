"""Plain Python versions of the corpus operators, for comparison."""

from __future__ import annotations

import html
import re
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def targets(sizes: dict, weights=(5, 2, 1), times=3) -> dict:
    """Targets by repeated sharing of what is above a limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, fixed, left = set(order), {}, Fraction(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > times * sizes[s]}
        if not over:
            break
        for s in over:
            fixed[s] = Fraction(times * sizes[s])
            left -= fixed[s]
        open_ -= over
    return fixed | {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def shingles(text: str | None, size: int) -> frozenset:
    found = words(lower(text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def groups(texts: dict[int, str | None], size: int, percent: int = 80) -> dict[int, int]:
    """The least linked id of each document, over all pairs."""
    sets = {k: shingles(t, size) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in ids}


def repeat_words(tokens: list[str], size: int = 5) -> int:
    windows = [tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)]
    seen: dict = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    covered = set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered.update(range(i, i + size))
    return len(covered)


def luhn(number: str) -> bool:
    digits = [int(c) for c in number if c.isdigit()]
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += sum(divmod(2 * d, 10)) if i % 2 else d
    return total % 10 == 0


def article(page: str) -> str:
    """The main text of the given tables' pages."""
    inner = re.search(r"(?s)<article>(.*?)(?:</article>|$)", page)
    body = re.sub("</?(?:p|h1)>", "\0", inner[1] if inner else "").replace("<br>", " ")
    body = re.sub("<[^>]*(?:>|$)", "", body)
    blocks = (" ".join(html.unescape(block).split()) for block in body.split("\0"))
    return "\n\n".join(block for block in blocks if block)
