"""Plain restatements of what the operators compute, for small tables."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text: str | None, n: int) -> set[tuple[str, ...]]:
    found = words(lowered(text))
    if len(found) < n:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + n]) for k in range(len(found) - n + 1)}


def components(docs: dict[int, str | None], n: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    """(set size, smallest id that links reach) of each id."""
    sets = {i: shingles(t, n) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and den * both >= num * (len(sets[a]) + len(sets[b]) - both) and both:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def without_repeats(docs: dict[int, str | None], window: int) -> dict[int, list[str]]:
    """The words each document keeps."""
    first: dict[tuple[str, ...], int] = {}
    told = {i: words(t) for i, t in docs.items()}
    for i in sorted(told):
        for k in range(len(told[i]) - window + 1):
            first.setdefault(tuple(told[i][k : k + window]), i)
    kept = {}
    for i, w in told.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept[i] = [x for k, x in enumerate(w) if k not in gone]
    return kept


def rule_counts(text: str | None) -> dict[str, int]:
    found = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(found[k : k + 8]) for k in range(len(found) - 7)]
    twice = {w for w in windows if windows.count(w) > 1}
    inside = {k + j for k, w in enumerate(windows) if w in twice for j in range(8)}
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(x in lines[:k] for k, x in enumerate(lines)),
        "n_repeat_words": len(inside),
    }
