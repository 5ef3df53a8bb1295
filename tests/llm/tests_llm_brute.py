"""Brute-force versions that several tests share."""

from __future__ import annotations

import re


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near_least(rows, size=5, percent=80):
    sets = {}
    for doc, text in rows.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
        sets[doc] = {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d for d in ids if find(d) == d}


def contaminated(text, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    own = " " + " ".join(re.findall(pattern, fold(text))) + " "
    for item in items:
        words = re.findall(pattern, fold(item))
        size = min(10, len(words))
        for i in range(len(words) - size + 1):
            if size and " " + " ".join(words[i : i + size]) + " " in own:
                return True
    return False
