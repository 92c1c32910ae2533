"""Plain versions that operators are held against."""

from __future__ import annotations

import re

import numpy as np

from rivulet.llm import probminhash

np.seterr(over="ignore")

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def brute_classes(texts):
    sets = {i: probminhash.shingles(t) for i, t in texts.items()}
    ids = sorted(texts)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            w = [None if len(s) and c.max() == 1 else c for s, c in (sets[i], sets[j])]
            if texts[i] == texts[j] or probminhash.similarity(sets[i][0], w[0], sets[j][0], w[1]) >= 0.8 - 1e-12:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}
