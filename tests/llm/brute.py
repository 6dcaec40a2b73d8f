"""Plain Python versions of the operators, for small inputs."""

import math
import re
from collections import Counter

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, window=13):
    """Words, words hit and test texts of a document."""
    own, hit, names = words(text), set(), set()
    for name, item in items:
        theirs = words(item)
        size = min(window, len(theirs))
        for start in range(len(theirs) - size + 1 if size else 0):
            for place in range(len(own) - size + 1):
                if own[place : place + size] == theirs[start : start + size]:
                    hit |= set(range(place, place + size))
                    names.add(str(name))
    return len(own), len(hit), sorted(names)


def repeats(docs, length):
    """Which bytes of each (id, text) go."""
    out = []
    for number, text in docs:
        own = (text or "").encode()
        gone, earlier = np.zeros(len(own), bool), set()
        for other, there in docs:
            if other < number:
                there = (there or "").encode()
                earlier |= {there[i : i + length] for i in range(len(there) - length + 1)}
        for i in range(len(own) - length + 1):
            if own[i : i + length] in earlier:
                gone[i : i + length] = True
        out.append(gone)
    return out


def shingles(text, size=5):
    own = words(text)
    if not own:
        return {}
    return Counter(tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1)))


def similarity(a, b):
    """Probability Jaccard of damped counts, and set Jaccard."""
    x, y = ({k: 1 + math.log(v) for k, v in side.items()} for side in (a, b))
    every = x.keys() | y.keys()
    weighted = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in x.keys() & y.keys())
    return weighted, len(x.keys() & y.keys()) / max(1, len(every))


def near_classes(docs, threshold=0.8):
    """Least id of each document's class."""
    parent = {i: i for i, _ in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    made = {i: shingles(t) for i, t in docs}
    for n, (i, text) in enumerate(docs):
        for j, other in docs[:n]:
            same = bool(text) and text == other
            if same or made[i] and made[j] and max(similarity(made[i], made[j])) >= threshold:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in docs}


def base_counts(text):
    """Words, their code points, symbols, repeated lines and words in repeated windows."""
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    hit, seen, again = set(), set(), 0
    for i in range(len(own) - 4):
        if windows[tuple(own[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)
