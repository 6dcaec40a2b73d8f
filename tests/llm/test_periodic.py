import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from jobtide.llm import periodic
from jobtide.llm.arrow import unpacked
from jobtide.llm.queries import op12_periodic_runs

SF = "/root/testdata/sf0.001"


def smallest_period(words):
    """By the longest border."""
    border = [0] * len(words)
    for i in range(1, len(words)):
        k = border[i - 1]
        while k and words[i] != words[k]:
            k = border[k - 1]
        border[i] = k + (words[i] == words[k])
    return len(words) - border[-1]


def brute(words, least=12):
    """Every stretch with a period that no word extends, if that is its smallest period."""
    words = np.array(words, dtype=object)
    out = []
    for period in range(1, len(words) // 2 + 1):
        same = np.concatenate([[False], words[period:] == words[:-period], [False]]).astype(int)
        edges = np.diff(same)
        for start, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            length = int(end - start) + period
            if length >= max(least, 2 * period) and smallest_period(words[start : start + length].tolist()) == period:
                out.append((int(start), length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    random.seed(7)
    out = []
    for _ in range(300):
        n, kinds = random.choice([0, 1, 3, 11, 12, 30, 90, 200]), random.choice([1, 2, 3, 8, 100])
        words = [random.choice("abcdefghij") * random.randint(1, 1 + kinds // 3) for _ in range(kinds)]
        made = random.choices(words, k=n)
        for _ in range(random.randint(0, 3)):
            at, q, times = random.randint(0, len(made)), random.randint(1, 25), random.randint(2, 6)
            made[at:at] = (random.choices(words, k=q) * times)[: q * times - random.randint(0, q - 1)]
        out.append(made)
    one, two = ["a"], ["a", "b"]
    while len(two) < 300:
        one, two = two, two + one
    thue = [["x", "y"][bin(i).count("1") % 2] for i in range(256)]
    return [*out, two, thue, thue + thue, ["w"] * 500, ["p", "q"] * 40 + ["r"] + ["p", "q"] * 40 + ["r"], ["w"] * 12, ["w"] * 11, list("abcdef") * 2]


def test_runs_are_those_of_brute_force():
    given = texts()
    names = {w: i for i, w in enumerate(sorted({w for t in given for w in t}))}
    flat = np.array([names[w] for t in given for w in t], np.int64)
    firsts = np.concatenate([[0], np.cumsum([len(t) for t in given])])
    for least in (12, 4):
        first, end, period = periodic.runs(flat, firsts, least)
        text = np.searchsorted(firsts, first, "right") - 1
        got = [[] for _ in given]
        for t, s, e, q in zip(text, first - firsts[text], end - first, period, strict=True):
            got[t].append((int(s), int(e), int(q)))
        for found, words in zip(got, given, strict=True):
            assert found == brute(words, least), words


def test_the_grammar_gives_back_the_texts():
    random.seed(8)
    words = np.array(random.choices(range(4), k=2000))
    firsts = np.array([0, 500, 500, 1203, 1204, 2000])
    nodes, names, stands = periodic.grammar(words, firsts)
    size = nodes[2] - nodes[0]
    for name, at in zip(names, stands, strict=True):
        assert (words[at : at + size[name]] == words[nodes[0][name] : nodes[2][name]]).all()
        assert np.searchsorted(firsts, at, "right") == np.searchsorted(firsts, at + size[name], "left")
    # a nonterminal is made where a pair stands twice, so there are fewer than words
    assert len(np.unique(names)) == nodes.shape[1] < len(words)
    # each text of several words is held by one node
    held = {(int(s), int(e)) for s, e in zip(nodes[0], nodes[2], strict=True)}
    assert {(0, 500), (500, 1203), (1204, 2000)} <= held


def test_a_wrong_hash_is_noticed(monkeypatch):
    words, equal = np.array([0, 1, 2, 0, 1, 3] * 8 + list(range(4, 40))), periodic._Extents.equal
    seeds = []

    def made(self, words, seed, init=periodic._Extents.__init__):
        seeds.append(seed)
        init(self, words, seed)

    monkeypatch.setattr(periodic._Extents, "__init__", made)
    monkeypatch.setattr(periodic._Extents, "equal", lambda self, *a: equal(self, *a) | (len(seeds) < 3))
    assert periodic.runs(words, np.array([0, len(words)])).T.tolist() == [[0, 48, 6]]
    assert seeds == [1, 2, 3]


def test_long_texts(documents):
    words = [f"w{i % 1700}" if i > 40_000 else f"v{i}" for i in range(60_000)]
    got = periodic.find(documents([" ".join(words)]), ["doc_id"]).first()
    start = next(i for i in range(40_001, 60_000))
    assert [tuple(r) for r in got["runs"]] == [(start, 60_000 - start, 1700)]
    assert got["text"] == " ".join(words[: start + 1700])


def test_odd_rows(documents):
    given = documents([(1, None), (2, ""), (3, " \n "), (None, "a " * 20), (4, "é\x0bé\té " * 5), (4, "é\x0bé\té " * 5), (5, "a b")], clashing=True)
    found = periodic.find(given, ["doc_id", "row", "text_a"])
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["text"]) for r in found.select(*unpacked(["doc_id"]), "n_words", "runs", "text").collect())
    assert got == [(0, 20, [(0, 20, 1)], "a"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 15, [(0, 15, 1)], "é"), (4, 15, [(0, 15, 1)], "é"), (5, 2, [], "a b")]
    assert periodic.find(given.where("false"), ["doc_id"]).count() == 0


@pytest.fixture
def expected(spark):
    out = {}
    for row in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (row["text"] or "").encode())
        words, n = [w.decode() for w in words], len(words)
        h = zlib.crc32(str(row["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        most = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        digests = ["".join(f"{s},{n},{q}\n" for s, n, q in found), collapsed(words, found)]
        out[row["doc_id"]] = (len(found), *most, 1000 * most[1] // most[2] if found else None, *[hashlib.sha256(d.encode()).hexdigest() for d in digests])
    return out


def test_the_query_against_brute_force(spark, expected):
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_periodic_runs(spark, SF).collect()}
    assert got == expected and sum(r[0] > 0 for r in got.values()) > 20
