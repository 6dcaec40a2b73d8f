import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from jobtide.llm import alignment
from jobtide.llm.arrow import unpacked

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [b for b in range(256) if b not in PLAIN]
SYMBOLS = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(OTHERS)}


def bytes_of_a(library, i):
    return bytes(SYMBOLS[c] for c in library.id_to_token(i))


def bytes_of_b(library, i):
    piece = library.IdToPiece(i)
    return bytes([int(piece[3:5], 16)]) if library.IsByte(i) else piece.replace("▁", " ").encode()


def brute(texts, libraries):
    """The measures of each text, from the whole texts' tokens one by one."""
    first, second = libraries
    all_groups, all_overlaps = [], []
    for text in texts:
        found, overlaps = [], 0
        wanted = (" " + text).encode() if text else b""
        ids = [first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)] if text else [[], []]
        spelled = [[bytes_of_a(first, i) for i in ids[0]], [bytes_of_b(second, i) for i in ids[1]]]
        if text and all(b"".join(s) == wanted for s in spelled):
            spans = [[(int(e) - len(t), int(e)) for t, e in zip(s, np.cumsum([len(t) for t in s]), strict=True)] for s in spelled]
            ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
            begin = 0
            for end in ends:
                found.append(tuple([i for i, (x, y) in zip(ids[k], spans[k], strict=True) if begin <= x and y <= end] for k in (0, 1)))
                begin = end
            overlaps = sum(x < v and u < y for x, y in spans[0] for u, v in spans[1])
        all_groups.append(found)
        all_overlaps.append(overlaps)
    held = collections.Counter(p for found in all_groups for p in {(a, b) for x, y in found for a in x for b in y})
    most = collections.defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    rows = []
    for found, overlaps in zip(all_groups, all_overlaps, strict=True):
        links = [(a, b) for x, y in found for a in x for b in y]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        rows.append((
            sum(len(x) for x, _ in found), sum(len(y) for _, y in found), len(found), overlaps, len(links),
            sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(written.encode()).hexdigest() if found else "",
        ))
    return rows, held, most


def test_products_are_those_of_dense_matrices():
    random.seed(3)
    for _ in range(50):
        x, y, z = (random.randint(0, 6) for _ in range(3))
        left, right = (np.random.default_rng(x + 7 * y).integers(0, 3, size) for size in ((x, y), (y, z)))
        sparse = []
        for dense in (left, right):
            row, column = np.nonzero(dense)
            sparse.append(alignment.Csr.counted(np.repeat(row, dense[row, column]), np.repeat(column, dense[row, column]), *dense.shape))
        for terms in (1, 4, 1000):
            out = sparse[0].times(sparse[1], terms)
            dense = np.zeros((x, z), int)
            dense[out.rows, out.columns] = out.values
            assert (dense == left @ right).all() and (out.values > 0).all()
        back = sparse[0].transposed()
        dense = np.zeros((y, x), int)
        dense[back.rows, back.columns] = back.values
        assert (dense == left.T).all()


PARTS = [" ", "  ", "   ", "\n", "\t", "　", " ", "\x85", "\x1c", "a", "the", "thereof", "Tionheit", "'s", "é", "中文字", "👍🏽", "123456", "!!", "<|endoftext|>", "</s>", "<0x0A>", "​", "\r\n", "straße", "ﬁ", "é", "\x00"]


def test_measures_are_those_of_whole_texts(documents, libraries, rows, spark):
    random.seed(4)
    texts = ["".join(random.choices(PARTS, k=random.choice([1, 2, 5, 30, 120]))) for _ in range(250)]
    texts += [None, "", " ", "   ", "\n", "a ▁ b", "▁", "plain words and ▁▁ more", "x" * 900, "the " * 3000, texts[3], texts[3]]
    expected, held, most = brute(texts, libraries)
    found = alignment.align(documents(texts, clashing=True).repartition(5), A, B, ["doc_id", "row"], keep_groups=True)
    got = {r["doc_id"]: r for r in found.select(*unpacked(["doc_id"]), "groups", *COLUMNS).collect()}
    assert len(got) == len(texts) and sum(r["n_a"] == 0 for r in got.values()) == 5
    for i, row in enumerate(expected):
        assert tuple(got[i][c] for c in COLUMNS) == row, texts[i]
        assert (hashlib.sha256(got[i]["groups"].encode()).hexdigest() if got[i]["groups"] else "") == row[-1]
    pairs = alignment.id_pairs(documents(texts), A, B)
    assert {(r["a"], r["b"]): (r["documents"], r["best"]) for r in pairs.collect()} == {p: (n, n == most[p[0]]) for p, n in held.items()}


def test_odd_tables(documents):
    assert alignment.align(documents(["a"]).where("false"), A, B, ["doc_id"]).count() == 0
    none = alignment.align(documents([None, "", None]), A, B, ["doc_id"]).collect()
    assert [(r["n_a"], r["n_links"], r["count_sum"], r["groups_sha256"]) for r in none] == [(0, 0, 0, "")] * 3
    several = alignment.align(documents([(1, "a b"), (1, "a b"), (None, "a")]), A, B, ["doc_id"]).collect()
    assert sorted(r["count_sum"] for r in several) == [3, 5, 5]
