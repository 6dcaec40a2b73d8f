import random

import numpy as np
import pyarrow as pa
from brute import near_classes, shingles, similarity

from jobtide.llm import minhash
from jobtide.sinks.scratch import Steps

WORDS = [f"w{i}" for i in range(300)]


def varied(text, changes):
    out = list(text)
    for _ in range(changes):
        out[random.randrange(len(out))] = random.choice(WORDS)
    return out


def families(n, members, size, most):
    out = []
    for _ in range(n):
        text = random.choices(WORDS, k=size)
        out += [" ".join(varied(text, random.randint(0, most))) for _ in range(members)]
    random.shuffle(out)
    return out


def test_similarity_is_that_of_the_definition():
    random.seed(1)
    a = [" ".join(random.choices("abcd", k=random.choice([0, 2, 5, 20]))) for _ in range(80)]
    b = [" ".join(varied(t.split(), 1)) if t and random.random() < 0.7 else t + " " + t for t in a]
    batch = pa.RecordBatch.from_arrays([pa.array(range(80)), pa.array(range(80)), pa.array(a), pa.array(b)], names=["a", "b", "text_a", "text_b"])
    for out in minhash._verify([batch], 0.8, 5):
        for row, left, right in zip(out.to_pylist(), a, b, strict=True):
            wanted = similarity(shingles(left), shingles(right))
            assert np.allclose((row["weighted"], row["plain"]), wanted)


def test_signatures_agree_as_often_as_texts_are_similar():
    random.seed(2)
    text = random.choices(WORDS, k=300)
    texts = [" ".join(text), " ".join(varied(text, 8)), " ".join(text[:50] * 4), " ".join(text[:50]), "x y", "", None]
    owner, key, counts = minhash.shingles(pa.array(texts))
    found = minhash.signatures(owner, key, minhash.weights(counts), len(texts), 4096)
    for i, j in ((0, 1), (2, 3)):
        assert abs((found[i] == found[j]).mean() - similarity(shingles(texts[i]), shingles(texts[j]))[0]) < 0.04
    assert found[4].all() and not found[5].any() and not found[6].any()


def test_classes_match_brute_force_whatever_the_blocks(documents):
    random.seed(3)
    # some members are far from the hub, so that buckets hold several classes
    texts = families(4, 14, 60, 3) + families(10, 1, 30, 0) + ["a b", "A, b", "c", "!!", "!!"]
    docs = list(enumerate(texts))
    wanted = near_classes(docs)
    for block in (4, 512):
        found = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(docs), block=block, likely=0.5).collect()}
        assert found == wanted


def test_blocks_find_links_that_hubs_miss(documents):
    random.seed(4)
    # a chain: each text is like the next, few like the first
    text, docs = random.choices(WORDS, k=120), []
    for i in range(25):
        docs.append((i, " ".join(text)))
        text = varied(text, 2)
    random.shuffle(docs)
    found = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(docs), block=3).collect()}
    assert found == near_classes(docs)


def test_odd_rows(documents):
    long = " ".join(f"v{i}" for i in range(30_000))
    docs = [(5, None), (6, None), (7, ""), (8, ""), (9, "?!"), (10, "?!"), (2, long), (3, long + " end"), (11, "one two"), (11, "three four"), (12, "three four"), (None, "n u l l"), (None, "z z")]
    given = documents(docs, clashing=True)
    found = sorted(((r["doc_id"], r["class_id"]) for r in minhash.classes(given).collect()), key=str)
    assert found == sorted([(5, 5), (6, 6), (7, 7), (8, 8), (9, 9), (10, 9), (2, 2), (3, 2), (11, 11), (11, 11), (12, 11), (None, None), (None, None)], key=str)
    kept = minhash.keep(given)
    assert kept.columns == given.columns
    assert sorted(((r["doc_id"], r["text"][:6] if r["text"] else r["text"]) for r in kept.collect()), key=str) == sorted(
        [(5, None), (6, None), (7, ""), (8, ""), (9, "?!"), (2, "v0 v1 "), (11, "one tw"), (None, "n u l ")], key=str
    )
    assert minhash.keep(given.where("false")).count() == 0


def test_set_similarity_counts_where_texts_repeat_lines(documents):
    random.seed(6)
    docs = []
    for i in range(60):
        words = [f"s{i}x{j}" for j in range(130)]
        for side in range(2):
            # 126 shingles in common, and a line of its own that is repeated
            docs.append((2 * i + side, " ".join(words + [f"r{i}x{side}x{j}" for j in range(11)] * 20)))
    weighted, plain = similarity(shingles(docs[0][1]), shingles(docs[1][1]))
    assert weighted < 0.6 and plain >= 0.8
    found = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(docs)).collect()}
    assert found == {i: i - i % 2 for i, _ in docs}
    links = set()
    for band in range(minhash.BANDS):
        block = pa.table({"node": [i for i, _ in docs], "class": [i for i, _ in docs], "side": [0] * len(docs), "band": [band] * len(docs), "text": [t for _, t in docs]})
        own = minhash._block_links(block, minhash.BANDS, minhash.ROWS, minhash.THRESHOLD, minhash.SHINGLE, minhash.LIKELY).to_pylist()
        assert not links & {(r["a"], r["b"]) for r in own}
        links |= {(r["a"], r["b"]) for r in own}
    assert links == {(i, i + 1) for i in range(0, len(docs), 2)}


def test_unlike_texts_of_one_id_or_none_all_stay(documents):
    random.seed(7)
    long = random.choices(WORDS, k=80)
    near = " ".join(long[:-1])
    docs = [(11, "one two"), (11, "three four"), (12, "three four"), (12, "three four"), (1, " ".join(long)), (None, near), (None, "n u l l"), (None, "z z"), (None, "z z"), (20, near), (20, "own"), (5, None), (5, ""), (None, None)]
    given = documents(docs, clashing=True)
    kept = minhash.keep_texts(given)
    assert kept.columns == given.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect() if r["text"]), key=str) == sorted(
        [(11, "one two"), (11, "three four"), (1, " ".join(long)), (None, "n u l l"), (None, "z z"), (20, "own")], key=str
    )
    assert sorted((r["doc_id"] for r in kept.collect() if not r["text"]), key=str) == [5, None]
    assert minhash.keep_texts(given.where("false")).count() == 0


def test_components_are_named_by_their_least_node(spark):
    random.seed(9)
    chains = [(i, i + 1) for i in range(100, 160)] + [(3 * i, 3 * i + 3) for i in range(300, 340)]
    star = [(5000, i) for i in range(5001, 5200)]
    wild = [(random.randrange(6000, 6300), random.randrange(6000, 6300)) for _ in range(250)]
    pairs = [p for p in chains + star + wild + wild[:20] for p in (p, p[::-1])][: 2 * 560]
    random.shuffle(pairs)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    with Steps(spark) as steps:
        found = minhash.components(spark.createDataFrame(pairs, "a long, b long"), steps)
        assert {r["node"]: r["class"] for r in found.collect()} == {x: find(x) for x in parent}
        assert minhash.components(spark.createDataFrame([], "a long, b long"), steps).count() == 0
