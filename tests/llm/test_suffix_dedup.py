import hashlib
import random

import numpy as np
import pyarrow as pa
from brute import repeats

from jobtide.llm import suffix_dedup
from jobtide.llm.arrow import unpacked


def check(docs, length, found):
    rows = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found), key=str)
    wanted = []
    for (number, text), gone in zip(docs, repeats(docs, length), strict=True):
        own = (text or "").encode()
        kept = bytes(b for b, g in zip(own, gone, strict=True) if not g)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        wanted.append((number, len(own), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert rows == sorted(wanted, key=str)


def some(n):
    base = ["".join(random.choices("abé", k=random.randint(0, 40))) for _ in range(6)]
    return [(random.choice([i, i, 3]), random.choice(["".join(random.choices([*base, "x", "yz"], k=random.randint(0, 5))), None, ""] + base)) for i in range(n)]


def test_ranks_sort_suffixes():
    random.seed(2)
    for n in [*range(12), 50, 51, 52]:
        text = np.array(random.choices([1, 2, 3], k=n), np.int64)
        ranks, suffixes = suffix_dedup.suffix_ranks(text, 7), [tuple(text[i:]) for i in range(n)]
        for i in range(n):
            for j in range(n):
                if ranks[i] == ranks[j]:
                    assert suffixes[i][:7] == suffixes[j][:7]
                if ranks[i] < ranks[j]:
                    assert suffixes[i][:7] <= suffixes[j][:7]


def test_matches_brute_force_with_cold_and_hot_anchors(documents):
    random.seed(5)
    for hot in (0, 1000):
        docs = some(40)
        found = suffix_dedup.find(documents(docs).repartition(5), ["doc_id"], length=9, anchor=4, bucket_bytes=200, hot_chunks=hot)
        check(docs, 9, found.select(*unpacked(["doc_id"]), "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_odd_rows(documents):
    passage = "the same fifty bytes and more than that, which two documents have "
    docs = [(2, passage + "é" * 9), (1, "x" + passage), (1, "y" + passage), (3, None), (4, ""), (None, passage), (5, "z" * 100_000), (6, "é" + passage[:-1] + "è")]
    given = documents(docs, clashing=True)
    left = suffix_dedup.remove(given)
    assert left.columns == given.columns
    texts = {(r["doc_id"], r["text"]) for r in left.collect()}
    # of equal ids neither is earlier; a null id is last; characters are not cut
    assert {(1, "x" + passage), (1, "y" + passage), (2, "é" * 9), (3, None), (4, ""), (6, "éè"), (5, "z" * 100_000)} == texts
    assert suffix_dedup.remove(given.where("false")).count() == 0
    repeated = documents([(1, passage), (1, passage)])
    assert suffix_dedup.remove(repeated).count() == 2


def chunk_of(texts, number=0):
    """A chunk as ``_send`` gets it; the ids are the places of the texts."""
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    row = {"chunk": number, "size": len(data), "text": suffix_dedup._squeezed(data), "ids": list(range(len(texts))), "lengths": [len(t.encode()) for t in texts]}
    return data, pa.Table.from_pylist([row])


def told_of(keys, hot):
    buckets = np.unique(keys >> np.uint64(32)).astype(np.int64)
    own = [keys[keys >> np.uint64(32) == b].astype(np.uint32).tobytes() for b in buckets]
    return pa.table({"chunk": pa.array([0] * len(own), pa.int64()), "bucket": pa.array(buckets), "keys": pa.array(own, pa.binary()), "hot": pa.array(own if hot else [b""] * len(own), pa.binary())})


def sent_of(texts, bits, hot):
    mask = np.uint64((1 << (32 + bits)) - 1)
    data, chunk = chunk_of(texts)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    keys = np.unique(suffix_dedup._segments(data, offsets, 50, 20)[3] & mask)
    return suffix_dedup._send(told_of(keys, hot), chunk, mask, 50, 20)


def test_a_chunks_work_does_not_grow_with_the_buckets(monkeypatch):
    random.seed(3)
    texts, calls, distinct = ["".join(random.choices("abcdefgh ", k=3000)) for _ in range(4)], [], suffix_dedup._distinct
    monkeypatch.setattr(suffix_dedup, "_distinct", lambda *given: calls.append(1) or distinct(*given))
    for bits in (1, 7):
        assert len(sent_of(texts, bits, False)) == 1 << bits
    assert len(calls) == 2


def test_an_anchor_is_split_by_its_segments_not_its_chunks():
    chunks = 2000
    keys, times = np.array([7, 9], np.uint32).tobytes(), np.array([1, 400], np.uint16).tobytes()
    table = pa.table({"bucket": pa.array([5] * chunks), "chunk": pa.array(range(chunks)), "keys": [keys] * chunks, "times": [times] * chunks})
    found = suffix_dedup._repeated(table, suffix_dedup.HOT_CHUNKS * 64)
    assert found.column("keys").to_pylist() == [keys] * chunks
    # an anchor that a chunk has once fills no bucket, however many chunks there are
    assert found.column("hot").to_pylist() == [keys[4:]] * chunks


def test_single_windows_need_no_sorting(monkeypatch):
    random.seed(4)
    shared = "a passage that is in each text "
    sent = sent_of(["".join(random.choices("abcdefgh", k=40)) + shared + "".join(random.choices("abcdefgh", k=40)) for _ in range(30)], 0, True)
    monkeypatch.setattr(suffix_dedup, "least_documents", lambda *given: 1 / 0)
    found = suffix_dedup._resolve(sent, 50, 20)
    assert len(found) == 1 and found.column("n").to_pylist() == sent.column("n").to_pylist()
