import heapq
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from jobtide.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def cost_without_limit(counts):
    """Bits of a Huffman code, by merging the two lightest."""
    heap, total = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def least_cost(counts, limit):
    """Bits of the best code of at most so many bits, by trying all lengths that fit (Kraft's sum is 1)."""
    ordered, best = sorted(counts, reverse=True), None

    def go(i, space, total, shortest):
        nonlocal best
        if i == len(ordered):
            best = total if best is None else min(best, total)
            return
        for bits in range(shortest, limit + 1):
            if space >= 2 ** (limit - bits) * (len(ordered) - i if bits == limit else 1):
                go(i + 1, space - 2 ** (limit - bits), total + bits * ordered[i], bits)

    go(0, 2**limit, 0, 1)
    return best


def test_lengths_are_least_under_the_limit():
    random.seed(1)
    for _ in range(60):
        counts = np.array([int(2 ** random.uniform(0, 12)) for _ in range(random.randint(2, 7))])
        lengths = token_files.code_lengths(counts, 3 if len(counts) < 9 else 4).astype(int)
        assert lengths.max() <= 3 and sum(2.0**-lengths) <= 1
        assert (lengths * counts).sum() == least_cost(counts.tolist(), 3)
        free = token_files.code_lengths(counts, 18).astype(int)
        assert (free * counts).sum() == cost_without_limit(counts)
    skewed = np.array([2**i for i in range(40)] + [0])
    lengths = token_files.code_lengths(skewed, 10)
    assert lengths.max() == 10 and lengths[40] == 0


def test_codes_are_prefix_free_and_rise():
    lengths = token_files.code_lengths(np.array([5, 0, 1, 1, 9, 30, 2]))
    found = [f"{c:0{n}b}" for c, n in zip(token_files.codes(lengths), lengths, strict=True) if n]
    assert not any(a != b and b.startswith(a) for a in found for b in found)
    assert sorted(found, key=lambda c: (len(c), c)) == [c for _, c in sorted(zip([n for n in lengths if n], found, strict=True), key=lambda x: x[0])]


LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def check(spark, docs, given, path, **options):
    token_files.write(given, path, PATH, **options)
    found = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in docs), key=lambda i: (i is not None, i))
    at, texts = 0, {}
    for number, text in docs:
        texts.setdefault(number, []).append(ids_of(text))
    for row in found:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        texts[row["doc_id"]].remove(ids)
        raw = np.array(ids, "<u4").tobytes()
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(raw))
        at += len(ids)
    return found


def test_files_give_back_every_id_in_order(spark, documents, tmp_path):
    random.seed(2)
    words = ["alpha", "beta", "gamma", "\n", "<|endoftext|>", "é中", "9" * 30]
    docs = [(random.randint(-500, 500), " ".join(random.choices(words, k=random.randint(0, 300)))) for _ in range(400)]
    found = check(spark, docs, documents(docs).repartition(5), str(tmp_path / "files"), block=16, file_ids=5000)
    assert spark.read.format("binaryFile").load(str(tmp_path / "files")).count() > 5
    # a span of each document, from the blocks that hold it
    spans = token_files.read(spark, str(tmp_path / "files"), first=40, most=20).collect()
    whole = sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4")[40:60].tolist()) for r in found)
    assert sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in spans) == whole


def test_odd_rows(spark, documents, tmp_path):
    docs = [(3, None), (2, ""), (None, "x y"), (None, None), (1, "word " * 40_000), (2, "a b"), (2, "a b"), (-(2**62), "\x00\n")]
    check(spark, docs, documents(docs, clashing=True), str(tmp_path / "odd"))
    token_files.write(documents(docs).where("false"), str(tmp_path / "none"), PATH)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0
