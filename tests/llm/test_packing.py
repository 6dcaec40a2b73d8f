import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from jobtide.llm import packing
from jobtide.llm.arrow import unpacked

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_library():
    random.seed(5)
    parts = [" ", "  ", "\n", "\t", " ", "　", " ", "\x85", "\x1c", "a", "the", " of", "'s", "'t", "é", "中", "123", "!!", "<|endoftext|>", "​", "\r\n", "x" * 500]
    texts = ["".join(random.choices(parts, k=random.choice([0, 1, 2, 5, 30, 200]))) for _ in range(800)] + [None, ""]
    ids, edges = packing.Tokenizer(PATH).encode(pa.array(texts, pa.string()))
    some = library()
    for text, a, b in zip(texts, edges[:-1], edges[1:], strict=True):
        assert ids[a:b].tolist() == some.encode(text or "", add_special_tokens=False).ids + [0]
    assert 50256 in ids


def test_strings_of_added_tokens_can_be_plain_text():
    ids, _ = packing.Tokenizer(PATH, plain=True).encode(pa.array(["hi <|endoftext|> there"]))
    some = library()
    some.encode_special_tokens = True
    assert ids.tolist() == some.encode("hi <|endoftext|> there", add_special_tokens=False).ids + [0] and 50256 not in ids


def check(docs, pieces, length):
    made, by_sequence, by_doc = library(), {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append(p)
    for parts in by_sequence.values():
        place = 0
        for offset, n in sorted(parts):
            assert offset == place
            place += n
        assert place <= length
    for number, text in docs:
        ids = made.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted(by_doc[number], key=lambda p: p["start"]):
            raw = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert (p["start"], p["doc_tokens"], p["ids_crc32"], p["ids"]) == (at, len(ids), zlib.crc32(raw), raw)
            at += p["length"]
        assert at == len(ids)
    return sum(n for parts in by_sequence.values() for _, n in parts) / (length * len(by_sequence))


def test_every_id_is_in_one_piece_and_padding_is_little(documents):
    random.seed(6)
    docs = [(i, " ".join(random.choices(["alpha", "beta", "gamma"], k=random.randint(0, 400)))) for i in range(300)]
    pieces = packing.pack(documents(docs).repartition(7), PATH, ["doc_id"], length=128, open_windows=8)
    filled = check(docs, pieces.select(*unpacked(["doc_id"]), *[c for c in pieces.columns if c != "row"]).collect(), 128)
    assert filled > 0.95


def test_open_windows_are_bounded():
    windows, done = packing._Windows(0, 100, 4), []
    for n in (60, 61, 62, 63, 64, 30):
        windows.put({"length": n}, done)
    # the fullest of four went out when none had room for 64, and 30 fits beside 64
    assert [p["length"] for p in done] == [63] and sorted(u for u, _ in windows.used) == [60, 61, 62, 94]


def test_odd_rows(documents):
    docs = [(1, None), (2, ""), (3, "a b c"), (None, "x"), (4, "word " * 30_000)]
    given = documents(docs, clashing=True)
    pieces = packing.pack(given, PATH, ["doc_id", "row", "open"])
    rows = pieces.select(*unpacked(["doc_id", "row", "open"]), *[c for c in pieces.columns if c != "row"]).collect()
    check(docs, rows, 1024)
    repeated = packing.pack(documents([(1, "a b"), (1, "a b")]), PATH, ["doc_id"], keep_ids=False)
    assert [r["length"] for r in repeated.collect()] == [3, 3]
    assert packing.pack(given.where("false"), PATH, ["doc_id"]).count() == 0
