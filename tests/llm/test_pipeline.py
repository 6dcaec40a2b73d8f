import random

import public_tokenizers
from brute import base_counts, contamination, near_classes, repeats
from tokenizers import Tokenizer

import corpus_pipeline

WORDS = [a + b for a in ("mor", "tal", "ven", "sop", "lin", "gra", "dus", "fer") for b in ("da", "ne", "ki", "lo", "sta", "wen")]


def sentence(n):
    return " ".join(random.choices(WORDS, k=n))


def corpus():
    random.seed(8)
    item, passage = sentence(15), sentence(60)
    texts = [sentence(random.randint(40, 90)) for _ in range(12)]
    texts += [texts[0], texts[1] + " more", "too short", None, "", "same words here now " * 12]
    texts += [sentence(20) + " " + passage + " " + sentence(20) for _ in range(3)] + [passage]
    texts += [sentence(10) + " " + item + " " + sentence(10), sentence(300) + " " + item, item.upper()]
    return list(enumerate(texts)), [(7, item)]


def expected(docs, items):
    kept = [(i, t) for i, t in docs if (c := base_counts(t))[0] >= 10 and 100 * c[4] <= 20 * c[0]]
    first = near_classes(kept)
    kept = [(i, t) for i, t in kept if first[i] == i]
    left = []
    for (i, t), gone in zip(kept, repeats(kept, 50), strict=True):
        text = bytes(b for b, g in zip(t.encode(), gone, strict=True) if not g).decode()
        if text or not gone.any():
            left.append((i, text))
    out = []
    for i, t in left:
        n, hit, _ = contamination(t, items)
        if not (hit and 20 * hit >= n):
            out.append((i, t))
    return out


def test_stages_are_those_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]


def test_the_pipeline_does_what_its_stages_do_in_brute_force(spark, tmp_path):
    docs, items = corpus()
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    library, made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}
    for piece in corpus_pipeline.run(spark, str(tmp_path)).collect():
        made.setdefault(piece["doc_id"], []).append((piece["start"], piece["ids"]))
    found = {}
    for number, pieces in made.items():
        raw = b"".join(ids for _, ids in sorted(pieces))
        ids = [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]
        assert ids[-1] == 0
        found[number] = library.decode(ids[:-1])
    wanted = expected(docs, items)
    assert len(wanted) > 12 and found == dict(wanted)


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, row int, kept boolean, id string"
    rows = [(1, None, None, None, None, 1, True, "a"), (None, "", "en", "s", 0, 2, False, "b"), (2, " ".join(WORDS), "en", "s", 5, 3, None, None), (2, " ".join(WORDS), "en", "s", 5, 3, None, None)]
    for given in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            assert docs.dtypes == given.dtypes
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
        assert [r["doc_id"] for r in pieces.collect()] == ([2] if not given.isEmpty() else [])
