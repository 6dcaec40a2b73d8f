import hashlib
import random

from brute import contamination

from jobtide.llm import decontaminate
from jobtide.llm.arrow import unpacked


def search(docs, items, **options):
    found = decontaminate.search(docs, items, ["doc_id"], **options)
    return {r["doc_id"]: r for r in found.select(*unpacked(["doc_id"]), "n_words", "n_hit", "items", "items_sha256", "contaminated", "spans").collect()}


def check(docs, items, found, window):
    for number, text in docs:
        n, hit, names = contamination(text, items, window)
        row = found[number]
        assert (row["n_words"], row["n_hit"], row["items"]) == (n, hit, names), text
        assert row["contaminated"] == (hit > 0 and 20 * hit >= n)
        assert row["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert sum(s["n_words"] for s in row["spans"]) >= hit


def test_matches_brute_force_in_one_block_and_in_several(spark, documents, table):
    random.seed(1)
    items = [(i, " ".join(random.choices("abc", k=random.choice([0, 1, 2, 5, 9])))) for i in range(12)]
    docs = [(i, ", ".join(random.choices(["a", "B", "c", "Zz"], k=random.choice([0, 1, 5, 40])))) for i in range(60)]
    benchmark = table("item_id long, text string", [{"item_id": i, "text": t} for i, t in items])
    for block_bytes in (1 << 20, 20):
        check(docs, items, search(documents(docs), benchmark, window=3, block_bytes=block_bytes), 3)


def test_equal_test_texts_are_dealt_to_blocks_and_searched_once(documents, table):
    same = "one two three four"
    items = [(i, same) for i in range(500)] + [(1000, "five six seven"), (1001, same), (1001, same)]
    benchmark = table("item_id long, text string", [{"item_id": i, "text": t} for i, t in items])
    docs = [(0, f"x {same} y"), (1, "nothing here"), (2, f"five six seven {same}")]
    for block_bytes in (1 << 20, 1000):
        found = search(documents(docs), benchmark, window=3, block_bytes=block_bytes)
        assert found[0]["items"] == sorted(map(str, [*range(500), 1001])) and found[1]["items"] == []
        assert len(found[2]["spans"]) == 502 and found[2]["n_hit"] == 7
    blocks = [b.value for b in decontaminate._blocks(benchmark, "item_id", "text", 3, 1000)]
    assert len(blocks) > 10 and max(len(b.ids) for b in blocks) < 60
    assert all(len(b.n_ids) <= 2 for b in blocks)


def test_longest_match_and_its_place(documents, table):
    text = "one two three four five"
    found = search(documents([f"x {text} six"]), table("item_id string, text string", [{"item_id": "i", "text": f"zero {text}"}]), window=3)
    assert [tuple(s) for s in found[0]["spans"]] == [("i", 1, 1, 5)]


def test_odd_rows(documents, table, spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    docs = [(0, None), (1, ""), (2, "... !"), (3, long), (3, long), (None, "a b"), (4, "Été A b")]
    items = [{"item_id": 1, "text": "a b"}, {"item_id": 1, "text": "a b"}, {"item_id": None, "text": "w1"}, {"item_id": 2, "text": None}, {"item_id": 3, "text": ""}]
    benchmark = table("item_id int, text string", items, clashing=True)
    given = documents(docs, clashing=True)
    found = search(given, benchmark)
    assert [(found[i]["n_words"], found[i]["n_hit"]) for i in (0, 1, 2, 3, 4, None)] == [(0, 0), (0, 0), (0, 0), (40_000, 0), (3, 2), (2, 2)]
    assert found[4]["items"] == ["1"]
    left = decontaminate.remove(given, benchmark)
    assert left.columns == given.columns and left.dtypes == given.dtypes
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 3, 3]
    empty = given.where("false")
    assert decontaminate.remove(empty, benchmark).count() == 0
    assert decontaminate.remove(given, benchmark.where("false")).count() == len(docs)
