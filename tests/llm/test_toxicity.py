import random

import numpy as np

from jobtide.llm import toxicity
from jobtide.llm.arrow import unpacked
from jobtide.llm.queries import op4_toxicity

TABLES = "/root/testdata/sf0.01"
WORDS = [a + b for a in ("mor", "tal", "ven", "sop", "lin", "gra") for b in ("da", "ne", "ki", "lo", "sta")]


def labelled(table, n=400):
    random.seed(4)
    rows = []
    for i in range(n):
        own = random.choices(WORDS, k=60)
        if i % 5 == 0:
            own[random.randrange(60)] = "blurgh"
            own[random.randrange(60)] = random.choice(["zonkal", "zonkist", "zonkum"])
        rows.append({"text": " ".join(own), "label": int(i % 5 == 0)})
    return table("text string, label int", rows)


def test_folding():
    assert toxicity.fold("You st00pid ѕcum, ｔrash!")[0].split() == ["you", "stoopid", "scum", "trash"]
    assert [r.split() for r in toxicity.fold("1diot c1own")] == [["idiot", "ciown"], ["ldiot", "clown"]]
    assert toxicity.fold("in 1990, 3 of 45")[0].split() == ["in", "1990", "3", "of", "45"]


def test_lexicon_finds_words_beginnings_and_disguises(table, documents):
    lexicon = toxicity.learn(labelled(table))
    found = {e.strip() for e, w in lexicon.weights.items() if w > 0}
    assert "blurgh" in found and any(e.startswith("zonk") for e in found) and not found & set(WORDS)
    clean, texts = " ".join(WORDS), ["b1urgh", "BLURGH!", "blυrgh", "zonkara", "unblurgh"]
    lexicon.weights[" blurgh" + toxicity._GAP + "can"] = 0.0
    texts = [f"{clean} {t}" for t in texts] + [clean, f"{clean} blurgh can", None, ""]
    rows = toxicity.score(documents(texts), lexicon, ["doc_id"]).select(*unpacked(["doc_id"]), "score", "weight").collect()
    weight = {r["doc_id"]: r["weight"] for r in rows}
    assert weight[1] > 0 and weight[3] > 0 and weight[0] > 0
    assert weight[4] == weight[5] == weight[6] == weight[7] == weight[8] == 0
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[1] > 0.7 > 0.3 > score[5] and score[7] == score[8] == score[5]


def test_longer_texts_score_lower(table, documents):
    lexicon = toxicity.learn(labelled(table))
    texts = ["blurgh " + "and so on " * n for n in (3, 3000)]
    rows = toxicity.score(documents(texts), lexicon, ["doc_id"]).select(*unpacked(["doc_id"]), "rate").collect()
    rate = {r["doc_id"]: r["rate"] for r in rows}
    assert rate[0] > 50 * rate[1] > 0


def test_held_out_rows_are_told_apart(spark):
    scored = op4_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    rows = scored.where("held_out").select("toxic", "predicted").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert np.mean(toxic) > 0.85 and np.mean([r["predicted"] for r in rows if not r["toxic"]]) < 0.01


def test_copies_count_once(table):
    rows = [{"doc_id": i, "text": " ".join(WORDS) + f" tail{i}"} for i in range(20)] + [{"doc_id": 50, "text": "other words here"}, {"doc_id": 51, "text": None}]
    docs = table("doc_id long, text string", rows, clashing=True)
    labels = table("doc_id long, toxic int", [{"doc_id": r["doc_id"], "toxic": 1} for r in rows] + [{"doc_id": 50, "toxic": None}])
    assert toxicity.sample(docs, labels).count() < 8
    assert toxicity.sample(docs, labels, rows=0).count() == 0


def test_odd_rows(documents, table):
    lexicon = toxicity.learn(labelled(table).where("label = 0"))
    given = documents([(1, None), (2, ""), (2, ""), (None, "x " * 100_000)], clashing=True)
    scores = [r["score"] for r in toxicity.score(given, lexicon, ["doc_id"]).collect()]
    assert len(scores) == 4 and len(set(scores)) == 1
    assert toxicity.score(given.where("false"), lexicon, ["doc_id"]).count() == 0


def test_rare_toxic_words_are_found_beside_very_many_frequent_ones(table):
    # 3,000 words in all documents have 21,000 entries, all more frequent than the toxic word
    common = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}oqrstuv" for i in range(3000))
    rows = [{"text": common + (" blurgh" if i < 8 else ""), "label": int(i < 20)} for i in range(200)]
    assert toxicity.learn(table("text string, label int", rows)).weights.get(" blurgh", 0) > 0
