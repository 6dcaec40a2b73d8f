import random

import public_tokenizers
from brute import base_counts

from jobtide.llm import quality_rules
from jobtide.llm.arrow import unpacked

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [a + b + c for a in "bdgkmp" for b in "aeiou" for c in ("nd", "rt", "l", "st", "ver", "ing")]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_match_brute_force(documents):
    random.seed(3)
    parts = ["a", "b ", "b", "\n", "\n", "\u2003", "é", "##", "\t", "c c c c c c c c\n", "a b\n", "x", " "]
    texts = ["".join(random.choices(parts, k=random.choice([0, 1, 5, 30, 60]))) for _ in range(150)] + [None, ""]
    judged = quality_rules.judge(documents(texts), MODEL, ["doc_id"])
    for row in judged.select(*unpacked(["doc_id"]), *COUNTS, "base_failed", "kept").collect():
        wanted = base_counts(texts[row["doc_id"]])
        assert tuple(row[c] for c in COUNTS) == wanted
        assert row["base_failed"] == (wanted[0] < 10 or 100 * wanted[4] > 20 * wanted[0])
        assert not (row["base_failed"] and row["kept"])


def test_measures_are_those_of_the_vocabulary(documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "A plain sentence whose tokens are counted one by one, unlike \u0f40\u0f41 letters."
    row = quality_rules.judge(documents([text]), MODEL, ["doc_id"]).first()
    ids = model.encode(text)
    chars = sum(map(len, text.split()))
    assert abs(row["chars_per_token"] - chars / len(ids)) < 1e-9
    assert abs(row["byte_share"] - sum(model.IsByte(i) for i in ids) / len(ids)) < 1e-9


def test_scripts_and_bands(documents):
    texts = {
        "latin": "The river runs slowly past the old mill and the children watch it from the bridge every morning.",
        "cyrillic": "Река медленно течет мимо старой мельницы, и дети каждое утро смотрят на нее с моста.",
        "greek": "Το ποτάμι κυλά αργά δίπλα στον παλιό μύλο και τα παιδιά το κοιτάζουν κάθε πρωί από τη γέφυρα.",
        "cjk": "河 水 缓 缓 流 过 旧 磨 坊 孩 子 们 每 天 早 上 从 桥 上 看 着 它",
    }
    judged = quality_rules.judge(documents(list(texts.values())), MODEL, ["doc_id"])
    assert [(r["script"], r["kept"]) for r in sorted(judged.collect(), key=lambda r: r["row"]["c0"])] == [(s, True) for s in texts]
    narrow = dict(quality_rules.BANDS, latin=((9.0, 10.0), (0.0, 1.0), (0.0, 1.0)))
    assert not quality_rules.judge(documents([texts["latin"]]), MODEL, ["doc_id"], bands=narrow).first()["kept"]
    spelt = " ".join("\u2fa0\u2fa1\u2fa2" for _ in range(3)) + " with some plain words of the usual kind after them here"
    assert not quality_rules.judge(documents([spelt]), MODEL, ["doc_id"]).first()["kept"]


def test_bands_are_fitted_to_the_documents(table):
    """Symbols behind every word, and menus, are rejected where their language's prose shows what is usual."""
    random.seed(11)
    rows = []
    for i in range(900):
        n, lang = random.choice([40, 90, 200]), random.choice(["one", "two"])
        words = [random.choice(LETTERS) + random.choice(LETTERS if lang == "two" else ["", "s"]) for _ in range(n)]
        kind = "plain" if i % 15 else ("symbols", "menu")[i % 2]
        mark = {"plain": " ", "symbols": "$$$ ", "menu": " | "}[kind]
        rows.append({"doc_id": i, "lang": None if i % 7 == 0 else lang, "text": mark.join(words), "kind": kind})
    docs = table("doc_id long, lang string, text string", rows)
    judged = quality_rules.judge(docs, MODEL, ["doc_id", "lang"], language="lang", least=60)
    found = judged.select(*unpacked(["doc_id", "lang"]), *[c for c in judged.columns if c != "row"]).collect()

    # the same from sorted values
    groups = {}
    for r in found:
        if not r["base_failed"]:
            groups.setdefault((r["lang"], r["n_tokens"].bit_length()), []).append(r)
    gone = {"plain": 0, "symbols": 0, "menu": 0}
    for r in found:
        expected = "base" if r["base_failed"] else None
        group = groups.get((r["lang"], r["n_tokens"].bit_length()), [])
        if not expected and len(group) >= 60:
            for m, floor in quality_rules.FLOORS.items():
                values = sorted(g[m] for g in group)
                low, middle, high = (values[-(-len(values) * q // 4) - 1] for q in (1, 2, 3))
                below, above = (4.0 * max(1.4826 * x, floor) for x in (middle - low, high - middle))
                if not middle - below <= r[m] <= middle + above:
                    expected = expected or m
        assert (r["reason"], r["kept"]) == (expected, expected is None)
        gone[rows[r["doc_id"]]["kind"]] += expected is not None
    assert gone["plain"] <= 8 and gone["symbols"] + gone["menu"] >= 30


def test_bands_decide_on_the_given_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    judged = quality_rules.judge(docs, MODEL, ["doc_id", "lang"], language="lang", least=50)
    judged = judged.select(*unpacked(["doc_id"]), "kept", "base_failed").join(labels, "doc_id").where("NOT base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    # of documents that pass the base rules, junk goes and the others stay
    assert counts[0, False] > 5 and counts.get((1, False), 0) <= 0.02 * counts[1, True]


def test_odd_rows(documents):
    plain = "These ten words or more are enough to be kept by every rule there is."
    docs = [(1, None), (2, ""), (3, plain), (3, plain), (None, plain), (4, " ".join(a + b for a in LETTERS for b in LETTERS))]
    given = documents(docs, clashing=True)
    kept = quality_rules.keep(given, MODEL)
    assert kept.columns == given.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["3", "3", "4", "None"]
    assert quality_rules.keep(given.where("false"), MODEL).count() == 0
