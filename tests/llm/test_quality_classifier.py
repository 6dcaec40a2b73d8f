import random
import re

import numpy as np
import pyarrow as pa

from jobtide.llm import quality_classifier as quality
from jobtide.llm.queries import op3_quality_classifier

TABLES = "/root/testdata/sf0.01"


def test_held_out_rows_are_told_apart(spark):
    scored = op3_quality_classifier(spark, TABLES).join(spark.read.parquet(f"{TABLES}/labels.parquet"), "doc_id")
    rows = scored.where("held_out").select("quality", "predicted", "score").collect()
    assert len(rows) > 100 and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.97


def test_score_is_the_difference_of_normal_log_densities():
    random.seed(1)
    rng, size = np.random.default_rng(1), len(quality.FEATURES)
    covariances = [np.cov(rng.normal(size=(50, size)).T) + np.eye(size) for _ in range(2)]
    means = rng.normal(size=(2, size))
    factors = np.stack([np.linalg.inv(np.linalg.cholesky(c)) for c in covariances])
    model = quality.Discriminant(0.3, means, factors, np.array([np.linalg.slogdet(c)[1] for c in covariances]))
    x = rng.normal(size=(20, size))
    logs = [-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1] for m, c in zip(means, covariances, strict=True)]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-(logs[1] - logs[0] + 0.3))))


def plain_statistics(text):
    """The statistics by their names, one text at a time."""
    data = (text or "").encode()
    words = re.findall(rb"[^ \t\n\x0b\x0c\r]+", data)
    chars = sum(len(w.decode()) for w in words)
    count, sizes = len(words), [len(w) for w in words]
    letters, capitals = re.findall(rb"[A-Za-z]", data), re.findall(rb"[A-Z]", data)
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    loud = [w for w in words if 2 * len(re.findall(rb"[A-Z]", w)) > max(len(w), 3)]

    def share(part, whole):
        odds = (part + 0.1) / (whole + 10.0)
        return np.log(odds / (1.001 - min(odds, 1.0)))

    def of(signs):
        return share(sum(data.count(bytes([c])) for c in signs), chars)

    return [
        np.log1p(count), np.log1p(np.mean(sizes) if sizes else 0), np.log1p(np.std(sizes) if sizes else 0),
        of(b"#*$%&<>@^~=_{}[]\\+"), of(b"!?"), of(b"|"), of(b"0123456789"), share(len(capitals), len(letters)), share(len(loud), count),
        np.log((len(set(words)) + 1) / (count + 1) ** 0.9), share(len(windows) - len(set(windows)), len(windows)), share(len(lines) - len(set(lines)), len(lines)),
        np.log1p(chars / max(len(lines), 1)), share(max(map(words.count, words), default=0), count), share(sum(line[-1:] in b".!?:;\"')" for line in lines), len(lines)),
    ]


def test_statistics_are_those_of_plain_counts(spark):
    random.seed(3)
    parts = ["a ", "Bc ", "ABC ", "\n", "x.\n", "!", "9", "é ", " the the the ", "#$", "|", "\t", "end.\n", "q"]
    texts = ["".join(random.choices(parts, k=random.choice([1, 4, 30, 90]))) for _ in range(120)] + [None, "", " ", "\n"]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()]
    found = quality.statistics(pa.array(texts, pa.string()))
    for text, row in zip(texts, found, strict=True):
        assert np.allclose(row, plain_statistics(text), atol=1e-6), (text, dict(zip(quality.FEATURES, row - plain_statistics(text), strict=True)))


def test_statistics_do_not_depend_on_neighbours():
    random.seed(2)
    texts = ["".join(random.choices(["a", "B ", "\n", "!", "9", "é", " the ", "x y z\n"], k=random.choice([0, 1, 3, 40]))) for _ in range(60)] + [None, "", "\n", "\n\n"]
    together = quality.statistics(pa.array(texts, pa.string()))
    alone = np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()


def test_odd_rows_and_missing_classes(spark, documents):
    docs = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x"), (4, "word " * 50_000)]
    measured = quality.measure(documents(docs, clashing=True), ["doc_id"])
    labelled = measured.selectExpr("features", "cast(null as int) AS label")
    for label, low, high in (("null", 0.5, 0.5), ("1", 0.5, 1), ("0", 0, 0.5)):
        model = quality.fit(labelled.selectExpr("features", f"cast({label} as int) AS label"))
        scores = [r["score"] for r in quality.score(measured, model).collect()]
        assert len(scores) == 6 and all(low <= s <= high for s in scores)
    assert quality.score(measured.where("false"), model).count() == 0
