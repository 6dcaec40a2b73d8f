"""Toxicity score: a weighted lexicon, matched by Aho-Corasick after folding look-alikes, normalised by length.

Texts are lower-cased; letters of other scripts that look like Latin ones, and digits and signs that stand for letters
inside a word, become those letters. The lexicon holds beginnings of words, each with the log odds of toxic documents,
and phrases and words that are exceptions; the longest entry at a place counts, so an exception hides what it begins
with. The sum of weights and the matches for each thousand words make the score.

Weights are learnt from a bounded sample of labelled rows, of which one of each group of copies counts; Spark counts
the entries.
"""

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import chunks, packed, quoted, row_type
from jobtide.llm.minhash import shingles
from jobtide.sinks.scratch import stored

#: Labelled rows that a lexicon is learnt from at most, those with the least hash of their id.
TRAINING_ROWS = 20_000
#: Toxic documents that must have an entry.
SUPPORT = 6
#: Least log odds of an entry, by so many standard errors; a word that is clean at these log odds is an exception to a
#: shorter entry.
ODDS, ERRORS, CLEAN_ODDS = 0.7, 2.5, -0.3
#: An entry goes where a longer one has this share of its toxic documents.
SAME = 0.9
SHORTEST, LONGEST = 3, 9
#: Documents of the sample that share one of so many least shingles count once.
COPY_HASHES = 3

#: Letters of other scripts, and the Latin letters they look like.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ո": "n",
    "в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ɡ": "g", "ɩ": "i", "ı": "i", "ⅼ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w", "η": "n",
}
#: Signs that stand for letters inside a word; 1 stands for i or l.
SIGNS = {"0": "o", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
#: Phrases that are no insults although they hold a word that can be one.
EXCEPTIONS = ["trash can", "trash bin", "trash bag", "trash collection", "clown fish", "clownfish", "class clown", "sore loser", "pond scum", "soap scum", "idiot proof"]

_GAP = "  "
_TABLE = {ord(k): v for k, v in LOOK_ALIKES.items()} | {i: _GAP for i in range(128) if not chr(i).isalnum()} | {0xA0: _GAP, 0x200B: "", 0x200C: "", 0x200D: "", 0xAD: "", 0xFEFF: ""}
_SIGN = re.compile(r"[0-9@$](?=[^\W\d_])|(?<=[^\W\d_])[0-9@$](?=[^\W_])")


def fold(text: str) -> list[str]:
    """The folded text, each gap between words as two spaces; two readings where a 1 stands in a word."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()
    readings = [text]
    if _SIGN.search(text):
        readings = [_SIGN.sub(lambda m, one=one: one if m[0] == "1" else SIGNS.get(m[0], m[0]), text) for one in "il"]
        readings = readings[: 1 + (readings[0] != readings[1])]
    return [_GAP + r.translate(_TABLE) + _GAP for r in readings]


def _entries(word: str) -> set[str]:
    """Beginnings of a word, and the whole word with the gap after it."""
    return {" " + word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1)} | {" " + word + " "}


@dataclass
class Lexicon:
    """Weights of entries (0 for exceptions) and the weights of what a document's matches add up to."""

    weights: dict[str, float]
    bias: np.ndarray = field(default_factory=lambda: np.array([-4.0, 1.0, 1.0, 0.0]))

    def automaton(self) -> ahocorasick.Automaton | None:
        made = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            made.add_word(entry, weight)
        if not self.weights:
            return None
        made.make_automaton()
        return made

    def score(self, found: np.ndarray) -> np.ndarray:
        """Probability that documents with the measures of ``measure`` are toxic."""
        x = np.column_stack([np.ones(len(found)), np.log1p(found[:, :2]), found[:, 2]])
        return 1 / (1 + np.exp(-np.clip(x @ self.bias, -700, 700)))


def measure(texts: list[str | None], automaton) -> np.ndarray:
    """Sum of weights, matches for each thousand words and largest weight of each text; null is empty."""
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        if not text or automaton is None:
            continue
        for reading in fold(text):
            hits = [w for _, w in automaton.iter_long(reading) if w > 0]
            if hits and sum(hits) > out[i, 0]:
                out[i] = sum(hits), 1000 * len(hits) / (len(text.split()) + 20), max(hits)
    return out


def _count(batches):
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            own = set()
            for word in set(fold(text or "")[0].split()):
                own |= _entries(word)
            for entry in own:
                counts.setdefault(entry, [0, 0])[label] += 1
    columns = [pa.array([c[i] for c in counts.values()], pa.int64()) for i in (1, 0)]
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *columns], names=["entry", "toxic", "clean"])


def _candidates(labelled: DataFrame, toxic: int, clean: int) -> DataFrame:
    """Entries with enough support that can get a weight or be an exception: ``entry``, ``toxic``, ``clean``, ``odds``, ``sure``.

    ``labelled`` has ``text`` and a 0/1 ``label``, of which ``toxic`` and ``clean`` rows.
    """
    counted = labelled.mapInArrow(_count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = stored(counted.where(F.col("toxic") >= SUPPORT), "entries")
    # an entry goes where one that is longer by a letter has nearly all its toxic documents
    beginnings = counted.where("entry NOT LIKE '% '").groupBy(F.expr("left(entry, length(entry) - 1)").alias("of")).agg(F.max("toxic").alias("longer"))
    left = counted.join(beginnings, F.col("entry") == F.col("of"), "left").where(F.coalesce("longer", F.lit(0)) < SAME * F.col("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 1.0) / (clean + 1))
    sure = F.col("odds") - ERRORS * F.sqrt(1 / F.col("toxic") + 1 / (F.col("clean") + 1.0))
    left = left.select("entry", "toxic", "clean", odds.alias("odds")).withColumn("sure", sure)
    return left.where((F.col("sure") >= ODDS) | (F.col("entry").endswith(" ") & (F.col("odds") <= CLEAN_ODDS)))


def _measures(batches, lexicon):
    automaton = lexicon.automaton()
    for batch in batches:
        found = measure(batch.column("text").to_pylist(), automaton)
        yield pa.RecordBatch.from_arrays([batch.column("label"), *[pa.array(found[:, i]) for i in range(3)]], names=["label", "weight", "rate", "most"])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), np.log1p(x[:, :2]), x[:, 2]])
    b = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(len(b))
        b = b + np.linalg.solve(hessian, x.T @ (y - p) - 0.05 * b)
    return b


def _least_shingles(column: pa.Array, n: int) -> np.ndarray:
    """``COPY_HASHES`` numbers for each text, any of which a near copy has as well most of the time."""
    text, key, _ = shingles(column, 3)
    out = np.zeros((n, COPY_HASHES), np.int64)
    starts = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    for i in range(COPY_HASHES):
        mixed = (key ^ np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
        if len(starts):
            out[text[starts], i] = np.minimum.reduceat(mixed, starts).view(np.int64)
    return out


def _marked(batches):
    for batch in batches:
        least = _least_shingles(batch.column("text"), batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(least[:, i]) for i in range(COPY_HASHES)]], names=[*batch.schema.names, *[f"m{i}" for i in range(COPY_HASHES)]])


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic", text: str = "text", rows: int = TRAINING_ROWS) -> DataFrame:
    """``text`` and ``label`` of up to ``rows`` labelled documents, without copies of one another.

    The rows with the least hash of their id are taken; of documents that share a least shingle the one with the least
    id stays. Null labels and texts do not count.
    """
    wanted = labels.where(quoted(label).isNotNull()).select(quoted(doc_id).alias("id"), quoted(label).cast("int").alias("label"))
    wanted = wanted.orderBy(F.xxhash64("id"), "id", "label").limit(rows)
    given = docs.where(quoted(text).isNotNull()).select(quoted(doc_id).alias("id"), quoted(text).cast("string").alias("text"))
    kind = dict(given.dtypes)["id"]
    names = ", ".join(f"m{i} long" for i in range(COPY_HASHES))
    found = given.join(wanted, "id").select("id", "text", "label").mapInArrow(_marked, f"id {kind}, text string, label int, {names}")
    found = stored(found, "labelled")
    left = found.drop("text")
    for i in range(COPY_HASHES):
        left = left.groupBy(f"m{i}").agg(F.min(F.struct("id", *[c for c in left.columns if c != "id"])).alias("row")).select("row.*")
    return stored(found.select("id", "text").join(left.select("id", "label"), "id").select("text", "label"), "sample")


def learn(labelled: DataFrame, exceptions: list[str] = EXCEPTIONS) -> Lexicon:
    """A lexicon from rows with ``text`` and a 0/1 ``label``, of which the caller gives a bounded number.

    Without rows of both labels the lexicon is empty, and every document scores the same.
    """
    known = {r["label"]: r["n"] for r in labelled.where("label IN (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = known.get(1, 0), known.get(0, 0)
    if not toxic or not clean:
        return Lexicon({})
    known_labels = labelled.where("label IN (0, 1)").select("text", F.col("label").cast("int").alias("label"))
    candidates = {r["entry"]: r for r in _candidates(known_labels, toxic, clean).collect()}
    # shorter ones first; a longer one is only of use where its weight differs
    kept: dict[str, float] = {}
    for entry in sorted(candidates, key=lambda e: (len(e), e)):
        outer = next((kept[entry[:n]] for n in range(len(entry) - 1, SHORTEST, -1) if entry[:n] in kept), None)
        weight = candidates[entry]["odds"]
        if candidates[entry]["sure"] >= ODDS and (outer is None or weight > outer + 0.7):
            kept[entry] = weight
        elif outer is not None and entry.endswith(" ") and weight <= CLEAN_ODDS:
            kept[entry] = 0.0
    phrases = {" " + _GAP.join(fold(p)[0].split()): 0.0 for p in exceptions}
    lexicon = Lexicon(kept | phrases)
    found = known_labels.mapInArrow(lambda batches: _measures(batches, lexicon), "label int, weight double, rate double, most double").collect()
    x = np.array([[r["weight"], r["rate"], r["most"]] for r in found])
    lexicon.bias = _logistic(x, np.array([r["label"] for r in found], float))
    return lexicon


def _score(batches, lexicon):
    automaton = lexicon.automaton()
    for batch in (chunk for whole in batches for chunk in chunks(whole)):
        found = measure(batch.column("text").to_pylist(), automaton)
        yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(found[:, i]) for i in range(3)], pa.array(lexicon.score(found))], names=["row", "weight", "rate", "most", "score"])


def score(docs: DataFrame, lexicon: Lexicon, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` as one struct ``row`` (see ``arrow.unpacked``), ``weight``, ``rate``, ``most`` (largest weight) and ``score``.

    Null and empty texts have no matches. Repeated rows score alike; an empty table gives no rows.
    """
    found = packed(docs, text, carried)
    row, _ = row_type(found)
    return found.mapInArrow(lambda batches: _score(batches, lexicon), f"row {row}, weight double, rate double, most double, score double")
