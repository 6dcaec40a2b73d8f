"""Quality rules by tokeniser fertility.

A public vocabulary shows whether a text is made of what it was made for: characters per token, the share of tokens
that spell out single bytes, and the entropy of the tokens (in bits per token, over what so many tokens can have at
most). A document outside a band of one of these is rejected. Bands are fitted to the documents themselves: for each
script, language and size (a power of two of tokens, as the measures of few tokens vary more), the median and
``SPREADS`` times the spread on each side of it, from quartiles that Spark adds up over all documents which pass the
base rules. So what a vocabulary made for prose takes more tokens for than it does for the same language's prose, such
as menus or texts strewn with symbols, goes. A group of less than ``LEAST`` documents has no fitted band. Wide outer
bands by script hold for all. Base rules count repeated windows, repeated lines and symbols inside the row.

Words are encoded once for each few MB of text. The vocabulary's pieces never cross white space, so this gives the
tokens of the text but for those of the white space itself.
"""

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import binary_array, chunks, packed, ranges, row_type, runs, sums, text_bytes, unpacked
from jobtide.sinks.scratch import stored

MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20

#: Band of each measure by script: characters per token, share of byte tokens, share of the possible entropy. A script
#: of many small characters takes more tokens for a character, and one that the vocabulary lacks is spelt in bytes.
BANDS = {
    "latin": ((1.2, 9.0), (0.0, 0.10), (0.40, 1.0)),
    "cyrillic": ((1.0, 8.0), (0.0, 0.30), (0.45, 1.0)),
    "greek": ((0.6, 8.0), (0.0, 0.60), (0.40, 1.0)),
    "cjk": ((0.25, 4.0), (0.0, 0.95), (0.35, 1.0)),
    "other": ((0.25, 9.0), (0.0, 1.0), (0.35, 1.0)),
}
_SCRIPTS = list(BANDS)
#: Width of a fitted band in spreads (a normal distribution's standard deviation, from its quartiles), the documents it
#: takes to fit one, and the least spread of each measure.
SPREADS, LEAST = 4.0, 100
FLOORS = {"chars_per_token": 0.01, "byte_share": 0.01, "entropy": 0.005}
_PER_QUARTILE = 1.4826

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Bytes of words ``[^\\x20\\x09-\\x0D]+``.
NOT_SPACE = ~_SPACE
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: What a lead byte adds to Latin, Cyrillic, Greek, CJK and other letters (UTF-8 blocks begin at fixed lead bytes).
_SCRIPT = np.full(256, -1, np.int8)
_SCRIPT[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 0
_SCRIPT[range(0xD0, 0xD4)] = 1
_SCRIPT[[0xCE, 0xCF]] = 2
_SCRIPT[[*range(0xE3, 0xEE), 0xF0]] = 3
_SCRIPT[[*range(0xD4, 0xE2)]] = 4

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MEASURES = list(FLOORS)


def _repeated_words(codes: np.ndarray, firsts: np.ndarray, window: int) -> np.ndarray:
    """Words of each document that lie in a window of words which it has twice or more."""
    counts = np.diff(firsts)
    windows = np.maximum(counts - window + 1, 0)
    doc, at = np.repeat(np.arange(len(counts)), windows), ranges(firsts[:-1], windows)
    if not len(at):
        return np.zeros(len(counts), np.int64)
    key = doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for step in range(window):
        key = (key ^ codes[at + step].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    pairs = np.flatnonzero(same)
    a, b = order[pairs], order[pairs + 1]
    really = doc[a] == doc[b]
    for step in range(window):
        really &= codes[at[a] + step] == codes[at[b] + step]
    hit = np.zeros(len(codes) + window, np.int64)
    twice = np.unique(np.concatenate([a[really], b[really]]))
    np.add.at(hit, at[twice], 1)
    np.subtract.at(hit, at[twice] + window, 1)
    return sums(np.cumsum(hit)[: len(codes)] > 0, firsts)


def _repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines of each document that have a word and equal an earlier line of it."""
    breaks = data == 10
    count = sums(breaks, offsets) + 1
    # a line ends at a break or at the document's end; at the same place the end of the document before comes first
    ends = np.concatenate([offsets[1:], np.flatnonzero(breaks)])
    order = np.argsort(ends, kind="stable")
    if not len(ends):
        return np.zeros(0, np.int64)
    ends, is_break = ends[order], order >= len(count)
    doc = np.repeat(np.arange(len(count)), count)
    places = np.concatenate([[0], ends - (np.cumsum(is_break) - is_break)])
    lines = binary_array(data[~breaks], places).dictionary_encode()
    full = sums(~_SPACE[data], np.concatenate([[0], ends])) > 0
    key = (doc[full] << 32) | lines.indices.to_numpy()[full]
    distinct = np.unique(key) >> 32
    return np.bincount(doc[full], minlength=len(count)) - np.bincount(distinct, minlength=len(count))


class _Vocabulary:
    """A sentencepiece model in a task, loaded from its file at first use."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.IsByte(i) or self.model.IsUnknown(i) for i in range(self.model.GetPieceSize())])

    def encode(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all values on end, and how many each has."""
        ids = self.model.encode(values, num_threads=1)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


def _measure(column: pa.Array, vocabulary: _Vocabulary) -> dict[str, np.ndarray]:
    data, offsets = text_bytes(column)
    inside, n = ~_SPACE[data], len(offsets) - 1
    found, firsts = runs(inside, offsets, data)
    encoded = found.dictionary_encode()
    codes = encoded.indices.to_numpy().astype(np.int64)
    out = {
        "n_words": np.diff(firsts),
        "word_chars": sums(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": sums(_SYMBOL[data], offsets),
        "n_dup_lines": _repeated_lines(data, offsets),
        "n_repeat_words": _repeated_words(codes, firsts, REPEAT_WINDOW),
    }
    ids, counts = vocabulary.encode(encoded.dictionary.cast(pa.large_string()).to_pylist())
    begins = np.cumsum(counts) - counts
    per_word = counts[codes]
    tokens = ids[ranges(begins[codes], per_word)]
    total = sums(per_word, firsts)
    edges = np.concatenate([[0], np.cumsum(total)])
    out["n_tokens"] = total
    out["byte_share"] = sums(vocabulary.is_byte[tokens], edges) / np.maximum(total, 1)
    out["chars_per_token"] = out["word_chars"] / np.maximum(total, 1)
    doc = np.repeat(np.arange(n), total)
    key, times = np.unique((doc << 32) | tokens, return_counts=True)
    weighted = np.bincount(key >> 32, weights=times * np.log2(times), minlength=n)
    most = np.log2(np.clip(np.minimum(total, len(vocabulary.is_byte)), 2, None))
    bits = np.log2(np.maximum(total, 1)) - weighted / np.maximum(total, 1)
    out["entropy"] = np.where(total > 1, bits / most, 1.0)
    scripts = _SCRIPT[data]
    votes = np.stack([sums(scripts == s, offsets) for s in range(len(_SCRIPTS))])
    out["script"] = np.where(votes.max(axis=0) > 0, votes.argmax(axis=0), len(_SCRIPTS) - 1)
    return out


def _apply(batches, path, bands, keep_text):
    vocabulary = None
    limits = np.array([bands[s] for s in _SCRIPTS])
    for batch in batches:
        for chunk in chunks(batch):
            vocabulary = vocabulary or _Vocabulary(path)
            out = _measure(chunk.column("text"), vocabulary)
            failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
            inside = np.ones(len(failed), bool)
            for i, name in enumerate(_MEASURES):
                low, high = limits[out["script"], i].T
                inside &= (out[name] >= low) & (out[name] <= high)
            columns = [chunk.column("row"), *[pa.array(out[c].astype(np.int64)) for c in [*_COUNTS, "n_tokens"]], *[pa.array(out[c].astype(float)) for c in _MEASURES]]
            columns += [pa.array([_SCRIPTS[i] for i in out["script"]], pa.string()), pa.array(failed), pa.array(inside)]
            names = ["row", *_COUNTS, "n_tokens", *_MEASURES, "script", "base_failed", "inside"]
            if keep_text:
                columns, names = [*columns, chunk.column("text")], [*names, "text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


_GROUP = ["script", "language", "size"]


def fit(measured: DataFrame, spreads: float = SPREADS, least: int = LEAST) -> DataFrame:
    """The bands of each group of measured documents: ``script``, ``language``, ``size``, and for each measure its
    ``_low`` and ``_high``. One row a group; what is added up are quantile summaries."""
    quartiles = [F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(m) for m in _MEASURES]
    found = measured.where("NOT base_failed AND inside").groupBy(*_GROUP).agg(F.count("*").alias("n"), *quartiles).where(F.col("n") >= least)
    edges = []
    for m in _MEASURES:
        low, middle, high = (F.col(m)[i] for i in range(3))
        below, above = (F.greatest(_PER_QUARTILE * spread, F.lit(FLOORS[m])) * spreads for spread in (middle - low, high - middle))
        edges += [(middle - below).alias(f"{m}_low"), (middle + above).alias(f"{m}_high")]
    return found.select(*_GROUP, *edges)


def judge(
    docs: DataFrame,
    model: str,
    carried: list[str],
    text: str = "text",
    language: str | None = None,
    bands: dict = BANDS,
    spreads: float = SPREADS,
    least: int = LEAST,
    keep_text: bool = False,
) -> DataFrame:
    """Counts, measures and verdict for each row of ``docs``; ``model`` is the path of a sentencepiece model.

    Columns: ``carried`` as one struct ``row`` (see ``arrow.unpacked``); ``n_words`` (runs without white space),
    ``word_chars`` (their code points), ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_tokens``;
    ``chars_per_token``, ``byte_share``, ``entropy`` and ``script``; ``base_failed``, ``kept`` and ``reason`` (what
    rejects it first: ``base``, ``outer band`` or a measure). ``language`` names one of the carried columns; without it
    bands are by script and size only. Null and empty texts have no words, so the base rules reject them. A text
    without letters belongs to the script ``other``. Repeated rows are judged alike, and count each in the bands.
    Measures are stored, as they are read twice; texts are not.
    """
    found = packed(docs, text, carried)
    row, _ = row_type(found)
    out = f"row {row}, " + ", ".join([f"{c} long" for c in [*_COUNTS, "n_tokens"]] + [f"{c} double" for c in _MEASURES]) + ", script string, base_failed boolean, inside boolean"
    named = F.lit("") if language is None else F.coalesce(F.col(f"row.c{carried.index(language)}").cast("string"), F.lit(""))
    size = F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")

    def measured(with_text: bool) -> DataFrame:
        made = found.mapInArrow(lambda batches: _apply(batches, model, bands, with_text), out + (", text string" if with_text else ""))
        return made.withColumns({"language": named, "size": size})

    narrow = stored(measured(False), "measured")
    fitted = stored(fit(narrow, spreads, least), "bands")
    # with their texts, documents are measured again: that takes less than storing and reading them
    judged = (measured(True) if keep_text else narrow).join(fitted, _GROUP, "left")
    reason = F.when(F.col("base_failed"), "base").when(~F.col("inside"), "outer band")
    for m in _MEASURES:
        reason = reason.when((F.col(m) < F.col(f"{m}_low")) | (F.col(m) > F.col(f"{m}_high")), m)
    judged = judged.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull())
    return judged.select("row", *_COUNTS, "n_tokens", *_MEASURES, "script", "base_failed", "kept", "reason", *(["text"] if keep_text else []))


def keep(docs: DataFrame, model: str, text: str = "text", language: str | None = "lang", **options) -> DataFrame:
    """``docs`` without the rows that the rules reject; columns as they were. ``language`` may be missing."""
    others = [c for c in docs.columns if c != text]
    language = language if language in others else None
    found = judge(docs, model, others, text, language, keep_text=True, **options).where("kept")
    columns = dict(zip(others, unpacked(others), strict=True)) | {text: F.col("text").alias(text)}
    return found.select(*[columns[c] for c in docs.columns])
