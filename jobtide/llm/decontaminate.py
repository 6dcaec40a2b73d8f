"""Benchmark decontamination with suffix arrays of the training texts.

A task sorts the word suffixes of its documents, a few MB of text at a time (a shard), and binary-searches every
suffix of the test texts in each shard. That gives the longest verbatim matches and their places, and from them the
words hit, the share of a document that is hit and the documents to remove. Documents are never shuffled: the test
texts go to the tasks in blocks of a checked size, which a task takes one after another for each shard. Test texts that
are alike are searched for once in a block.

Words that no test text has cannot be part of a match; they end a suffix like the end of a document does. Suffixes are
sorted to the length of the longest test text, beyond which no match can go.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import chunks, packed, quoted, ranges, row_type, unpacked, words

WINDOW = 13
#: Text bytes of a block of test texts; a block is collected and sent to every task.
BLOCK_BYTES = 16 << 20

_SPAN = "struct<item_id:string,item_word:long,word:long,n_words:long>"
_SPANS = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("word", pa.int64()), ("n_words", pa.int64())]))


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``codes`` that are not 0, sorted by what follows up to the next 0 and by ``depth`` codes at least.

    The first sort key packs as many codes as fit into a word; each round doubles the length compared, and only
    suffixes that are still equal to another take part.
    """
    places = np.flatnonzero(codes)
    if not len(places):
        return places
    zeros = np.append(np.flatnonzero(codes == 0), len(codes))
    left = zeros[np.searchsorted(zeros, places)] - places
    bits = int(codes.max()).bit_length()
    length = max(1, min(62 // bits, depth))
    padded = np.concatenate([codes, np.zeros(length, codes.dtype)]).astype(np.int64)
    key = np.zeros(len(places), np.int64)
    for step in range(length):
        key = (key << bits) | np.where(left > step, padded[places + step], 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(first, len(key)))
    group = np.repeat(first, sizes)
    rank = np.zeros(len(codes) + 1, np.int64)
    rank[places[order]] = group + 1
    while length < depth and (sizes > 1).any():
        unsorted = ranges(first[sizes > 1], sizes[sizes > 1])
        at = order[unsorted]
        after = np.where(left[at] > length, rank[np.minimum(places[at] + length, len(codes))], 0)
        key = group[unsorted] * (len(places) + 1) + after
        by = np.argsort(key, kind="stable")
        order[unsorted], key = at[by], key[by]
        first = unsorted[np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))]
        # a group's places are consecutive, so its first place names it
        new = np.concatenate([[True], key[1:] != key[:-1]])
        sizes = np.diff(np.append(np.flatnonzero(new), len(key)))
        group[unsorted] = np.repeat(first, sizes)
        rank[places[order[unsorted]]] = group[unsorted] + 1
        length *= 2
    return places[order]


class TestTexts:
    """A block of test texts: the words of each distinct one as codes, where it begins, and the ids that have it."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        ids: dict[str, set[str]] = {}
        for i, text in items:
            ids.setdefault(text, set()).add(i)
        self.n_ids = np.array([len(each) for each in ids.values()], np.int64)
        self.ids = np.array([i for each in ids.values() for i in sorted(each)], object)
        found, self.firsts = words(pa.array(list(ids), pa.string()))
        self.vocabulary = pc.unique(found)
        self.codes = self.encode(found)
        lengths = np.diff(self.firsts)
        self.depth = int(lengths.max(initial=0))
        self.item = np.repeat(np.arange(len(ids)), lengths)
        self.left = np.repeat(self.firsts[1:], lengths) - np.arange(len(found))
        self.need = np.minimum(window, np.repeat(lengths, lengths))
        self.starts = np.flatnonzero(self.left >= self.need)

    def encode(self, found: pa.Array) -> np.ndarray:
        """Codes of words, 0 for those in no test text."""
        places = pc.index_in(found, value_set=self.vocabulary)
        return pc.add(pc.fill_null(places, -1), 1).to_numpy(zero_copy_only=False).astype(np.int64)

    def bound(self, codes: np.ndarray, order: np.ndarray, upper: bool) -> np.ndarray:
        """Binary search of all windows at once: how many suffixes come before each (or before what follows it)."""
        low, high = np.zeros(len(self.starts), np.int64), np.full(len(self.starts), len(order), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            start, need = self.starts[open_], self.need[self.starts[open_]]
            sign, at, step = np.zeros(len(open_), np.int64), order[middle], 0
            same = np.arange(len(open_))
            while same.size:
                difference = codes[np.minimum(at[same] + step, len(codes) - 1)] - self.codes[start[same] + step]
                sign[same] = np.sign(difference)
                step += 1
                same = same[(difference == 0) & (need[same] > step)]
            after = (sign < 0) | (upper & (sign == 0))
            low[open_[after]] = middle[after] + 1
            high[open_[~after]] = middle[~after]
        return low

    def matches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest matches of a window or more: place of the first word here and there, and the number of words."""
        order = suffix_array(codes, self.depth)
        if not len(order) or not len(self.starts):
            return (np.zeros(0, np.int64),) * 3
        low = self.bound(codes, order, False)
        counts = self.bound(codes, order, True) - low
        here, there = order[ranges(low, counts)], np.repeat(self.starts, counts)
        # a match that the word before would lengthen is part of a longer one
        inner = self.firsts[self.item[there]] < there
        longer = inner & (here > 0)
        longer[longer] = codes[here[longer] - 1] == self.codes[there[longer] - 1]
        here, there = here[~longer], there[~longer]
        lengths = self.need[there].copy()
        growing = np.flatnonzero(lengths < self.left[there])
        while growing.size:
            same = codes[np.minimum(here[growing] + lengths[growing], len(codes) - 1)] == self.codes[there[growing] + lengths[growing]]
            growing = growing[same]
            lengths[growing] += 1
            growing = growing[lengths[growing] < self.left[there[growing]]]
        return here, there, lengths


def _opened(blocks):
    """The blocks one after another; of several none stays in memory."""
    for block in blocks:
        yield block.value
        if len(blocks) > 1:
            vars(block).pop("_value", None)


def _found(texts: TestTexts, words_found: pa.Array, firsts: np.ndarray) -> list[np.ndarray]:
    """Matches of a block in the documents of a shard: document, word in it, test text's id, word in it, and length."""
    counts = np.diff(firsts)
    # a 0 after each document
    codes = np.zeros(len(words_found) + len(counts), np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    codes[np.arange(len(words_found)) + doc] = texts.encode(words_found)
    begins = firsts[:-1] + np.arange(len(counts))
    here, there, lengths = texts.matches(codes)
    owner = np.searchsorted(begins, here, "right") - 1
    item = texts.item[there]
    times = texts.n_ids[item]
    ids = texts.ids[ranges((np.cumsum(texts.n_ids) - texts.n_ids)[item], times)]
    owner, word, item_word, lengths = (np.repeat(a, times) for a in (owner, here - begins[owner], there - texts.firsts[item], lengths))
    return [owner, word, ids, item_word, lengths]


def _search(batches, blocks):
    for batch in batches:
        for chunk in chunks(batch):
            found, firsts = words(chunk.column("text"))
            parts = [_found(texts, found, firsts) for texts in _opened(blocks)]
            owner, word, ids, item_word, lengths = (np.concatenate([p[i] for p in parts]) for i in range(5))
            by = np.lexsort((item_word, word, owner))
            spans = pa.StructArray.from_arrays(
                [pa.array(ids[by], pa.string()), *[pa.array(a[by], pa.int64()) for a in (item_word, word, lengths)]], names=["item_id", "item_word", "word", "n_words"]
            )
            places = np.searchsorted(owner[by], np.arange(len(firsts))).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(places), spans).cast(_SPANS)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("row"), chunk.column("text"), pa.array(np.diff(firsts).astype(np.int64)), listed], names=["row", "text", "n_words", "spans"]
            )


def _judge(batches, ratio, keep_text):
    for batch in batches:
        hits, items, digests, verdicts = [], [], [], []
        for n, spans in zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            covered, end = 0, 0
            for start, length in sorted((s["word"], s["n_words"]) for s in spans):
                covered += max(0, start + length - max(end, start))
                end = max(end, start + length)
            names = sorted({s["item_id"] for s in spans})
            hits.append(covered)
            items.append(names)
            digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            verdicts.append(covered > 0 and ratio * covered >= n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n_words"), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(digests, pa.string()), pa.array(verdicts, pa.bool_()), batch.column("spans")]
            + ([batch.column("text")] if keep_text else []),
            names=["row", "n_words", "n_hit", "items", "items_sha256", "contaminated", "spans"] + (["text"] if keep_text else []),
        )


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int):
    """Blocks of test texts as broadcasts, each of a size near the given one; one test text must fit into a block.

    Texts are dealt by their ids as well, so that those alike, under however many ids, don't all meet in a block.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(quoted(item).cast("string").alias("item_id"), quoted(text).cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item_id")), F.lit(0))).first()[0]
    count = 1 if total <= block_bytes else 2 * -(-total // block_bytes)
    for block in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(count)) == block)
        yield spark.sparkContext.broadcast(TestTexts([tuple(r) for r in part.collect()], window))


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    carried: list[str],
    text: str = "text",
    item: str = "item_id",
    window: int = WINDOW,
    ratio: int = 20,
    keep_text: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents with the words that test texts share with them, a row for each row of ``docs``.

    Columns: ``carried`` as one struct ``row`` (see ``arrow.unpacked``), ``n_words``, ``n_hit`` (words in a match),
    ``items`` (test texts with a match, sorted as strings), ``items_sha256``, ``contaminated`` (something is hit, and
    at least one word in ``ratio``) and ``spans`` (longest matches: test text, its first word, the document's first
    word, number of words). A match has ``window`` words, or all words of a shorter test text; one without words
    matches nothing. Null text has no words; null test texts and ids are no test texts. Repeated rows each get their
    result; an empty table on either side gives no rows or no matches.
    """
    found = packed(docs, text, carried)
    # names of struct fields are c0, c1, ..., so that the type's text form is safe to parse
    row, _ = row_type(found)
    blocks = list(_blocks(benchmark, item, text, window, block_bytes))
    out = f"row {row}, n_words long, n_hit long, items array<string>, items_sha256 string, contaminated boolean, spans array<{_SPAN}>"
    return found.mapInArrow(lambda batches: _judge(_search(batches, blocks), ratio, keep_text), out + (", text string" if keep_text else ""))


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows; columns as they were."""
    others = [c for c in docs.columns if c != text]
    found = search(docs, benchmark, others, text, keep_text=True, **options).where(~F.col("contaminated"))
    columns = dict(zip(others, unpacked(others), strict=True)) | {text: F.col("text").alias(text)}
    return found.select(*[columns[c] for c in docs.columns])
