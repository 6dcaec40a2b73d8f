"""Bounded-space online packing of tokenised documents into sequences.

A task reads its documents one after another, cuts each into full sequences and a rest, and puts the rest into one of
a fixed number of open windows: the one where it leaves the least room. Where none has room, the fullest window goes
out and a new one opens. What is still open when a task has read all its documents is merged: those pieces, a fixed
number of windows a task, are dealt to fewer tasks and packed the same way; their last windows are filled best-fit
from the longest piece on.

Tokens: the vocabulary splits a text where white space begins, if not before. So a run of white space and the word
after it are always encoded alike, and each distinct one is encoded once for a few MB of text.
"""

import json
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import binary_array, chunks, packed, ranges, row_type, text_bytes, unpacked
from jobtide.sinks.scratch import stored

LENGTH, OPEN_WINDOWS = 1024, 64
#: Tasks whose open windows are packed together.
MERGED = 32

#: Fixed value: how the vocabulary splits a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Bytes after which white space may go on: white space, and what some take for it.
_MAYBE_SPACE = _SPACE.copy()
_MAYBE_SPACE[28:32] = True
_PIECES = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


def _byte_of_symbol() -> dict[str, int]:
    """The byte for which each symbol of a byte-level vocabulary stands: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _maybe_space_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether white space, or what some take for it, may end right before each place."""
    one, two, three = (np.where(places >= i, data[np.maximum(places - i, 0)], 0).astype(np.uint16) for i in (1, 2, 3))
    # two- and three-byte white space, and its neighbours
    return _MAYBE_SPACE[one] | (two == 0xC2) | np.isin((three << 8) | two, [0xE19A, 0xE280, 0xE281, 0xE380])


def units(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray = _SPACE) -> tuple[pa.Array, np.ndarray]:
    """The texts cut before each run of white space that begins with a byte of ``cut``, and the first piece of each."""
    n = len(data)
    starts = cut[data]
    begins = np.flatnonzero(starts)
    starts[begins] = ~_maybe_space_before(data, begins)
    if n:
        starts[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(starts)
    return binary_array(data, np.append(at, n)), np.searchsorted(at, offsets)


class Tokenizer:
    """A byte-level BPE vocabulary in a task, read from its file at first use.

    Its ids follow the order of its merges, so the faster of two public libraries gives the same ids; tests hold it
    against the other. Runs of over ``long`` bytes go to the other, whose time does not grow with their square, and so
    do texts with the string of an added token, which is that token unless ``plain``.
    """

    def __init__(self, path: str, long: int = 400, plain: bool = False):
        import tiktoken
        from tokenizers import Tokenizer as Library

        self.library, self.long, self._load = Library.from_file(path), long, lambda: Library.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.added = [] if plain else [t["content"] for t in given["added_tokens"]]
        symbols, added = _byte_of_symbol(), {t["content"] for t in given["added_tokens"]}
        #: Bytes of each token of the vocabulary, by its id.
        self.token_bytes = {i: bytes(symbols[c] for c in token) for token, i in given["model"]["vocab"].items() if token not in added}
        ranks = {token: i for i, token in self.token_bytes.items()}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(self.token_bytes) + 1, np.int64)
        self.sizes[list(self.token_bytes)] = [len(token) for token in self.token_bytes.values()]

    def one(self, text: str) -> list[int]:
        """Ids of a text in which the strings of added tokens mean nothing."""
        if len(text) > self.long:
            return self.library.encode(text, add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text)

    def each(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all values on end, as ``one`` gives them, and how many each value has."""
        data, offsets = text_bytes(values)
        sizes = np.diff(offsets)
        # a value that begins with white space and ends with something else can stand between such ones
        fit = (sizes > 0) & (sizes <= self.long)
        fit[fit] = _SPACE[data[offsets[:-1][fit]]] & ~_maybe_space_before(data, offsets[1:][fit])
        joined = data[ranges(offsets[:-1][fit], sizes[fit])].tobytes().decode()
        ids = self.encoding.encode_to_numpy(joined).astype(np.uint32)
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes[fit]), "right")
        lists = [self.one(v) for v in values.filter(pa.array(~fit)).cast(pa.large_string()).to_pylist()]
        counts = np.zeros(len(values), np.int64)
        counts[fit] = np.diff(ends, prepend=0)
        counts[~fit] = [len(each) for each in lists]
        out, begins = np.zeros(int(counts.sum()), np.uint32), np.cumsum(counts) - counts
        out[ranges(begins[fit], counts[fit])] = ids
        out[ranges(begins[~fit], counts[~fit])] = np.fromiter((i for each in lists for i in each), np.uint32, int(counts[~fit].sum()))
        return out, counts

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end with a 0 after each, and where each text begins."""
        marked = np.zeros(len(column), bool)
        for token in self.added:
            marked |= pc.fill_null(pc.match_substring(column, token), False).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._encode(column)
        ids, edges = self._encode(pc.if_else(pa.array(marked), pa.scalar("", column.type), column))
        lists, whole = [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)], self._load()
        for i in np.flatnonzero(marked):
            lists[i] = np.array([*whole.encode(column[int(i)].as_py(), add_special_tokens=False).ids, 0], np.uint32)
        return np.concatenate(lists), np.concatenate([[0], np.cumsum([len(each) for each in lists])])

    def _encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(column)
        found, firsts = units(data, offsets)
        encoded = found.dictionary_encode()
        ids, counts = self.each(encoded.dictionary)
        codes = encoded.indices.to_numpy().astype(np.int64)
        per_unit, begins = counts[codes], (np.cumsum(counts) - counts)[codes]
        ends = np.concatenate([[0], np.cumsum(per_unit)])
        edges = ends[firsts] + np.arange(len(firsts))
        out, inside = np.zeros(int(edges[-1]), np.uint32), np.ones(int(edges[-1]), bool)
        inside[edges[1:] - 1] = False
        out[inside] = ids[ranges(begins, per_unit)]
        return out, edges


class _Windows:
    """Open windows of a task; pieces are dicts and get their sequence and offset when their window goes out."""

    def __init__(self, task: int, length: int, most: int):
        self.length, self.most, self.next = length, most, task << 33
        self.used: list[tuple[int, int]] = []  # sorted by what is used
        self.pieces: dict[int, list[dict]] = {}

    def out(self, pieces: list[dict], done: list[dict]) -> None:
        offset = 0
        for piece in pieces:
            piece["sequence_id"], piece["offset"] = self.next, offset
            offset += piece["length"]
        self.next += 1
        done += pieces

    def put(self, piece: dict, done: list[dict]) -> None:
        """Into the fullest window that has room, else into a new one; windows that go out add to ``done``."""
        n = piece["length"]
        if n == self.length:
            return self.out([piece], done)
        place = bisect_left(self.used, (self.length - n + 1,)) - 1
        if place >= 0:
            used, window = self.used.pop(place)
        else:
            if len(self.used) == self.most:
                self.out(self.pieces.pop(self.used.pop()[1]), done)
            used, window = 0, (max(self.pieces, default=-1) + 1)
            self.pieces[window] = []
        self.pieces[window].append(piece)
        if used + n == self.length:
            self.out(self.pieces.pop(window), done)
        else:
            insort(self.used, (used + n, window))

    def rest(self, last: bool) -> list[dict]:
        """All open windows; where ``last``, their pieces are packed anew from the longest on."""
        done: list[dict] = []
        pieces = [p for window in self.pieces.values() for p in window]
        if last:
            self.used, self.pieces, self.most = [], {}, len(pieces) + 1
            for piece in sorted(pieces, key=lambda p: -p["length"]):
                self.put(piece, done)
        for window in list(self.pieces.values()):
            self.out(window, done)
        return done


def _batch(pieces: list[dict], row: pa.DataType, is_open: bool, keep_ids: bool) -> pa.RecordBatch:
    fields = [("row", row), *_PIECES, ("open", pa.bool_())] + ([("ids", pa.binary())] if keep_ids else [])
    for piece in pieces:
        piece["open"] = is_open
    return pa.RecordBatch.from_arrays([pa.array([p.get(n) for p in pieces], t) for n, t in fields], names=[n for n, _ in fields])


def _pack(batches, path, row, length, most, keep_ids):
    windows, tokenizer = _Windows(TaskContext.get().partitionId(), length, most), None
    for batch in batches:
        tokenizer = tokenizer or Tokenizer(path)
        for chunk in chunks(batch):
            ids, edges = tokenizer.encode(chunk.column("text"))
            done: list[dict] = []
            for values, first, end in zip(chunk.column("row").to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                for start in range(first, end, length):
                    raw = ids[start : min(start + length, end)].astype("<u4").tobytes()
                    piece = {"row": values, "start": start - first, "length": len(raw) // 4, "ids_crc32": zlib.crc32(raw), "doc_tokens": end - first}
                    if keep_ids:
                        piece["ids"] = raw
                    windows.put(piece, done)
            yield _batch(done, row, False, keep_ids)
    yield _batch(windows.rest(False), row, True, keep_ids)


def _merge(batches, row, length, most, keep_ids):
    # ids of merged windows begin above those of any task before
    windows = _Windows((1 << 28) + TaskContext.get().partitionId(), length, most)
    for batch in batches:
        done: list[dict] = []
        for piece in batch.to_pylist():
            windows.put(piece, done)
        yield _batch(done, row, False, keep_ids)
    yield _batch(windows.rest(True), row, False, keep_ids)


def pack(
    docs: DataFrame,
    vocabulary: str,
    carried: list[str],
    text: str = "text",
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens; ``vocabulary`` is the path of a tokeniser file.

    A row per piece: ``carried`` as one struct ``row`` (see ``arrow.unpacked``), ``start`` (tokens of its document
    before it), ``length``, ``ids_crc32`` and ``ids`` (little-endian unsigned 32-bit ids; left out unless
    ``keep_ids``), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence. A document's ids end with a 0, so
    null and empty texts have one token. Every token is in one piece. Repeated rows are packed each by itself; an
    empty table gives no pieces. Memory: one chunk of texts and the open windows.
    """
    found = packed(docs, text, carried)
    row, arrow_row = row_type(found)
    names = f"row {row}, " + ", ".join(f"{n} long" for n, _ in _PIECES) + ", open boolean" + (", ids binary" if keep_ids else "")
    first = stored(found.mapInArrow(lambda batches: _pack(batches, vocabulary, arrow_row, length, open_windows, keep_ids), names), "packed")
    still_open = first.where("open").withColumn("task", F.shiftright("sequence_id", 33))
    tasks = still_open.select("task").distinct().count()
    dealt = still_open.repartition(max(1, -(-tasks // MERGED)), F.expr(f"task div {MERGED}"))
    dealt = dealt.sortWithinPartitions("sequence_id", "offset").drop("task")
    merged = dealt.mapInArrow(lambda batches: _merge(batches, arrow_row, length, open_windows, keep_ids), names)
    return first.where("NOT open").unionByName(merged).drop("open")
