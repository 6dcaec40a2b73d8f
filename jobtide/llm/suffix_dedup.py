"""Removal of byte strings that an earlier document has, with suffix arrays by difference covers.

A byte goes where it is covered by ``length`` bytes that also start in a document with a smaller id. Every string of
that length (a window) belongs to the least of the ``anchor``-byte strings in it, by hash; consecutive windows of the
same anchor are a segment. Equal windows have equal anchors, so the suffixes of the corpus fall into buckets by anchor
that can be sorted apart, and a bucket's suffix array is a part of that of the whole corpus.

1. Documents are put into chunks, a table of a few MB of compressed text a row.
2. Each chunk sends the hashes of its anchors to buckets, which tell it the anchors that other chunks have too.
3. Each chunk sends its segments with such an anchor to buckets, each distinct one once with its least document.
4. A bucket sorts the suffixes of its segments (difference cover modulo 3: sort sampled triples, recurse on their
   names, merge the other suffixes), compares adjacent prefixes, and so finds the least document of each window. It
   does so for anchors with several different segments; a segment alone in its anchor needs no sorting.
5. Each chunk gets these back and marks the bytes that go.

Chunks send an anchor or segment once however often they have it, so a passage in a third of all documents is a row's
small part for each chunk. An anchor with very many segments is split further, by the windows' own hashes. Chunks times
buckets grows with the square of the input, so a chunk's segments are worked on for many buckets at once, and what it
sends to one bucket costs two calls to compress. Results are exact: hashes only decide where strings meet, equality is
judged on bytes.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import binary_array, chunks, give_back, packed, ranges, row_type, text_bytes, unpacked
from jobtide.sinks.scratch import stored

LENGTH, ANCHOR = 50, 20
#: Bytes of text for each bucket, and windows that a task works on at once.
BUCKET_BYTES, BLOCK = 16 << 20, 1 << 18
#: An anchor is split by the hashes of its windows if it has more segments than so many chunks with so many of it each.
HOT_CHUNKS, HOT_EACH = 1000, 64
#: Text bytes that are sorted together, unless one anchor has more.
SORTED_BYTES = 1 << 19
#: Text bytes of a chunk.
CHUNK_TEXT = 4 << 20
#: Bytes of segments, and windows, of several buckets that are worked on at once.
AT_ONCE = 4 << 20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_FOLD, _PLACE = np.uint64(32), np.uint64((1 << 28) - 1)


# --- suffix sorting -------------------------------------------------------------------------------------------------


def _keys(*tables: list[np.ndarray]) -> list[np.ndarray]:
    """A number for each row of the tables that orders the rows of all tables like their columns do."""
    sizes = np.cumsum([len(t[0]) for t in tables])[:-1]
    key, bits = None, 0
    for columns in zip(*tables, strict=True):
        column = np.concatenate(columns)
        more = int(column.max(initial=0)).bit_length()
        if key is None:
            key, bits = column.astype(np.int64), more
            continue
        if bits + more > 62:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            bits = int(key.max(initial=0)).bit_length()
        key, bits = (key << more) | column, bits + more
    return np.split(key, sizes)


def _names(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and for each key how many distinct ones are up to it."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), np.int64)
    new[1:] = ordered[1:] != ordered[:-1]
    names = np.empty(len(key), np.int64)
    names[order] = np.cumsum(new)
    return order, names


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of ``text`` (numbers from 1 on) by ``depth`` numbers at least, or up to the end.

    Suffixes with the same rank agree in so many numbers. A 0 in the text ends what is compared like its end does; how
    suffixes compare beyond one is left open.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(5, np.int64)])
    # where the last suffix at a place of the form 3i + 1 would not end in a 0, one more does
    one, two, rest = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    if depth <= 1 or n < 4:
        return _names(_keys([padded[np.arange(n) + i] for i in range(4)])[0])[1] if n else np.zeros(0, np.int64)
    sampled = np.concatenate([one, two])
    names = _names(_keys([padded[sampled], padded[sampled + 1], padded[sampled + 2]])[0])[1]
    if depth > 3 and names.max() < len(names):
        names = suffix_ranks(names, -(-depth // 3))
    rank = np.zeros(n + 5, np.int64)
    rank[sampled] = names
    # the others by their first number and the rank of the suffix after it
    zero, first = _keys([padded[rest], rank[rest + 1]], [padded[one], rank[one + 1]])
    long_zero, second = _keys([padded[rest], padded[rest + 1], rank[rest + 2]], [padded[two], padded[two + 1], rank[two + 2]])
    order, zero_names = _names(zero)
    below, equal = np.zeros(len(rest), np.int64), np.zeros(len(rest), bool)
    for sampled_keys, keys in ((np.sort(first), zero[order]), (np.sort(second), long_zero[order])):
        if len(sampled_keys):
            found = np.searchsorted(sampled_keys, keys)
            below += found
            equal |= sampled_keys[np.minimum(found, len(sampled_keys) - 1)] == keys
    # how many sampled suffixes come before each sampled one
    before = np.cumsum(np.bincount(names))[names - 1]
    place, inner = np.empty(n + 1, np.int64), np.zeros(n, np.int64)
    place[sampled] = 2 * before + 1
    place[rest[order]] = 2 * below + equal
    inner[rest[order]] = np.where(equal, 0, zero_names[order])
    return _names(_keys([place[:n], inner])[0])[1]


def least_documents(segments: np.ndarray, offsets: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For each window of each segment, in order, the least document of any segment with an equal window."""
    sizes = np.diff(offsets)
    count = len(sizes)
    # a 0 after each segment, so that no window runs on into the next
    text = np.zeros(len(segments) + count, np.int64)
    shifted = offsets[:-1] + np.arange(count)
    text[ranges(shifted, sizes)] = segments.astype(np.int64) + 1
    windows = sizes - length + 1
    starts, doc = ranges(shifted, windows), np.repeat(least, windows)
    order = np.argsort(suffix_ranks(text, length)[starts])
    at = starts[order]
    # adjacent prefixes, compared eight bytes at a time
    raw = np.zeros(len(text) + 8, np.uint8)
    raw[: len(text)] = (text - 1) * (text > 0)
    words = np.lib.stride_tricks.sliding_window_view(raw, 8)
    new = np.zeros(len(at), bool)
    new[:1] = True
    same = np.arange(1, len(at))
    for step in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        differs = (words[at[same] + step] != words[at[same - 1] + step]).any(axis=1)
        new[same[differs]] = True
        same = same[~differs]
    groups = np.flatnonzero(new)
    out = np.empty(len(at), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(doc[order], groups), np.diff(np.append(groups, len(at)))) if len(at) else 0
    return out


# --- segments -------------------------------------------------------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on as a number, the last ones filled up with zeros. A view."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data), "<u8", padded, strides=(1,))


def _hashes(words: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on, or from each place in ``at``."""
    count = max(0, len(words) - size + 1)
    out = None
    for step in [*range(0, size - 7, 8), *([size - 8] if size % 8 and size > 8 else [])] or [0]:
        part = words[step : step + count] if at is None else words[at + step]
        if size < 8:
            part = part & np.uint64((1 << 8 * size) - 1)
        out = part + _M2 if out is None else np.add(out, part, out=out)
        out *= _M1
        out ^= out >> _FOLD
    out *= _M2
    out ^= out >> _FOLD
    return out


def _segments(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Segments of the documents: first window's place, number of windows, anchor's place and hash."""
    found = []
    per_window = length - anchor + 1
    # windows that would run beyond their document
    sizes, inside = np.diff(offsets), np.ones(len(data), bool)
    beyond = np.minimum(sizes, length - 1)
    inside[ranges(offsets[1:] - beyond, beyond)] = False
    place = np.arange(min(BLOCK, max(0, len(data) - length + 1)) + per_window - 1, dtype=np.uint64)
    for first in range(0, len(data) - length + 1, BLOCK):
        valid = inside[first : min(first + BLOCK, len(data) - length + 1)]
        if not valid.any():
            continue
        hashes = _hashes(_words(data[first : first + len(valid) + length - 1]).copy(), anchor)
        # the least of each window: of two places, four and so on, and of the window's two ends
        least, span = (hashes & ~_PLACE) | place[: len(hashes)], 1
        while span < per_window:
            step = min(span, per_window - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        edge = np.ones(len(valid) + 1, bool)
        edge[1:-1] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
        edges = np.flatnonzero(edge)
        own = valid[edges[:-1]]
        at, windows = edges[:-1][own], np.diff(edges)[own]
        owner = (least[at] & _PLACE).astype(np.int64)
        found.append((at + first, windows, owner + first, hashes[owner]))
    if not found:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _squeezed(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes on end, compressed."""
    return pa.Codec("zstd", compression_level=3).compress(b"".join(a.tobytes() for a in arrays), asbytes=True)


def _unsqueezed(squeezed: bytes, n: int, *kinds) -> list[np.ndarray]:
    """Arrays of ``n`` values each, one for each kind."""
    places = np.cumsum([0] + [n * np.dtype(kind).itemsize for kind in kinds]).tolist()
    data = np.frombuffer(pa.decompress(squeezed, places[-1], codec="zstd"), np.uint8) if n else np.zeros(0, np.uint8)
    return [data[a:b].view(kind) for kind, a, b in zip(kinds, places, places[1:])]


# --- steps ----------------------------------------------------------------------------------------------------------

_CHUNK = "chunk long, size long, text binary, ids array<long>, lengths array<long>, nulls array<boolean>"


def _make_chunks(batches, rows):
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for chunk in chunks(batch, size=CHUNK_TEXT):
            data, offsets = text_bytes(chunk.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.array([len(data)]), pa.array([_squeezed(data)], pa.binary()),
                    pa.array([chunk.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([np.diff(offsets).tolist()], pa.list_(pa.int64())),
                    pa.array([chunk.column("text").is_null().to_pylist()], pa.list_(pa.bool_())), pa.array([chunk.column("row").to_pylist()], rows),
                ],
                names=["chunk", "size", "text", "ids", "lengths", "nulls", "rows"],
            )
            number += 1


def _opened(chunk: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = _unsqueezed(chunk["text"], chunk["size"], np.uint8)[0]
    return data, np.concatenate([[0], np.cumsum(np.array(chunk["lengths"], np.int64))]), np.array(chunk["ids"], np.int64)


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the place after the last."""
    new = np.ones(len(values) + 1, bool)
    new[1:-1] = values[1:] != values[:-1]
    return np.flatnonzero(new) if len(values) else np.zeros(1, np.int64)


def _portions(load: np.ndarray, edges: np.ndarray, most: int):
    """First and last edge of portions of ``most`` at most of what ``load`` adds up between edges, or one stretch."""
    total, first = np.concatenate([[0], np.cumsum(load)])[edges], 0
    while first < len(edges) - 1:
        last = max(first + 1, int(np.searchsorted(total, total[first] + most, "right")) - 1)
        yield first, last
        first = last


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of runs of values, the i-th from ``ends[i]`` to ``ends[i + 1]``."""
    return binary_array(np.ascontiguousarray(values).view(np.uint8), ends * values.itemsize).cast(pa.binary())


def _numbers(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """What ``_binaries`` has packed."""
    data, ends = text_bytes(column.cast(pa.large_binary()).combine_chunks())
    return data.copy().view(kind), ends // np.dtype(kind).itemsize


def _anchors(batches, mask, length, anchor):
    for batch in batches:
        for chunk in batch.to_pylist():
            data, offsets, _ = _opened(chunk)
            keys = np.sort(_segments(data, offsets, length, anchor)[3] & mask)
            firsts = _firsts(keys)
            keys, times = keys[firsts[:-1]], np.minimum(np.diff(firsts), (1 << 16) - 1).astype(np.uint16)
            bucket = (keys >> np.uint64(32)).astype(np.int64)
            edges = _firsts(bucket)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[edges[:-1]]), pa.array(np.full(len(edges) - 1, chunk["chunk"])), _binaries(keys.astype(np.uint32), edges), _binaries(times, edges)],
                names=["bucket", "chunk", "keys", "times"],
            )
        give_back()


_REPEATED = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("hot", pa.binary())])


def _repeated(table: pa.Table, hot: int) -> pa.Table:
    """Anchors of a bucket that two chunks or more have, told to each of these, and which have more than ``hot`` segments."""
    keys, edges = _numbers(table.column("keys"), np.uint32)
    times = _numbers(table.column("times"), np.uint16)[0].astype(np.int64)
    order = np.argsort(keys)
    firsts = _firsts(keys[order])
    held = np.diff(firsts)
    repeated, split = np.empty((2, len(keys)), bool)
    repeated[order] = np.repeat(held > 1, held)
    split[order] = np.repeat((held > 1) & (np.add.reduceat(times[order], firsts[:-1]) > hot), held)
    told, many = (np.concatenate([[0], np.cumsum(of)])[edges] for of in (repeated, split))
    some = np.append(np.diff(told) > 0, True)
    out = table.select(["chunk", "bucket"]).filter(pa.array(some[:-1]))
    # what the rows that are left out have is nothing
    return pa.table([*out.columns, _binaries(keys[repeated], told[some]), _binaries(keys[split], many[some])], schema=_REPEATED)


_SENT = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("n_bytes", pa.int64()), ("text", pa.binary()), ("segments", pa.binary())])


def _among(keys: np.ndarray, told: pa.Table, name: str, own: np.ndarray) -> np.ndarray:
    """Which anchor keys a chunk has found itself or was told."""
    rest, edges = _numbers(told.column(name), np.uint32)
    bucket = np.repeat(told.column("bucket").to_numpy().astype(np.uint64), np.diff(edges))
    wanted = np.sort(np.concatenate([own, (bucket << np.uint64(32)) | rest]))
    if not len(wanted):
        return np.zeros(len(keys), bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys


def _repeated_segments(data, offsets, told: pa.Table, mask, length, anchor):
    """Segments of a chunk whose anchor is in several documents, by bucket.

    Columns: place, windows, anchor's place in the segment, document's place in the chunk, bucket. Each window of a
    hot anchor is a segment by itself and goes where its own hash says.
    """
    at, windows, owner, hashes = _segments(data, offsets, length, anchor)
    keys = hashes & mask
    doc = np.searchsorted(offsets, at, "right") - 1
    order = np.argsort(keys)
    twice = (keys[order[1:]] == keys[order[:-1]]) & (doc[order[1:]] != doc[order[:-1]])
    own = keys[order[1:][twice]]
    wanted = _among(keys, told, "keys", own)
    hot = _among(keys, told, "hot", own[:0])
    single = ranges(at[hot], windows[hot])
    by_window = _hashes(_words(data), length, single)
    of, cold = np.repeat(np.flatnonzero(hot), windows[hot]), np.flatnonzero(wanted & ~hot)
    start, every = np.concatenate([at[cold], single]), np.concatenate([cold, of])
    count = np.concatenate([windows[cold], np.ones(len(single), np.int64)])
    bucket = np.concatenate([keys[cold], by_window & mask]) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    start, every = start[order], every[order]
    return start, count[order], owner[every] - start, doc[every], bucket[order].astype(np.int64)


def _distinct(data, start, sizes):
    """The segments' bytes as a dictionary array; its order depends on nothing but the segments.

    Segments of different buckets differ, so those of a bucket have numbers on end if they stand on end.
    """
    return binary_array(data[ranges(start, sizes)], np.concatenate([[0], np.cumsum(sizes)])).dictionary_encode()


def _send(found: pa.Table, chunk: pa.Table, mask, length, anchor) -> pa.Table:
    """A chunk's distinct segments with repeated anchors, for each bucket, with the least document that has each."""
    out = []
    for row in chunk.select(["chunk", "size", "text", "ids", "lengths"]).to_pylist():
        data, offsets, ids = _opened(row)
        start, windows, owner, doc, bucket = _repeated_segments(data, offsets, found, mask, length, anchor)
        edges, sizes = _firsts(bucket), windows + length - 1
        for x, y in _portions(sizes, edges, AT_ONCE):
            part = slice(edges[x], edges[y])
            coded = _distinct(data, start[part], sizes[part])
            codes = coded.indices.to_numpy()
            text, places = text_bytes(coded.dictionary)
            first = _first_places(codes, len(places) - 1)
            least = np.full(len(first), np.iinfo(np.int64).max)
            np.minimum.at(least, codes, ids[doc[part]])
            lengths, begins = np.diff(places).astype(np.uint16), owner[part][first].astype(np.uint16)
            ends = [*np.searchsorted(first, edges[x:y] - edges[x]).tolist(), len(first)]
            for number, a, b in zip(bucket[edges[x:y]].tolist(), ends, ends[1:]):
                own = text[places[a] : places[b]]
                out.append((row["chunk"], number, b - a, len(own), _squeezed(own), _squeezed(least[a:b], lengths[a:b], begins[a:b])))
    give_back()
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 6, _SENT)], schema=_SENT)


def _first_places(codes: np.ndarray, count: int) -> np.ndarray:
    """The first place of each of ``count`` codes, which begin in order."""
    first = np.empty(count, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return first


_LEAST = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("runs", pa.binary())])


def _resolve(table: pa.Table, length: int, anchor: int) -> pa.Table:
    """For the segments of a bucket, chunk by chunk, the least document of each window, as runs of windows."""
    counts, n_bytes = table.column("n").to_numpy(), table.column("n_bytes").to_pylist()
    text = np.concatenate([_unsqueezed(t, n, np.uint8)[0] for t, n in zip(table.column("text").to_pylist(), n_bytes, strict=True)])
    parts = [_unsqueezed(s, n, np.int64, np.uint16, np.uint16) for s, n in zip(table.column("segments").to_pylist(), counts.tolist(), strict=True)]
    docs, sizes, begins = (np.concatenate(part) for part in zip(*parts, strict=True))
    places = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    coded = binary_array(text, places).dictionary_encode()
    codes, several_of = coded.indices.to_numpy(), len(coded.dictionary)
    first = _first_places(codes, several_of)
    least = np.full(several_of, np.iinfo(np.int64).max)
    np.minimum.at(least, codes, docs)
    # from here on distinct segments, ordered by anchor
    anchors = binary_array(text[ranges(places[first] + begins[first], np.full(len(first), anchor))], np.arange(len(first) + 1) * anchor).dictionary_encode()
    group = anchors.indices.to_numpy().astype(np.int64)
    size = np.diff(places)[first]
    windows = size - length + 1
    # different segments of one window each have no window in common
    held, longest = np.bincount(group), np.zeros(int(group.max(initial=0)) + 1, np.int64)
    np.maximum.at(longest, group, windows)
    several = (held[group] > 1) & (longest[group] > 1)
    edges = np.concatenate([[0], np.cumsum(windows)])
    of_window = np.repeat(least, windows)
    order = np.argsort(group, kind="stable")
    order = order[several[order]]
    groups = _firsts(group[order])
    for x, y in _portions(size[order], groups, SORTED_BYTES):
        part = order[groups[x] : groups[y]]
        ends = np.concatenate([[0], np.cumsum(size[part])])
        found = least_documents(text[ranges(places[first[part]], size[part])], ends, least[part], length)
        of_window[ranges(edges[part], windows[part])] = found
    out, rows = [], np.concatenate([[0], np.cumsum(counts)])
    chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket").to_pylist()
    for x, y in _portions(windows[codes], rows, AT_ONCE):
        own = codes[rows[x] : rows[y]]
        values = of_window[ranges(edges[own], windows[own])]
        begin = np.concatenate([[0], np.cumsum(windows[own])])
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        new[begin[:-1]] = True
        starts = np.flatnonzero(new)
        lengths, values = np.diff(np.append(starts, len(values))).astype(np.uint16), values[starts]
        ends = np.searchsorted(starts, begin[rows[x : y + 1] - rows[x]]).tolist()
        out += [(chunk[x + i], bucket[x + i], b - a, _squeezed(values[a:b], lengths[a:b])) for i, (a, b) in enumerate(zip(ends, ends[1:]))]
    give_back()
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, _LEAST)], schema=_LEAST)


def _removed(data, offsets, ids, given: pa.Table, mask, length: int, anchor: int) -> np.ndarray:
    """Which bytes of a chunk go, by what it was told of its anchors and of its segments."""
    replied = given.column("runs").is_valid()
    replies, told = given.filter(replied).sort_by("bucket"), given.filter(pc.invert(replied))
    start, windows, _, doc, bucket = _repeated_segments(data, offsets, told, mask, length, anchor)
    edges, going = _firsts(bucket), np.zeros(len(data), bool)
    for x, y in _portions(windows + length - 1, edges, AT_ONCE):
        reply, part = replies.slice(x, y - x), slice(edges[x], edges[y])
        if reply.column("bucket").to_pylist() != bucket[edges[x:y]].tolist():
            raise ValueError("each bucket that a chunk has sent segments to has one reply")
        runs = [_unsqueezed(r, n, np.int64, np.uint16) for r, n in zip(reply.column("runs").to_pylist(), reply.column("n").to_pylist(), strict=True)]
        values, lengths = (np.concatenate(of) for of in zip(*runs, strict=True))
        values = np.repeat(values, lengths)
        count, coded = windows[part], _distinct(data, start[part], windows[part] + length - 1)
        codes = coded.indices.to_numpy()
        # windows of the distinct segments, in the order in which they were sent
        of_code = np.zeros(len(coded.dictionary), np.int64)
        of_code[codes] = count
        least = values[ranges((np.cumsum(of_code) - of_code)[codes], count)]
        going[ranges(start[part], count)[least < np.repeat(ids[doc[part]], count)]] = True
    # a byte goes if a window that goes begins there or less than a window before
    before = np.cumsum(going, dtype=np.int32)
    gone = before > 0
    gone[length:] = before[length:] > before[:-length]
    return gone


def _finish(told: pa.Table, chunk: pa.Table, row, mask, length: int, anchor: int, keep_text: bool) -> pa.Table:
    out = []
    for given_row in chunk.to_pylist():
        data, offsets, ids = _opened(given_row)
        gone = _removed(data, offsets, ids, told, mask, length, anchor)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            own, cut = data[a:b], gone[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], cut, [False]]).astype(np.int8)))
            spans = [{"start": s, "length": e - s} for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
            item = {"row": given_row["rows"][i], "n_bytes": b - a, "n_removed": int(cut.sum()), "n_spans": len(spans), "kept_sha256": hashlib.sha256(own[~cut].tobytes()).hexdigest(), "spans": spans}
            if keep_text:
                # a character goes if all its bytes go
                if spans:
                    starts = np.flatnonzero((own & 0xC0) != 0x80)
                    whole = np.repeat(np.minimum.reduceat(cut, starts), np.diff(np.append(starts, len(own))))
                    own = own[~whole]
                item["text"] = None if given_row["nulls"][i] else own.tobytes().decode()
            out.append(item)
    fields = [("row", row), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))]
    fields += [("text", pa.string())] if keep_text else []
    give_back()
    return pa.table([pa.array([o[n] for o in out], t) for n, t in fields], names=[n for n, _ in fields])


def find(
    docs: DataFrame,
    carried: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    keep_text: bool = False,
    bucket_bytes: int = BUCKET_BYTES,
    hot_chunks: int = HOT_CHUNKS,
) -> DataFrame:
    """The bytes to remove from each row of ``docs``; ``doc_id`` is a whole number.

    Columns: ``carried`` as one struct ``row`` (see ``arrow.unpacked``), ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``spans`` (maximal removed runs), ``kept_sha256`` (of the remaining bytes), and where ``keep_text`` the remaining
    ``text``, of which only whole characters are removed. Null text is empty (its ``text`` stays null) and a null id
    comes after all others. Rows with the same id do not count as earlier than one another; texts shorter than
    ``length`` keep all. An empty table gives no rows.
    """
    given = packed(docs, text, [*carried, doc_id])
    row, arrow_row = row_type(given)
    given = given.withColumn("id", F.coalesce(F.col(f"row.c{len(carried)}").cast("long"), F.lit((1 << 63) - 1)))
    rows = pa.list_(arrow_row)
    table = stored(given.mapInArrow(lambda batches: _make_chunks(batches, rows), f"{_CHUNK}, rows array<{row}>"), "chunks")
    total = table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits = max(0, (int(total) // bucket_bytes).bit_length())
    mask = np.uint64((1 << (32 + bits)) - 1)

    anchors = table.drop("rows", "nulls").mapInArrow(lambda batches: _anchors(batches, mask, length, anchor), "bucket long, chunk long, keys binary, times binary")
    told = anchors.groupBy("bucket").applyInArrow(lambda t: _repeated(t, hot_chunks * HOT_EACH), "chunk long, bucket long, keys binary, hot binary")
    told = stored(told, "anchors")
    # the chunks are shuffled once for both cogroups, which needs the same columns
    sent = told.groupBy("chunk").cogroup(table.groupBy("chunk")).applyInArrow(
        lambda found, chunk: _send(found, chunk, mask, length, anchor),
        "chunk long, bucket long, n long, n_bytes long, text binary, segments binary",
    )
    least = sent.groupBy("bucket").applyInArrow(lambda t: _resolve(t, length, anchor), "chunk long, bucket long, n long, runs binary")
    both = least.unionByName(told, allowMissingColumns=True)
    out = f"row {row}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,length:long>>"
    return both.groupBy("chunk").cogroup(table.groupBy("chunk")).applyInArrow(
        lambda found, chunk: _finish(found, chunk, arrow_row, mask, length, anchor, keep_text), out + (", text string" if keep_text else "")
    )


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the remaining text, without rows of which nothing remains; columns as they were."""
    others = [c for c in docs.columns if c != text]
    found = find(docs, others, doc_id, text, keep_text=True, **options).where("n_removed = 0 OR text != ''")
    columns = dict(zip(others, unpacked(others), strict=True)) | {text: F.col("text").alias(text)}
    return found.select(*[columns[c] for c in docs.columns])
