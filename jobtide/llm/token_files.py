"""Files of token ids in canonical length-limited Huffman codes, and reading them back.

The lengths of the codes come from the counts of all ids in all documents (package-merge, so no length is over
``limit`` bits); the codes follow from the lengths alone. A document's code bits begin at a full byte, and the bit
offset of every ``block``-th id is noted: blocks are decoded independently of each other, all of a few MB of them side
by side, by a table with an entry for each ``limit`` bits.

A folder holds files in ascending order of the documents' ids. Each file is a header record and then a record for each
document, every record followed by a line feed; numbers are little-endian:

* header: ``JTID``, version and ``limit`` (one byte each), ``block`` (4 bytes), the file's number in the folder (8),
  the size of what follows (8), and, compressed by zlib, a byte for each id: the length of its code, 0 if it has none;
* document: 1 if it has an id of its own, else 0 (one byte), that id (8, signed), its number of token ids (8), the size
  of its code bits in bytes (8), the bit offsets of its second and later blocks (8 each), and the code bits.

Files are written and read by Spark's own sources, so they can lie wherever Spark can write.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobtide.llm.arrow import binary_array, chunks, give_back, quoted, ranges, text_bytes
from jobtide.llm.packing import Tokenizer
from jobtide.sinks.scratch import stored

#: Most bits of a code, ids of a block, and ids of a file.
LIMIT, BLOCK, FILE_IDS = 18, 512, 16 << 20
#: Code bytes that are decoded side by side, unless one document has more.
DECODED_BYTES = 2 << 20

_HEADER, _DOCUMENT = "<4sBBIQQ", "<BqQQ"
_MAGIC, _VERSION = b"JTID", 1


# --- codes ----------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of the codes that make a text with these counts of ids shortest, none of over ``limit`` bits.

    An id that does not occur has no code (length 0). Among equal counts the greater id has the shorter code.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    # of each list, by rising weight: which of its items are leaves; the others are pairs of the list before
    is_leaf, merged = [], np.zeros(0, np.int64)
    for _ in range(limit):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        merged = both[place]
        is_leaf.append(place < len(leaves))
    taken = 2 * len(leaves) - 2
    for items in reversed(is_leaf):
        n = int(items[:taken].sum())
        lengths[order[:n]] += 1
        taken = 2 * (taken - n)
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """The canonical codes of these lengths: shorter ones first, and rising with the id among equal lengths."""
    out, code, before = np.zeros(len(lengths), np.uint32), 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        code <<= bits - before
        of = np.flatnonzero(lengths == bits)
        out[of] = code + np.arange(len(of), dtype=np.uint32)
        code, before = code + len(of), bits
    return out


def decoding_table(lengths: np.ndarray, limit: int) -> np.ndarray:
    """For each value of the next ``limit`` bits, the id they begin with, times 32, plus the length of its code."""
    table, each = np.zeros(1 << limit, np.uint32), codes(lengths)
    used = np.flatnonzero(lengths)
    spare = limit - lengths[used].astype(np.int64)
    table[ranges(each[used].astype(np.int64) << spare, 1 << spare)] = np.repeat((used.astype(np.uint32) << 5) | lengths[used], 1 << spare)
    return table


def encode(ids: np.ndarray, edges: np.ndarray, lengths: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code bytes of documents on end, where each document's begin, and the bit offset of each id in its document."""
    bits = lengths[ids].astype(np.int64)
    before = np.concatenate([[0], np.cumsum(bits)])
    begins = np.concatenate([[0], np.cumsum((before[edges[1:]] - before[edges[:-1]] + 7) // 8)])
    own = before[:-1] - np.repeat(before[edges[:-1]], np.diff(edges))
    at = own + 8 * np.repeat(begins[:-1], np.diff(edges))
    # the codes that begin in the same byte reach at most into the three bytes after it
    value = each[ids].astype(np.uint32) << (32 - bits - (at & 7)).astype(np.uint32)
    place = at >> 3
    first = np.flatnonzero(np.diff(place, prepend=-1))
    out = np.zeros(int(begins[-1]) + 4, np.uint8)
    if len(first):
        place, value = place[first], np.bitwise_or.reduceat(value, first)
        for step in range(4):
            out[place + step] |= (value >> np.uint32(24 - 8 * step)).astype(np.uint8)
    return out[: int(begins[-1])], begins, own


def decode(data: np.ndarray, at: np.ndarray, counts: np.ndarray, table: np.ndarray, limit: int) -> np.ndarray:
    """The ids of blocks on end: block i has ``counts[i]`` codes from bit ``at[i]`` of ``data`` on."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    word = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    out = np.zeros(int(counts.sum()), np.uint32)
    to = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    at, to, counts = at[order].astype(np.int64), to[order], counts[order]
    going = np.searchsorted(-counts, -np.arange(int(counts[0]) if len(counts) else 0), "left")
    mask, shift = np.uint32((1 << limit) - 1), 32 - limit
    for step, n in enumerate(going.tolist()):
        place = at[:n]
        entry = table[(word[place >> 3] >> (shift - (place & 7)).astype(np.uint32)) & mask]
        out[to[:n] + step] = entry >> 5
        at[:n] += entry & 31
    return out


# --- writing --------------------------------------------------------------------------------------------------------


def _ids(batches, vocabulary):
    tokenizer = None
    for batch in batches:
        tokenizer = tokenizer or Tokenizer(vocabulary)
        for chunk in chunks(batch):
            ids, edges = tokenizer.encode(chunk.column("text"))
            if ids.max(initial=0) >= 1 << 16:
                raise ValueError("ids of more than 16 bits")
            raw = binary_array(ids.astype("<u2").view(np.uint8), 2 * edges).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), raw, pa.array(np.diff(edges), pa.int64())], names=["doc_id", "ids", "n"])


def _count(batches):
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        counts += np.bincount(text_bytes(batch.column("ids"))[0].view("<u2"), minlength=len(counts))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])


def _records(batches, lengths, block):
    lengths = np.frombuffer(zlib.decompress(lengths), np.uint8)
    each = codes(lengths)
    for batch in batches:
        for chunk in chunks(batch, "ids"):
            raw, places = text_bytes(chunk.column("ids"))
            ids, edges = raw.view("<u2"), places // 2
            data, begins, own = encode(ids, edges, lengths, each)
            records = []
            for i, doc_id in enumerate(chunk.column("doc_id").to_pylist()):
                first, end = int(edges[i]), int(edges[i + 1])
                head = struct.pack(_DOCUMENT, doc_id is not None, doc_id or 0, end - first, int(begins[i + 1] - begins[i]))
                records.append(b"".join([head, own[first + block : end : block].astype("<u8").tobytes(), data[begins[i] : begins[i + 1]].tobytes()]))
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("key"), pa.array(records, pa.binary())], names=["doc_id", "key", "record"])


def _files(batches, lengths, limit, block):
    head = struct.pack(_HEADER, _MAGIC, _VERSION, limit, block, TaskContext.get().partitionId(), len(lengths)) + lengths
    for batch in batches:
        if batch.num_rows:
            if head:
                yield pa.RecordBatch.from_arrays([pa.array([head], pa.binary())], names=["record"])
                head = b""
            yield pa.RecordBatch.from_arrays([batch.column("record")], names=["record"])
    give_back()


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    block: int = BLOCK,
    file_ids: int = FILE_IDS,
) -> None:
    """Write the token ids of all rows to a new folder ``path``; ``vocabulary`` is the path of a tokeniser file.

    A document's ids end with a 0, so null and empty texts have one. ``doc_id`` is a whole number; rows without one
    come first, and rows of the same id after one another, each a document of its own. An empty table gives a folder
    without documents. A vocabulary has at most 65,536 ids. Texts are encoded once: their ids are stored, counted, and
    then coded. Memory: a chunk of texts; one document's ids and codes must fit into a task.
    """
    given = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    encoded = stored(given.mapInArrow(lambda batches: _ids(batches, vocabulary), "doc_id long, ids binary, n long"), "ids")
    # a row for each id of the vocabulary
    counted = encoded.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, np.int64)
    counts[[r["id"] for r in counted]] = [r["n"] for r in counted]
    lengths = zlib.compress(code_lengths(counts, limit).tobytes(), 9)
    files = max(1, -(-int(counts.sum()) // file_ids))
    keyed = encoded.select("doc_id", "ids", F.monotonically_increasing_id().alias("key"))
    coded = keyed.mapInArrow(lambda batches: _records(batches, lengths, block), "doc_id long, key long, record binary")
    dealt = coded.repartitionByRange(files, "doc_id", "key").sortWithinPartitions("doc_id", "key")
    out = dealt.mapInArrow(lambda batches: _files(batches, lengths, limit, block), "record binary")
    # the text source writes the bytes as they are
    out.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").text(path)


# --- reading --------------------------------------------------------------------------------------------------------


def _documents(content: memoryview):
    """Header and then, for each document of a file: id, number of ids, offsets of its blocks, code bytes."""
    magic, version, limit, block, number, size = struct.unpack_from(_HEADER, content)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a file of token ids")
    at = struct.calcsize(_HEADER) + size
    yield number, limit, block, np.frombuffer(zlib.decompress(content[at - size : at]), np.uint8)
    while at + 1 < len(content):
        has, doc_id, n, size = struct.unpack_from(_DOCUMENT, content, at + 1)
        at += 1 + struct.calcsize(_DOCUMENT)
        later = max(0, -(-n // block) - 1)
        offsets = np.concatenate([[0], np.frombuffer(content, "<u8", later, at).astype(np.int64)])
        at += 8 * later
        yield doc_id if has else None, n, offsets, np.frombuffer(content, np.uint8, size, at)
        at += size


def _rows(number, found, start, table, limit, block, first, most):
    """A batch of rows for documents of a file; ``start``: the ids that the file has before them."""
    data = np.concatenate([each[3] for each in found])
    begins = np.concatenate([[0], np.cumsum([len(each[3]) for each in found])])
    at, counts, wanted, edges = [], [], [], [0]
    for (_, n, offsets, _), begin in zip(found, begins[:-1], strict=True):
        # only the blocks that hold what is asked for
        low, high = min(first, n), n if most is None else min(first + most, n)
        blocks = np.arange(low // block, -(-high // block) if high > low else low // block)
        at.append(offsets[blocks] + 8 * begin)
        counts.append(np.minimum(block, n - blocks * block))
        wanted.append((edges[-1] + low - low // block * block, high - low))
        edges.append(edges[-1] + int(counts[-1].sum()))
    ids = decode(data, np.concatenate(at), np.concatenate(counts), table, limit)
    raw = [ids[a : a + n].astype("<u4").tobytes() for a, n in wanted]
    sizes = np.array([each[1] for each in found], np.int64)
    columns = [
        pa.array([each[0] for each in found], pa.int64()),
        pa.array(np.full(len(found), number), pa.int64()),
        pa.array(start + np.cumsum(sizes) - sizes, pa.int64()),
        pa.array(sizes, pa.int64()),
        pa.array([zlib.crc32(each) for each in raw], pa.int64()),
        pa.array(raw, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "start", "n_tokens", "ids_crc32", "ids"])


def _read(batches, first, most, keep_ids):
    tables = {}
    for batch in batches:
        for content in batch.column("content"):
            content = memoryview(content.as_buffer())
            if not len(content):
                continue
            documents = _documents(content)
            number, limit, block, lengths = next(documents)
            key = lengths.tobytes()
            if key not in tables:
                tables = {key: decoding_table(lengths, limit)}
            start, group, size = 0, [], 0
            for document in documents:
                if group and size + len(document[3]) > DECODED_BYTES:
                    yield from _batches(number, group, start, tables[key], limit, block, first, most, keep_ids)
                    start, group, size = start + sum(each[1] for each in group), [], 0
                group.append(document)
                size += len(document[3])
            if group:
                yield from _batches(number, group, start, tables[key], limit, block, first, most, keep_ids)
            give_back()


def _batches(*given):
    *of, keep_ids = given
    batch = _rows(*of)
    yield batch if keep_ids else batch.drop_columns(["ids"])


def read(spark: SparkSession, path: str, first: int = 0, most: int | None = None, keep_ids: bool = True) -> DataFrame:
    """The documents of a folder that ``write`` made, a row each.

    Columns: ``doc_id``, ``start`` (ids of all documents before it in the folder's order), ``n_tokens``, ``ids_crc32``
    and ``ids`` (little-endian unsigned 32-bit; left out unless ``keep_ids``). Only ids from the ``first`` on, and at
    most so many, are decoded of each document, if so asked. A file is read by one task, a few MB at a time.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    columns = "doc_id long, file long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    found = stored(files.mapInArrow(lambda batches: _read(batches, first, most, keep_ids), columns), "decoded")
    return _numbered(found)


def _numbered(found: DataFrame) -> DataFrame:
    """Rows with ``start`` counted from the folder's beginning; sums run over files, in groups of a thousand."""
    sizes = stored(found.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("group", F.expr("file div 1000")), "sizes")
    groups = sizes.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", (F.sum("n").over(Window.orderBy("group")) - F.col("n")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("group").orderBy("file")) - F.col("n")
    files = sizes.select("file", "group", within.alias("within")).join(groups, "group").select("file", (F.col("before") + F.col("within")).alias("before"))
    return found.join(files, "file").withColumn("start", F.col("start") + F.col("before")).drop("file", "before")
