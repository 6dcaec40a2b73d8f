"""Alignment of two vocabularies' tokens by sparse matrix products.

A text, with a space before it, is encoded by a byte-level vocabulary (A) and by a vocabulary of pieces (B), whose
tokens cover the same bytes. Matrices lie in compressed rows (``Csr``) and are multiplied by Gustavson's method: a row
of the product is the sum of the right matrix's rows that the left row names.

* Token-byte incidence A x B transposed: how many bytes two tokens share (overlap links). A token of A begins a group
  where its first link lies behind the last link of the token before it, so groups end where tokens of both end.
* Group incidence A x B: tokens of the same group (shared-group links), by ids and with their number.
* Documents x distinct words, times words x id pairs: the links of each document.

Both vocabularies split a text where a space follows something else, so each distinct word is encoded and aligned once
for a few MB of text. A text in which a word's tokens don't spell the word is encoded again as a whole.

The links of a chunk of documents are stored as one row. How many documents hold an id pair is added up over the
chunks' own counts; each chunk gets back the counts of its pairs. A pair that all documents hold is one row a chunk.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import chunks, give_back, packed, ranges, row_type, sums, text_bytes
from jobtide.llm.packing import Tokenizer, units
from jobtide.sinks.scratch import stored

#: Text bytes of a chunk, and terms of a product that are worked out at once, unless one row has more.
CHUNK_TEXT, TERMS = 4 << 20, 1 << 20

_SPACE_ONLY = np.zeros(256, bool)
_SPACE_ONLY[32] = True
_MEASURES = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links"]


# --- matrices -------------------------------------------------------------------------------------------------------


class Csr:
    """A sparse matrix: row i has ``values[starts[i]:starts[i + 1]]`` in the columns ``columns[...]``, which rise."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.starts, self.columns, self.values, self.width = starts, columns, values, width

    @classmethod
    def counted(cls, rows: np.ndarray, columns: np.ndarray, height: int, width: int) -> "Csr":
        """How often each place is named."""
        key, n = np.unique(rows.astype(np.int64) * width + columns, return_counts=True)
        return cls(np.searchsorted(key, np.arange(height + 1) * width), key % max(1, width), n, width)

    @property
    def rows(self) -> np.ndarray:
        """The row of each value."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> "Csr":
        order = np.argsort(self.columns, kind="stable")
        starts = np.searchsorted(self.columns[order], np.arange(self.width + 1))
        return Csr(starts, self.rows[order], self.values[order], len(self.starts) - 1)

    def times(self, other: "Csr", terms: int = TERMS) -> "Csr":
        """The product, by rows; ``terms`` are added up at once, or those of one row."""
        sizes = np.diff(other.starts)
        per_row = np.cumsum(sums(sizes[self.columns], self.starts))
        height, first, parts = len(self.starts) - 1, 0, []
        while first < height:
            last = max(first + 1, int(np.searchsorted(per_row, (per_row[first - 1] if first else 0) + terms, "right")))
            at = slice(self.starts[first], self.starts[last])
            named = self.columns[at]
            row = np.repeat(np.arange(first, last), np.diff(self.starts[first : last + 1]))
            taken = ranges(other.starts[named], sizes[named])
            key = np.repeat(row, sizes[named]) * other.width + other.columns[taken]
            value = np.repeat(self.values[at], sizes[named]) * other.values[taken]
            order = np.argsort(key)
            key = key[order]
            new = np.flatnonzero(np.diff(key, prepend=-1))
            parts.append((key[new], np.add.reduceat(value[order], new) if len(new) else value))
            first = last
        key, value = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
        return Csr(np.searchsorted(key, np.arange(height + 1) * other.width), key % max(1, other.width), value, other.width)


def incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes: the i-th token covers the bytes up to ``ends[i]`` that no token before it covers."""
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(total), np.ones(total, np.int64), total)


def groups(overlap: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of either side, from their overlap links."""
    first, last = overlap.columns[overlap.starts[:-1]], overlap.columns[overlap.starts[1:] - 1]
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > last[:-1]
    left, right = np.cumsum(new) - 1, np.zeros(overlap.width, np.int64)
    right[overlap.columns] = left[overlap.rows]
    return left, right


# --- words ----------------------------------------------------------------------------------------------------------


class _Bytes:
    """The bytes that the tokens of a vocabulary stand for, by id."""

    def __init__(self, spelled: list[bytes]):
        self.size = np.array([len(s) for s in spelled], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(spelled), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.start[ids], self.size[ids])]


class Vocabularies:
    """Both vocabularies in a task, loaded from their files at first use."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Tokenizer(path_a, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        known = self.a.token_bytes
        self.bytes_a = _Bytes([known.get(i, b"") for i in range(max(known) + 1)])
        self.bytes_b = _Bytes([self._spelled(i) for i in range(self.b.GetPieceSize())])

    def _spelled(self, i: int) -> bytes:
        piece = self.b.IdToPiece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.IsByte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Ids of A and of B, each with where a text's begin, and whether both spell the text; texts begin with a space."""
        sides = []
        values = pa.array(texts, pa.large_string())
        wanted, places = text_bytes(values)
        right = np.ones(len(texts), bool)
        lists = self.b.encode([t[1:] for t in texts], num_threads=1)
        of_b = np.fromiter((i for each in lists for i in each), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))
        for (ids, counts), spelled in ((self.a.each(values), self.bytes_a), (of_b, self.bytes_b)):
            ids, edges = ids.astype(np.int64), np.concatenate([[0], np.cumsum(counts)])
            sizes, found = sums(spelled.size[ids], edges), spelled.of(ids)
            same = sizes == np.diff(places)
            begins, counts = (np.cumsum(sizes) - sizes)[same], sizes[same]
            equal = found[ranges(begins, counts)] == wanted[ranges(places[:-1][same], counts)]
            same[same] = sums(equal, np.concatenate([[0], np.cumsum(counts)])) == counts
            right &= same
            sides.append((ids, edges))
        return sides[0], sides[1], right


def _texts_of_groups(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, first: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2`` for each word, whose groups are those from ``first[i]`` on."""
    side = np.repeat([0, 1], [len(a), len(b)])
    place = np.concatenate([group_a, group_b]) * 2 + side
    order = np.argsort(place, kind="stable")
    place, names = place[order], list(map(str, np.concatenate([a, b])[order].tolist()))
    marks = np.where(place[1:] == place[:-1], 0, np.where(place[1:] & 1, 1, 2))
    parts = [""] * (2 * len(names))
    parts[::2] = names
    parts[1:-1:2] = [",|;"[m] for m in marks.tolist()]
    ends = np.searchsorted(place, 2 * first).tolist()
    return ["".join(parts[2 * s : 2 * e - 1]) for s, e in zip(ends[:-1], ends[1:], strict=True)]


def _words(column: pa.Array, vocabularies: Vocabularies):
    """Distinct words, for each text its words' numbers on end and where they begin; those of texts that cannot be
    aligned are left out. With the words' tokens."""
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    places = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
    spaced = np.full(int(places[-1]), 32, np.uint8)
    spaced[ranges((places[1:] - sizes), sizes)] = data
    cut, firsts = units(spaced, places, _SPACE_ONLY)
    encoded = cut.dictionary_encode()
    texts, codes = encoded.dictionary.cast(pa.large_string()).to_pylist(), encoded.indices.to_numpy().astype(np.int64)
    a, b, right = vocabularies.encode(texts)
    wrong = np.flatnonzero(sums(~right[codes], firsts)) if not right.all() else ()
    if len(wrong):
        # these texts are one word each
        whole = [bytes(spaced[places[i] : places[i + 1]]).decode() for i in wrong]
        per_text = [codes[x:y] for x, y in zip(firsts[:-1], firsts[1:], strict=True)]
        a, b, right = vocabularies.encode(texts + whole)
        for n, i in enumerate(wrong):
            code = len(texts) + n
            per_text[i] = np.array([code] if right[code] else [], np.int64)
        codes, firsts = np.concatenate(per_text), np.concatenate([[0], np.cumsum([len(c) for c in per_text])])
        # words that no text uses any more and that neither side spells
        used = np.unique(codes)
        a, b = _picked(a, used), _picked(b, used)
        codes = np.searchsorted(used, codes)
    return a, b, codes, firsts


def _picked(side, used):
    ids, edges = side
    counts = np.diff(edges)[used]
    return ids[ranges(edges[:-1][used], counts)], np.concatenate([[0], np.cumsum(counts)])


def _aligned(column: pa.Array, vocabularies: Vocabularies) -> tuple[dict[str, np.ndarray], list[str], Csr, np.ndarray]:
    """Counts and groups of each text, its links by id pair, and the pairs (A's id times 2^32 plus B's id)."""
    (a, edges_a), (b, edges_b), codes, firsts = _words(column, vocabularies)
    height, n_words = len(firsts) - 1, len(edges_a) - 1
    ends_a, ends_b = np.cumsum(vocabularies.bytes_a.size[a]), np.cumsum(vocabularies.bytes_b.size[b])
    overlap = incidence(ends_a).times(incidence(ends_b).transposed())
    group_a, group_b = groups(overlap)
    n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
    # rows: the ids of A in each word
    word_a = np.repeat(np.arange(n_words), np.diff(edges_a))
    ids, row = np.unique((word_a << 32) | a, return_inverse=True)
    shared = Csr.counted(row, group_a, len(ids), n_groups).times(Csr.counted(group_b, b, n_groups, len(vocabularies.bytes_b.size)))
    pairs, pair = np.unique(((ids & 0xFFFFFFFF)[shared.rows] << 32) | shared.columns, return_inverse=True)
    by_word = Csr(np.searchsorted((ids >> 32)[shared.rows], np.arange(n_words + 1)), pair, shared.values, len(pairs))
    text = np.repeat(np.arange(height), np.diff(firsts))
    links = Csr.counted(text, codes, height, n_words).times(by_word)
    first_group = np.concatenate([group_a[edges_a[:-1]], [n_groups]])
    written = _texts_of_groups(a, b, group_a, group_b, first_group)
    spelled = [";".join([written[c] for c in codes[x:y].tolist()]) for x, y in zip(firsts[:-1], firsts[1:], strict=True)]
    overlaps = sums(np.diff(overlap.starts), edges_a)
    per_word = [np.diff(edges_a), np.diff(edges_b), np.diff(first_group), overlaps]
    measures = {name: sums(n[codes], firsts) for name, n in zip(_MEASURES, per_word, strict=False)}
    return measures | {"n_links": sums(links.values, links.starts)}, spelled, links, pairs


# --- chunks ---------------------------------------------------------------------------------------------------------


def _packed_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked_table(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _chunks(batches, path_a, path_b, keep_groups):
    vocabularies, number = None, TaskContext.get().partitionId() << 33
    for batch in batches:
        vocabularies = vocabularies or Vocabularies(path_a, path_b)
        for chunk in chunks(batch, size=CHUNK_TEXT):
            measures, spelled, links, pairs = _aligned(chunk.column("text"), vocabularies)
            columns = {"row": chunk.column("row")} | {n: pa.array(measures[n], pa.int64()) for n in _MEASURES}
            columns["groups_sha256"] = pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled], pa.string())
            if keep_groups:
                columns["groups"] = pa.array(spelled, pa.large_string())
            columns["pairs"] = pa.LargeListArray.from_arrays(pa.array(links.starts, pa.int64()), pa.array(links.columns, pa.int32()))
            columns["links"] = pa.LargeListArray.from_arrays(pa.array(links.starts, pa.int64()), pa.array(links.values, pa.int64()))
            holders = pa.table({"pair": pa.array(pairs, pa.int64()), "documents": pa.array(np.bincount(links.columns, minlength=len(pairs)), pa.int64())})
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([_packed_table(pa.table(columns))], pa.binary()), pa.array([_packed_table(holders)], pa.binary())],
                names=["chunk", "docs", "pairs"],
            )
            number += 1


def _pairs(batches):
    for batch in batches:
        for number, raw in zip(batch.column("chunk").to_pylist(), batch.column("pairs"), strict=True):
            table = _unpacked_table(raw.as_py())
            if table.num_rows:
                table = table.append_column("chunk", pa.array(np.full(table.num_rows, number), pa.int64()))
                yield from table.select(["chunk", "pair", "documents"]).to_batches()


def _counted(chunked: DataFrame) -> DataFrame:
    """Each id pair of the corpus (``pair``), the documents that hold it, and whether that is the most of its A id."""
    found = chunked.select("chunk", "pairs").mapInArrow(_pairs, "chunk long, pair long, documents long")
    counts = stored(found.groupBy("pair").agg(F.sum("documents").alias("documents")).withColumn("a", F.shiftright("pair", 32)), "pairs")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return stored(counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best")), "pairs")


def _judged(of_chunk: pa.Table, of_pairs: pa.Table, schema: pa.Schema) -> pa.Table:
    """Documents of a chunk with what the corpus says of their links."""
    table = _unpacked_table(of_chunk.column("docs")[0].as_py())
    order = np.argsort(of_pairs.column("pair").to_numpy())
    documents, best = (of_pairs.column(c).to_numpy()[order].astype(np.int64) for c in ("documents", "best"))
    lists = [table.column(c).combine_chunks() for c in ("pairs", "links")]
    starts, pair, links = lists[0].offsets.to_numpy(), lists[0].values.to_numpy(), lists[1].values.to_numpy()
    out = table.drop_columns(["pairs", "links"])
    out = out.append_column("n_best", pa.array(sums(links * best[pair], starts), pa.int64()))
    out = out.append_column("count_sum", pa.array(sums(links * documents[pair], starts), pa.int64()))
    give_back()
    return out.select(schema.names).cast(schema)


def _chunked(docs: DataFrame, text: str, carried: list[str], vocabulary: str, model: str, keep_groups: bool) -> tuple[DataFrame, tuple[str, pa.DataType]]:
    given = packed(docs, text, carried)
    made = given.mapInArrow(lambda batches: _chunks(batches, vocabulary, model, keep_groups), "chunk long, docs binary, pairs binary")
    return stored(made, "alignment"), row_type(given)


def align(docs: DataFrame, vocabulary: str, model: str, carried: list[str], text: str = "text", keep_groups: bool = False) -> DataFrame:
    """How the tokens of two vocabularies fit together in each row's text; ``vocabulary`` is the path of a byte-level
    tokeniser file (A), ``model`` that of a sentencepiece model (B).

    Columns: ``carried`` as one struct ``row`` (see ``arrow.unpacked``); ``n_a`` and ``n_b`` (tokens), ``n_groups``,
    ``n_overlaps`` (pairs of tokens that share a byte), ``n_links`` (pairs of tokens in a group), ``n_best`` (links
    whose id pair no other pair of that A id outnumbers in documents), ``count_sum`` (documents of a link's id pair,
    over all links), ``groups_sha256`` and, where ``keep_groups``, ``groups``: ids as ``a1,a2|b1;a3|b2,b3``.

    Texts that are null, empty, or not spelled by their tokens have none: zeros and an empty string. Strings of added
    tokens are plain text. Repeated rows count as a document each; an empty table gives no rows. Memory: a chunk.
    """
    chunked, (row, arrow_row) = _chunked(docs, text, carried, vocabulary, model, keep_groups)
    pairs = chunked.select("chunk", "pairs").mapInArrow(_pairs, "chunk long, pair long, documents long").select("chunk", "pair")
    # both sides are read from tables, so that Spark can split a pair that very many chunks have
    back = pairs.join(_counted(chunked), "pair")
    kinds = {n: ("long", pa.int64()) for n in [*_MEASURES, "n_best", "count_sum"]}
    kinds |= {n: ("string", pa.string()) for n in ["groups_sha256", *(["groups"] if keep_groups else [])]}
    out = f"row {row}, " + ", ".join(f"{n} {kind}" for n, (kind, _) in kinds.items())
    schema = pa.schema([("row", arrow_row), *[(n, kind) for n, (_, kind) in kinds.items()]])
    sides = chunked.select("chunk", "docs").groupBy("chunk").cogroup(back.groupBy("chunk"))
    return sides.applyInArrow(lambda of_chunk, of_pairs: _judged(of_chunk, of_pairs, schema), out)


def id_pairs(docs: DataFrame, vocabulary: str, model: str, text: str = "text") -> DataFrame:
    """The id pairs that the corpus links: ``a``, ``b``, ``documents`` that hold the pair, and whether it is the
    ``best`` of its A id, ties included."""
    counted = _counted(_chunked(docs, text, [], vocabulary, model, False)[0])
    return counted.select(F.shiftright("pair", 32).alias("a"), F.expr("pair & 4294967295").alias("b"), "documents", "best")
