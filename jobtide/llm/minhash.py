"""Near-duplicate classes by ProbMinHash over weighted word shingles.

Signature: every shingle is the source of a Poisson process whose rate is its weight; each arrival falls on a random
component of the signature, and a component keeps the shingle that arrived first. A document is done as soon as the
next arrivals come after the last component was filled. Two documents agree in a component with the probability
Jaccard similarity of their shingles. A text that repeats shingles has a second signature, from equal weights, that
agrees with the set Jaccard similarity; for one that repeats none both are the same.

Candidates: bands of components; documents that share a band's values in either signature meet in a bucket. In each bucket all documents
are compared with one of them, the hub. Links make classes, and buckets of a single class are done, however large. In
what is left, documents of different classes are compared block by block, and only links leave a block: its largest
class is cut into blocks that meet the blocks of the others, so no block grows with the bucket. Buckets are never
capped. A pair is judged in the first band it shares.

Verification computes the similarity of each candidate pair from the texts; only verified links make classes.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.arrow import chunks, give_back, quoted, ranges, words
from jobtide.sinks.scratch import Steps, stored

SHINGLE, THRESHOLD = 5, 0.8
#: A pair at the threshold, by either similarity, shares no band of that signature once in 300,000 times.
BANDS, ROWS = 32, 5
#: Documents of a block, and the share of equal components below which, in both signatures, a pair in it is no
#: candidate: a pair at the threshold stays below once in 200,000 times.
BLOCK, LIKELY = 512, 0.66

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_NONE = (1 << 63) - 1


def _mixed(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    key = (key ^ (key >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return key ^ (key >> np.uint64(31))


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text as hashes: text, hash and count, sorted by text and hash.

    Words are as in ``arrow.words``; a text of fewer words than ``size`` has one shingle of all its words.
    """
    found, firsts = words(column)
    encoded = found.dictionary_encode()
    by_word = np.array([xxhash.xxh64_intdigest(w) for w in encoded.dictionary.to_pylist()], np.uint64)
    code = by_word[encoded.indices.to_numpy()] if len(found) else by_word
    counts = np.diff(firsts)
    windows = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    text, at = np.repeat(np.arange(len(counts)), windows), ranges(firsts[:-1], windows)
    key = np.minimum(counts, size)[text].astype(np.uint64)
    for step in range(size):
        inside = at + step < firsts[text + 1]
        value = np.where(inside, code[np.minimum(at + step, len(code) - 1)], np.uint64(0)) if len(code) else key
        key = (key ^ value) * _M1
        key ^= key >> np.uint64(32)
    key = _mixed(key)
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    return text[starts], key[starts], np.diff(np.append(starts, len(key)))


def weights(counts: np.ndarray) -> np.ndarray:
    """Weight of a shingle by how often its text has it."""
    return 1 + np.log(counts)


def signatures(text: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """ProbMinHash of ``n`` texts (a row each) from their shingles; the row of a text without any is all 0."""
    first = np.full((n, size), np.inf)
    out = np.zeros((n, size), np.uint64)
    arrived, made, at_once = np.zeros(len(key)), 0, 1
    last = np.full(n, np.inf)
    while len(key):
        # the next arrivals of each shingle still in play, at times that add up exponential waits
        number = np.arange(made, made + at_once, dtype=np.uint64)
        bits = _mixed((key[:, None] + (number + np.uint64(1)) * _M1) * _M2)
        wait = -np.log(((bits >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / weight[:, None]
        wait[:, 0] += arrived
        time = np.cumsum(wait, axis=1)
        place = (_mixed(bits ^ _M2) % np.uint64(size)).astype(np.int64) + text[:, None] * size
        time_flat, place_flat = time.ravel(), place.ravel()
        better = np.flatnonzero(time_flat < first.ravel()[place_flat])
        # the earliest is written last
        better = better[np.argsort(-time_flat[better], kind="stable")]
        first.ravel()[place_flat[better]] = time_flat[better]
        out.ravel()[place_flat[better]] = key[better // at_once]
        touched = np.unique(text)
        last[touched] = first[touched].max(axis=1)
        arrived = time[:, -1]
        going = arrived <= last[text]
        text, key, weight, arrived = text[going], key[going], weight[going], arrived[going]
        made += at_once
        at_once = min(2 * at_once, 64)
    return out


def similarities(pair: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability Jaccard and set Jaccard of ``n`` pairs, from the two weights of each shingle that either text has."""
    both = (x > 0) & (y > 0)
    union, shared = np.bincount(pair, minlength=n), np.bincount(pair[both], minlength=n)
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.lexsort((ratio, pair))
    pair, x, y, ratio, both = pair[order], x[order], y[order], ratio[order], both[order]
    starts = np.searchsorted(pair, np.arange(n + 1))
    before_x, before_y = (np.concatenate([[0.0], np.cumsum(v)]) for v in (x, y))
    total = before_x[starts[pair + 1]]
    # sum over all shingles of the larger of the two, after the second text is scaled to agree in this one
    scaled = np.where(both, ratio, 0.0)
    larger = (total - before_x[:-1]) + scaled * (before_y[:-1] - before_y[starts[pair]])
    terms = np.divide(x, larger, out=np.zeros(len(x)), where=both)
    return np.bincount(pair, weights=terms, minlength=n), shared / np.maximum(union, 1)


def _both_signatures(text: np.ndarray, key: np.ndarray, counts: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures by damped counts and by equal weights, and which texts repeat a shingle, so that the two differ."""
    weighted = signatures(text, key, weights(counts), n, size)
    again = np.bincount(text[counts > 1], minlength=n) > 0
    plain, number = weighted, np.cumsum(again) - 1
    if again.any():
        of = again[text]
        plain = weighted.copy()
        plain[again] = signatures(number[text[of]], key[of], np.ones(int(of.sum())), int(again.sum()), size)
    return weighted, plain, again


def _band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    hashed = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _M2, (len(found), 1))
    for row in range(rows):
        hashed = _mixed((hashed ^ found[:, row * bands : (row + 1) * bands]) * _M1)
    return hashed


def _sign(batches, bands, rows, shingle):
    for batch in batches:
        for chunk in chunks(batch):
            text, key, counts = shingles(chunk.column("text"), shingle)
            n = chunk.num_rows
            weighted, plain, again = _both_signatures(text, key, counts, n, bands * rows)
            has = np.bincount(text, minlength=n) > 0
            # keys by equal weights follow, null where they are the same
            keys, second = _band_keys(weighted, bands, rows), np.zeros((n, bands), np.uint64)
            second[again] = _band_keys(plain[again], bands, rows)
            given = np.repeat(np.stack([has, again], axis=1), bands, axis=1)
            null = np.concatenate([np.zeros((n, bands), bool), second == keys], axis=1)[given]
            values = pa.array(np.concatenate([keys, second], axis=1)[given].view(np.int64), mask=null)
            places = np.concatenate([[0], np.cumsum((has.astype(int) + again) * bands)]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(places), values)
            yield pa.RecordBatch.from_arrays([chunk.column("id"), chunk.column("digest"), keys], names=["id", "digest", "keys"])


def _pair_similarities(pair, key, weight, second, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``similarities`` of ``n`` pairs from the shingles of their first and second texts."""
    order = np.lexsort((key, pair))
    pair, key, weight, second = pair[order], key[order], weight[order], second[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])
    group = np.cumsum(new) - 1
    x, y = (np.bincount(group, weights=weight * side, minlength=int(new.sum())) for side in (~second, second))
    return similarities(pair[new], x, y, n)


def _verify(batches, threshold, shingle):
    for batch in batches:
        for chunk in chunks(batch, "text_a"):
            sides = [shingles(chunk.column(c), shingle) for c in ("text_a", "text_b")]
            pair, key = (np.concatenate([side[i] for side in sides]) for i in (0, 1))
            weight = np.concatenate([weights(side[2]) for side in sides])
            second = np.repeat([False, True], [len(side[0]) for side in sides])
            weighted, plain = _pair_similarities(pair, key, weight, second, chunk.num_rows)
            linked = np.maximum(weighted, plain) >= threshold
            yield pa.RecordBatch.from_arrays([chunk.column("a"), chunk.column("b"), pa.array(weighted), pa.array(plain), pa.array(linked)], names=["a", "b", "weighted", "plain", "linked"])


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _block_links(table: pa.Table, bands: int, rows: int, threshold: float, shingle: int, likely: float) -> pa.Table:
    """Links between the classes of a block, from its members' texts: ``band``, ``side``, ``node``, ``class``, ``text``.

    Where the block is one of two sides, only pairs across are judged.
    """
    node, kind, side = (table.column(c).to_numpy() for c in ("node", "class", "side"))
    band = table.column("band")[0].as_py()
    text, key, counts = shingles(table.column("text").combine_chunks(), shingle)
    weight = weights(counts)
    weighted, plain, again = _both_signatures(text, key, counts, len(node), bands * rows)
    first, last = np.searchsorted(text, np.arange(len(node))), np.searchsorted(text, np.arange(len(node)), "right")
    two_sides = side.min() != side.max()
    pairs = []
    for a in range(len(node) - 1):
        others = np.arange(a + 1, len(node))
        others = others[(kind[others] != kind[a]) & ((side[others] != side[a]) | (not two_sides))]
        equal = weighted[others] == weighted[a]
        near = equal.mean(axis=1) >= likely
        shared = equal.reshape(-1, rows, bands).all(axis=1)
        if again[a] or again[others].any():
            equal = plain[others] == plain[a]
            near |= equal.mean(axis=1) >= likely
            shared |= equal.reshape(-1, rows, bands).all(axis=1)
        here = others[near & shared.any(axis=1) & (shared.argmax(axis=1) == band)]
        pairs.append(np.stack([np.full(len(here), a), here]))
    left, right = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    links = []
    step = max(1, (1 << 19) // max(1, int((last - first).max(initial=1))))
    for at in range(0, len(left), step):
        i, j = left[at : at + step], right[at : at + step]
        of = np.concatenate([ranges(first[i], (last - first)[i]), ranges(first[j], (last - first)[j])])
        sizes = (last - first)[i], (last - first)[j]
        pair = np.concatenate([np.repeat(np.arange(len(i)), size) for size in sizes])
        second = np.repeat([False, True], [size.sum() for size in sizes])
        linked = np.maximum(*_pair_similarities(pair, key[of], weight[of], second, len(i))) >= threshold
        links.append(np.stack([node[i[linked]], node[j[linked]]]))
    a, b = np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)
    if len(node) > 100:
        give_back()
    return pa.table([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], schema=_LINKS)


def components(links: DataFrame, steps: Steps) -> DataFrame:
    """The least node that each linked node is connected with: ``node``, ``class``. Links: ``a``, ``b``.

    In rounds, each node takes the least of itself and its neighbours for its class, and then the class of that; links
    inside a class go, and the others become links between classes. After the first round few are left. Each round is
    a stored table; at the end the classes of all rounds are chained.
    """
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    left, rounds = steps.stored(links.where("a != b").select(*ends).distinct(), "links"), []
    while not rounds or not left.isEmpty():
        near = left.select("a", "b").union(left.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        near = steps.stored(near.select("node", F.least("node", "near").alias("next")), "labels")
        jump = near.select(F.col("node").alias("next"), F.col("next").alias("class"))
        rounds.append(steps.stored(near.join(jump, "next").select("node", "class"), "labels"))
        of_a, of_b = (rounds[-1].select(F.col("node").alias(c), F.col("class").alias(f"class_{c}")) for c in ("a", "b"))
        moved = left.join(of_a, "a").join(of_b, "b").where("class_a != class_b")
        left = steps.stored(moved.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")).distinct(), "links")
    found = rounds[0]
    for later in rounds[1:]:
        found = found.join(later.select(F.col("node").alias("class"), F.col("class").alias("next")), "class", "left").select("node", F.coalesce("next", "class").alias("class"))
    return steps.stored(found, "components")


def _with_hubs(members: DataFrame, steps: Steps, label: str) -> DataFrame:
    """Members (``key``, ``band``, ``node``) of buckets with two nodes or more, and the least node of their bucket."""
    hubs = members.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("most")).where("hub != most")
    return steps.stored(members.join(steps.stored(hubs.select("key", "hub"), "hubs"), "key"), label)


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of each bucket's hub and its other nodes."""
    return members.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def _blocks(members: DataFrame, found: DataFrame, steps: Steps, block: int) -> DataFrame:
    """Members of buckets with several classes, dealt to blocks: ``key``, ``band``, ``pair``, ``side``, ``node``, ``class``.

    A small bucket is one block. In a larger one the largest class and the others are cut into pieces; each piece of
    the others meets each piece of the largest class and each of the others.
    """
    placed = members.select("key", "band", "node").join(found, "node", "left").select("key", "band", "node", F.coalesce("class", "node").alias("class"))
    placed = steps.stored(placed, "placed")
    by_class = placed.groupBy("key", "class").agg(F.count("*").alias("n"))
    buckets = by_class.groupBy("key").agg(F.count("*").alias("classes"), F.sum("n").alias("size"), F.max(F.struct("n", "class")).alias("most")).where("classes > 1")
    buckets = steps.stored(buckets.select("key", "size", F.col("most.class").alias("largest"), F.col("most.n").alias("n")), "mixed")
    dealt = placed.join(buckets, "key")
    big, inner, outer = F.col("size") > block, F.ceil(F.col("n") / block), F.ceil((F.col("size") - F.col("n")) / block)
    is_inner = F.col("class") == F.col("largest")
    piece = F.pmod(F.xxhash64("node"), F.when(is_inner, inner).otherwise(outer))

    def with_each(count, pair):
        return F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), pair)

    def blocks_of(a, b, side):
        return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), side.alias("side"))

    own = piece.cast("int")
    across = F.when(is_inner, with_each(outer, lambda o: blocks_of(own, o, F.lit(0)))).otherwise(with_each(inner, lambda i: blocks_of(i, own, F.lit(1))))
    # pieces of the others are numbered on from -1 downwards, the lower number first
    among = with_each(outer, lambda o: blocks_of(-1 - F.least(o, own), F.greatest(o, own), (own > o).cast("int")))
    all_of = F.when(~big, F.array(blocks_of(F.lit(0), F.lit(0), F.lit(0)))).when(is_inner, across).otherwise(F.concat(across, among))
    return dealt.select("key", "band", "node", "class", F.explode(all_of).alias("pair")).select("key", "band", "node", "class", F.col("pair.a").alias("one"), F.col("pair.b").alias("two"), F.col("pair.side").alias("side"))


def _classed(given: DataFrame, steps: Steps, threshold: float, shingle: int, bands: int, rows: int, block: int, likely: float) -> tuple[DataFrame, DataFrame]:
    """The rows of ``given`` (``id``, ``text``) as ``id`` and ``digest``, and the classes of their texts.

    Each distinct text that is not empty has a node of its own, whatever its ids: ``digest``, ``id`` (the least) and
    ``class`` (a node of its class). The digest of null and empty texts is null.

    Texts are joined by sorting at every size, so that what is shuffled grows as the input does. Those of documents
    that share no band with another leave the first such join.
    """
    stored = steps.stored
    signed = given.select("id", F.md5("text").alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    signed = signed.withColumn("digest", F.when(F.col("text") != "", F.col("digest")))
    signed = stored(signed.mapInArrow(lambda batches: _sign(batches, bands, rows, shingle), "id long, digest string, keys array<long>"), "signed")
    whole = signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id"), F.any_value("keys").alias("keys"))
    whole = stored(whole.withColumn("node", F.monotonically_increasing_id()), "texts")
    shared = _with_hubs(whole.select("node", F.posexplode("keys").alias("band", "key")).where("key IS NOT NULL").withColumn("band", F.col("band") % bands), steps, "buckets")
    wanted = shared.select("node").distinct().join(whole, "node").select("node", F.col("digest").alias("of"), F.col("id").alias("least"))
    wanted = stored(wanted, "wanted")
    # a text is read from the row with its least id
    own = given.where("text != ''").join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("least")) & (F.md5("text") == F.col("of"))).select("node", "text")
    texts = stored(own.distinct(), "candidates")
    pairs = stored(_stars(shared), "pairs")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")
    judged = joined.mapInArrow(lambda batches: _verify(batches, threshold, shingle), "a long, b long, weighted double, plain double, linked boolean")
    links = stored(judged.where("linked").select("a", "b"), "links")
    found = components(links, steps)
    dealt = stored(_blocks(shared, found, steps, block), "blocks").join(texts.hint("merge"), "node")
    more = dealt.groupBy("key", "one", "two").applyInArrow(lambda t: _block_links(t, bands, rows, threshold, shingle, likely), "a long, b long")
    more = stored(more.distinct(), "links")
    if not more.isEmpty():
        found = components(links.union(more), steps)
    placed = whole.join(found, "node", "left").select("digest", "id", F.coalesce("class", "node").alias("class"))
    return signed.select("id", "digest"), stored(placed, "classed")


def _given(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(quoted(doc_id).cast("long").alias("id"), quoted(text).cast("string").alias("text"))


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    likely: float = LIKELY,
) -> DataFrame:
    """``doc_id`` and ``class_id`` for each row of ``docs``: the least id of the documents it is linked with.

    Equal texts are linked, and texts whose shingles have a similarity of ``threshold``, weighted by their counts
    (probability Jaccard) or not. ``doc_id`` is a whole number. Null and empty texts are linked with nothing; texts
    without words only with equal ones. Rows of the same id are one document: they share a class. Rows without an id
    are documents of their own, and a class of such rows only has no id. An empty table gives no rows.
    """
    with Steps(docs.sparkSession) as steps:
        stored = steps.stored
        signed, texts = _classed(_given(docs, doc_id, text), steps, threshold, shingle, bands, rows, block, likely)
        placed = stored(signed.join(texts.select("digest", "class"), "digest", "left").select("id", "class"), "rows")
        # unlike texts of one id
        several = placed.where("id IS NOT NULL AND class IS NOT NULL").groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("most")).where("a != most")
        same = stored(placed.join(several.select("id", "a"), "id").where("class != a").select("a", F.col("class").alias("b")).distinct(), "links")
        if not same.isEmpty():
            merged = components(same, steps).withColumnRenamed("class", "all")
            placed = stored(placed.join(merged, placed["class"] == merged["node"], "left").select("id", F.coalesce("all", "class").alias("class")), "rows")
        full, empty = placed.where("class IS NOT NULL"), placed.where("class IS NULL").select("id")
        named = full.join(full.groupBy("class").agg(F.min("id").alias("class_id")), "class").select("id", "class_id")
        if not empty.isEmpty():
            by_id = named.where("id IS NOT NULL").join(empty.distinct(), "id", "left_semi").groupBy("id").agg(F.min("class_id").alias("class_id"))
            named = named.union(empty.join(by_id, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id")))
        found = stored(named.withColumnRenamed("id", "doc_id"), "classes")
        steps.keep(found)
    return found


def _rows_of(docs: DataFrame, kept: DataFrame, doc_id: str, text: str, by_text: bool) -> DataFrame:
    """A row of ``docs`` for each of ``kept`` (``id``, ``copies`` and, where ``by_text``, ``digest``): that of the least text."""
    key, own = quoted(doc_id).cast("long"), F.md5(F.coalesce(quoted(text).cast("string"), F.lit("")))
    names = [F.col("id").alias("_kept_id"), *([F.col("digest").alias("_kept_digest")] if by_text else [])]
    same = key.eqNullSafe(F.col("_kept_id")) & ((own == F.col("_kept_digest")) if by_text else F.lit(True))
    single, several = kept.where("copies = 1").select(names), kept.where("copies > 1").select(names)
    # the kept are most documents, so the plan is the same at every size
    out = docs.join(single.hint("merge"), same).drop("_kept_id", "_kept_digest")
    if not several.isEmpty():
        again = docs.join(several, same).drop("_kept_id", "_kept_digest")
        first = Window.partitionBy(key, *([own] if by_text else [])).orderBy(quoted(text))
        out = out.union(again.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place"))
    return out


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class, the one with the least id; columns as they were.

    Documents are told apart by their ids only: of several rows with that id the one with the least text stays, and of
    all rows without an id one. ``keep_texts`` loses no unlike text of theirs.
    """
    placed = classes(docs, doc_id, text, **options)
    kept = placed.where(F.equal_null("doc_id", "class_id")).groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("copies"))
    return _rows_of(docs, stored(kept, "kept"), doc_id, text, False)


def keep_texts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    likely: float = LIKELY,
) -> DataFrame:
    """``docs`` with one row of each class of texts, columns as they were: that of the least id, and then digest.

    Classes are those of texts alone, so unlike texts of one id, or without an id, all stay. Rows without an id come
    after the others. Of rows with a null or empty text one stays for each id.
    """
    with Steps(docs.sparkSession) as steps:
        signed, texts = _classed(_given(docs, doc_id, text), steps, threshold, shingle, bands, rows, block, likely)
        best = texts.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("without"), "id", "digest")).alias("row")).select("row.id", "row.digest")
        counted = signed.groupBy("id", "digest").agg(F.count("*").alias("copies"))
        best = best.withColumnsRenamed({"id": "best_id", "digest": "best_digest"})
        kept = counted.join(best, (F.col("digest") == F.col("best_digest")) & F.col("id").eqNullSafe(F.col("best_id")), "left")
        kept = kept.where("best_digest IS NOT NULL OR digest IS NULL").select("id", F.coalesce("digest", F.md5(F.lit(""))).alias("digest"), "copies")
        kept = steps.stored(kept, "kept")
        steps.keep(kept)
    return _rows_of(docs, kept, doc_id, text, True)
