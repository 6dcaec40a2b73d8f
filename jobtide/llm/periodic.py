"""Runs of words that repeat with a period, found in a grammar of the texts.

A run is a stretch of words with smallest period q, of 2q words and ``least`` words or more, that no neighbouring word
extends with that period. The texts of a chunk are compressed together:

1. Re-Pair over word ids: in rounds, each occurrence of a repeated pair whose pair is more frequent than those it
   overlaps with becomes a nonterminal. What is left of a text is joined by a balanced tree of nodes.
2. Each nonterminal is a left and a right part. The runs that cross this boundary are found once, at one place where
   the nonterminal stands: for each period, how far the words to both sides of the boundary agree with those a period
   further on, or before. Hashes of a few words leave few periods; sums of word hashes then give each extent.
3. The runs are carried to all places where the nonterminal stands in the texts. Every run of a text crosses the
   boundary of the least nonterminal or node that holds it, so all are there, with parts of theirs from smaller ones:
   only intervals that no other of the same period holds are kept, and of equal ones that of the smallest period.

Runs are exact: what hashes found is compared word by word, and worked out anew with others if a word differs.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from jobtide.llm.arrow import chunks, packed, ranges, row_type, runs as byte_runs, sums, text_bytes
from jobtide.llm.quality_rules import NOT_SPACE

LEAST = 12
#: Pairs of a boundary and a period that are looked at together.
BLOCK = 1 << 20
#: From this period on a run agrees over so many words on one side of a boundary at least.
_LONG, _MANY = 16, 8

_PRIMES = (2**31 - 1, 2**31 - 19)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# --- grammar --------------------------------------------------------------------------------------------------------


def _ranks(symbols: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """How frequent each of the pairs at ``at`` is: 0 for those that occur once, else rising, and apart for each pair.

    Among equally frequent pairs a hash decides. By their numbers, those of a repeated passage would rise from one to
    the next, and a round would replace one of them.
    """
    key, which, counts = np.unique(symbols[at] * size + symbols[at + 1], return_inverse=True, return_counts=True)
    order, rank = np.lexsort((_mixed(key.astype(np.uint64) * _M1), counts)), np.empty(len(key), np.int64)
    rank[order] = np.arange(1, len(key) + 1)
    rank[counts < 2] = 0
    return rank[which]


def _chosen(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` have a pair that outranks those it overlaps with; of a word that repeats itself,
    every other one."""
    near = at[1:] == at[:-1] + 1
    before, after = np.concatenate([[0], rank[:-1] * near]), np.concatenate([rank[1:] * near, [0]])
    begin = np.maximum.accumulate(np.where(before != rank, at, 0))
    return (rank > 0) & (before <= rank) & (after <= rank) & ((at - begin) % 2 == 0)


def grammar(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nonterminals and nodes of texts whose words lie on end, the i-th from ``firsts[i]`` on.

    First, boundary and end of one place of each; which nonterminal stands at a place, and where: the numbers are those
    of the first result. Nodes stand at one place.
    """
    ends_text = np.zeros(len(words) + 1, bool)
    ends_text[firsts] = True
    symbols, places = words.astype(np.int64), np.arange(len(words) + 1)
    size = int(words.max(initial=0)) + 1
    joined = ~ends_text[places[1:]]
    live = joined.copy()
    made, names, stands, n = [], [], [], 0
    while live.any():
        at = np.flatnonzero(live)
        rank = _ranks(symbols, at, size)
        taken = _chosen(at, rank)
        chosen = at[taken]
        if not len(chosen):
            break
        _, one, which = np.unique(rank[taken], return_index=True, return_inverse=True)
        named = chosen[one]
        made.append(np.stack([places[named], places[named + 1], places[named + 2]]))
        names.append(n + which)
        stands.append(places[chosen])
        symbols[chosen] = size + which
        n, size = n + len(one), size + len(one)
        # pairs that may repeat: those that did, and those with a new symbol
        live = np.zeros(len(symbols), bool)
        live[at[rank > 0]] = True
        live[chosen] = True
        live[np.maximum(chosen - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols, live, places = symbols[keep], live[keep], np.append(places[:-1][keep], len(words))
        joined = ~ends_text[places[1:]]
        live &= joined
    # what is left, two by two
    while joined.any():
        begin = np.maximum.accumulate(np.where(np.concatenate([[True], ~joined[:-1]]), np.arange(len(joined)), 0))
        left = np.flatnonzero(joined & ((np.arange(len(joined)) - begin) % 2 == 0))
        made.append(np.stack([places[left], places[left + 1], places[left + 2]]))
        names.append(n + np.arange(len(left)))
        stands.append(places[left])
        n += len(left)
        keep = np.ones(len(joined), bool)
        keep[left + 1] = False
        places = np.append(places[:-1][keep], len(words))
        joined = ~ends_text[places[1:]]
    if not made:
        return np.zeros((3, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(made, axis=1), np.concatenate(names), np.concatenate(stands)


# --- runs -----------------------------------------------------------------------------------------------------------


def _mixed(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(32))) * _M2
    return key ^ (key >> np.uint64(29))


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of ``size`` words from each place on; beyond the end as if zeros followed."""
    padded = np.concatenate([words, np.zeros(size, words.dtype)]).astype(np.uint64)
    key = np.zeros(len(words) + 1, np.uint64)
    for step in range(size):
        key = _mixed((key + padded[step : step + len(key)]) * _M1)
    return key


class _Extents:
    """How far words agree from two places on, by sums of word hashes modulo two primes."""

    def __init__(self, words: np.ndarray, seed: int):
        random = np.random.default_rng(seed)
        self.sums, self.powers = [], []
        for prime in _PRIMES:
            value = random.integers(1, prime, int(words.max(initial=0)) + 1)[words]
            power, base = np.ones(1, np.int64), int(random.integers(2, prime))
            while len(power) <= len(words):
                power = np.concatenate([power, power * pow(base, len(power), prime) % prime])
            self.powers.append(power)
            self.sums.append(np.concatenate([[0], np.cumsum(value * power[: len(words)] % prime)]) % prime)

    def equal(self, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether so many words from ``left`` on are those from ``right`` (behind it) on."""
        out = np.ones(len(left), bool)
        for prime, total, power in zip(_PRIMES, self.sums, self.powers, strict=True):
            here, there = (total[left + size] - total[left]) % prime, (total[right + size] - total[right]) % prime
            out &= here * power[right - left] % prime == there
        return out

    def ahead(self, left: np.ndarray, right: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree, ``most`` at most; where ``back``, of those before the two places."""
        low, high = np.zeros(len(left), np.int64), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            size = (low[open_] + high[open_] + 1) // 2
            shift = size if back else 0
            same = self.equal(left[open_] - shift, right[open_] - shift, size)
            low[open_[same]] = size[same]
            high[open_[~same]] = size[~same] - 1
        return low


def _crossing(words: np.ndarray, nodes: np.ndarray, least: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs at the boundary of each node, inside it: the node, and first word, end and period."""
    # words agree over the period, or what the least length has beyond it; half of that on one side
    size_few = min(_MANY, max(1, -(-least // 4)))
    few, many = _window_hashes(words, size_few), _window_hashes(words, _MANY)
    extents = _Extents(words, seed)
    of, found = [np.zeros(0, np.int64)], [np.zeros((3, 0), np.int64)]
    first, bound, end = nodes
    # a whole period lies to the right of the boundary, or to its left
    for step in (1, -1):
        periods = np.minimum(end - bound if step > 0 else bound - first, (end - first) // 2)
        periods[end - first < least] = 0
        total = np.cumsum(periods)
        node = 0
        while node < len(periods):
            last = max(node + 1, int(np.searchsorted(total, (total[node - 1] if node else 0) + BLOCK, "right")))
            for at in range(0, max(1, int(periods[node])) if last == node + 1 else 1, BLOCK):
                # one node alone may have more than a block of periods
                count = np.minimum(periods[node:last] - at, BLOCK)
                which = np.repeat(np.arange(node, last), count)
                period = ranges(np.full(last - node, at + 1), count)
                here = bound[which]
                left, right = (here, here + period) if step > 0 else (here - period, here)
                near = np.zeros(len(which), bool)
                for hashes, size, part in ((few, size_few, period < _LONG), (many, _MANY, period >= _LONG)):
                    near |= part & (hashes[left] == hashes[right])
                    near |= part & (left >= size) & (hashes[left - size] == hashes[right - size])
                which, period, left, right = which[near], period[near], left[near], right[near]
                after = extents.ahead(left, right, end[which] - right)
                before = extents.ahead(left, right, left - first[which], back=True)
                long = after + before >= np.maximum(period, least - period)
                of.append(which[long])
                found.append(np.stack([left - before, right + after, period])[:, long])
            node = last
    return np.concatenate(of), np.concatenate(found, axis=1)


def _smallest_periods(found: np.ndarray) -> np.ndarray:
    """Of equal intervals that with the smallest period, by first word and period."""
    found = found[:, np.lexsort((found[2], found[1], found[0]))]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:2, 1:] != found[:2, :-1]).any(axis=0)
    found = found[:, new]
    return found[:, np.lexsort((found[2], found[0]))]


def runs(words: np.ndarray, firsts: np.ndarray, least: int = LEAST, seed: int = 1) -> np.ndarray:
    """First word, end and period of all runs of texts whose words lie on end, the i-th from ``firsts[i]`` on."""
    nodes, names, stands = grammar(words, firsts)
    node, found = _crossing(words, nodes, least, seed)
    # to all places of the nonterminal
    order = np.argsort(names, kind="stable")
    begins = np.searchsorted(names[order], np.arange(nodes.shape[1] + 1))
    times = np.diff(begins)[node]
    shift = stands[order][ranges(begins[node], times)] - np.repeat(nodes[0][node], times)
    first, end, period = np.repeat(found, times, axis=1)
    first, end = first + shift, end + shift
    # no other interval of the period holds it
    order = np.lexsort((-end, first, period))
    found = np.stack([first, end, period])[:, order]
    reach = np.maximum.accumulate(found[2] * (len(words) + 1) + found[1])
    kept = np.ones(len(reach), bool)
    kept[1:] = reach[1:] > reach[:-1]
    found = _smallest_periods(found[:, kept])
    sizes = found[1] - found[0] - found[2]
    at = ranges(found[0], sizes)
    if not (words[at] == words[at + np.repeat(found[2], sizes)]).all():
        return runs(words, firsts, least, seed + 1)
    return found


# --- documents ------------------------------------------------------------------------------------------------------

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(batches, least):
    for batch in batches:
        for chunk in chunks(batch):
            data, offsets = text_bytes(chunk.column("text"))
            found, firsts = byte_runs(NOT_SPACE[data], offsets, data)
            words = found.dictionary_encode().indices.to_numpy().astype(np.int64)
            first, end, period = runs(words, firsts, least)
            text = np.searchsorted(firsts, first, "right") - 1
            dropped = np.zeros(len(words) + 1, np.int64)
            np.add.at(dropped, first + period, 1)
            np.subtract.at(dropped, end, 1)
            keep = np.cumsum(dropped)[:-1] == 0
            edges = pa.array(np.concatenate([[0], np.cumsum(sums(keep, firsts))]), pa.int32())
            kept = pa.ListArray.from_arrays(edges, found.filter(pa.array(keep)).cast(pa.string()))
            parts = [pa.array(a) for a in (first - firsts[text], end - first, period)]
            places = pa.array(np.searchsorted(text, np.arange(len(firsts))), pa.int32())
            listed = pa.ListArray.from_arrays(places, pa.StructArray.from_arrays(parts, fields=list(_RUN)))
            columns = [chunk.column("row"), pa.array(np.diff(firsts)), listed, pc.binary_join(kept, " ")]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "runs", "text"])


def find(docs: DataFrame, carried: list[str], text: str = "text", least: int = LEAST) -> DataFrame:
    """The runs of each row's text, and the text without their repetitions.

    Columns: ``carried`` as one struct ``row`` (see ``arrow.unpacked``); ``n_words`` (words are what white space of
    ASCII parts); ``runs`` (``start`` in words, ``length``, ``period``) by start and period; ``text``: the words that no
    run has after its first period, joined by a space. Null and empty texts have no words. Repeated rows have the same
    runs. Rows stay where they are; memory: a chunk of texts, about 500 bytes for each word of a single longer text.
    """
    given = packed(docs, text, carried)
    row, _ = row_type(given)
    out = f"row {row}, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"
    return given.mapInArrow(lambda batches: _find(batches, least), out)
