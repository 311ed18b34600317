"""Benchmark decontamination: item-sized SimHash windows by Hamming blocks, heavy shingles, and an exact check.

Windows within the radius find copies and lightly edited ones. A place can be within the similarity and its
window beyond the radius; a few shingles of each item, one of which every match holds, find these.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.scratch import documents, settle, small_batches, texts
from spanwatch.llm.words import LOWER, SHINGLE, Words, pieces, shingles

RADIUS = 7  # bits of 64 in which a window may differ from an item
BLOCKS = 4  # of 16 bits; within the radius, one block differs in RADIUS // BLOCKS bits at most
SIMILARITY = 0.8
HALVED = 26  # words from which on an item has windows of half its size too; shorter windows would cost a pass each
GROWTH = 1.25  # of one window size to the next
STEP = 1 << 15  # shingles and windows looked up at a time
SOURCES = ("windows", "shingles")
ITEMS_PER_PASS = 20_000


def window_size(words: int) -> int:
    """The largest window size that an item of so many words fills: exact up to 8, then growing."""
    size = min(words, 8)
    while size >= 8 and math.ceil(size * GROWTH) <= words:
        size = math.ceil(size * GROWTH)
    return size


def fingerprints(hashes: np.ndarray, size: int, run: np.ndarray | None = None) -> np.ndarray:
    """64-bit SimHash of each window of ``size`` words. ``run`` has running sums of the words' signs."""
    run = running_signs(hashes, size) if run is None else run
    n = len(run) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    return np.packbits((run[size:] - run[:n] > 0).reshape(-1)).view(np.uint64)


def running_signs(hashes: np.ndarray, largest: int) -> np.ndarray:
    # Differences of wrapped sums are right while a window's sum fits the type.
    kind = np.int8 if largest < 128 else np.int32
    run = np.zeros((len(hashes) + 1, 64), kind)
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8)).reshape(-1, 64).view(np.int8)
    np.cumsum(bits * np.int8(2) - np.int8(1), axis=0, dtype=kind, out=run[1:])
    return run


@dataclass
class Items:
    """Benchmark items: their ids, word hashes, and shingles with weights.

    ``shared`` has, of a benchmark in several passes, the shingles here that several items hold, and how many.
    """

    ids: list
    words: list[np.ndarray]
    shared: tuple[np.ndarray, np.ndarray] | None = None

    def index(self) -> dict[int, "Blocks"]:
        """For each window size the blocks of the items' windows: the first and the last of the item's size, and, of
        items with HALVED words, of half that size the first, the middle and the last one, of which a run of changed
        words spares one."""
        sized: dict[int, list[tuple[int, int, np.uint64]]] = {}
        for i, words in enumerate(self.words):
            whole, half = window_size(len(words)), window_size(len(words) // 2)
            places = {(whole, 0), (whole, len(words) - whole)}
            if len(words) >= HALVED:
                places |= {(half, 0), (half, (len(words) - half) // 2), (half, len(words) - half)}
            for size, shift in sorted(places):
                sized.setdefault(size, []).append((i, shift, fingerprints(words[shift : shift + size], size)[0]))
        return {size: Blocks(entries) for size, entries in sized.items()}

    def weighted(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Distinct shingles of each item; a shingle weighs 1 / (number of items that hold it)."""
        bags = [np.unique(shingles(words)) for words in self.words]
        every, n = np.unique(np.concatenate(bags), return_counts=True) if bags else (np.zeros(0), np.zeros(0))
        if self.shared is not None and len(every):
            n = np.ones(len(every), np.int64)
            at = np.searchsorted(every, self.shared[0])
            n[at] = self.shared[1]
        return [(bag, 1.0 / n[np.searchsorted(every, bag)]) for bag in bags]

    def seeds(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> dict[int, "Seeds"]:
        """For each shingle size the heaviest shingles of each item that weigh more than all it may lack."""
        sized: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, (bag, weight) in enumerate(bags):
            order = np.argsort(-weight, kind="stable")
            may_lack = (1 - SIMILARITY) * weight.sum() * (1 + 1e-9)
            n = int(np.searchsorted(np.cumsum(weight[order]), may_lack, "right")) + 1
            sized.setdefault(min(SHINGLE, len(self.words[i])), []).append((i, bag[order[:n]]))
        return {size: Seeds(entries) for size, entries in sized.items()}


class Seeds:
    """Shingles in order, and the items of each."""

    def __init__(self, entries: list[tuple[int, np.ndarray]]):
        every = np.concatenate([bag for _, bag in entries])
        item = np.repeat([i for i, _ in entries], [len(bag) for _, bag in entries])
        self.items = item[np.argsort(every, kind="stable")]
        self.hashes, n = np.unique(every, return_counts=True)
        self.starts = np.concatenate(([0], np.cumsum(n)))

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are seeds, and of which number."""
        k = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[k] == hashes)
        return hit, k[hit]


class Blocks:
    """Fingerprints by the value of each 16-bit block, and by all values one bit away."""

    def __init__(self, entries: list[tuple[int, int, np.uint64]]):
        self.item = np.array([e[0] for e in entries])
        self.shift = np.array([e[1] for e in entries])
        self.prints = np.array([e[2] for e in entries], np.uint64)
        near = np.array([0, *(1 << k for k in range(16))], np.uint16)
        self.starts, self.members, self.some = [], [], []
        for b in range(BLOCKS):
            values = (self.prints.view(np.uint16).reshape(-1, BLOCKS)[:, b, None] ^ near).reshape(-1).astype(np.int64)
            order = np.argsort(values, kind="stable")
            self.members.append(order // len(near))
            self.starts.append(np.searchsorted(values[order], np.arange((1 << 16) + 1)))
            self.some.append(np.diff(self.starts[-1]) > 0)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (window, entry) within the radius."""
        values = prints.view(np.uint16).reshape(-1, BLOCKS)
        pairs = []
        for b in range(BLOCKS):
            window = np.flatnonzero(self.some[b][values[:, b]])
            lo, hi = self.starts[b][values[window, b]], self.starts[b][values[window, b].astype(np.int64) + 1]
            n = hi - lo
            rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            entry = self.members[b][np.repeat(lo, n) + rank]
            window = np.repeat(window, n)
            close = np.bitwise_count(prints[window] ^ self.prints[entry]) <= RADIUS
            pairs.append(np.stack([window[close], entry[close]]))
        found = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return found[0], found[1]


def _near(words: Words, index: dict[int, Blocks]) -> set[tuple[int, int]]:
    """All (text, item) of a batch where a window of the text is within the radius of one of the item's."""
    pairs: set[tuple[int, int]] = set()
    largest = max(index, default=0)
    for at in range(0, len(words.hashes) if index else 0, STEP):
        part = words.hashes[at : at + STEP + largest]
        run = running_signs(part, largest)
        for size, blocks in index.items():
            window, entry = blocks.near(fingerprints(part, size, run)[:STEP])
            text = np.searchsorted(words.first, window + at, "right") - 1
            inside = window + at + size <= words.first[text + 1]
            pairs.update(zip(text[inside].tolist(), blocks.item[entry[inside]].tolist()))
    return pairs


def _candidates(words: Words, size: int, seeds: Seeds) -> set[tuple[int, int]]:
    """All (text, item) of a batch where the text holds a seed of the item."""
    pairs: set[tuple[int, int]] = set()
    for at in range(0, len(words.hashes) - size + 1, STEP):
        hit, seed = seeds.found(shingles(words.hashes[at : at + STEP + size - 1], size))
        text = np.searchsorted(words.first, hit + at, "right") - 1
        inside = hit + at + size <= words.first[text + 1]
        for i, k in set(zip(text[inside].tolist(), seed[inside].tolist())):
            pairs.update((i, item) for item in seeds.items[seeds.starts[k] : seeds.starts[k + 1]].tolist())
    return pairs


def _best_place(here: np.ndarray, length: int, bag: np.ndarray, weight: np.ndarray) -> tuple[float, int, int] | None:
    """Similarity of the best place among a text's shingles ``here``, and its first and last shared shingle.

    A place has an item's length of words and a quarter more, and begins with a shared shingle.
    Of equal places the shortest, then the first one counts.
    """
    member = np.minimum(np.searchsorted(bag, here), len(bag) - 1)
    places = np.flatnonzero(bag[member] == here)
    member = member[places]
    words = length + 2 * math.ceil(length / 8)
    end = np.searchsorted(places, places + words - min(SHINGLE, length), "right")
    upto, total = np.concatenate(([0.0], np.cumsum(weight[member]))), float(weight.sum())
    best, found = (SIMILARITY, -math.inf), None
    # A place weighs no more than all its shared shingles, repeated ones included.
    for k in np.flatnonzero(upto[end] - upto[:-1] >= SIMILARITY * total * (1 - 1e-9)).tolist():
        held = np.zeros(len(bag), bool)
        held[member[k : end[k]]] = True
        value = float(weight[held].sum() / total)
        if value >= best[0]:
            last = k + int(np.unique(member[k : end[k]], return_index=True)[1].max())
            if (value, int(places[k] - places[last])) > best:
                best = (value, int(places[k] - places[last]))
                found = (value, int(places[k]), int(places[last]))
    return found


def _best_places(words: Words, items: Items, index: dict[int, Blocks], seeds: dict[int, Seeds], bags: list
                 ) -> dict[tuple[int, int], tuple]:
    """Per (text, item) of a batch that match: similarity, and bytes from where to where."""
    pairs = _near(words, index).union(*(_candidates(words, size, some) for size, some in seeds.items()))
    best: dict[tuple[int, int], tuple] = {}
    known: dict[int, np.ndarray] = {}
    of = -1
    for i, item in sorted(pairs):
        size = min(SHINGLE, len(items.words[item]))
        if i != of:
            of, known = i, {}
        if size not in known:
            known[size] = shingles(words.of(i), size)
        found = _best_place(known[size], len(items.words[item]), *bags[item])
        if found:
            value, first, last = found
            at = int(words.first[i])
            best[i, item] = (value, int(words.starts[at + first]), int(words.ends[at + last + size - 1]))
    return best


def _scanned(batches: Iterator[pa.RecordBatch], items: Items, sources: tuple[str, ...] = SOURCES
             ) -> Iterator[tuple[pa.RecordBatch, Words, dict]]:
    bags = items.weighted()
    index = items.index() if "windows" in sources else {}
    seeds = items.seeds(bags) if "shingles" in sources else {}
    for batch in pieces(batches, "text"):
        words = Words(batch.column("text"), LOWER)
        yield batch, words, _best_places(words, items, index, seeds, bags)


def _rows(batch: pa.RecordBatch, words: Words, items: Items, best: dict) -> pa.RecordBatch:
    keys = sorted(best)
    spans = []
    for i, item in keys:
        _, start, end = best[i, item]
        head = words.data[words.offsets[i] : start].tobytes().decode()
        spans.append((len(head), len(head) + len(words.data[start:end].tobytes().decode())))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array([i for i, _ in keys], pa.int64())),
            pa.array([items.ids[item] for _, item in keys], pa.int64()),
            pa.array([best[k][0] for k in keys], pa.float64()),
            pa.array([s[0] for s in spans], pa.int32()), pa.array([s[1] for s in spans], pa.int32()),
        ],
        ["doc_id", "item_id", "similarity", "start", "end"],
    )


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        words = Words(batch.column("text"), LOWER)
        bags = [np.unique(shingles(words.of(i))) for i in range(batch.num_rows)]
        turn = np.repeat(batch.column("turn").to_numpy(zero_copy_only=False), [len(bag) for bag in bags])
        yield pa.RecordBatch.from_arrays(
            [pa.array(turn, pa.int64()), pa.array(np.concatenate(bags).view(np.int64), pa.int64())], ["turn", "shingle"]
        )


def _passes(benchmark: DataFrame) -> Iterator[Items]:
    """The items in passes of about ITEMS_PER_PASS, by a hash: what a task holds is bounded.

    Of several passes, each gets the weights that its shingles have in the whole benchmark.
    """
    known = benchmark.select("item_id", F.col("text").cast("string").alias("text")).dropna(subset=["text"]).distinct()
    n = max(1, math.ceil(known.count() / ITEMS_PER_PASS))
    known = known.withColumn("turn", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    if n > 1:
        held = settle(
            known.select("turn", "text").mapInArrow(_item_shingles, "turn long, shingle long")
            .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.collect_set("turn").alias("turns")).filter("n > 1")
        )
    for k in range(n):
        rows = known.filter(F.col("turn") == k).collect()
        shared = None
        if n > 1:
            few = held.filter(F.array_contains("turns", F.lit(k).cast("long"))).select("shingle", "n").collect()
            shared = (np.array([r["shingle"] for r in few], np.int64).view(np.uint64), np.array([r["n"] for r in few], np.int64))
        words = Words(pa.array([r["text"] for r in rows], pa.string()), LOWER)
        full = [i for i in range(len(rows)) if len(words.of(i))]
        yield Items([rows[i]["item_id"] for i in full], [words.of(i).copy() for i in full], shared)


def find_leaks(docs: DataFrame, benchmark: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """One row (doc_id, item_id, similarity, start, end) for each document and item it holds.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text). Words have A-Z lower-cased. An
    item is found if any place of the text, of the item's length and a quarter more, holds at least
    SIMILARITY of the item's weight in 5-word shingles. start and end are characters of the text, and span the
    shared shingles of the best place.

    Texts to compare come from ``sources``. "windows": an item's first or last words, as many as the next
    window size below its length (and below half of it), against all windows of that size; those whose SimHash lies within RADIUS bits, none
    of which the blocks miss. "shingles": the item's heaviest shingles, which together weigh more than the rest that a
    match may lack, so that with them no place is missed.

    Items and texts that are null or without words match nothing; repeated items count once,
    repeated documents each for itself. An empty table on either side gives no rows. Other
    columns are not read.
    """
    docs = texts(docs)

    def found(items: Items):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, words, best in _scanned(batches, items, sources):
                yield _rows(batch, words, items, best)

        return docs.mapInArrow(find, "doc_id long, item_id long, similarity double, start int, end int")

    return reduce(DataFrame.union, [found(items) for items in _passes(benchmark)])


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no item, with all their columns and in place."""

    def clean(items: Items):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, _, best in _scanned(batches, items):
                fine = np.ones(batch.num_rows, bool)
                fine[[i for i, _ in best]] = False
                yield batch.filter(pa.array(fine))

        return keep

    small_batches(docs.sparkSession)
    for items in _passes(benchmark):
        docs = docs.mapInArrow(clean(items), docs.schema)
    return docs


def op7_benchmark_leaks(spark, sf_dir) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
