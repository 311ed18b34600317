"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanwatch.llm.graph import components
from spanwatch.llm.scratch import compact, documents, free_names, partitions, release, settle, texts
from spanwatch.llm.words import LOWER, SHINGLE, Words, mix, pieces, shingles

BINS = 256
ROWS = 5
MISS = 1e-5
CENTRES = 4
PERCENT = 85
SET = ["n_shingles", "set_a", "set_b"]
SKETCH = [f"s{k}" for k in range(8)]
SIGNED = "doc_id long, n_shingles long, set_a long, set_b long"
SURE = 64  # sets of so many shingles have sketches that can rule a pair out


def band_count(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Fewest bands so that a pair at the threshold shares none with chance ``miss`` at most."""
    s = percent / 100
    return min(math.ceil(math.log(miss) / math.log1p(-(s**rows))), BINS // rows) if s < 1 else 1


def most_unlike(percent: int) -> int:
    """Bins with differing sketches that a pair at the threshold exceeds only beyond four and a half deviations."""
    rate = (1 - percent / 100) * 3 / 4
    return math.ceil(BINS * rate + 4.5 * math.sqrt(BINS * rate * (1 - rate)))


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One-permutation MinHash with optimal densification of a non-empty set of hashes.

    A hash falls into the bin of its high bits and competes by its low ones. An empty bin
    copies the first filled one in a sequence of bins that hashing draws for it alone, the
    same for every set.
    """
    spread = mix(hashes ^ np.uint64(0xA0761D6478BD642F))
    where = ((spread >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    least = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, where.astype(np.int64), spread & np.uint64(0xFFFFFFFF))
    filled = least <= np.uint64(0xFFFFFFFF)
    empty, attempt, source = np.flatnonzero(~filled), 0, np.arange(bins)
    while len(empty):
        attempt += 1
        drawn = mix(empty.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(attempt)) % np.uint64(bins)
        hit = filled[drawn.astype(np.int64)]
        source[empty[hit]] = drawn[hit].astype(np.int64)
        empty = empty[~hit]
    return least[source]


def bands(sig: np.ndarray, n: int, rows: int = ROWS) -> np.ndarray:
    """One bucket key for each of ``n`` bands: its number and its values."""
    keys, values = np.arange(n, dtype=np.uint64), sig[: n * rows].reshape(n, rows)
    for k in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + values[:, k])
    return keys.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two bits of every bin: all low bits, then all high ones."""
    low, high = sig & np.uint64(1), (sig >> np.uint64(1)) & np.uint64(1)
    return np.packbits(np.concatenate((low, high)).astype(np.uint8)).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *[len(p) for p in parts]])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _set_columns(bags: list[np.ndarray]) -> list[pa.Array]:
    """Size and a 128-bit hash of each set: sums of two mixes of its members."""
    sums = [
        [int(mix(bag ^ np.uint64(salt)).sum().view(np.int64)) if len(bag) else None for bag in bags]
        for salt in (0, 0x5851F42D4C957F2D)
    ]
    return [pa.array(x, pa.int64()) for x in ([len(bag) for bag in bags], *sums)]


def _bags(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in pieces(batches, "text"):
        words = Words(batch.column("text"), LOWER)
        yield batch, [np.unique(shingles(words.of(i), size)) for i in range(batch.num_rows)]


def _signed(n: int, size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch, bags in _bags(batches, size):
            signatures = [signature(bag) if len(bag) else None for bag in bags]
            keys = [none if s is None else bands(s, n) for s in signatures]
            sketches = [none if s is None else sketch(s) for s in signatures]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *_set_columns(bags), _lists(keys), _lists(sketches)],
                ["doc_id", *SET, "bands", "sketch"],
            )

    return sign


def _sets(size: int):
    """The sets of texts; where rows share a doc_id, of that with the wanted set alone."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bags in _bags(batches, size):
            own = _set_columns(bags)
            same = pc.and_(pc.equal(own[1], batch.column("set_a")), pc.equal(own[2], batch.column("set_b")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(bags)], ["doc_id", "bag"]).filter(same)

    return gather


def _verified(pairs: DataFrame, bags: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough. ``bags`` has one row per id."""
    left = bags.select(F.col("doc_id").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("doc_id").alias("b"), F.col("bag").alias("bag_b"))
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    # common / (a + b - common) >= percent / 100, in whole numbers
    return (
        pairs.join(left, "a").join(right, "b")
        .filter((100 + percent) * common >= percent * (F.size("bag_a") + F.size("bag_b")))
        .select("a", "b")
    )


def _likely(percent: int):
    """Whether a member and a centre may be similar enough, by what they can share and by sketches."""
    common = F.least(F.col("n_shingles") - F.col("alone"), F.col("c_n") - F.col("c_alone"))
    fits = (100 + percent) * common >= percent * (F.col("n_shingles") + F.col("c_n"))
    apart = [F.col(s).bitwiseXOR(F.col(f"c_{s}")) for s in SKETCH]
    half = len(SKETCH) // 2
    unlike = sum((F.bit_count(x.bitwiseOR(y)) for x, y in zip(apart[:half], apart[half:])), F.lit(0))
    alike = (F.least("n_shingles", "c_n") < SURE) | (unlike <= most_unlike(percent))
    # A pair that shares several buckets is compared in the first of them.
    return fits & alike & (F.get(F.array_intersect("bands", "c_bands"), F.lit(0)) == F.col("key"))


def near_links(members: DataFrame, bags: DataFrame, percent: int) -> DataFrame | None:
    """Components (id, label) of distinct sets from their buckets (key, id, n, popular, bands, sizes, alone, sketches).

    Per bucket and round, a few centres, the most popular of their share of the bucket, are
    compared with all members: pairs grow with the members, not with their square. A member
    that is already in a centre's component needs no comparison, and a pair that too few
    shared shingles or the sketches rule out gets none. A pair that shares several buckets
    meets in the first of them. Centres leave after their round, having met everybody; a
    bucket is done when its members share one component. Later rounds take more centres, so
    that buckets whose members are alike but not similar enough come to an end, too. At the
    end, each pair of a bucket was compared, ruled out, or is connected.
    """
    labels, centres = None, CENTRES
    members = compact(members.withColumn("label", F.col("id")))
    while not members.isEmpty():
        parts = partitions(members)
        slot = F.pmod(F.xxhash64("id", F.lit(centres)), F.lit(centres))
        facts = ["n_shingles", "alone", *SKETCH, "bands"]
        best = F.max(F.struct("popular", (-F.col("id")).alias("minus"), "label", *facts)).alias("c")
        chosen = compact(
            members.groupBy("key", slot.alias("slot")).agg(best).select(
                F.col("key").alias("c_key"), (-F.col("c.minus")).alias("centre"), F.col("c.label").alias("c_label"),
                F.col("c.n_shingles").alias("c_n"), *[F.col(f"c.{f}").alias(f"c_{f}") for f in facts[1:]],
            ).coalesce(parts)
        )
        meet = (F.col("key") == F.col("c_key")) & (F.col("label") != F.col("c_label"))
        pairs = (
            members.join(chosen, meet & _likely(percent))
            .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
        )
        found = _verified(compact(pairs), bags, percent)
        if labels is not None:  # what earlier rounds found, one edge per node
            found = found.union(labels.filter("id <> label").select(F.col("label").alias("a"), F.col("id").alias("b")))
        labels = components(found)
        met = chosen.select(F.col("c_key").alias("key"), F.col("centre").alias("id"))
        members = (
            members.drop("label").join(met, ["key", "id"], "left_anti").coalesce(parts)
            .join(labels, "id", "left").coalesce(parts).withColumn("label", F.coalesce("label", "id"))
        )
        mixed = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
        members = compact(members.join(mixed.select("key").coalesce(parts), "key").coalesce(parts))
        centres *= 16
        release(members.sparkSession)
    return labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Documents are linked when their sets of ``size``-word shingles (A-Z lower-cased) have a
    Jaccard similarity of ``percent`` / 100 or more; shorter texts are one shingle. Texts
    with equal sets are one class from the start; its smallest doc_id stands for it.
    component_id is the smallest doc_id reachable, and kept marks that document.

    A text without words, or null, has 0 shingles and no links. A row without doc_id links
    with nothing and is kept, with a null component_id. Rows that share a doc_id are one
    document, compared by the least of their sets (by size, then hash), and reported one by
    one. Columns beyond the two are not read.
    """
    docs = texts(docs)
    spark = docs.sparkSession
    signed = settle(docs.mapInArrow(
        _signed(band_count(percent), size), f"{SIGNED}, bands array<long>, sketch array<long>"
    ))
    known = signed.filter("n_shingles > 0 and doc_id is not null")
    own = settle(
        known.groupBy("doc_id").agg(F.min(F.struct(*SET)).alias("s")).select("doc_id", "s.*")
    )
    classes = settle(own.groupBy(*SET).agg(F.min("doc_id").alias("doc_id")))
    one = settle(known.join(classes, [*SET, "doc_id"]).dropDuplicates(["doc_id"]))
    keyed = one.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    full = keyed.groupBy("key").agg(F.count("id").alias("n")).filter("n > 1")
    members = settle(keyed.join(full, "key"))
    # A member of many full buckets is likely to be near many others: a good centre.
    popular = members.groupBy("id").agg(F.sum("n").alias("popular"))
    facts = settle(
        one.join(popular, F.col("doc_id") == F.col("id"))
        .select("id", "popular", "bands", *SET, *[F.col("sketch")[k].alias(s) for k, s in enumerate(SKETCH)])
    )
    members = members.join(facts.drop("set_a", "set_b"), "id")
    bags = docs.join(facts.select(F.col("id").alias("doc_id"), "set_a", "set_b"), "doc_id").mapInArrow(
        _sets(size), "doc_id long, bag array<long>"
    )
    # Dealt by id once: the joins of all rounds move pairs, not sets.
    bags = settle(bags.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id"))
    if own.count() < known.count():
        bags = settle(bags.dropDuplicates(["doc_id"]))
    # Shingles that no other member has: nobody can share them.
    alone = (
        bags.select("doc_id", F.explode("bag").alias("s")).groupBy("s")
        .agg(F.count(F.lit(1)).alias("holders"), F.min("doc_id").alias("id")).filter("holders = 1")
        .groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    )
    members = (
        members.join(compact(alone), "id", "left").withColumn("alone", F.coalesce("alone", F.lit(0).cast("long")))
        .filter(100 * (F.col("n_shingles") - F.col("alone")) >= percent * F.col("n_shingles"))
    )
    release(spark)
    placed = own.join(classes.withColumnRenamed("doc_id", "id"), SET).select("doc_id", "id")
    labels = near_links(members, bags, percent)
    if labels is not None:
        placed = placed.join(labels, "id", "left").select("doc_id", F.coalesce("label", "id").alias("id"))
    component = F.coalesce("id", "doc_id")
    return (
        signed.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
        .select(
            "doc_id", "n_shingles", component.alias("component_id"),
            component.eqNullSafe(F.col("doc_id")).alias("kept"),
        )
    )


def first_of_each(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` that stand for their group of near-duplicates, with all their columns.

    Of rows that share a doc_id the one with the least hash of its text stays. Rows without
    doc_id all stay.
    """
    kept_id, row = free_names(docs.columns, "kept_id", "row")
    found = settle(near_duplicates(docs, percent, size).filter("kept and doc_id is not null").select("doc_id"))
    ids = found.distinct().withColumnRenamed("doc_id", kept_id)
    kept = docs.join(ids, docs["doc_id"] == F.col(kept_id), "left_semi")
    if found.count() > ids.count():
        order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
        kept = kept.withColumn(row, F.row_number().over(order)).filter(F.col(row) == 1).drop(row)
    return kept.union(docs.filter("doc_id is null"))


def op4_near_duplicates(spark, sf_dir) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                      ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                                 END) AS s FROM w
), n AS (
  SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), r AS (
  SELECT doc_id, doc_id AS id FROM n
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.id
)
SELECT doc_id, n AS n_shingles, min(id) AS component_id, doc_id = min(id) AS kept
FROM r JOIN n USING (doc_id) GROUP BY doc_id, n
"""
