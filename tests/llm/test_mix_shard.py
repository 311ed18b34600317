import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from spanwatch.llm import mix, shard
from spanwatch.llm.prefix import with_prefix

CLASHES = ("part", "before", "place", "weight", "size", "turn", "copy", "repetitions", "shard", "slot", "digest")


def mixed(docs):
    sized = mix.sized_documents(docs)
    return mix.mix_sources(sized, mix.cycled_weights(sized, mix.CYCLE))


def test_targets_are_shared_by_weight_and_capped(spark):
    sources = spark.createDataFrame([("a", 10, 5), ("b", 100, 2), ("c", 100, 1)], "source string, source_size long, weight int")
    got = {r["source"]: r["target"] for r in mix.source_targets(sources, 3).collect()}
    assert got == {"a": 30.0, "b": pytest.approx(120.0), "c": pytest.approx(60.0)}


def test_all_targets_capped_when_the_budget_is_too_large(spark):
    sources = spark.createDataFrame([("a", 10, 5), ("b", 20, None)], "source string, source_size long, weight int")
    got = {r["source"]: r["target"] for r in mix.source_targets(sources, 3, 1000).collect()}
    assert got == {"a": 30.0, "b": 0.0}


@pytest.mark.parametrize("words", [1_000_000, 12_000_000, 40_000_000])  # a row; 0.1, 1.2 and 4 billion in all
def test_mix_of_any_number_of_words_has_exact_targets(spark, words):
    rows = [(i, f"s{i % 4}", words + i) for i in range(40)] + [(90, "large", 60 * words)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    weight = dict(zip(["large", "s0", "s1", "s2", "s3"], [5, 2, 1, 5, 2]))
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        share = {s: Fraction(left * weight[s], sum(w for t, w in weight.items() if t not in capped)) for s in weight}
        if not (more := {s for s in weight if s not in capped and 2 * sizes[s] <= share[s]}):
            break
        capped |= more
    assert capped and capped != set(weight)
    want = {s: float(2 * sizes[s] if s in capped else share[s]) for s in weight}
    got = mix.mix_sources(sized, mix.cycled_weights(sized, mix.CYCLE), max_epochs=2).collect()
    assert len(got) == len(rows)
    assert {(r["source"], r["source_size"], r["target"]) for r in got} == {(s, sizes[s], want[s]) for s in weight}
    for s in weight:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - want[s]) <= max(r["size"] for r in got if r["source"] == s) / 2


def test_mix_comes_near_its_targets_and_repeats_itself(make_docs, prose):
    docs = make_docs([(i, prose(5 + i % 30, i), f"s{i % 3}" if i % 5 else None) for i in range(300)])
    first, again = mixed(docs).collect(), mixed(docs.repartition(5)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    taken, target = Counter(), {}
    for r in first:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["repetitions"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 35 for s in target)
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in first))


def test_mix_of_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, CLASHES)
    rows = mixed(docs).collect()
    assert len(rows) == len(odd_rows)
    out = mix.mixed_rows(docs, mixed(docs))
    assert out.columns == docs.columns
    want = Counter()
    for r in rows:
        want[r["doc_id"], r["source"]] += r["repetitions"]
    got = Counter((r["doc_id"], r["source"]) for r in out.collect())
    assert got == +want


def test_empty_tables(make_docs):
    empty = make_docs([])
    assert mixed(empty).count() == 0
    assert shard.sharded_rows(empty, 4).count() == 0


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "v long, k long").repartition(6)
    got = {r["k"]: (r["b"], r["n"]) for r in with_prefix(df, [F.col("k")], "v", "b", "n").collect()}
    total = 0
    for i in range(500):
        assert got[i] == (total, i)
        total += i % 7


def check_shards(rows, shards, sizes):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for members in by.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    mean = sum(sizes) / shards
    for k in range(shards):
        assert abs(sum(r["size"] for r in by.get(k, [])) - mean) <= max(sizes)


def test_shards_are_contiguous_and_balanced(spark, make_docs, prose):
    docs = make_docs([(i, prose(1 + i * 7 % 40, i)) for i in range(400)])
    sized = docs.select("doc_id", (shard.text_bytes(F.col("text")) + 16).alias("size"))
    rows = shard.shard_by_bytes(sized, 8, [F.col("doc_id")], "size").collect()
    check_shards(rows, 8, [r["size"] for r in rows])
    ordered = sorted(rows, key=lambda r: r["doc_id"])
    assert [r["shard"] for r in ordered] == sorted(r["shard"] for r in rows)


def test_shards_of_odd_rows_keep_all_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows, CLASHES)
    out = shard.sharded_rows(docs, 3)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    assert set(out.columns) == set(docs.columns)  # a shard and a slot column are replaced
    assert Counter(str(r["doc_id"]) for r in rows) == Counter(str(r[0]) for r in odd_rows)
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)


def test_checksum_matches_zlib(spark):
    text = "é ß 漢字"
    assert spark.range(1).select(F.crc32(F.lit(text))).first()[0] == zlib.crc32(text.encode())


def test_op8_over_its_table(spark):
    rows = shard.op8_shard_by_bytes(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "bytes", None)
    check_shards(rows, 40, [r["size"] for r in rows])


def test_every_shard_and_slot_of_a_table_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    rows = []
    for doc_id, text in texts:
        data = (text or "").encode()
        rows.append((doc_id is not None, doc_id, zlib.crc32(data), len(data) + 16))
    rows.sort()
    total, before, filled, want = sum(r[3] for r in rows), 0, Counter(), []
    for _, doc_id, crc, size in rows:
        k = min(int((2 * before + size) * 40 // (2 * total)), 39)
        want.append((doc_id, crc, size, k, filled[k]))
        filled[k] += 1
        before += size
    got = shard.op8_shard_by_bytes(spark, path).select("doc_id", "text_crc32", "size", "shard", "slot").collect()
    assert Counter(map(tuple, got)) == Counter(want)
