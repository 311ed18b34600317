from collections import Counter

import corpus_pipeline
from spanwatch.llm import decontam, mix, neardup, toxicity
from spanwatch.llm.scratch import documents

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "mixing", "sharding"
    ]
    docs, columns = documents(spark, SF), documents(spark, SF).columns
    states = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns if name != "sharding" else set(columns) < set(docs.columns)
        states.append([r.asDict() for r in docs.collect()])
    ids = [[r["doc_id"] for r in s] for s in states]
    raw = documents(spark, SF)
    model = toxicity.fit_toxicity(raw, spark.read.parquet(f"{SF}/labels.parquet"))
    harmless = {r["doc_id"] for r in toxicity.find_toxic(raw, model).collect() if r["score"] < toxicity.THRESHOLD}
    assert set(ids[0]) == harmless and len(ids[0]) == len(harmless)
    groups = neardup.near_duplicates(raw.filter(raw["doc_id"].isin(list(harmless))), 80).collect()
    assert sorted(ids[1]) == sorted(r["doc_id"] for r in groups if r["kept"])
    leaks = {r["doc_id"] for r in decontam.find_leaks(raw, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert set(ids[2]) == set(ids[1]) - leaks
    assert set(ids[3]) <= set(ids[2]) and max(Counter(ids[3]).values()) <= mix.MAX_EPOCHS
    assert sorted(ids[4]) == sorted(ids[3])
    assert len({(r["shard"], r["slot"]) for r in states[4]}) == len(states[4])


def test_run_gives_the_same_rows_each_time(spark):
    key = lambda r: (r["doc_id"], r["shard"], r["slot"])
    first = sorted(map(key, corpus_pipeline.run(spark, SF).collect()))
    assert first and first == sorted(map(key, corpus_pipeline.run(spark, SF).collect()))


def test_registered(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


def through_all_stages(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    return docs


def test_odd_rows_and_clashing_columns_pass_all_stages(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, ("score", "component_id", "kept", "item_id", "target", "taken", "size", "place", "bag"))
    out = through_all_stages(spark, docs)
    assert set(out.columns) == {*docs.columns, "shard", "slot"}
    rows = out.collect()
    assert rows and {r["doc_id"] for r in rows} <= {r[0] for r in odd_rows}
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)


def test_an_empty_table_passes_all_stages(spark, make_docs):
    assert through_all_stages(spark, make_docs([])).count() == 0


def test_mixing_stage_where_words_times_weight_pass_the_range_of_an_int(spark, make_docs, prose, monkeypatch):
    docs = make_docs([(i, prose(5 + i % 30, i), f"s{i % 4}") for i in range(80)])
    stage = dict(corpus_pipeline.STAGES)["mixing"]
    want = Counter(r["doc_id"] for r in stage(spark, docs, SF).collect())
    # The same shares by larger numbers: 80 rows then reach what takes 430 million words by the weights themselves.
    monkeypatch.setattr(mix, "CYCLE", [x * 100_000_000 for x in mix.CYCLE])
    assert want and Counter(r["doc_id"] for r in stage(spark, docs, SF).collect()) == want
