import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanwatch.llm import toxicity

INSULTS = ["grobnak", "grobnakly", "vilzerp"]


@pytest.fixture
def labelled(spark, make_docs, prose):
    draw, rows, marks = random.Random(3), [], []
    for i in range(600):
        words, bad = prose(80, i).split(), i % 6 == 0
        if bad:
            at = draw.randrange(60)
            for k in range(4):
                words[at + 3 * k] = draw.choice(INSULTS)
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    return make_docs(rows), spark.createDataFrame(marks, "doc_id long, toxic int")


@given(st.lists(st.tuples(st.integers(0, 40), st.floats(0.1, 5.0)), max_size=12, unique_by=lambda x: x[0]))
@settings(max_examples=200, deadline=None)
def test_segments_are_the_maximal_ones(tokens):
    tokens = sorted(tokens)
    scores = np.full(41, toxicity.BACKGROUND)
    for i, s in tokens:
        scores[i] = s

    def recurse(lo, hi):  # the best segment, the shortest of equals, then the best ones beside it
        best = None
        for a in range(lo, hi):
            run = 0.0
            for b in range(a, hi):
                run += scores[b]
                longer = best is not None and b - a >= best[1] - best[0]
                if run > 1e-9 and (best is None or run > best[2] + 1e-9 or (run > best[2] - 1e-9 and not longer)):
                    best = (a, b, run)
        if best is None:
            return []
        return recurse(lo, best[0]) + [best] + recurse(best[1] + 1, hi)

    got = toxicity.maximal_segments(np.array([t[0] for t in tokens], int), np.array([t[1] for t in tokens], float))
    assert sum(s for _, _, s in got) == pytest.approx(sum(s for _, _, s in recurse(0, 41)))
    if got:
        assert max(s for _, _, s in got) == pytest.approx(max(s for _, _, s in recurse(0, 41)))


def test_held_out_documents_are_told_apart(labelled):
    docs, labels = labelled
    found = toxicity.find_toxic(docs, toxicity.fit_toxicity(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 100
    assert all((r["score"] >= toxicity.THRESHOLD) == bool(r["toxic"]) for r in held)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found:
        for p in r["passages"]:
            assert any(w in text[r["doc_id"]][p["start"] : p["end"]] for w in INSULTS)
            assert text[r["doc_id"]][p["start"] : p["end"]].split()[0] in INSULTS


def test_labels_of_held_out_rows_are_not_read(spark, labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(F.expr(toxicity.HELD_OUT), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit_toxicity(docs, labels), toxicity.fit_toxicity(docs, turned)
    assert a.keys.tolist() == b.keys.tolist() and a.odds.tolist() == pytest.approx(b.odds.tolist())


def test_odd_rows(spark, make_docs, odd_rows, labelled):
    model = toxicity.fit_toxicity(*labelled)
    docs = make_docs(odd_rows + [(50, "É " + " ".join(INSULTS))], ("score", "toxic", "passages"))
    rows = toxicity.find_toxic(docs, model).collect()
    assert len(rows) == len(odd_rows) + 1
    assert all(0 <= r["score"] <= 1 for r in rows)
    worst = next(r for r in rows if r["doc_id"] == 50)
    assert worst["score"] >= toxicity.THRESHOLD and worst["passages"][0]["start"] == 2
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows)
    assert toxicity.find_toxic(make_docs([]), model).count() == 0


def test_without_labels_nothing_is_toxic(spark, make_docs, prose):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs([(1, prose(30, 1)), (2, None)])
    rows = toxicity.find_toxic(docs, toxicity.fit_toxicity(docs, none)).collect()
    assert all(r["score"] < 0.01 for r in rows)
    broken = spark.createDataFrame([(None, 1), (2, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(docs, broken).offset == -10.0


def test_copies_of_a_toxic_text_do_not_make_its_words_toxic(spark, make_docs, prose):
    rows = [(i, prose(60, 1)) for i in range(200)] + [(500 + i, prose(60, 500 + i)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(make_docs(rows), labels)
    assert not len(model.keys)
