import random

import numpy as np
import pytest

from spanwatch.llm import neardup
from spanwatch.llm.graph import components

LOWER = {c: c + 32 for c in range(65, 91)}


def word_sets(text, size=5):
    words = (text or "").translate(LOWER).split()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def brute(rows, percent):
    sets = {i: word_sets(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(text, edits, seed):
    draw, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("percent", [85, 80])
def test_groups_equal_brute_force(make_docs, prose, percent):
    rows = [(i, prose(90, i)) for i in range(40)]
    base, number = rows[0][1], 100
    for edits in (0, 0, 1, 1, 2, 2, 3, 4, 5):  # around one original, near and not so near
        for k in range(6):
            rows.append((number, edited(base, edits, number)))
            number += 1
    chain = rows[1][1]
    for k in range(12):  # each like the one before, the ends unlike
        chain = edited(chain, 1, 500 + k)
        rows.append((500 + k, chain))
    rows += [(600 + k, prose(200, 7) + " " + prose(20, 600 + k)) for k in range(30)]  # a shared passage
    rows += [(700, "a b"), (701, "A  b"), (702, "a b c"), (703, ""), (704, "")]
    want = brute(rows, percent)
    for r in neardup.near_duplicates(make_docs(rows), percent).collect():
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, ("bag", "bands", "kept", "id", "row", "kept_id"))
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == len(odd_rows)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[8]["component_id"] == 1 and not by[8]["kept"]
    assert (by[3]["n_shingles"], by[4]["n_shingles"], by[5]["n_shingles"]) == (0, 0, 0)
    assert by[3]["kept"] and by[4]["kept"] and by[10]["component_id"] == 10
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    out = neardup.first_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(
        ["1", "2", "3", "4", "5", "6", "9", "10", "11", "None", "None"]
    )


def test_rows_that_share_an_id_are_one_document(make_docs, prose):
    rows = [(1, prose(50, 1)), (1, prose(60, 2)), (2, prose(50, 1)), (3, prose(60, 2))]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(make_docs(rows)).collect())
    assert got == [(1, 46, 1), (1, 56, 1), (2, 46, 1), (3, 56, 3)]


def test_empty_table(make_docs):
    assert neardup.near_duplicates(make_docs([])).count() == 0


def test_band_settings_keep_the_chance_of_a_miss():
    for percent in (80, 85, 90):
        n = neardup.band_count(percent)
        assert (1 - (percent / 100) ** neardup.ROWS) ** n <= neardup.MISS and n * neardup.ROWS <= neardup.BINS


def test_signature_agrees_as_often_as_sets_overlap():
    draw = np.random.default_rng(1)
    shared, a, b = (draw.integers(0, 1 << 62, n).astype(np.uint64) for n in (60, 20, 20))
    same = [
        np.mean(neardup.signature(np.concatenate([shared + np.uint64(s), a + np.uint64(s)]))
                == neardup.signature(np.concatenate([shared + np.uint64(s), b + np.uint64(s)])))
        for s in range(30)
    ]
    assert abs(np.mean(same) - 0.6) < 0.05


def test_components_of_chains_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == got[102] == 100
