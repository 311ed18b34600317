import random

import numpy as np
import pyarrow as pa
import pytest

from spanwatch.llm import decontam
from spanwatch.llm.words import Words


@pytest.fixture
def items(spark, prose):
    rows = [(i, prose(n, 9000 + i)) for i, n in enumerate([14, 20, 37, 59, 80, 200, 9, 3])] + [(90, None), (91, " "), (3, prose(59, 9003))]
    return spark.createDataFrame(rows, "item_id long, text string"), dict(rows[:8])


def test_items_are_found_wherever_they_stand(spark, make_docs, prose, items):
    benchmark, text = items
    rows, want = [], set()
    for i in range(8):
        for k, (a, b) in enumerate([(0, 0), (0, 50), (50, 0), (70, 70)]):
            doc = 100 + 10 * i + k
            rows.append((doc, " ".join([prose(a, doc), text[i].upper() if k == 1 else text[i], prose(b, -doc)]).strip()))
            want.add((doc, i))
    rows += [(i, prose(150, i)) for i in range(60)]
    got = decontam.find_leaks(make_docs(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    texts = dict(rows)
    for r in got:
        assert r["similarity"] == 1.0
        assert texts[r["doc_id"]][r["start"] : r["end"]].lower() == text[r["item_id"]].lower()
    clean = decontam.without_leaks(make_docs(rows, ("similarity", "item_id")), benchmark)
    assert {r["doc_id"] for r in clean.collect()} == set(range(60)) and "item_id" in clean.columns


def test_edited_items_within_the_similarity_are_found(spark, make_docs, prose, items):
    benchmark, text = items
    rows, draw = [], random.Random(5)
    for k in range(40):
        words = text[4].split()
        words[draw.randrange(80)] = "changed"
        rows.append((k, prose(30, k) + " " + " ".join(words) + " " + prose(30, -k)))
    got = {r["doc_id"] for r in decontam.find_leaks(make_docs(rows), benchmark).collect()}
    assert len(got) >= 38  # one word of 80 leaves more than nine tenths of the shingles


def test_odd_rows_and_empty_tables(spark, make_docs, odd_rows, items):
    benchmark, text = items
    rows = odd_rows + [(60, text[2]), (60, text[2]), (None, text[2])]
    got = sorted(str(r["doc_id"]) for r in decontam.find_leaks(make_docs(rows), benchmark).collect())
    assert got == ["60", "60", "None"]
    assert decontam.find_leaks(make_docs([]), benchmark).count() == 0
    none = benchmark.limit(0)
    assert decontam.find_leaks(make_docs(rows), none).count() == 0
    assert decontam.without_leaks(make_docs(rows), none).count() == len(rows)


def test_blocks_miss_nothing_within_the_radius():
    draw = np.random.default_rng(2)
    prints = draw.integers(0, 1 << 63, 50).astype(np.uint64)
    blocks = decontam.Blocks([(i, 0, p) for i, p in enumerate(prints)])
    for bits in range(decontam.RADIUS + 1):
        flipped = prints.copy()
        for k in range(len(prints)):
            for b in draw.choice(64, bits, replace=False):
                flipped[k] ^= np.uint64(1) << np.uint64(b)
        window, entry = blocks.near(flipped)
        assert {(k, k) for k in range(50)} <= set(zip(window.tolist(), entry.tolist()))


def test_window_fingerprints_do_not_depend_on_their_place(prose):
    a = Words(pa.array([prose(40, 1)])).hashes
    b = Words(pa.array([prose(25, 2) + " " + prose(40, 1)])).hashes
    assert decontam.fingerprints(a, 20).tolist() == decontam.fingerprints(b, 20)[25:].tolist()
    assert decontam.fingerprints(a, 20, decontam.running_signs(a, 300)).tolist() == decontam.fingerprints(a, 20).tolist()
    assert [decontam.window_size(n) for n in (1, 5, 8, 9, 10, 12, 13)] == [1, 5, 8, 8, 10, 10, 13]


def test_items_in_passes(monkeypatch, make_docs, items):
    benchmark, text = items
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 3)
    rows = [(i, text[i]) for i in range(8)]
    assert {r["doc_id"] for r in decontam.find_leaks(make_docs(rows), benchmark).collect()} == set(range(8))
    assert decontam.without_leaks(make_docs(rows), benchmark).count() == 0


def plain_similarity(text, item, weight):
    """The best share of the item's weight among all places of its length and a quarter more."""
    of = lambda words: [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    bag, n = set(of(item)), len(item) + 2 * -(-len(item) // 8)
    total = sum(map(weight, bag))
    return max(sum(map(weight, bag & set(of(text[k : k + n])))) / total for k in range(max(1, len(text) - n + 1)))


KINDS = ("run", "ends", "words", "insert")


@pytest.fixture
def edited(prose):
    """Items, texts that hold them with edits, and all (text, item) within the similarity by brute force."""
    draw, own = random.Random(9), {}
    shared = prose(6, 1).split()
    for i, n in enumerate([16, 20, 27, 35, 35, 60, 60, 80, 100, 100]):
        own[i] = prose(n, 700 + i).split()
        if i % 3 == 0:
            own[i][3:9] = shared  # shingles of several items weigh less
    held = {}
    for words in own.values():
        for gram in {tuple(words[k : k + 5]) for k in range(len(words) - 4)}:
            held[gram] = held.get(gram, 0) + 1
    rows, want = [], {}
    for i, item in own.items():
        for k in range(48):
            words, n, kind = list(item), len(item), k % 4
            part = draw.randint(1, max(1, n // 6))
            if kind == 0:  # a replaced run
                at = draw.randrange(n - part)
                words[at : at + part] = ["new"] * part
            elif kind == 1:  # both ends altered
                words[: part // 2 + 1] = ["new"] * (part // 2 + 1)
                words[-(part // 2) - 1 :] = ["old"] * (part // 2 + 1)
            elif kind == 2:  # single words
                for at in draw.sample(range(n), draw.randint(1, 3)):
                    words[at] = "new"
            else:  # words put in
                at = draw.randrange(n)
                words[at:at] = ["new"] * draw.randint(1, n // 8)
            doc = 100 * i + k
            text = prose(40, 3000 + doc).split() + words + prose(40, 6000 + doc).split()
            rows.append((doc, " ".join(text)))
            value = plain_similarity(text, item, lambda gram: 1 / held[gram])
            if value >= 0.8 - 1e-12:
                want[doc, i] = value
    return {i: " ".join(w) for i, w in own.items()}, rows, want


def leaks(spark, make_docs, own, rows, **options):
    benchmark = spark.createDataFrame(list(own.items()), "item_id long, text string")
    found = decontam.find_leaks(make_docs(rows), benchmark, **options).collect()
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}


def test_every_place_within_the_similarity_is_found(spark, make_docs, edited):
    own, rows, want = edited
    got = leaks(spark, make_docs, own, rows)
    near = {k for k, v in want.items() if abs(v - 0.8) < 1e-9}  # sums in another order
    assert len(want) > 150 and set(got) - near == set(want) - near
    assert all(abs(got[k] - want[k]) < 1e-9 for k in set(got) & set(want))


def test_windows_find_places_by_themselves(spark, make_docs, edited, monkeypatch):
    """What the SimHash windows find alone, by kind of edit; without the blocks they find nothing."""
    own, rows, want = edited
    got = leaks(spark, make_docs, own, rows, sources=("windows",))
    assert all(abs(got[k] - want[k]) < 1e-9 for k in set(got) & set(want))
    share = {kind: [k in got for k in want if k[0] % 100 % 4 == n] for n, kind in enumerate(KINDS)}
    recall = {kind: sum(found) / len(found) for kind, found in share.items()}
    assert min(recall.values()) >= 0.9, recall
    exact = [(i, f"before {text} behind") for i, text in own.items()]
    assert len(leaks(spark, make_docs, own, exact, sources=("windows",))) == len(own)
    monkeypatch.setattr(decontam.Items, "index", lambda self: {})
    assert leaks(spark, make_docs, own, exact, sources=("windows",)) == {}


def test_similarity_does_not_depend_on_passes(spark, monkeypatch, make_docs, prose):
    stock, own = prose(15, 1), {i: prose(24, 50 + i) for i in range(12)}
    benchmark = spark.createDataFrame([(i, f"{stock} {t}") for i, t in own.items()], "item_id long, text string")
    # Without the stock words, and with another end.
    rows = [(i, t) for i, t in own.items()] + [(20 + i, f"{stock} {t[: len(t) * 3 // 4]}") for i, t in own.items()]

    def found():
        return sorted(map(tuple, decontam.find_leaks(make_docs(rows), benchmark).collect()))

    once = found()
    assert len(once) >= 12
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 2)
    assert found() == once
