import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spanwatch.llm.words import KEEP, LOWER, Words, pieces, shingles

TEXTS = st.lists(st.one_of(st.none(), st.text("ab Aé\n\t\x0b漢", max_size=30)), max_size=8)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_are_split_and_hashed_alike(texts):
    found, seen = Words(pa.array(texts, pa.string()), KEEP), {}
    for i, text in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        mine = found.of(i).tolist()
        assert len(mine) == len(want)
        for word, h in zip(want, mine):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_pieces_cover_all_rows_and_long_words_stay_whole():
    texts = ["x" * 3_000_000 + " y", None, "", "a b"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(pieces(iter([batch]), "text", 1 << 20))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert len(Words(pa.array(texts[:1])).hashes) == 2


def test_shingles_and_folding():
    a, b = Words(pa.array(["A b C d e F"]), LOWER).of(0), Words(pa.array(["a B c D e f"]), LOWER).of(0)
    assert shingles(a).tolist() == shingles(b).tolist() and len(shingles(a)) == 2
    assert len(shingles(a[:3])) == 1 and not len(shingles(a[:0]))
    assert shingles(a[:3])[0] != shingles(a[:3], 2)[0]
