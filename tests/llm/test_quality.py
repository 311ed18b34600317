import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spanwatch.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            inside.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


@given(st.lists(st.one_of(st.none(), st.text("ab é#|\n\t ", max_size=60)), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_measures_equal_brute_force(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    got = pa.Table.from_batches(list(quality._measured(iter([batch])))).to_pylist()
    for row, text in zip(got, texts):
        assert tuple(row[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute(text)


def test_frequent_lines_go_and_depleted_documents_fall(make_docs, prose):
    common = "Accept  all cookies 2024 to read on this site of ours now please"
    rows = [(i, prose(60, i) + "\n" + common.upper() + "\n" + prose(40, 1000 + i), "h") for i in range(30)]
    rows += [(100 + i, f"{common}\n{prose(25, 50 + i)}".replace("2024", str(1000 + i)), "h") for i in range(3)]
    rows += [(200, common + "\n" + prose(12, 7) + "\n" + prose(3, 8), "h"), (300, common + "\n" + prose(30, 9), "other")]
    rows += [(400 + i, prose(50, 77), "h") for i in range(60)]  # equal copies make no line frequent
    docs = make_docs(rows, ("row", "removed", "line"))
    judged = quality.judge(docs)
    by = {r["doc_id"]: r for r in judged.collect()}
    assert len(by) == len(rows)
    assert all(by[i]["removed"] == [1] and by[i]["kept"] and by[i]["n_left"] == 100 for i in range(30))
    assert all(by[100 + i]["removed"] == [0] and by[100 + i]["kept"] for i in range(3))
    assert not by[200]["kept"] and not by[200]["base_failed"]
    assert by[300]["removed"] == [] and by[300]["kept"]
    assert all(by[400 + i]["kept"] for i in range(60))
    out = quality.cleaned(docs, judged)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert 200 not in texts and texts[0] == rows[0][1].split("\n")[0] + "\n" + rows[0][1].split("\n")[2]


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    rows = quality.judge(docs).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r["n_words"] < 20:
            assert r["base_failed"] and not r["kept"]
    assert next(r for r in rows if r["doc_id"] == 9)["kept"]
    assert len(quality.cleaned(docs, quality.judge(docs)).collect()) == sum(r["kept"] for r in rows)
    assert quality.judge(make_docs([])).count() == 0
