import base64
import math
import os
import random

import pytest

from spanwatch.llm import license, tokens


@pytest.fixture
def vocabulary(tmp_path):
    pieces = [bytes([b]) for b in range(128)] + [b"ab", b"abc", b" a", b"bc", b"cab", b" abc", b"aaaa"]
    path = tmp_path / "v.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(p) + b" %d" % (r if len(p) == 1 else r - 120) for r, p in enumerate(pieces)))
    return str(path)


def cheapest(word, costs):
    """All segmentations, the cheapest and shortest of them."""
    worst = max(costs.values()) + tokens.UNIT
    if not word:
        return (0, 0)
    options = []
    for k in range(1, len(word) + 1):
        head = word[:k]
        cost = costs.get(head, worst if k == 1 else None)
        if cost is not None:
            rest = cheapest(word[k:], costs)
            options.append((cost + rest[0], 1 + rest[1]))
    return min(options)


def test_counts_equal_all_segmentations(vocabulary):
    costs, draw = tokens.read_vocabulary(vocabulary), random.Random(1)
    words = list({"".join(draw.choice("abc aé") for _ in range(draw.randint(0, 9))).encode() for _ in range(300)})
    got = tokens.trie_counts(words, tokens.with_suffixes(costs))
    assert got == {w: cheapest(w, costs)[1] for w in words}


def test_documents_sum_their_pre_tokens(monkeypatch, make_docs, odd_rows, vocabulary):
    monkeypatch.setattr(tokens, "CACHE", 50)
    costs = tokens.read_vocabulary(vocabulary)
    rows = [r for r in odd_rows if r[0] != 9] + [(80, "abc abcab aaaa  ab\n")]
    got = tokens.count_tokens(make_docs(rows, ("n_tokens",)), vocabulary).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for doc, text, *_ in rows:
        if doc is not None and len(text or "") < 40:
            parts = tokens.PRE_TOKEN.findall(text or "")
            assert "".join(parts) == (text or "")
            assert by[doc]["n_tokens"] == sum(cheapest(p.encode(), costs)[1] for p in parts)
    assert tokens.count_tokens(make_docs([]), vocabulary).count() == 0
    assert len(tokens.count_tokens(make_docs(odd_rows), vocabulary).collect()) == len(odd_rows)


@pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")
def test_public_vocabulary_over_a_table(spark):
    rows = tokens.op3_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r["n_tokens"] >= r["n_pre_tokens"] >= r["n_distinct"] for r in rows)


def test_vocabularies_are_bounded(tmp_path):
    (tmp_path / "none").write_text("")
    with pytest.raises(ValueError):
        tokens.read_vocabulary(str(tmp_path / "none"))


def test_notices_are_found_in_any_place(make_docs, prose):
    rows, want = [], set()
    for i, (name, text) in enumerate(license.TEMPLATES):
        for k, (a, b) in enumerate([(0, 0), (30, 0), (0, 33), (41, 37)]):
            doc = 100 * i + k
            rows.append((doc, f"{prose(a, doc)} {text.upper() if k == 2 else text} {prose(b, -doc)}".strip()))
            want.add((doc, name))
    rows += [(9000 + k, prose(100, k)) for k in range(40)]
    got = license.find_licenses(make_docs(rows)).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == want
    texts = dict(rows)
    assert all(r["containment"] == 1.0 for r in got)
    for r in got:
        text = dict(license.TEMPLATES)[r["license"]].strip(".\"")
        assert texts[r["doc_id"]][r["start"] : r["end"]].lower() == text.lower()


def test_two_notices_and_an_edited_one(make_docs, prose):
    text = dict(license.TEMPLATES)
    words = text["mit-grant"].split()
    words[15] = "every"
    rows = [
        (1, f"{text['mit']} {prose(60, 1)} {text['mit']}"),
        (2, f"{prose(20, 2)} {' '.join(words)} {prose(20, 3)}"),
        (3, " ".join(text["mit-grant"].split()[:12])),
    ]
    got = license.find_licenses(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["license"]) for r in got) == [(1, "mit"), (1, "mit"), (2, "mit-grant")]


def test_license_of_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(None, license.TEMPLATES[1][1]), (6, license.TEMPLATES[1][1]), (6, license.TEMPLATES[1][1])]
    got = sorted(str(r["doc_id"]) for r in license.find_licenses(make_docs(rows, ("license", "start"))).collect())
    assert got == ["6", "6", "None"]
    assert license.find_licenses(make_docs([])).count() == 0
    assert license.find_licenses(make_docs(rows), [("none", " . ")]).count() == 0


def test_bands_keep_the_chance_of_a_miss():
    for largest in (1, 2, 4, 8, 16, 32, 64):
        c = license.WindowClass(5, largest, [])
        assert c.blocks * c.step >= largest + c.step - 1
        for least in range(largest // 2 + 1, largest + 1):
            shared = math.ceil(0.8 * least)
            similar = shared / (c.blocks * c.step + least - shared)
            assert (1 - similar) ** c.bands(least) <= license.MISS * 1.0001
