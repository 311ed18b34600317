import hashlib
import random
from collections import Counter

import pytest

from spanwatch.llm import align


@pytest.fixture(scope="module")
def models():
    return [align.tokenizer(p, align._read(p)) for p in (align.FIRST, align.SECOND)]


def plain(texts, models):
    """Every row's result by a walk along both token lists, each text encoded whole."""
    tables = []
    for text in texts:
        raw = (" " + text).encode() if text else b""
        a, b = (m.encode([" " + text])[0].tolist() if text else [] for m in models)
        spans = [[m.bytes[i] for i in ids] for m, ids in zip(models, (a, b))]
        if any(b"".join(s) != raw for s in spans):
            a, b, spans = [], [], [[], []]
        ends = [[sum(map(len, s[: i + 1])) for i in range(len(s))] for s in spans]
        links, groups, ga, gb, i, j = [], [], [], [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            at = min(ends[0][i], ends[1][j])
            both = ends[0][i] == ends[1][j]
            if ends[0][i] == at:
                ga.append(a[i])
            if ends[1][j] == at:
                gb.append(b[j])
            i, j = i + (ends[0][i] == at), j + (ends[1][j] == at)
            if both:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
        tables.append((len(a), len(b), groups, links))
    counts = Counter(pair for *_, links in tables for pair in set(links))
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for n_a, n_b, groups, links in tables
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "plain words here", None, "", " ", "  ", "a  b", " lead", "trail ", "line\n next\n\n  indented\tx", "\n", "tab\t end", "a▁b", "▁", "<0x41> <s> </s> <unk>",
    "<|endoftext|> said <|endoftext|>", "é ß 漢字かな \U0001F600\U0001F1E9\U0001F1EA x", "\x00nul \x00", "\u00a0nbsp\u00a0 x", "\u3000wide x\u2028y",
    "I'm we'll it's 'tis", "12345 6.7e8 0x1F", "https://a.example.org/x?y=z&w", "a" * 3000, "plain words here", "plain words here", "́combining é",
    "\r\n crlf\r\n", "x\x85 y", "x\x1c y",
]


def rows(spark, texts, partitions=2):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(partitions)
    return {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in align.align_tokens(df).collect()}


def test_odd_texts_equal_brute_force(spark, models):
    assert rows(spark, TEXTS) == dict(enumerate(plain(TEXTS, models)))


def test_random_texts_equal_brute_force(spark, models):
    draw = random.Random(5)
    parts = ["the", " ", "  ", "\n", "tion", "Étr", "漢", "ing ", "...", "'s", "7", "\t", "<0x0A>", "▁", "\U0001F600", "Wort", " and"]
    texts = ["".join(draw.choices(parts, weights=[9, 9, 1, 1, 9, 3, 1, 5, 2, 1, 2, 1, 1, 0.2, 1, 5, 9], k=draw.randint(0, 60))) for _ in range(150)]
    assert rows(spark, texts) == dict(enumerate(plain(texts, models)))


def test_blocks_and_caches_change_nothing(spark, models, monkeypatch):
    texts = [t for t in TEXTS if t] * 3
    whole = rows(spark, texts, 1)
    monkeypatch.setattr(align, "BLOCK", 50)
    monkeypatch.setattr(align, "CACHE", 5)
    monkeypatch.setattr(align, "pieces", lambda batches, column, limit: (b.slice(i, 1) for b in batches for i in range(len(b))))
    assert rows(spark, texts, 3) == whole == dict(enumerate(plain(texts, models)))


def test_a_very_long_text_goes_through_whole(spark, models, prose):
    texts = [prose(40_000, 3), "a b"]
    got = rows(spark, texts)
    ids = [m.encode([" " + texts[0]])[1].sum() for m in models]
    assert got[0][:2] == tuple(ids)


def test_null_and_repeated_ids_clashing_columns_empty_table(spark, make_docs, odd_rows, models):
    df = make_docs([(r[0], (r[1] or "")[:500] if r[1] else r[1]) for r in odd_rows], extra=("block", "rows", "pairs"))
    got = sorted(map(str, ((r["doc_id"], *[r[c] for c in COLUMNS]) for r in align.align_tokens(df).collect())))
    texts = [r[1][:500] if r[1] else r[1] for r in odd_rows]
    assert got == sorted(str((r[0], *p)) for r, p in zip(odd_rows, plain(texts, models)))
    empty = align.align_tokens(df.limit(0))
    assert empty.collect() == [] and empty.columns[0] == "doc_id"
    assert got and rows(spark, [None, ""]) == dict(enumerate(plain([None, ""], models)))


def test_query_over_a_table_equals_brute_force(spark, models):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in align.op12_token_alignment(spark, sf).collect()}
    assert got == dict(zip([d["doc_id"] for d in docs], plain([d["text"] for d in docs], models)))
