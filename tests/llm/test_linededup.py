import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spanwatch.llm import linededup
from spanwatch.llm.words import Words


def lines_of(prose, n, seed):
    return [prose(9, 1000 * seed + k) + ". " for k in range(n)]


def normal(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "k long, text string")
    return {
        r["k"]: (r["p"], [" ".join(x.lower().split()) for x in r["p"]])
        for r in df.select("k", linededup.line_parts(F.col("text")).alias("p")).collect()
    }


def test_parts_join_to_the_text_and_their_words_are_counted(spark):
    alphabet, draw = "ab.!? \t\r\n", random.Random(4)
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40))) for _ in range(300)] + [None, "", "a. ", "\n"]
    column = pa.array(texts)
    counts = linededup._line_words(column, Words(column)).to_pylist()
    for k, (parts, forms) in normal(spark, dict(enumerate(texts))).items():
        assert "".join(parts) == (texts[k] or "")
        assert counts[k] == [len(f.split()) for f in forms]


def test_blocks_equal_brute_force():
    draw = random.Random(5)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.choice([0, 3, 6, 7, 8, 40, 90]))) for _ in range(80)]
    texts += ["ha " * 50, None, " \n"]
    column = pa.array(texts)
    for least in (1, 7, 20):
        words = Words(column)
        size = 1 << (min(linededup.GRAM, least).bit_length() - 1)
        for i, blocks in enumerate(linededup.word_blocks(words, least).to_pylist()):
            own = words.of(i)
            grams = [int(linededup.run_hashes(own, np.array([j]), np.array([j + size]))[0]) for j in range(len(own) - size + 1)]
            # The place of each run's mark: the first of its least grams.
            marks = [min(range(j, j + least - size + 1), key=lambda k: (grams[k], k)) for j in range(len(own) - least + 1)]
            cuts = [j for j in range(len(marks)) if not j or marks[j] != marks[j - 1]]
            assert [b["first"] for b in blocks] == cuts
            assert [b["last"] for b in blocks] == [j - 1 for j in cuts[1:]] + [len(marks) - 1] * bool(marks)
            assert [b["mark"] % 2**64 for b in blocks] == [grams[marks[j]] for j in cuts]


def test_later_runs_go_and_first_ones_stay(make_docs, prose):
    passage = "".join(lines_of(prose, 8, 1))
    own = {i: ["".join(lines_of(prose, 6, 100 + 2 * i)), "".join(lines_of(prose, 6, 101 + 2 * i))] for i in range(6)}
    rows = [(i, own[i][0] + (passage.upper() if i == 3 else passage) + own[i][1]) for i in range(6)]
    rows += [(10, prose(5, 1) + " " + passage + prose(5, 2)), (11, passage + prose(30, 3) + ". " + passage)]
    short = "".join(lines_of(prose, 2, 1))
    rows += [(20, prose(30, 20) + ". " + short + prose(30, 21))]  # two lines are no run
    docs = make_docs(rows, ("removed", "turn", "line"))
    runs = linededup.repeated_runs(docs)
    left = {r["doc_id"]: r["text"] for r in linededup.without_runs(docs, runs).collect()}
    assert left[0] == rows[0][1]
    for i in range(1, 6):
        assert left[i] == own[i][0] + own[i][1]
    assert len(left[10]) < len(rows[6][1]) - 300  # all but the lines cut at its ends
    assert passage not in left[11] and prose(30, 3) in left[11]
    assert left[20] == rows[8][1]
    assert linededup.without_runs(docs, runs).columns == docs.columns


def test_every_deleted_line_stands_earlier_and_every_run_is_found(spark, make_docs, prose):
    draw, pool = random.Random(8), [prose(8, 5000 + k) + ".\n" for k in range(60)]
    texts = {}
    for i in range(40):
        lines = []
        while len(lines) < 25:
            at = draw.randrange(60)
            lines += pool[at : at + draw.randint(1, 7)] if draw.random() < 0.5 else [prose(8, 9000 + 100 * i + len(lines)) + ".\n"]
        texts[i] = "".join(lines)
    got = {r["doc_id"]: r for r in linededup.repeated_runs(make_docs(list(texts.items()))).collect()}
    forms = {i: f for i, (_, f) in normal(spark, texts).items()}
    kept, grams = set(), set()
    for i in sorted(texts):
        removed, lines = set(got[i]["removed"]), [x for x in forms[i]]
        for k in removed:
            assert lines[k] in kept or lines[k] in lines[:k]
        kept.update(x for k, x in enumerate(lines) if k not in removed)
        # A run of five lines whose pairs were all seen first in one earlier document cannot stay whole.
        for j in range(len(lines) - 4):
            if (i, j) and all((lines[j + m], lines[j + m + 1]) in grams for m in range(4)):
                assert removed & set(range(j, j + 5))
        grams.update(zip(lines, lines[1:]))
    assert sum(len(r["removed"]) for r in got.values()) > 100


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    runs = linededup.repeated_runs(docs)
    assert runs.count() == len(odd_rows)
    out = {str(r["doc_id"]) + str(k): r for k, r in enumerate(linededup.without_runs(docs, runs).collect())}
    assert len(out) == len(odd_rows)
    assert any(r["text"] is None for r in out.values())
    assert linededup.repeated_runs(make_docs([])).count() == 0


def test_equal_rows_lose_all_but_the_first(make_docs, prose):
    text = "".join(lines_of(prose, 6, 3))
    docs = make_docs([(1, text), (1, text), (2, text), (None, text)])
    left = sorted(r["text"] for r in linededup.without_runs(docs, linededup.repeated_runs(docs)).collect())
    assert left == ["", "", "", text]


def words_of(text):
    return text.lower().split()


def brute(texts, least=20):
    """Numbers of the words that stand in a run of so many words that stands earlier; texts in their order."""
    seen, out = set(), {}
    for key, text in texts:
        w, gone = words_of(text), set()
        for j in range(len(w) - least + 1):
            run = tuple(w[j : j + least])
            if run in seen:
                gone.update(range(j, j + least))
            seen.add(run)
        out[key] = gone
    return out


def deleted(rows):
    return {r["doc_id"]: {p for a in r["runs"] for p in range(a["first"], a["last"] + 1)} for r in rows}


def test_passages_cut_at_random_words_go_whole(make_docs, prose):
    draw, rows, want = random.Random(3), [], {}
    for k in range(30):
        host = prose(200, 400 + k).split()
        for i in draw.sample(range(200), 8):
            host[i] += "."
        n = draw.randint(51, 80)
        at = draw.randrange(200 - n)
        a, b = prose(60, 500 + k), prose(60, 600 + k)
        rows += [(k, " ".join(host)), (100 + k, f"{a} {' '.join(host[at : at + n])} {b}")]
        want[100 + k] = f"{a} {b}"
    line = prose(200, 700)  # a single line is a run as well
    rows += [(200, f"{prose(9, 1)}.\n{line}\n"), (201, f"{prose(9, 2)}.\n{line}\n")]
    docs = make_docs(rows)
    runs = linededup.repeated_runs(docs)
    left = {r["doc_id"]: r["text"] for r in linededup.without_runs(docs, runs).collect()}
    assert {k: left[k] for k in want} == want
    assert left[201] == prose(9, 2) + ".\n"
    assert {r["doc_id"]: r["removed"] for r in runs.collect()}[201] == [1]


def test_a_run_is_found_whatever_stands_first_with_its_mark(make_docs, prose):
    rows, want = [], {}
    for k in range(0, 120, 10):
        # a, b stand together in the first document already, but with other lines beside them.
        a, b, c, p, q, r, s, z = (prose(9, 8000 + 10 * k + i) + ".\n" for i in range(8))
        rows += [(k, a + b + z), (k + 1, p + a + b + c + q), (k + 2, r + a + b + c + s)]
        want |= {k: [], k + 1: [], k + 2: [1, 2, 3]}
    assert {x["doc_id"]: x["removed"] for x in linededup.repeated_runs(make_docs(rows)).collect()} == want


def test_words_equal_brute_force(make_docs, odd_rows, prose):
    draw, pool = random.Random(12), prose(400, 77).split()
    rows = [r for r in odd_rows if r[0] is not None]
    for i in range(120):
        words = []
        while len(words) < 150:
            at = draw.randrange(400)
            words += pool[at : at + draw.randint(1, 60)] if draw.random() < 0.6 else prose(draw.randint(1, 30), draw.random()).split()
            words += ["ha"] * draw.choice([0, 0, 0, 5, 30, 61]) + ["la", "lu"] * draw.choice([0, 0, 0, 13])
        rows.append((100 + i, " \n"[draw.randrange(2)] + "".join(u + draw.choice([" ", " ", "\n", ".  ", " \r\n"]) for u in words)))
    rows.sort(key=lambda r: r[0])
    for least in (20, 7, 33):
        want = brute([(k, r[1] or "") for k, r in enumerate(rows) if r[0] >= 100], least)
        some = [r for r in rows if r[0] >= 100]
        got = deleted(linededup.repeated_runs(make_docs(some), least).collect())
        assert [got[r[0]] for r in some] == list(want.values())
    docs = make_docs(some)
    runs = linededup.repeated_runs(docs).collect()
    left = {r["doc_id"]: r["text"] for r in linededup.without_runs(docs, linededup.repeated_runs(docs)).collect()}
    for r in runs:
        words, gone = dict(some)[r["doc_id"]].split(), deleted([r])[r["doc_id"]]
        assert left[r["doc_id"]].split() == [u for k, u in enumerate(words) if k not in gone]
        assert r["n_removed_words"] == len(gone) and r["n_words"] == len(words)


def test_a_table_equals_brute_force(spark):
    from spanwatch.llm.scratch import documents

    docs = documents(spark, "/root/testdata/sf0.001").filter("doc_id is not null and text is not null")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = deleted(linededup.repeated_runs(docs).collect())
    assert len({k for k, _ in rows}) == len(rows)
    # Blanks here are those of ASCII.
    texts = [(k, " ".join(re.split("[ \t\n\x0b\f\r]+", t.strip(" \t\n\x0b\f\r"))).replace("\x85", "x").replace("\xa0", "x")) for k, t in rows]
    assert got == brute(texts)


def test_no_step_runs_python_on_the_executors(monkeypatch, make_docs, prose):
    plans = []

    def seen(made):
        def make(df, *rest):
            plans.append(df._jdf.queryExecution().toString())
            return made(df, *rest)

        return make

    for name in ("settle", "written"):
        monkeypatch.setattr(linededup, name, seen(getattr(linededup, name)))
    docs = make_docs([(k, prose(9, k) + " " + prose(40, 1) + " " + prose(9, 50 + k)) for k in range(5)])
    plans.append(linededup.repeated_runs(docs)._jdf.queryExecution().toString())
    assert len(plans) > 5
    assert not [p for p in plans if re.search("Python|Pandas|Arrow", p)]


def test_tokens_give_words_and_lines(spark):
    alphabet, draw = "ab.!? \t\r\n", random.Random(4)
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40))) for _ in range(300)] + ["", "a. ", "\n", " ", "a.\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, low string").withColumn("t", linededup._tokens(F.col("low")))
    counts = linededup._counts(linededup._cuts(F.col("t")), F.size("t")).alias("counts")
    _, plain = zip(*sorted(normal(spark, dict(enumerate(texts))).items()))
    for r in df.select("k", counts, F.size(linededup._hashes(F.col("t"))).alias("n")).collect():
        want = [len(f.split()) for f in plain[r["k"]][1]]
        assert r["counts"] in (want, want + [0]) and r["n"] == sum(want)


def test_blocks_hold_every_place_once_and_equal_runs_share_their_mark(spark):
    draw = random.Random(5)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.choice([0, 3, 6, 7, 8, 40, 90]))) for _ in range(60)] + ["ha " * 50, ""]
    df = spark.createDataFrame([(k, k, k, t) for k, t in enumerate(texts)], "row long, doc_id long, text_hash long, low string")
    for least in (1, 7, 20):
        places, marks, full = {k: [] for k in range(len(texts))}, {}, {}
        rows = linededup._blocks(df, least).collect()
        assert sorted(r["row"] for r in rows if r["cuts"] is not None) == sorted(places)
        for r in rows:
            if r["mark"] is None:
                continue
            words, own = texts[r["row"]].split(), range(r["first"], r["last"] + 1)
            places[r["row"]] += own
            runs = [tuple(words[j : j + least]) for j in own]
            assert len(set(runs)) == len(runs) > 0
            assert full.setdefault(r["all"], (r["mark"], words[own[0] : own[-1] + least])) == (r["mark"], words[own[0] : own[-1] + least])
            for run in runs:
                assert marks.setdefault(run, r["mark"]) == r["mark"]
        assert all(sorted(p) == list(range(max(len(texts[k].split()) - least + 1, 0))) for k, p in places.items())


def test_words_and_line_counts_of_a_text(spark):
    alphabet, draw = "ab.!? \t\r\n", random.Random(6)
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40))) for _ in range(400)]
    texts += ["", " ", "\n", "a. ", "a.\n", " a", "a ", "\n \n", "a\r\n\r\nb", "a.  b", "a. \nb", "\x0ba\x0cb."]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, low string").withColumn("t", linededup._spaced(F.col("low")))
    _, plain = zip(*sorted(normal(spark, dict(enumerate(texts))).items()))
    for r in df.select("k", linededup._words(F.col("t")).alias("words"), linededup._line_counts(F.col("t")).alias("n")).collect():
        forms = [f.split() for f in plain[r["k"]][1]]
        want = [len(f) for f in forms]
        assert r["words"] == [w for f in forms for w in f]
        assert r["n"] in (want, want + [0])


def test_marks_come_from_generated_code_that_the_jvm_compiles(spark, capsys):
    df = spark.createDataFrame([(1, 1, 1, "a b")], "row long, doc_id long, text_hash long, low string")
    linededup._blocks(df, linededup.MIN_WORDS).explain("codegen")
    out = capsys.readouterr().out
    # Beyond 8000 bytes the JVM interprets a method.
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", out)]
    assert sizes and max(sizes) < 8000
    assert "posexplode" in out and "zip_with" not in out
    # The words are hashed once, not in a filter below the explode as well.
    assert not re.search(r"Filter[^\n]*transform", out)
