import hashlib
import random
import re
import zlib
from functools import reduce
from itertools import product

import pytest

from spanwatch.llm import repair

COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def ordered(rows):
    def digest(r):
        return hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()

    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """A plain walk over rows and states that keeps the least cost and text of edits, inserts one by one."""
    best = {"": (0, "", ())}

    def step(at, letter, more, out, item):
        cost, edits, rows_ = at
        new = (cost + more, edits + letter, rows_ + item)
        if out not in states or new[:2] < states[out][:2]:
            states[out] = new
            return True
        return False

    def follow(state):
        return "a" if state == "u" else "u"

    def insert_all():
        again = True
        while again:
            again = any([step(at, "I", 3, follow(s), (f"{'user' if follow(s) == 'u' else 'assistant'}:",)) for s, at in list(states.items())])

    for (_, _, role, text), fault in zip(rows, found):
        states = best
        insert_all()
        before, states = states, {}
        for s, at in before.items():
            step(at, "D", 4, s, ())
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                kind, go = role[:1], follow(s)
                if kind == go or kind == "s" and s == "":
                    step(at, "K", more, kind, (f"{role}:{text}",))
                step(at, "R", 3 + more, go, (f"{'user' if go == 'u' else 'assistant'}:{text}",))
        best = states
    states = best
    insert_all()
    return min(states[s] for s in ("", "a") if s in states)


def plain(rows):
    rows = ordered(rows)
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    found = faults(rows)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    kinds = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
    cost, audit, written = cheapest(rows, found)
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(written).encode()).hexdigest())


def conversations(rows, hurt=False):
    groups = {r[0]: [] for r in rows}
    for r in damage(rows) if hurt else [(r[0], r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows]:
        groups[r[0]].append(r)
    return {c: plain(g) for c, g in groups.items()}


def table(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)


def collected(df):
    got = [(r["conv_id"], tuple(r[c] for c in COLUMNS)) for r in df.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def some(seed, count, longest):
    draw = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choices(["user", "assistant", "system", "tool", "u", "", None], [8, 8, 2, 1, 1, 1, 1])[0]
            text = draw.choices(["Yes.", "No!", "cut", " ", "", None, f"t{draw.random()}.", "x.\n", "é?"], [2, 2, 2, 1, 1, 1, 9, 1, 1])[0]
            rows.append((conv, draw.choice([turn, turn, turn, turn // 2, None, turn + 1]), role, text))
    return rows


def test_cheapest_finds_the_least_of_all_edits():
    """The plain walk itself, against every sequence of edits of short conversations."""
    for kinds in product("suao", repeat=3):
        for found in product(("", "truncated", "blank"), repeat=3):
            rows = [(0, i, k, f"{i}.") for i, k in enumerate(kinds)]
            costs = []
            for inserted in product(range(3), repeat=4):
                if sum(inserted) > 3:
                    continue
                for edits in product("KRD", repeat=3):
                    cost, audit, roles = 0, "", ""
                    for n, edit, k, f in zip(inserted, (*edits, ""), (*kinds, ""), (*found, "")):
                        audit, cost = audit + "I" * n + edit, cost + 3 * n
                        for _ in range(n):
                            roles += "a" if roles[-1:] == "u" else "u"
                        if edit in ("K", "R"):
                            roles += k if edit == "K" else "a" if roles[-1:] == "u" else "u"
                            cost += (3 if edit == "R" else 0) + (3 if f == "truncated" else 0) + (1000 if f == "blank" else 0)
                        cost += 4 if edit == "D" else 0
                    if re.fullmatch("(s?(ua)+)?", roles):
                        costs.append((cost, audit))
            assert cheapest(rows, found)[:2] == min(costs)


@pytest.mark.parametrize("segment, rounds", [(1024, 8), (3, 2), (1, 0), (7, 4)])
def test_rows_equal_brute_force(spark, monkeypatch, segment, rounds):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rules = repair.grammar
    monkeypatch.setattr(repair, "grammar", lambda seqs: rules(seqs, rounds))
    rows = some(segment, 60, 14)
    assert collected(repair.repair_conversations(table(spark, rows))) == conversations(rows)


def test_damage_and_every_conversation(spark):
    rows = some(1, 150, 6)
    df = table(spark, rows)
    got = collected(repair.repair_conversations(repair.damaged(df), df))
    assert got == conversations(rows, hurt=True)
    assert any(v[6] == "" for v in got.values())


def test_a_hot_conversation_goes_over_many_segments(spark):
    draw = random.Random(2)
    rows = [(7, i, draw.choice(["user", "assistant"]), draw.choice(["ok.", f"{i}.", f"{i}"])) for i in range(6000)]
    rows += [(8, i, "user", "same.") for i in range(500)] + [(9, 1, "user", "same.")] * 700
    assert collected(repair.repair_conversations(table(spark, rows, 9))) == conversations(rows)


def test_grammar_rules_stand_for_what_they_replace(spark):
    seqs = spark.createDataFrame([("ABABABCB" * 20,), ("ABCB" * 9,), ("A",), ("BABA",)], "seq string")
    rules = repair.grammar(seqs)
    assert rules
    known = {chr(repair.FIRST_SYMBOL + i): chr(repair.FIRST_SYMBOL + i) for i in range(16)}
    for i, (left, right) in enumerate(rules):
        known[chr(repair.FIRST_RULE + i)] = known[left] + known[right]
    for row in seqs.select("seq", repair._packed(rules).alias("packed")).collect():
        assert "".join(known[s] for s in row["packed"]) == row["seq"]
        assert len(row["packed"]) < 20


def test_matrices_of_rules_equal_those_of_their_symbols():
    symbols = [chr(repair.FIRST_SYMBOL + i) for i in range(16)]
    draw = random.Random(3)
    rules = []
    for i in range(40):
        rules.append(tuple(draw.choice(symbols + [chr(repair.FIRST_RULE + k) for k in range(i)][-6:]) for _ in "ab"))
    known = repair.matrices(rules)
    flat = lambda m: {k: (c, repair.text_of(r)) for k, (c, r) in m.items()}

    def spelled(s):
        return s if s in symbols else "".join(map(spelled, rules[ord(s) - repair.FIRST_RULE]))

    for i in range(40):
        word = spelled(chr(repair.FIRST_RULE + i))
        if len(word) < 3000:
            assert flat(known[chr(repair.FIRST_RULE + i)]) == flat(reduce(repair.times, (known[s] for s in word)))


def test_nulls_ties_clashing_columns_and_empty_tables(spark):
    from pyspark.sql import functions as F

    rows = [(None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (None, 1, "assistant", "b."), (1, None, "user", None),
            (2, 5, "system", "x" * 100_000 + "."), (2, 5, "assistant", "."), (2, -4, "user", "?"), (3, 1, "ünder", "\u00a0")]
    df = table(spark, rows)
    wide = df.withColumn("symbols", F.lit("A")).withColumn("part", F.lit(3)).withColumn("step", F.lit(9)).withColumn("seq", F.lit(""))
    assert collected(repair.repair_conversations(wide)) == conversations(rows)
    assert repair.repair_conversations(df.limit(0)).collect() == []
    got = collected(repair.repair_conversations(df.where("conv_id = 1"), df))
    assert got[2] == plain([]) and got[1] == conversations(rows)[1]
