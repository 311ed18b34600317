"""Conversation structure repair: cheapest edits by min-plus matrices of a grammar that conversations share."""

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.llm.scratch import settle

BLANKS = " \t\n\x0b\f\r"
SEGMENT = 1024  # rows of a conversation that are taken as one sequence at most
ROUNDS, RULES_A_ROUND = 8, 16  # of the grammar
LEAST = 4  # places that a pair of symbols needs to become a rule

# The costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# A row is one symbol: the letter for its role's initial (s, u, a, other) and its first fault.
CLASSES, FAULTS = "suao", ("", "truncated", "blank", "duplicate")
FIRST_SYMBOL, FIRST_RULE = ord("A"), 0xE000
LEGAL = {"su", "ua", "au"}
# States of what is written so far: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = range(4), (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}

# A rope is a text or a pair of ropes. An entry of a matrix is a cost and the rope of its edits' initials.
Rope = str | tuple
Entry = tuple[int, Rope]
Matrix = dict[tuple[int, int], Entry]


def leaves(rope: Rope) -> Iterator[str]:
    left = [rope]
    while left:
        top = left.pop()
        if isinstance(top, str):
            yield top
        else:
            left.extend((top[1], top[0]))


def text_of(rope: Rope) -> str:
    return "".join(leaves(rope))


def lesser(one: Entry, two: Entry | None) -> Entry:
    """The cheaper entry; of equally cheap ones that whose edits come first as ASCII."""
    if two is None or one[0] != two[0]:
        return one if two is None or one[0] < two[0] else two
    if one[1] is two[1]:
        return one
    return one if text_of(one[1]) < text_of(two[1]) else two


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: first ``a``, then ``b``. Edits of the same rows and cost are never one
    the beginning of the other, so the least of parts make the least whole."""
    out: Matrix = {}
    for (p, m), (cost, rope) in a.items():
        for q in STATES:
            if (more := b.get((m, q))) is not None:
                out[p, q] = lesser((cost + more[0], (rope, more[1])), out.get((p, q)))
    return out


def inserts() -> Matrix:
    """No insert, or as many as lead to another state."""
    out: Matrix = {}
    for p in STATES:
        at, n = p, 0
        while (p, at) not in out:
            out[p, at] = (INSERT * n, "I" * n)
            at, n = NEXT[at], n + 1
    return out


def row_matrix(symbol: int) -> Matrix:
    """What may be done with a row, after any inserts before it."""
    kind, fault = CLASSES[symbol % 4], FAULTS[symbol // 4]
    edits: Matrix = {(p, p): (DELETE, "D") for p in STATES}
    if fault in ("", "truncated"):
        more = TRUNCATED if fault else 0
        for p in STATES:
            edits[p, NEXT[p]] = (REROLE + more, "R")
        for p, q in KEEP[kind].items():
            edits[p, q] = (more, "K")
    return times(inserts(), edits)


def matrices(rules: Iterable[tuple[str, str]]) -> dict[str, Matrix]:
    """The matrix of each symbol and, from the bottom up, of each rule, which stands for two of them."""
    known = {chr(FIRST_SYMBOL + i): row_matrix(i) for i in range(16)}
    for i, (left, right) in enumerate(rules):
        known[chr(FIRST_RULE + i)] = times(known[left], known[right])
    return known


class Paths:
    """The cheapest edits so far that lead to each state, over segments of any number.

    How two of them compare is carried on, so no text is compared twice: either that is decided, or
    one is the beginning of the other and what the other has more is kept.
    """

    def __init__(self):
        self.best = {START: (0, None)}
        self.order: dict[tuple[int, int], int | tuple[str, str]] = {}

    def _compare(self, p: int, more_p: str, q: int, more_q: str) -> int | tuple[str, str]:
        known = self.order[p, q] if p != q else ("", "")
        if isinstance(known, int):
            return known
        x, y = known[0] + more_p, known[1] + more_q
        if x.startswith(y) or y.startswith(x):
            n = min(len(x), len(y))
            return x[n:], y[n:]
        return -1 if x < y else 1

    def add(self, matrix: dict[tuple[int, int], tuple[int, str]]) -> None:
        came: dict[int, tuple[int, int, str]] = {}
        for (p, q), (cost, edits) in matrix.items():
            if p not in self.best:
                continue
            total, old = self.best[p][0] + cost, came.get(q)
            if old is not None and old[0] == total:
                if self._compare(p, edits, old[1], old[2]) == -1:
                    came[q] = (total, p, edits)
            elif old is None or total < old[0]:
                came[q] = (total, p, edits)
        order = {
            (q, r): self._compare(came[q][1], came[q][2], came[r][1], came[r][2]) for q in came for r in came if q != r
        }
        self.best = {q: (total, (self.best[p][1], edits)) for q, (total, p, edits) in came.items()}
        self.order = order

    def end(self) -> tuple[int, str]:
        self.add(inserts())
        states = [q for q in ENDS if q in self.best]
        best = states[0]
        for q in states[1:]:
            cost, least = self.best[q][0], self.best[best][0]
            if cost < least or cost == least and self._compare(q, "", best, "") == -1:
                best = q
        cost, node = self.best[best]
        parts = []
        while node is not None:
            parts.append(node[1])
            node = node[0]
        return cost, "".join(reversed(parts))


def _symbol(kind: Column, fault: str) -> Column:
    first = FIRST_SYMBOL + 4 * FAULTS.index(fault)
    return F.translate(kind, CLASSES, "".join(chr(first + i) for i in range(4)))


def _shaped(turns: DataFrame) -> DataFrame:
    """Rows with their role's initial, a digest of role and text, and whether they are blank or truncated."""
    said = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    return turns.select(
        "conv_id", "turn", "role", "text", "times",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("kind"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


def _symbols(rows: DataFrame) -> DataFrame:
    """One row per different row of a turn, with the symbols of all its repeats.

    Repeats are added up before the shuffle. The first of equal rows is found by a least turn per
    conversation and digest, and joined, so that a line which comes again and again is no window.
    """
    each = rows.groupBy("conv_id", "turn", "role", "digest", "kind", "blank", "truncated").agg(F.sum("times").cast("int").alias("n"))
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    first = each.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(turn).alias("first"))
    here = (F.col("digest") == F.col("d")) & F.col("conv_id").eqNullSafe(F.col("c"))
    own = F.when(F.col("truncated"), _symbol(F.col("kind"), "truncated")).otherwise(_symbol(F.col("kind"), ""))
    again = _symbol(F.col("kind"), "duplicate")
    symbols = (
        F.when(F.col("blank"), F.repeat(_symbol(F.col("kind"), "blank"), F.col("n")))
        .when(F.col("first") == turn, F.concat(own, F.repeat(again, F.col("n") - 1)))
        .otherwise(F.repeat(again, F.col("n")))
    )
    return each.join(first, here).select("conv_id", "turn", "role", "digest", symbols.alias("symbols"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences of a sorted partition's conversations, of SEGMENT symbols at most."""
    part, held, at, conv = TaskContext.get().partitionId(), "", 0, None
    made: list[tuple] = []
    for batch in batches:
        for c, symbols in zip(batch.column("conv_id").to_pylist(), batch.column("symbols").to_pylist()):
            if held and c != conv:
                made.append((conv, at, held))
                at, held = at + 1, ""
            conv, held = c, held + symbols
            if len(held) >= SEGMENT:
                made += [(conv, at + i // SEGMENT, held[i : i + SEGMENT]) for i in range(0, len(held), SEGMENT)]
                at, held = made[-1][1] + 1, ""
        yield _segments(made, part, batch.schema.field("conv_id").type)
        made = []
    if held:
        yield _segments([(conv, at, held)], part, batch.schema.field("conv_id").type)


def _segments(made: list[tuple], part: int, kind: pa.DataType) -> pa.RecordBatch:
    convs, at, seqs = zip(*made) if made else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(convs, kind), pa.array([part] * len(made), pa.int64()), pa.array(at, pa.int64()), pa.array(seqs, pa.string())],
        ["conv_id", "part", "at", "seq"],
    )


def _packed(rules: list[tuple[str, str]]) -> Column:
    """A sequence with each rule's pair replaced by its symbol, rule after rule."""
    return reduce(
        lambda seq, i: F.replace(seq, F.lit("".join(rules[i])), F.lit(chr(FIRST_RULE + i))), range(len(rules)), F.col("seq")
    )


def grammar(seqs: DataFrame, rounds: int = ROUNDS) -> list[tuple[str, str]]:
    """Re-Pair rules over all sequences (``seq``): each round makes the most frequent adjacent pairs rules.

    Spark counts the pairs; the driver gets RULES_A_ROUND of them a round.
    """
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        symbols = seqs.select(F.split(_packed(rules), "").alias("s")).where(F.size("s") > 1)
        pairs = symbols.select(F.explode(F.zip_with(
            F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s") - 1),
            lambda left, right: F.concat(left, right),
        )).alias("pair"))
        top = pairs.groupBy("pair").count().where(F.col("count") >= LEAST).orderBy(F.desc("count"), "pair").limit(RULES_A_ROUND)
        found = [(r["pair"][0], r["pair"][1]) for r in top.collect()]
        if not found:
            break
        rules += found
    return rules


EVALUATED = (
    "seq string, edits array<struct<p: int, q: int, cost: long, audit: string>>, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string"
)


def _evaluated(rules: list[tuple[str, str]]):
    """Matrix and counts of each distinct sequence, from the symbols of its compressed form."""

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(rules)
        for batch in batches:
            out = []
            for seq, packed in zip(batch.column("seq").to_pylist(), batch.column("packed").to_pylist()):
                matrix = reduce(times, (known[s] for s in packed))
                codes = [ord(s) - FIRST_SYMBOL for s in seq]
                kinds = [CLASSES[c % 4] for c in codes]
                faults = [FAULTS[c // 4] for c in codes]
                out.append({
                    "seq": seq,
                    "edits": [{"p": p, "q": q, "cost": cost, "audit": text_of(rope)} for (p, q), (cost, rope) in matrix.items()],
                    **{f: faults.count(f) for f in FAULTS[1:]},
                    "illegal": sum(a + b not in LEGAL for a, b in zip(kinds, kinds[1:])),
                    "first": kinds[0], "last": kinds[-1],
                })
            edit = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("seq", pa.string()), ("edits", pa.list_(edit)), ("blank", pa.int64()), ("duplicate", pa.int64()),
                ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
            ]))

    return evaluate


COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of each conversation, in order, put together: counts, cost and audit."""
    conv, paths, counts, last = None, None, None, None

    def done() -> dict:
        cost, audit = paths.end()
        return {"conv_id": conv, **counts, "cost": cost, "audit": audit}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if paths is None or row["conv_id"] != conv:
                if paths is not None:
                    out.append(done())
                conv, paths, counts, last = row["conv_id"], Paths(), dict.fromkeys(COUNTS, 0), None
            for c in COUNTS:
                counts[c] += row[c]
            counts["illegal"] += last is not None and last + row["first"] not in LEGAL
            last = row["last"]
            paths.add({(e["p"], e["q"]): (e["cost"], e["audit"]) for e in row["edits"]})
        schema = _joined_schema(batch.schema.field("conv_id").type)
        yield pa.RecordBatch.from_pylist(out, schema)
    if paths is not None:
        yield pa.RecordBatch.from_pylist([done()], schema)


def _joined_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", kind), *((c, pa.int64()) for c in COUNTS), ("cost", pa.int64()), ("audit", pa.string())])


class _Written:
    """A conversation as its rows pass by in order: its turns, and the digest of its repaired form."""

    def __init__(self, conv, told: dict | None):
        self.conv, self.told = conv, told
        self.audit = told["audit"] if told else ""
        self.at, self.state, self.digest, self.begun = 0, START, hashlib.sha256(), False
        self.low = self.high = None
        self.turns = 0

    def _put(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode())
        self.begun = True

    def _to_next(self, text: str) -> None:
        self.state = NEXT[self.state]
        self._put("user" if self.state == USER else "assistant", text)

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._to_next("")
            self.at += 1

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None and turn != self.high:  # turns come in order
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self._to_next(text)
        elif edit == "K":
            self.state = KEEP[role[0]][self.state]
            self._put(role, text)

    def end(self) -> dict:
        self._inserted()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        told = self.told or dict.fromkeys((*COUNTS, "cost"), 0)
        return {"conv_id": self.conv, "gaps": gaps, **{c: told[c] for c in (*COUNTS, "cost")},
                "audit": self.audit, "repaired_sha256": self.digest.hexdigest()}


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: a row that names it, one with its audit if it has rows, and its rows in order."""
    now, schema = None, None
    for batch in batches:
        out = []
        kind = batch.schema.field("conv_id").type
        schema = pa.schema([("conv_id", kind), ("gaps", pa.int64()), *((c, pa.int64()) for c in (*COUNTS, "cost")),
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for row in batch.to_pylist():
            if row["step"] < 2:
                if now is None or now.conv != row["conv_id"]:
                    if now is not None:
                        out.append(now.end())
                    now = _Written(row["conv_id"], None)
                if row["step"] == 1:
                    now = _Written(row["conv_id"], row)
                continue
            for _ in range(row["times"]):
                now.add(row["turn"], row["role"], row["text"])
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.end()], schema)


def repair_conversations(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Cheapest repair of every conversation of ``turns`` (conv_id, turn, role, text, and times if rows repeat).

    A repaired conversation's role initials are ``(s?(ua)+)?``. Keeping a row costs 0, another role 3,
    deleting it 4, inserting an empty row 3, and keeping a truncated row 3 more; blank rows and
    repeats of a role and text are deleted. Of the cheapest edits, those whose initials come first as ASCII are
    taken. Gives conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows stand in the order of turn (null first), then of role, then of a digest of the text, as nothing else
    orders them. Null roles and texts are one space; a null conv_id is a conversation; rows that are equal
    in all columns are repeats. ``ids`` names conversations that are given though they have no rows. An
    empty table gives an empty one; other columns are not read.

    Roles and faults of a conversation are a sequence of symbols, cut after SEGMENT of them. All distinct
    sequences share one grammar, whose rules' matrices are worked out once. A long conversation
    is cut over many tasks; only its digest, which needs its rows one after the other, passes one task,
    row by row, with no more than its audit in memory.
    """
    given = [c for c in turns.columns if c.lower() == "times"]
    rows = _shaped(turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.col(given[0]).cast("int") if given else F.lit(1)).alias("times"),
    ).where("times > 0"))
    kind = dict(turns.dtypes)["conv_id"]
    order = ["conv_id", "turn", "role", "digest"]
    sorted_rows = _symbols(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    segments = settle(sorted_rows.mapInArrow(_cut, f"conv_id {kind}, part long, at long, seq string"))
    seqs = settle(segments.select("seq").distinct())
    rules = grammar(seqs)
    evaluated = seqs.select("seq", _packed(rules).alias("packed")).mapInArrow(_evaluated(rules), EVALUATED)
    told = (
        segments.join(evaluated, "seq").drop("seq").repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
        .mapInArrow(_joined, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string")
    )
    named = (turns if ids is None else ids).select("conv_id").distinct().withColumn("step", F.lit(0))
    parts = named.unionByName(told.withColumn("step", F.lit(1)), allowMissingColumns=True).unionByName(
        rows.select(*order, "text", "times", F.lit(2).alias("step")), allowMissingColumns=True
    )
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "step", "turn", "role", "digest").drop("digest").mapInArrow(
        _repaired, f"conv_id {kind}, gaps long, " + ", ".join(f"{c} long" for c in (*COUNTS, "cost"))
        + ", audit string, repaired_sha256 string"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of their conversation and turn; ``times`` tells how often a row stands."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = filled("text")
    return conversations.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(filled("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1).alias("times"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_conversations(damaged(conversations), conversations)


_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS BIGINT)) % 20"""
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), marked AS (SELECT *, {_CRC32} AS harm FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM marked, (VALUES (1), (2)) copies(copy) WHERE harm <> 0 AND (copy = 1 OR harm = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS pos,
    rtrim(text, {_BLANKS}) AS said, substr(role, 1, 1) AS kind FROM hurt
), judged AS (
  SELECT *, CASE WHEN said = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
    lag(kind) OVER (PARTITION BY conv_id ORDER BY pos) || kind AS step FROM placed
), inserts(p, q, cost, letters) AS (VALUES
  (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (2, 3, 3, 'I'), (3, 2, 3, 'I'),
  (0, 3, 6, 'II'), (1, 3, 6, 'II')
), kept(kind, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
moved(p, q) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
edits AS (
  SELECT conv_id, pos, p, q, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cost, 'K' AS letter
  FROM judged JOIN kept USING (kind) WHERE fault IN ('fine', 'truncated')
  UNION ALL SELECT conv_id, pos, p, q, CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, 'R'
  FROM judged, moved WHERE fault IN ('fine', 'truncated')
  UNION ALL SELECT conv_id, pos, p, p, 4, 'D' FROM judged, (VALUES (0), (1), (2), (3)) s(p)
), steps AS (
  SELECT conv_id, pos, i.p, e.q, i.cost + e.cost AS cost, i.letters || e.letter AS letters
  FROM edits e JOIN inserts i ON i.q = e.p
), paths AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, {{'cost': 0, 'audit': ''}} AS best FROM hurt
  UNION ALL
  SELECT w.conv_id, s.pos, s.q, min({{'cost': w.best.cost + s.cost, 'audit': w.best.audit || s.letters}})
  FROM paths w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.pos = w.pos + 1 AND s.p = w.state
  GROUP BY w.conv_id, s.pos, s.q
), sizes AS (
  SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), chosen AS (
  SELECT z.conv_id, min({{'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.letters}}) AS best
  FROM sizes z JOIN paths w ON w.conv_id IS NOT DISTINCT FROM z.conv_id AND w.pos = z.n JOIN inserts i ON i.p = w.state
  WHERE i.q IN (0, 3) GROUP BY z.conv_id
), letters AS (
  SELECT conv_id, i, substr(best.audit, CAST(i AS INT), 1) AS letter,
    length(replace(substr(best.audit, 1, CAST(i AS INT)), 'I', '')) AS pos,
    length(replace(substr(best.audit, 1, CAST(i AS INT)), 'D', '')) AS place
  FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS i FROM chosen)
), written AS (
  SELECT l.conv_id, l.i, l.letter, l.place, j.role, j.text, j.kind,
    max(CASE WHEN l.letter = 'K' AND j.kind = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS led
  FROM letters l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.pos = l.pos AND l.letter <> 'I'
  WHERE l.letter <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role
      WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END,
    chr(10) ORDER BY i)) AS digest FROM written GROUP BY conv_id
)
SELECT c.conv_id, coalesce(z.gaps, 0) AS gaps, coalesce(z.blank, 0) AS blank, coalesce(z.duplicate, 0) AS duplicate,
  coalesce(z.truncated, 0) AS truncated, coalesce(z.illegal, 0) AS illegal,
  CAST(coalesce(h.best.cost, 0) AS BIGINT) AS cost, coalesce(h.best.audit, '') AS audit,
  coalesce(r.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""
