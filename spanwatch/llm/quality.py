"""Quality rules: measures of a text, and lines that too many documents of a host share."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.scratch import documents, free_names, settle, small_batches
from spanwatch.llm.words import LOWER, SPACE, Words, mix, pieces, shingles

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
LINE_DOCUMENTS = 20  # a line is above the limits in more documents of a host than this,
LINE_PERCENT = 5  # and in more than this share of the host's documents
MAX_REMOVED_PERCENT = 50  # a document is depleted if more of its words are removed

# Symbols of the base rules; A-Z in lower case and digits as 0 in a line's normal form.
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
NORMAL = LOWER.copy()
NORMAL[0x30:0x3A] = 0x30

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_MULTIPLIER = 0xD6E8FEB86659FD93


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window found at least twice."""
    if len(words) < window:
        return 0
    _, where, n = np.unique(shingles(words, window), return_inverse=True, return_counts=True)
    twice = np.flatnonzero(n[where] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def _runs(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """One hash for each run [lo, hi) of hashes, the same wherever the run stands."""
    n = len(hashes) + 1
    up, down = np.full(n, _MULTIPLIER, np.uint64), np.full(n, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])))
    return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        texts = batch.column("text")
        words, lines = Words(texts), Words(texts, space=NEWLINE)
        normal = Words(texts, NORMAL).hashes
        count = lambda flags: np.concatenate(([0], np.cumsum(flags)))
        chars = count(((words.data & 0xC0) != 0x80) & ~SPACE[words.data])
        symbols, breaks = count(IS_SYMBOL[words.data]), count(words.data == 0x0A)
        lo, hi = np.searchsorted(words.starts, lines.starts), np.searchsorted(words.starts, lines.ends)
        worded, forms = hi > lo, _runs(normal, lo, hi)
        at, out = words.offsets, {name: [] for name in ("words", "dup", "repeat", "line", "n", "index")}
        for i in range(batch.num_rows):
            mine = np.arange(lines.first[i], lines.first[i + 1])
            mine = mine[worded[mine]]
            exact = lines.hashes[mine]
            out["words"].append(int(words.first[i + 1] - words.first[i]))
            out["dup"].append(len(exact) - len(np.unique(exact)))
            out["repeat"].append(repeated_words(words.of(i)))
            out["line"].append(forms[mine].view(np.int64))
            out["n"].append((hi - lo)[mine])
            out["index"].append(breaks[lines.starts[mine]] - breaks[at[i]])
        ends = pa.array(np.cumsum([0, *map(len, out["line"])]), pa.int32())
        flat = [pa.array(np.concatenate(out[k]) if out[k] else [], pa.int64()) for k in ("line", "n", "index")]
        kept = [batch.column(c) for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [
                *kept,
                pa.array(out["words"], pa.int64()), pa.array(chars[at[1:]] - chars[at[:-1]], pa.int64()),
                pa.array(symbols[at[1:]] - symbols[at[:-1]], pa.int64()),
                pa.array(out["dup"], pa.int64()), pa.array(out["repeat"], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, ["line", "words", "at"])),
            ],
            [*[c for c in batch.schema.names if c != "text"], *[m.split()[0] for m in MEASURES.split(", ")], "lines"],
        )


def judge(
    docs: DataFrame, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT,
    line_documents: int = LINE_DOCUMENTS, line_percent: int = LINE_PERCENT, max_removed: int = MAX_REMOVED_PERCENT,
) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (doc_id, source, text).

    A line is its words with A-Z lower-cased and digits as 0; lines without a word do not
    count. A line goes if more than ``line_documents`` distinct texts of the host (source)
    hold it, and more than ``line_percent`` of them; equal texts are one document, so copies
    alone make no line frequent. A document fails the base rules with fewer than ``min_words`` words, or
    with more than ``max_repeat`` percent of its words in repeated windows; it is depleted if
    more than ``max_removed`` percent of its words go, or fewer than ``min_words`` stay.

    Adds to doc_id and source: text_hash, the measures, base_failed, removed (numbers of the
    lines that go, from 0), n_left (words that stay) and kept. A null source is a host of
    its own; null and empty texts fail. Rows are judged one by one, equal or not.
    """
    small_batches(docs.sparkSession)
    rows = settle(
        docs.select(
            "doc_id", "source", F.xxhash64("text").alias("text_hash"), F.xxhash64("source").alias("host"),
            F.col("text").cast("string").alias("text"),
        )
        .mapInArrow(_measured, "doc_id long, source string, text_hash long, host long, " + MEASURES
                    + ", lines array<struct<line:long,words:long,at:long>>")
        .withColumn("row", F.monotonically_increasing_id())
    )
    lines = rows.select("row", "host", "text_hash", F.explode("lines").alias("l")).select(
        "row", "host", "text_hash", "l.*"
    )
    hosts = rows.groupBy("host").agg(F.count_distinct("text_hash").alias("host_documents"))
    seen = (
        lines.groupBy("host", "line").agg(F.count_distinct("text_hash").alias("n"))
        .filter(F.col("n") > line_documents)
    )
    frequent = settle(
        seen.join(hosts, "host").filter(F.col("n") * 100 > F.col("host_documents") * line_percent)
        .select("host", "line")
    )
    gone = lines.join(frequent, ["host", "line"]).groupBy("row").agg(
        F.sort_array(F.collect_list(F.col("at").cast("int"))).alias("removed"), F.sum("words").alias("n_removed")
    )
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    depleted = (100 * F.col("n_removed") > max_removed * F.col("n_words")) | (F.col("n_left") < min_words)
    return (
        rows.drop("lines", "host").join(gone, "row", "left").drop("row")
        .withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
        .withColumn("n_left", F.col("n_words") - F.col("n_removed"))
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & ~depleted)
        .drop("n_removed")
    )


def cleaned(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, their text without the removed lines; all columns of ``docs`` stay."""
    removed, doc, host, text = free_names(docs.columns, "removed", "j_doc", "j_source", "j_text")
    verdict = judged.filter("kept").select(
        F.col("doc_id").alias(doc), F.col("source").alias(host), F.col("text_hash").alias(text),
        F.col("removed").alias(removed),
    ).dropDuplicates([doc, host, text])
    lines = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(F.col(removed), i))
    same = (
        docs["doc_id"].eqNullSafe(F.col(doc)) & docs["source"].eqNullSafe(F.col(host))
        & (F.xxhash64(docs["text"]) == F.col(text))
    )
    return docs.join(verdict, same).withColumn("text", F.array_join(lines, "\n")).select(docs.columns)


def op5_quality_rules(spark, sf_dir) -> DataFrame:
    judged = judge(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.size("removed").cast("long").alias("n_removed_lines"), "n_left",
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d
), l AS (
  SELECT r, host, text, line, i - 1 AS at,
         regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
                            '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
), k AS (
  SELECT *, array_to_string(lw, ' ') AS form FROM l WHERE len(lw) > 0
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM k GROUP BY r
), f AS (
  SELECT host, form FROM k GROUP BY host, form
  HAVING count(DISTINCT text) > 20
     AND count(DISTINCT text) * 100 > 5 * (SELECT count(DISTINCT text) FROM d WHERE d.host = k.host)
), gone AS (
  SELECT r, count(*) AS n, sum(len(lw)) AS words FROM k JOIN f USING (host, form) GROUP BY r
), g AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)
), t AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(range(i, i + 8)) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM g) WHERE c > 1)
  GROUP BY r
), m AS (
  SELECT w.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(t.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(gone.words, 0) AS BIGINT) AS words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN t USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_lines, n_words - words AS n_left,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND NOT (100 * words > 50 * n_words OR n_words - words < 20) AS kept
FROM m
"""
