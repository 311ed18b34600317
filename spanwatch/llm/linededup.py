"""Repeated runs of words: winnowed blocks, equal blocks by their hash, equal word runs at the blocks' edges.

DataFrame operations only: nothing runs in Python on the executors.
"""

import gc
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanwatch.llm.quality import _runs as run_hashes
from spanwatch.llm.scratch import documents, free_names, release, remove, settle, written
from spanwatch.llm.words import Words, buffers

# A line ends with a line break, or with a sentence inside a paragraph. The parts keep their ends.
LINE_ENDS = r"(?<=\n)|(?<=[.!?][ \t\x0B\f\r])"
BLANKS = " \t\n\x0b\f\r"
INNER_BLANKS = " \t\x0b\f\r"
WORD_STARTS = r"(?<=[ \t\n\x0B\f\r])(?=[^ \t\n\x0B\f\r])"
GRAM = 8  # words that a mark has; a run of min_words holds several, and one of them is its mark
MIN_WORDS = 20


# Lines and blocks over Arrow buffers (down to word_blocks), by which tests measure; the query runs none of it.
# The bytes of LINE_ENDS.
STOPS = np.zeros(256, bool)
STOPS[list(b".!?")] = True
INNER = np.zeros(256, bool)
INNER[list(b" \t\x0b\f\r")] = True


def line_parts(text: Column) -> Column:
    """The lines of a text, which joined are the text again."""
    return F.split(F.coalesce(text, F.lit("")), LINE_ENDS, -1)


def _lists(ends: np.ndarray, **columns: np.ndarray) -> pa.ListArray:
    """Lists of structs: list i holds the elements from ``ends[i]`` to before ``ends[i + 1]``."""
    values = pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _line_words(texts: pa.Array, words: Words) -> pa.ListArray:
    """The number of words in each line of each text; a text has one line at least."""
    data, offsets = buffers(texts)
    after_stop = np.concatenate(([False], STOPS[data[:-1]])) if len(data) else np.zeros(0, bool)
    begins = offsets[:-1][offsets[:-1] < len(data)]
    after_stop[begins] = False  # the stop ends another text
    cuts = np.flatnonzero((data == 0x0A) | (INNER[data] & after_stop))
    heads = np.searchsorted(cuts, offsets[:-1])
    starts = np.insert(cuts + 1, heads, offsets[:-1])
    at = np.searchsorted(words.starts, starts)
    counts = np.diff(np.append(at, len(words.starts))).astype(np.int32)
    ends = np.append(heads + np.arange(len(heads)), len(starts))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[: max(len(values) - step, 0)], values[step:])
        have += step
    return values


def word_blocks(words: Words, min_words: int) -> pa.ListArray:
    """The blocks of each text: places (word numbers) at which runs of ``min_words`` words begin.

    Each place is in one block: those the runs of which have the same gram as their least one (the
    first of equals). ``mark`` is that gram, ``all`` a hash of every word of the block's runs,
    ``first`` and ``last`` are its places.
    """
    size = 1 << (min(GRAM, min_words).bit_length() - 1)
    hashes, first = words.hashes, words.first
    at = np.arange(max(len(hashes) - size + 1, 0))
    grams = run_hashes(hashes, at, at + size)
    least = _least(grams, min_words - size + 1)
    n = np.maximum(np.diff(first) - min_words + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    sums = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(sums[-1]) - sums[text] + first[text]
    begins = np.concatenate(([True], text[1:] != text[:-1]))[: len(text)]
    before = place - 1  # at a text's beginning it is not looked at
    begins |= (least[place] != least[before]) | (grams[before] == least[before])
    heads = np.flatnonzero(begins)
    lasts = np.append(heads[1:], len(place))[: len(heads)] - 1
    a, b, t = place[heads], place[lasts], text[heads]
    return _lists(
        np.searchsorted(t, np.arange(len(n) + 1)),
        mark=least[a].view(np.int64), all=run_hashes(hashes, a, b + min_words).view(np.int64),
        first=(a - first[t]).astype(np.int32), last=(b - first[t]).astype(np.int32),
    )


# Words with their line breaks (down to _counts), by which tests measure as well; the query runs none of it.
def _tokens(low: Column) -> Column:
    """The words of a lower-cased text with the line break that follows them at once; other breaks alone."""
    spaced = F.btrim(F.replace(low, F.lit("\n"), F.lit("\n ")), F.lit(INNER_BLANKS))
    return F.when(spaced != "", F.split(spaced, f"[{INNER_BLANKS}]+", -1)).otherwise(F.array().cast("array<string>"))


def _hashes(tokens: Column) -> Column:
    """A hash of each word of ``_tokens``."""
    bare = lambda t: F.when(t.endswith("\n"), F.rtrim(t, F.lit("\n"))).otherwise(t)
    return F.transform(F.array_remove(tokens, "\n"), lambda t: F.xxhash64(bare(t)))


def _cuts(tokens: Column) -> Column:
    """Where lines end: twice the number of the line's last token, and 1 more if that is no word."""
    ends = lambda t: t.endswith("\n") | t.endswith(".") | t.endswith("!") | t.endswith("?")
    return F.array_compact(
        F.transform(tokens, lambda t, i: F.when(ends(t), F.when(t == "\n", i * 2 + 1).otherwise(i * 2)))
    )


def _counts(cuts: Column, tokens: Column) -> Column:
    """The number of words in each line; a line without words may follow the last one."""
    token = lambda cut: F.shiftright(cut, 1)
    return F.zip_with(
        F.concat(cuts, F.array((tokens - 1) * 2)), F.concat(F.array(F.lit(-2)), cuts),
        lambda own, before: token(own) - token(before) - own.bitwiseAND(F.lit(1)),
    )


def _spaced(low: Column) -> Column:
    """A text with a space for each blank but line breaks."""
    for blank in INNER_BLANKS[1:]:
        low = F.replace(low, F.lit(blank), F.lit(" "))
    return low


def _words(spaced: Column) -> Column:
    """The words of a ``_spaced`` text. A split at a single character needs no regular expression."""
    return F.array_remove(F.split(F.replace(spaced, F.lit("\n"), F.lit(" ")), " ", -1), "")


def _line_counts(spaced: Column) -> Column:
    """The number of words in each line of a ``_spaced`` text; a line without words may follow the last one."""
    single = F.when(spaced.contains("  "), F.regexp_replace(spaced, " +", " ")).otherwise(spaced)
    for stop in ".!?":
        single = F.replace(single, F.lit(f"{stop} "), F.lit(f"{stop}\n"))
    spaces = lambda line: F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    # Spaces at the ends part no words; a lone one is at both ends.
    ends = lambda line: line.startswith(" ").cast("int") + line.endswith(" ").cast("int")
    return F.transform(F.split(single, "\n", -1), lambda line: F.when(line == "", 0).otherwise(spaces(line) + 1 - ends(line)))


def _blocks(texts: DataFrame, min_words: int) -> DataFrame:
    """The blocks of each text of ``texts`` (row, doc_id, text_hash, low), as rows.

    A place is a word number at which a run of ``min_words`` words begins. Its mark is the word with the least
    hash (the first of equals) among those with which GRAM words lie in the run. Places with one mark are one
    block: no two runs of a block are equal. ``mark`` is a hash of the GRAM words, ``all`` one of every word of
    the block's runs, ``first`` and ``last`` are its places. Besides, each text has a row with nulls there; it
    alone holds ``text_hash`` and ``cuts``, the number of words in each line.
    """
    gram = min(GRAM, min_words)
    width = min_words - gram + 1
    keys = ["row", "doc_id", "text_hash", "h", "cuts"]
    df = texts.withColumn("low", _spaced(F.col("low"))).withColumn("words", _words(F.col("low")))
    # Words count from 1 here; the text's own row stands before them.
    hashes = F.transform("words", lambda word: F.xxhash64(word))
    df = df.withColumn("h", F.concat(F.array(F.lit(0).cast("long")), hashes)).withColumn("cuts", _line_counts(F.col("low")))
    # Outer ones, as Spark evaluates what a plain explode reads once more, in a filter below it.
    df = df.select(*keys, F.posexplode_outer("h").alias("at", "own"))
    at, own = F.col("at"), F.col("own")
    left, right = F.when(at < 1, 0), F.when(at < 1, 0)
    for k in range(1, width):  # most words meet a lesser one within two steps
        left = left.when(F.get("h", at - k) <= own, k - 1)
        right = right.when(F.get("h", at + k) < own, k - 1)
    first = F.greatest(at - left.otherwise(width - 1), F.lit(1))
    last = F.least(at + right.otherwise(width - 1), F.size("h") - gram) - (width - 1)
    df = df.select(*keys, "at", first.alias("first"), last.alias("last"))
    some = at > 0
    block = F.when(~some | (F.col("first") <= F.col("last")), F.array(F.struct("first", "last")))
    df = df.select(*keys, "at", F.explode_outer(block).alias("block")).filter("block is not null")
    df = df.select(*keys, "at", "block.first", "block.last")
    run = F.slice("h", F.col("first") + 1, F.col("last") - F.col("first") + min_words)
    return df.select(
        "row", "doc_id", *(F.when(~some, F.col(c)).alias(c) for c in ("text_hash", "cuts")),
        F.when(some, F.xxhash64(F.slice("h", at + 1, F.lit(gram)))).alias("mark"),
        F.when(some, F.xxhash64(run)).alias("all"), F.when(some, F.col("first") - 1).alias("first"),
        F.when(some, F.col("last") - 1).alias("last"),
    )


def _single(held: DataFrame, min_words: int) -> DataFrame:
    """The runs that begin at the ``places`` of texts (doc_id, row, places, low), one row each."""
    words = held.select("doc_id", "row", "places", _words(_spaced(F.col("low"))).alias("words"))
    hashed = words.select("doc_id", "row", "places", F.transform("words", lambda word: F.xxhash64(word)).alias("h"))
    ranges = hashed.select("doc_id", "row", "h", F.explode_outer("places").alias("r"))  # outer ones as in _blocks
    each = ranges.select("doc_id", "row", "h", F.explode_outer(F.sequence("r.first", "r.last")).alias("first"))
    return each.select("doc_id", "row", F.xxhash64(F.slice("h", F.col("first") + 1, F.lit(min_words))).alias("all"), "first")


def _joined(places: DataFrame, min_words: int) -> DataFrame:
    """The words that repeated runs cover, in maximal runs of each row.

    ``places`` has row, kind (block or single run), first, last and origin: whether the place is the earliest of
    its kind. A place given as the earliest stays, however often it is given. Those that go share no word number
    at which runs begin: single runs are of blocks that stay.
    """
    # First above, then last, then the kind: a text of 2 GB has fewer than 2**30 words.
    packed = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.shiftleft("last", 1).cast("long")).bitwiseOR(F.col("kind").cast("long"))
    given = places.select("row", "origin", packed.alias("place")).repartition("row").groupBy("row").agg(
        F.collect_list(F.when(F.col("origin") == 0, F.col("place"))).alias("all"),
        F.collect_list(F.when(F.col("origin") == 1, F.col("place"))).alias("kept"),
    )
    later = given.select("row", F.sort_array(F.array_except("all", "kept")).alias("p"))
    each = later.select("row", "p", F.posexplode_outer("p").alias("i", "place")).filter("place is not null")
    begin = lambda place: F.shiftright(place, 32)
    end = lambda place: F.shiftright(place.bitwiseAND(F.lit(2**32 - 1)), 1) + min_words
    i, place = F.col("i"), F.col("place")
    opens = (i == 0) | (begin(place) > end(F.get("p", i - 1)))
    closes = (i == F.size("p") - 1) | (begin(F.get("p", i + 1)) > end(place))
    bounds = each.select(
        "row", F.when(opens, begin(place)).cast("int").alias("first"), F.when(closes, end(place) - 1).cast("int").alias("last")
    ).filter("first is not null or last is not null")
    runs = bounds.groupBy("row").agg(
        (F.sum("last") - F.sum("first") + F.count("first")).alias("n"),
        F.sort_array(F.collect_list("first")).alias("first"), F.sort_array(F.collect_list("last")).alias("last"),
    )
    return runs.select("row", "n", F.arrays_zip("first", "last").alias("runs"))


def _release(spark: SparkSession) -> None:
    """``release``, once the frames that Python no longer holds are let go of in the JVM too, by a thread of its own."""
    gc.collect()
    time.sleep(1)
    release(spark)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): its lines and words, and those that repeat an earlier run.

    Returns doc_id, text_hash, n_lines, n_words (lines with a word), runs (first, last: numbers
    of the words to delete, from 0, in maximal runs), removed (numbers of the lines, from 0, among
    ``line_parts``, all words of which are deleted), n_removed_words. Earlier is by doc_id (null first),
    then by the order of the table, then by place. A word is deleted if it stands in a run of ``min_words``
    words that, case and spaces aside, stands somewhere earlier, in the same document or another; lines
    and sentences do not matter. So every earlier run counts, and the earliest occurrence of each stays.

    Runs are compared in blocks: those that share their least gram. Of equal blocks all but the first
    repeat; where a mark has several blocks, the runs of the first of each are compared one by one.
    Rows of a shuffle grow with the words; runs one by one are only those at the edges of what repeats.
    Words and runs are equal if their 64-bit hashes are.
    Null and empty texts have no words. Equal rows follow each other; all but the first lose
    what repeats. Other columns are not read.
    """
    spark = docs.sparkSession
    text_of = F.lower(F.col("text").cast("string"))
    low = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"),
        F.coalesce(text_of, F.lit("")).alias("low"),
    )
    made, made_at = written(_blocks(low, min_words), "blocks")
    lines = settle(made.filter("cuts is not null").select("doc_id", "text_hash", "row", F.col("cuts").alias("words")))
    every = made.filter("mark is not null").select("doc_id", "row", "mark", "all", "first", "last")
    shared = settle(every.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark"))
    _release(spark)
    again, again_at = written(every.join(shared.hint("shuffle_hash"), "mark"), "again")
    remove(spark, made_at)
    del shared
    _release(spark)
    # Of equal blocks, all but the earliest repeat. A block is named by its row and its first place.
    order = F.struct("doc_id", "row", "first", "last")
    earliest, earliest_at = written(
        again.groupBy("mark", "all").agg(F.min(order).alias("o")).select("mark", "o.row", "o.first", "o.last"), "earliest"
    )
    # Where blocks with one mark differ, each run of the earliest blocks is looked for by itself.
    several = settle(earliest.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark"))
    edges = (
        earliest.join(several, "mark")
        .groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("places"))
        .join(lines.select("doc_id", "text_hash", "row"), "row")
    )
    doc, hashed = free_names(edges.columns, "j_doc", "j_text")
    texts = docs.select(
        F.col("doc_id").alias(doc), F.xxhash64("text").alias(hashed), F.coalesce(text_of, F.lit("")).alias("low")
    )
    held = texts.join(edges.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col("text_hash") == F.col(hashed)))
    # Rows that agree in id and text meet each other's places; a run that so comes twice changes nothing.
    single = settle(_single(held, min_words))
    _release(spark)
    # Of equal runs, too, all but the earliest repeat; most runs here have no equal.
    equal = single.groupBy("all").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("all")
    equal = settle(single.join(equal.hint("shuffle_hash"), "all"))
    first_runs = equal.groupBy("all").agg(F.min(F.struct("doc_id", "row", "first")).alias("o"))
    repeats = equal.join(first_runs.hint("shuffle_hash"), "all").filter("row != o.row or first != o.first")
    kind = lambda df, kind, origin: df.select(
        "row", F.lit(kind).alias("kind"), "first", "last", F.lit(origin).alias("origin")
    )
    places = (
        kind(again, 0, 0).union(kind(earliest, 0, 1))
        .union(kind(repeats.select("row", "first", F.col("first").alias("last")), 1, 0))
    )
    gone = settle(_joined(places, min_words))
    remove(spark, again_at)
    remove(spark, earliest_at)
    del single, equal, first_runs, repeats, places, several
    _release(spark)
    total = lambda column: F.aggregate(column, F.lit(0).cast("long"), lambda a, b: a + b)
    line_of = F.flatten(F.transform("words", lambda n, i: F.array_repeat(i, n)))
    # Of a run's first line, the beginning must be deleted as well, and of its last one the end.
    part = lambda a, b: F.coalesce(F.get("line", a) == F.get("line", b), F.lit(False)).cast("int")
    low = lambda r: F.get("line", r["first"]) + part(r["first"] - 1, r["first"])
    high = lambda r: F.get("line", r["last"]) - part(r["last"], r["last"] + 1)
    none = F.array().cast("array<int>")
    whole = F.flatten(F.transform("runs", lambda r: F.when(low(r) <= high(r), F.sequence(low(r), high(r))).otherwise(none)))
    return (
        lines.select("doc_id", "text_hash", "row", "words").join(gone, "row", "left")
        .select(
            "doc_id", "text_hash", "words", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed_words"),
            F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("runs"),
            F.when(F.col("n") > 0, line_of).alias("line"),
        )
        .select(
            "doc_id", "text_hash", F.size(F.filter("words", lambda n: n > 0)).cast("long").alias("n_lines"),
            total(F.col("words")).alias("n_words"), "runs",
            F.filter(whole, lambda i: F.get("words", i) > 0).alias("removed"), "n_removed_words",
        )
    )


def without_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``docs`` with the words of ``runs`` (from ``repeated_runs``) deleted; all columns stay.

    The blanks after a word go with it.

    Rows that agree in doc_id and text cannot be told apart: all but one lose what the later
    ones lose, and one loses what the first one does.
    """
    names = free_names(docs.columns, "runs", "n", "j_doc", "j_text", "turn", "j_turn", "parts", "bounds")
    gone, n, doc, text, turn, j_turn, parts, bounds = names
    verdict = runs.select(
        F.col("doc_id").alias(doc), F.col("text_hash").alias(text), F.col("runs").alias(gone),
        F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("n_removed_words")).alias(j_turn),
    )
    own = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(1))
    turned = docs.withColumn(turn, F.row_number().over(own))
    same = (
        turned["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(turned["text"]) == F.col(text))
        & (F.col(turn) == F.col(j_turn))
    )
    # Blanks before the first word are a part of their own.
    head = (F.btrim(F.get(parts, F.lit(0)), F.lit(BLANKS)) == "").cast("int")
    edge = lambda place: F.array(F.struct(place.alias("first"), place.alias("last")))
    placed = (
        turned.join(verdict, same)
        .withColumn(parts, F.split(F.coalesce("text", F.lit("")), WORD_STARTS, -1)).withColumn(n, head)
        .withColumn(bounds, F.concat(
            edge(F.lit(-1)),
            F.transform(gone, lambda r: F.struct((r["first"] + F.col(n)).alias("first"), (r["last"] + F.col(n)).alias("last"))),
            edge(F.size(parts)),
        ))
    )
    between = F.zip_with(
        F.slice(bounds, 1, F.size(bounds) - 1), F.slice(bounds, 2, F.size(bounds) - 1),
        lambda a, b: F.array_join(F.slice(parts, a["last"] + 2, b["first"] - a["last"] - 1), ""),
    )
    cleaned = F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(between, ""))
    return placed.withColumn("text", F.when(F.col("text").isNotNull(), cleaned)).select(docs.columns)


def op10_line_dedup(spark, sf_dir) -> DataFrame:
    return repeated_runs(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_words", "runs", "removed", F.size("removed").cast("long").alias("n_removed"), "n_removed_words"
    )
