"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value calibration."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.scratch import documents, settle, small_batches, texts
from spanwatch.llm.words import Words, mix, pieces, shingles

TRAIN_ROWS = 20_000  # labelled rows that a model is fitted on, at most about
MODEL_SIZE = 20_000  # features that a model keeps, at most
PRIOR = 50.0  # strength of the Dirichlet prior, in documents
MIN_G = 20.0  # likelihood ratio statistic that a feature needs
MIN_ODDS = 2.0
MIN_WEIGHT = 2.5  # toxic documents, near copies counted once, that must hold a feature
BACKGROUND = -0.25  # score of a token that tells nothing
THRESHOLD = 0.7
SIGNIFICANCE = 0.05
PREFIXES = (4, 5, 6, 7, 8, 9)
HELD_OUT = "crc32(cast(doc_id as string)) % 3 = 1"

# Fixed value: ASCII letters and all bytes of other characters make tokens.
BREAK = np.ones(256, bool)
BREAK[0x41:0x5B] = BREAK[0x61:0x7B] = BREAK[0x80:] = False


class Tokens:
    """Lower-cased tokens of a batch, and their features: the token and its beginnings."""

    def __init__(self, texts: pa.Array):
        self.words = Words(pc.utf8_lower(texts), space=BREAK, prefixes=PREFIXES)
        self.features = [self.words.hashes, *self.words.prefixes.values()]
        self.first = self.words.first

    def present(self, i: int) -> np.ndarray:
        """Distinct features of text ``i``."""
        lo, hi = self.first[i], self.first[i + 1]
        found = np.unique(np.concatenate([f[lo:hi] for f in self.features]))
        return found[found != 0]


@dataclass
class Model:
    """Features with their scores (sorted by feature), and what turns segment sums into a score."""

    keys: np.ndarray
    odds: np.ndarray
    scale: float = 1.0  # lambda of the extreme-value law
    offset: float = 0.0
    slope: float = 1.0

    def __post_init__(self):
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def token_scores(self, tokens: Tokens) -> np.ndarray:
        """Per token the largest log-odds of its features, or the background score."""
        scores = np.full(len(tokens.words.hashes), BACKGROUND)
        for feature in tokens.features:
            maybe = np.flatnonzero(self.table[(feature & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.searchsorted(self.keys, feature[maybe])
            hit = at < len(self.keys)
            hit[hit] = self.keys[at[hit]] == feature[maybe][hit]
            np.maximum.at(scores, maybe[hit], self.odds[at[hit]])
        return scores

    def evidence(self, total: np.ndarray, n: int) -> np.ndarray:
        """-log of the chance that ``n`` harmless tokens hold a segment of this sum (0 if not significant)."""
        tail = -np.expm1(-n * np.exp(-self.scale * np.asarray(total)))
        strong = tail <= SIGNIFICANCE
        return np.where(strong, np.minimum(self.scale * np.asarray(total) - np.log(n), 60.0), 0.0)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.offset + self.slope * np.log1p(np.asarray(evidence, float)))))


def maximal_segments(at: np.ndarray, scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, sum) of a sequence, in linear time.

    ``at`` and ``scores`` are the tokens of positive score; all others score BACKGROUND.
    Segments are joined while that raises the sum of the earlier one (Ruzzo and Tompa).
    """
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum up to the end
    total, previous = 0.0, -1
    for i, s in zip(at.tolist(), scores.tolist()):
        total += BACKGROUND * (i - previous - 1)
        first, left, total, previous = i, total, total + s, i
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= total:
                stack.append((first, i, left, total))
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(first, last, right - left) for first, last, left, right in stack]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        words, out = Words(batch.column("text")), []
        for i in range(batch.num_rows):
            runs = shingles(words.of(i), 3)
            out.append([int(mix(runs ^ np.uint64(k)).min().view(np.int64)) if len(runs) else k for k in range(4)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(out, pa.list_(pa.int64()))],
            ["doc_id", "toxic", "marks"],
        )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of the toxic and the other documents that hold a feature, summed per piece."""
    for batch in pieces(batches, "text", 16 << 20):
        tokens = Tokens(batch.column("text"))
        toxic, weight = batch.column("toxic").to_numpy(), batch.column("weight").to_numpy()
        found = [tokens.present(i) for i in range(batch.num_rows)]
        size = np.array([len(f) for f in found])
        keys, where = np.unique(np.concatenate(found), return_inverse=True)
        sums = [np.bincount(where, np.repeat(weight * (toxic == y), size), len(keys)) for y in (1, 0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(sums[0]), pa.array(sums[1])], ["feature", "bad", "good"]
        )


def _scan(model: Model):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            tokens = Tokens(batch.column("text"))
            scores, out = model.token_scores(tokens), []
            starts, ends = tokens.words.starts, tokens.words.ends
            for i in range(batch.num_rows):
                lo, hi = tokens.first[i], tokens.first[i + 1]
                high = np.flatnonzero(scores[lo:hi] > 0)
                segments, passages, evidence = maximal_segments(high, scores[lo:hi][high]), [], 0.0
                if segments:
                    values = model.evidence(np.array([s[2] for s in segments]), int(hi - lo))
                    begin = tokens.words.offsets[i]
                    # Characters before each byte of the lower-cased text.
                    chars = np.cumsum((tokens.words.data[begin : tokens.words.offsets[i + 1]] & 0xC0) != 0x80)
                    for (a, b, s), v in zip(segments, values.tolist()):
                        if v > 0:
                            evidence += v
                            passages.append({
                                "start": int(chars[starts[lo + a] - begin]) - 1,
                                "end": int(chars[ends[lo + b] - 1 - begin]),
                                "score": float(s), "evidence": v,
                            })
                out.append((int(hi - lo), passages, evidence))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], PASSAGES), pa.array([o[2] for o in out], pa.float64()),
                    pa.array(model.probability([o[2] for o in out]), pa.float64()),
                ],
                ["doc_id", "n_tokens", "passages", "evidence", "score"],
            )

    return scan


PASSAGES = pa.list_(pa.struct([
    ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("evidence", pa.float64())
]))
SCANNED = (
    "doc_id long, n_tokens long, passages array<struct<start:int,end:int,score:double,evidence:double>>, "
    "evidence double, score double"
)


def find_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, passages, evidence and score of every row of ``docs`` (doc_id, text).

    A passage is a maximal segment whose sum is significant for the document's length; its
    span counts characters of the lower-cased text. The score follows from the passages'
    summed evidence. A text without tokens, or null, has no passage and the lowest score.
    Rows are scored one by one, equal ids or not; other columns are not read.
    """
    return texts(docs).mapInArrow(_scan(model), SCANNED)


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns and in place."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            scored = next(_scan(model)(iter([batch])))
            yield batch.filter(pc.less(scored.column("score"), threshold))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(keep, docs.schema)


def log_odds(counts: DataFrame, bad: float, good: float) -> DataFrame:
    """Log-odds ratio of each feature (bad, good weights) with an informative Dirichlet prior.

    The prior is the feature's share of all documents. ``g`` is the likelihood ratio statistic
    of the feature being as frequent in both classes (0 if it is rarer in the bad one).
    """
    both, total = F.col("bad") + F.col("good"), bad + good
    prior = PRIOR * both / total + 0.01
    x, z = F.col("bad") + prior, F.col("good") + prior
    # A document may hold every feature, so the rest of a class is its documents without it.
    odds = F.log(x / (bad + PRIOR - x + 1)) - F.log(z / (good + PRIOR - z + 1))
    part = lambda n, of: F.when(n > 0, n * F.log(n * total / (both * of))).otherwise(0.0)
    g = 2 * (part(F.col("bad"), bad) + part(F.col("good"), good))
    return counts.withColumn("odds", odds).withColumn("g", F.when(odds > 0, g).otherwise(0.0))


def _calibrate(model: Model, scored: pd.DataFrame) -> None:
    """Logistic curve over the evidence, by weighted Newton steps with a small ridge."""
    x, y, w = scored["evidence"].to_numpy(), scored["toxic"].to_numpy(), scored["weight"].to_numpy()
    beta, design = np.zeros(2), np.column_stack([np.ones(len(x)), np.log1p(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (y - p)) - 0.01 * beta
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    model.offset, model.slope = float(beta[0]), float(max(beta[1], 0.0))


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from ``docs`` (doc_id, text) whose ``labels`` (doc_id, toxic) are not held out.

    About ``train_rows`` labelled rows, drawn by a hash of doc_id, are used if there are
    more. A document weighs 1 / (number of documents that share one of its MinHashes), so a
    large group of copies counts about once. Null ids, labels and texts are left out; of several
    labels of an id the largest counts. Without toxic or other rows the model finds nothing.
    """
    known = (
        labels.filter(f"doc_id is not null and toxic is not null and not ({HELD_OUT})")
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    share = min(1.0, train_rows / max(known.count(), 1))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) < int(share * (1 << 20)))
    known_texts = texts(docs).filter("text is not null")
    # At most about ``train_rows`` rows, by the draw above.
    marks = settle(
        known_texts.join(F.broadcast(drawn), "doc_id")
        .mapInArrow(_signatures, "doc_id long, toxic int, marks array<long>")
        .dropDuplicates(["doc_id"])
    )
    each = marks.select("doc_id", "toxic", F.posexplode("marks").alias("k", "mark"))
    sizes = each.groupBy("k", "mark").agg(F.count(F.lit(1)).alias("n"))
    weights = settle(
        each.join(sizes, ["k", "mark"]).groupBy("doc_id", "toxic").agg((1 / F.max("n")).alias("weight"))
    )
    mass = {r["toxic"]: r["w"] for r in weights.groupBy("toxic").agg(F.sum("weight").alias("w")).collect()}
    model = Model(np.zeros(0, np.uint64), np.zeros(0))
    if not mass.get(1) or not mass.get(0):
        model.offset = -10.0
        return model
    training = known_texts.join(F.broadcast(weights), "doc_id")
    counts = training.mapInArrow(_counts, "feature long, bad double, good double").groupBy("feature").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    ).filter(F.col("bad") >= MIN_WEIGHT)
    best = (
        log_odds(counts, mass[1], mass[0]).filter((F.col("g") >= MIN_G) & (F.col("odds") >= MIN_ODDS))
        .orderBy(F.desc("g"), "feature").limit(MODEL_SIZE).select("feature", "odds").toPandas()
    )
    keys = best["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    model = Model(keys[order], best["odds"].to_numpy(float)[order])
    model.scale = _scale(training, model)
    scored = (
        find_toxic(training, model).select("doc_id", "evidence").dropDuplicates(["doc_id"])
        .join(weights, "doc_id").toPandas()
    )
    _calibrate(model, scored)
    return model


def _histogram(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            scores = np.round(model.token_scores(Tokens(batch.column("text"))), 1)
            values, n = np.unique(scores, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], ["value", "n"])

    return count


def _scale(training: DataFrame, model: Model) -> float:
    """The positive root of mean(exp(scale * score)) = 1 over tokens of harmless documents.

    Scores are rounded to tenths, so a few hundred rows come to the driver.
    """
    seen = (
        training.filter("toxic = 0").select("text").mapInArrow(_histogram(model), "value double, n long")
        .groupBy("value").agg(F.sum("n").alias("n")).toPandas()
    )
    if not len(model.odds):
        return 1.0
    # One more token of the best score: a class of harmless texts never rules it out.
    value = np.append(seen["value"].to_numpy(float), model.odds.max())
    share = np.append(seen["n"].to_numpy(float), 1.0)
    share = share / share.sum()
    if float((share * value).sum()) >= 0:
        return 0.1
    lo, hi = 0.0, 100.0
    for _ in range(60):
        mid = (lo + hi) / 2
        below = float((share * np.exp(np.minimum(mid * value, 700))).sum()) < 1
        lo, hi = (mid, hi) if below else (lo, mid)
    return max(lo, 0.1)


def op6_toxicity(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return find_toxic(docs, model).select(
        "doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"), "evidence",
    )
