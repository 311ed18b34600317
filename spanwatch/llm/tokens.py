"""Token counts under a unigram model of a given vocabulary, shared over a trie of pre-tokens."""

import base64
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from spanwatch.llm.scratch import documents, texts
from spanwatch.llm.words import pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 1_000_000  # pieces; more are refused, since every task holds the vocabulary
CACHE = 400_000  # pre-tokens whose counts a task keeps; beyond it starts anew, which costs time only
ZIPF = 2.7  # a piece of rank r has a probability proportional to 1 / (r + ZIPF)
UNIT = 1_000_000  # costs are whole millionths, so sums are exact and ties are real

# Fixed value: the pattern that splits texts before byte pairs are merged.
PRE_TOKEN = regex.compile(
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Pieces with their costs (negative log-probabilities) from lines of base64 text and rank."""
    costs = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                piece, rank = line.split()
                costs[base64.b64decode(piece)] = round(UNIT * math.log(int(rank) + 1 + ZIPF))
    if not costs or len(costs) > MAX_VOCABULARY:
        raise ValueError(f"{path}: {len(costs)} pieces; 1 to {MAX_VOCABULARY} are allowed")
    return costs


def with_suffixes(costs: dict[bytes, int]) -> dict[bytes, int | None]:
    """The pieces, their suffixes that are no pieces (None), and all single bytes at the highest cost at least."""
    worst = max(costs.values()) + UNIT
    known: dict[bytes, int | None] = {bytes([b]): worst for b in range(256)}
    for piece in costs:
        for k in range(1, len(piece)):
            known.setdefault(piece[k:], None)
    known.update(costs)
    return known


def trie_counts(words: list[bytes], known: dict[bytes, int | None]) -> dict[bytes, int]:
    """Number of tokens of the cheapest segmentation of each word; of equals, the one of fewest tokens.

    The sorted words are the paths of a trie, visited depth first: the forward scores of a
    prefix are worked out when it is first met, and stand until the walk leaves it.
    """
    counts, path, scores = {}, b"", [(0, 0)]
    for word in sorted(words):
        shared = 0
        for a, b in zip(path, word):
            if a != b:
                break
            shared += 1
        del scores[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            best = None
            for start in range(end - 1, -1, -1):
                cost = known.get(word[start:end], -1)
                if cost == -1:  # no piece ends so
                    break
                if cost is not None:
                    before = scores[start]
                    score = (before[0] + cost, before[1] + 1)
                    if best is None or score < best:
                        best = score
            scores.append(best)
        counts[word], path = scores[len(word)][1], word
    return counts


def _counted(costs: dict[bytes, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache = with_suffixes(costs), {}
        for batch in pieces(batches, "text"):
            found = [Counter(PRE_TOKEN.findall(t or "")) for t in batch.column("text").to_pylist()]
            new = set().union(*found) - cache.keys() if found else set()
            if len(cache) + len(new) > CACHE:
                cache, new = {}, set().union(*found)
            coded = {w.encode(): w for w in new}
            for word, n in trie_counts(list(coded), known).items():
                cache[coded[word]] = n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([sum(f.values()) for f in found], pa.int64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([sum(cache[w] * n for w, n in f.items()) for f in found], pa.int64()),
                ],
                ["doc_id", "n_pre_tokens", "n_distinct", "n_tokens"],
            )

    return count


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_pre_tokens, n_distinct (of them) and n_tokens of every row of ``docs`` (doc_id, text).

    A text is split into pre-tokens, and each of them into the pieces of the vocabulary whose
    costs sum up to the least; a piece costs log(rank + 1 + ZIPF), and bytes that are no piece
    count one token each. The driver reads ``vocabulary``. Null and empty texts count 0; rows
    are counted one by one, equal or not; other columns are not read.
    """
    return texts(docs).mapInArrow(
        _counted(read_vocabulary(vocabulary)), "doc_id long, n_pre_tokens long, n_distinct long, n_tokens long"
    )


def op3_token_counts(spark, sf_dir) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))
