"""Alignment of two tokenizers' tokens by the bytes they cover, and of their ids over a corpus."""

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanwatch.llm.scratch import documents, texts, written
from spanwatch.llm.words import buffers, pieces

TOKENIZERS = "/opt/tokenizers"
FIRST, SECOND = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
BLOCK = 2 << 20  # bytes of texts whose id pairs are counted together before they are shuffled
PIECE = 1 << 18  # bytes of texts that are aligned at a time
CACHE = 400_000  # chunks, and 10 times as many tokens, that a task keeps; beyond it starts anew, which costs time only
SPACE_MARK = "▁"
# A place where neither tokenizer joins what stands before and after: a space after anything but white space.
JOINED = 64
CUT = re.compile(r"(?<=\S)(?= )")
UNSURE = re.compile(r"\s | \Z")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for
    themselves, the others for characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int32, counts.sum()), counts


class ByteLevel:
    """A byte-level BPE vocabulary file; encodes a space and the text, special tokens as plain text."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        told = json.loads(content)
        self._tokenizer = Tokenizer.from_str(content.decode())
        self._tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (1 + max(vocabulary.values()))
        for piece, i in vocabulary.items():
            self.bytes[i] = bytes(alphabet[c] for c in piece)
        split = told.get("pre_tokenizer") or {}
        # The usual pattern starts a new pre-token at such a space.
        self.cuts = told.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", False)

        self._lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks (each with the space before it) in a row, and the number of each."""
        if not self.cuts or any(c[-1].isspace() or c[1:2].isspace() for c in chunks):
            return _flat([e.ids for e in self._tokenizer.encode_batch_fast(chunks, add_special_tokens=False)])
        # Such chunks stay apart when they are joined, which spares the library most of its calls.
        joined = ["".join(chunks[i : i + JOINED]) for i in range(0, len(chunks), JOINED)]
        ids, _ = _flat([e.ids for e in self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        covered = np.cumsum(self._lengths[ids])
        ends = np.searchsorted(covered, np.cumsum([len(c.encode()) for c in chunks])) + 1
        return ids, np.diff(ends, prepend=0)


class Pieces:
    """A sentencepiece model file, which puts the space before the text itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.bytes = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()
            self.bytes.append(raw)
        # No piece goes on over a space, so words do not touch each other.
        self.cuts = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", self._model.id_to_piece(i)) for i in range(len(self.bytes)))

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self._model.encode([c[1:] for c in chunks], num_threads=1))


def tokenizer(name: str, content: bytes) -> ByteLevel | Pieces:
    """A tokenizer by its file: a ``.json`` of a byte-level BPE, or a sentencepiece ``.model``."""
    return ByteLevel(content) if name.endswith(".json") else Pieces(content)


class Chunks:
    """Ids of texts by two tokenizers, where chunks that come again are encoded once.

    Per side, the ids of all known chunks stand in a row in ``ids``; ``bounds`` cut it.
    """

    def __init__(self, first: ByteLevel | Pieces, second: ByteLevel | Pieces):
        self.models = first, second
        self.lengths = [np.array([len(b) for b in m.bytes], np.int64) for m in self.models]
        self.cuts = first.cuts and second.cuts
        self._start()

    def _start(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.bounds = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.wrong = np.zeros(0, bool)

    def _cut(self, text: str) -> list[str]:
        """A space and the text in chunks that both tokenizers take apart by themselves."""
        if not self.cuts:
            return [" " + text]
        if text[:1] == " " or UNSURE.search(text):
            parts = CUT.split(" " + text)
            return [" " + text] if parts[-1].isspace() else parts
        return (" " + text.replace(" ", "\0 ")).split("\0") if "\0" not in text else [" " + p for p in text.split(" ")]

    def _learn(self, chunks: list[str]) -> None:
        raw = [c.encode() for c in chunks]
        sizes = np.cumsum([len(r) for r in raw])
        wrong = np.zeros(len(chunks), bool)
        for side, model in enumerate(self.models):
            ids, counts = model.encode(chunks)
            ends = np.cumsum(counts)
            told = [model.bytes[i] for i in ids.tolist()]
            covered = np.concatenate(([0], np.cumsum(self.lengths[side][ids])))
            if b"".join(told) != b"".join(raw) or (covered[ends] != sizes).any():
                wrong |= [b"".join(told[to - n : to]) != r for n, to, r in zip(counts, ends, raw)]
            self.ids[side] = np.concatenate([self.ids[side], ids])
            self.bounds[side] = np.concatenate([self.bounds[side], self.bounds[side][-1] + ends])
        self.wrong = np.concatenate([self.wrong, wrong])
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))

    def of(self, texts_: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per side, the token ids of all texts in a row and the number of each text's; none where
        the text is empty or any side's bytes are not the text's."""
        cut = [self._cut(t) if t else [] for t in texts_]
        if len(self.known) > CACHE or len(self.ids[0]) > 10 * CACHE:
            self._start()
        new = set(chain.from_iterable(cut)).difference(self.known)
        if new:
            self._learn(list(new))
        first = np.concatenate(([0], np.cumsum([len(c) for c in cut]))).astype(np.int64)
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, first[-1])
        wrong = np.concatenate(([0], np.cumsum(self.wrong[numbers])))
        fine = wrong[first[1:]] == wrong[first[:-1]]
        numbers = numbers[np.repeat(fine, np.diff(first))]
        first = np.concatenate(([0], np.cumsum(np.where(fine, np.diff(first), 0))))
        out = [], []
        for side in (0, 1):
            starts = self.bounds[side][numbers]
            sizes = self.bounds[side][numbers + 1] - starts
            ends = np.concatenate(([0], np.cumsum(sizes)))
            out[0].append(self.ids[side][np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])])
            out[1].append(ends[first[1:]] - ends[first[:-1]])
        return out


def _tokens(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> pd.DataFrame:
    """Tokens of documents in a row: their document, id, place, and the bytes they cover."""
    ends = np.cumsum(lengths[ids])
    return pd.DataFrame({
        "doc": np.repeat(np.arange(len(counts)), counts), "id": ids, "at": np.arange(len(ids)),
        "start": ends - lengths[ids], "end": ends,
    })


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of all pairs whose byte ranges overlap.

    The later start of a pair lies within the other token. So each start looks for the token of the
    other side that covers it, in both directions; pairs that start together come from the first.
    """
    places = ["start", "doc", "at"]
    one = pd.merge_asof(a[places], b[places].rename(columns={"at": "other"}), on="start", by="doc")
    left = a[places].rename(columns={"at": "other"}).assign(begun=a["start"])
    two = pd.merge_asof(b[places], left, on="start", by="doc")
    two = two[two["begun"] < two["start"]]
    column = lambda frame, name: frame[name].to_numpy(np.int64)
    return (np.concatenate([column(one, "at"), column(two, "other")]),
            np.concatenate([column(one, "other"), column(two, "at")]))


class Aligned:
    """Documents of a batch aligned: tokens, links, and groups between places where both sides end."""

    def __init__(self, texts_: list[str | None], chunks: Chunks):
        given = [t or "" for t in texts_]
        (ids_a, ids_b), (self.n_a, self.n_b) = chunks.of(given)
        self.a, self.b = (_tokens(*side) for side in zip((ids_a, ids_b), (self.n_a, self.n_b), chunks.lengths))
        self.docs = len(given)
        left, right = overlaps(self.a, self.b)
        self.doc = self.a["doc"].to_numpy()[left]
        self.pair_a, self.pair_b = ids_a[left], ids_b[right]
        self.links = np.bincount(self.doc, minlength=self.docs)
        ends_a, ends_b = self.a["end"].to_numpy(), self.b["end"].to_numpy()
        self._last_a, self._last_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        self.groups = np.bincount(self.a["doc"].to_numpy()[self._last_a], minlength=self.docs)

    def digests(self, words: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups; ``words`` holds the ids' texts for _codes."""
        a, b = self._last_a, self._last_b
        group_a, group_b = np.cumsum(a) - a, np.cumsum(b) - b
        code = np.concatenate([_codes(self.a["id"].to_numpy(), a, 0), _codes(self.b["id"].to_numpy(), b, 2)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        said = words[code[order]].tolist()
        bounds = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        return [
            hashlib.sha256("".join(said[at:to])[:-1].encode()).hexdigest() if to > at else ""
            for at, to in zip(bounds, bounds[1:])
        ]


def _codes(ids: np.ndarray, last: np.ndarray, side: int) -> np.ndarray:
    return 4 * ids + side + last


def _words(size: int) -> np.ndarray:
    """Each id's text followed by a comma, or by what ends its side of a group."""
    return np.array([f"{i}{end}" for i in range(size) for end in (",", "|", ",", ";")], object)


def _packed(name_a: str, a: bytes, name_b: str, b: bytes):
    """Documents with their counts, as blocks: ``pairs`` are a block's distinct id pairs, ``docs`` how
    many of its documents have each, ``rows`` its documents and ``at`` and ``times`` their links by
    place in ``pairs``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spark runs a task per core; threads of the library's own would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        chunks = Chunks(tokenizer(name_a, a), tokenizer(name_b, b))
        width = len(chunks.lengths[1])
        words = _words(max(len(chunks.lengths[0]), width))
        rows: list[pa.RecordBatch] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def block() -> pa.RecordBatch:
            pair = np.concatenate([p for p, _, _ in held])
            pairs, at, docs = np.unique(pair, return_inverse=True, return_counts=True)
            table = pa.Table.from_batches(rows).combine_chunks().to_batches()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table[0].schema) as out:
                out.write_batch(table[0])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    pa.array([pairs], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64())),
                    pa.array([at.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([np.concatenate([t for _, t, _ in held]).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([np.concatenate([n for _, _, n in held]).astype(np.int32).tobytes()], pa.binary()),
                ],
                ["block", "rows", "pairs", "docs", "at", "times", "sizes"],
            )

        for batch in pieces(batches, "text", PIECE):
            found = Aligned(batch.column("text").to_pylist(), chunks)
            pair = found.pair_a.astype(np.int64) * width + found.pair_b
            order = np.lexsort((pair, found.doc))
            doc, pair = found.doc[order], pair[order]
            starts = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])))[: len(doc)])
            held.append((pair[starts], np.diff(np.append(starts, len(doc))), np.bincount(doc[starts], minlength=found.docs)))
            rows.append(pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(found.n_a), pa.array(found.n_b),
                 pa.array(found.groups), pa.array(found.links), pa.array(found.digests(words), pa.string())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"],
            ))
            size += buffers(batch.column("text"))[1][-1]
            if size >= BLOCK:
                yield block()
                rows, held, size = [], [], 0
        if rows:
            yield block()

    return pack


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block with ``n_best`` and ``count_sum`` from the corpus-wide counts of its pairs."""
    for batch in batches:
        for i in range(len(batch)):
            part = {c: batch.column(c)[i] for c in batch.schema.names}
            with pa.ipc.open_stream(part["rows"].as_py()) as stream:
                docs = stream.read_next_batch()
            at, times, sizes = (np.frombuffer(part[c].as_py(), np.int32) for c in ("at", "times", "sizes"))
            where = part["place"].values.to_numpy(zero_copy_only=False) if part["place"].is_valid else np.zeros(0, np.int64)
            count, best = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
            if len(where):
                count[where] = part["count"].values.to_numpy(zero_copy_only=False)
                best[where] = part["best"].values.to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            total = np.concatenate(([0], np.cumsum(count[at] * times)))
            top = np.concatenate(([0], np.cumsum(best[at] * times)))
            yield pa.RecordBatch.from_arrays(
                [*docs.columns, pa.array(np.diff(top[bounds])), pa.array(np.diff(total[bounds]))],
                [*docs.schema.names, "n_best", "count_sum"],
            )


PACKED = (
    "block string, rows binary, pairs array<long>, docs array<long>, at binary, times binary, sizes binary"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
)


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def id_pairs(packed: DataFrame, width: int) -> DataFrame:
    """``pair`` (first id times ``width`` plus second id), its ``count`` of documents, and ``best``: 1 if no
    pair of the first id has more, else 0. Blocks have added up their documents before the shuffle."""
    each = packed.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))
    # One first id has at most ``width`` pairs.
    top = F.max("count").over(Window.partitionBy(F.expr(f"pair div {width}")))
    return counts.withColumn("best", F.when(F.col("count") == top, 1).otherwise(0).cast("long"))


def align_tokens(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum of every row of ``docs``.

    Both tokenizers (files that the driver reads) encode a space and the whole text. Places where
    tokens of both end cut them into groups; tokens whose bytes overlap are linked. ``n_best`` links
    have an id pair that is in as many documents as any of its first id; ``count_sum`` adds up those
    numbers over all links. A text that is null or empty, or whose tokens' bytes are not a space and
    the text, has no tokens: zeros and an empty digest. Rows are documents, whether ids and texts are
    repeated or null; other columns are not read; an empty table gives an empty one. Texts are encoded
    whole; those without spaces need memory in proportion to their length.

    Documents go through in blocks of about BLOCK bytes, written once. Only a block's distinct id
    pairs are shuffled to be counted; their counts come back to the block, which is one row.
    """
    name_a, name_b = first, second
    a, b = _read(first), _read(second)
    width = len(tokenizer(name_b, b).bytes)
    packed, _ = written(texts(docs).mapInArrow(_packed(name_a, a, name_b, b), PACKED), "aligned")
    each = packed.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p"))
    told = (
        each.select("block", "place", F.col("p.pairs").alias("pair")).join(id_pairs(packed, width), "pair")
        .groupBy("block").agg(F.collect_list(F.struct("place", "count", "best")).alias("t"))
        .select("block", F.col("t.place").alias("place"), F.col("t.count").alias("count"), F.col("t.best").alias("best"))
    )
    return packed.drop("pairs", "docs").join(told, "block", "left").mapInArrow(_unpacked, ALIGNED)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(documents(spark, sf_dir))
