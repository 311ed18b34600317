"""License notices: MinHash bands over overlapping windows retrieve templates, shingles verify them."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spanwatch.llm.scratch import documents, texts
from spanwatch.llm.words import LOWER, SHINGLE, Words, pieces, shingles

CONTAINMENT = 0.8
MISS = 1e-4
CHUNK = 1 << 16  # shingles hashed at a time
MAX_TEMPLATES = 10_000

# Names and wordings of common notices.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0-header", "you may not use this file except in compliance with the License. You may obtain a copy "
                          "of the License at"),
    ("apache-2.0-warranty", "Unless required by applicable law or agreed to in writing, software distributed under "
                            "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                            "ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-header", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                   "GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

# Letters, digits and all bytes of other characters make words here; the rest parts them.
PARTING = np.ones(256, bool)
PARTING[0x30:0x3A] = PARTING[0x41:0x5B] = PARTING[0x61:0x7B] = PARTING[0x80:] = False


def license_words(texts: pa.Array) -> Words:
    return Words(texts, LOWER, PARTING)


def class_size(n: int) -> int:
    """The least power of two that holds ``n`` shingles."""
    return 1 << (n - 1).bit_length()


@dataclass
class WindowClass:
    """Templates of one shingle length whose shingles fit windows of one size.

    Windows of ``blocks`` times ``step`` shingles begin at every ``step``-th: wherever a notice of
    at most ``largest`` shingles stands, one window holds it whole.
    """

    words: int
    largest: int
    members: list[int]

    def __post_init__(self):
        self.step = max(1, self.largest // 4)
        self.blocks = math.ceil((self.largest + self.step - 1) / self.step)

    def bands(self, least: int) -> int:
        """Bands of one MinHash that find a window with CONTAINMENT of ``least`` shingles but for a chance of MISS."""
        shared = math.ceil(CONTAINMENT * least)
        similar = shared / (self.blocks * self.step + least - shared)
        return 1 if similar >= 1 else math.ceil(math.log(MISS) / math.log1p(-similar))


class Scanner:
    """MinHash tables of all templates."""

    def __init__(self, templates: list[tuple[str, str]]):
        words = license_words(pa.array([t for _, t in templates], pa.string()))
        self.names = [n for n, _ in templates]
        size = [len(words.of(i)) for i in range(len(templates))]
        self.bags = [np.unique(shingles(words.of(i))) for i in range(len(templates))]
        groups: dict[tuple[int, int], list[int]] = {}
        for i, n in enumerate(size):
            if n:
                groups.setdefault((min(n, SHINGLE), class_size(len(self.bags[i]))), []).append(i)
        self.classes = [WindowClass(*key, members) for key, members in sorted(groups.items())]
        self.odd = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.tables = []
        for c in self.classes:
            n = min(c.bands(min(len(self.bags[i]) for i in c.members)), len(self.odd))
            least = np.array([[(self.bags[i] * m).min() for i in c.members] for m in self.odd[:n]], np.uint64)
            bits = np.zeros((n, 1 << 12), bool)
            for k in range(n):
                bits[k, (least[k] & np.uint64(0xFFF)).astype(np.int64)] = True
            self.tables.append((least, bits))

    def candidates(self, hashes: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """(template, first, end) of windows of shingles that share a band with a template."""
        for c, (least, bits) in zip(self.classes, self.tables):
            if c.words != size:
                continue
            span = c.step * c.blocks
            for at in range(0, len(hashes), CHUNK // c.step * c.step):
                part = hashes[at : at + CHUNK // c.step * c.step + span - c.step]
                padded = np.concatenate([part, np.full(-len(part) % c.step, part[-1], np.uint64)])
                for k in range(len(least)):
                    low = (padded * self.odd[k]).reshape(-1, c.step).min(axis=1)
                    window = low
                    for shift in range(1, min(c.blocks, len(low))):
                        window = np.minimum(window[:-1], low[shift:])
                    maybe = np.flatnonzero(bits[k][(window & np.uint64(0xFFF)).astype(np.int64)])
                    for w in maybe[np.isin(window[maybe], least[k])].tolist():
                        for j in np.flatnonzero(least[k] == window[w]).tolist():
                            yield c.members[j], at + w * c.step, at + w * c.step + span

    def notices(self, words: Words) -> list[tuple[int, int, int, int, float]]:
        """(text, template, first word, end word, containment) of every verified notice."""
        found: dict[tuple[int, int, int], tuple[int, float]] = {}
        text_of = np.searchsorted(words.first, np.arange(len(words.hashes)), "right") - 1
        seen = set()
        for size in sorted({c.words for c in self.classes}):
            if len(words.hashes) < size:
                continue
            hashes = shingles(words.hashes, size)
            whole = text_of[: len(hashes)] == text_of[size - 1 :]  # shingles within one text
            for template, lo, hi in self.candidates(hashes, size):
                # Half a window more on either side, so that cut notices are whole.
                lo, hi = max(0, lo - (hi - lo) // 2), min(len(hashes), hi + (hi - lo) // 2)
                if (template, lo, hi) in seen:
                    continue
                seen.add((template, lo, hi))
                hit = lo + np.flatnonzero(np.isin(hashes[lo:hi], self.bags[template]) & whole[lo:hi])
                for part in self._stretches(hit, text_of, len(self.bags[template])):
                    share = len(np.unique(hashes[part])) / len(self.bags[template])
                    if share >= CONTAINMENT:
                        key = (int(text_of[part[0]]), template, int(part[0]))
                        end = int(part[-1]) + size
                        if (end, share) > found.get(key, (0, 0.0)):
                            found[key] = (end, share)
        return self._merged(found)

    @staticmethod
    def _stretches(hit: np.ndarray, text_of: np.ndarray, size: int) -> list[np.ndarray]:
        """Hits cut where the text changes, or where a gap exceeds the notice's length."""
        if not len(hit):
            return []
        cut = (np.diff(hit) > max(size, SHINGLE)) | (np.diff(text_of[hit]) > 0)
        return np.split(hit, np.flatnonzero(cut) + 1)

    @staticmethod
    def _merged(found: dict) -> list[tuple[int, int, int, int, float]]:
        """Overlapping finds of one template in one text are one."""
        out: list[tuple[int, int, int, int, float]] = []
        for (text, template, first), (end, share) in sorted(found.items()):
            last = out[-1] if out else None
            if last and last[:2] == (text, template) and first < last[3]:
                out[-1] = (text, template, last[2], max(end, last[3]), max(share, last[4]))
            else:
                out.append((text, template, first, end, share))
        return out


def _scan(templates: list[tuple[str, str]]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in pieces(batches, "text"):
            words, rows = license_words(batch.column("text")), []
            for text, template, first, end, share in scanner.notices(words):
                begin, start, stop = words.offsets[text], words.starts[first], words.ends[end - 1]
                head = len(words.data[begin:start].tobytes().decode())
                rows.append((text, template, head, head + len(words.data[start:stop].tobytes().decode()), share))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([scanner.names[r[1]] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32()),
                    pa.array([r[4] for r in rows], pa.float64()),
                ],
                ["doc_id", "license", "start", "end", "containment"],
            )

    return scan


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row (doc_id, license, start, end, containment) for each notice in ``docs`` (doc_id, text).

    A notice is a stretch of a text that holds CONTAINMENT or more of a template's 5-word shingles
    (of all its words, if it has fewer). Words are runs of letters and digits, A-Z lower-cased;
    start and end are characters of the text. A window misses a template that it
    holds with a chance of MISS at most.

    ``templates`` are (name, text) pairs, MAX_TEMPLATES at most, since every task holds them; those
    without a word match nothing. Null and empty texts hold no notice; repeated rows are
    scanned each for itself; other columns are not read.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; at most {MAX_TEMPLATES} are allowed")
    return texts(docs).mapInArrow(
        _scan(list(templates)), "doc_id long, license string, start int, end int, containment double"
    )


def op2_license_scan(spark, sf_dir) -> DataFrame:
    return find_licenses(documents(spark, sf_dir))
