"""License scan by conditional compression.

A text is one sequence of words; line breaks, comment markers and other punctuation lie between them, so
a wording that is wrapped over several lines is one run of words. At most `DIFFERENCES` of a wording's words
may be changed, added or missing.

1. Candidate blocks. Of each wording one word more than may differ, the rarest ones, are its anchors, so every
   run within the differences holds one. A block is the words around anchors of one wording, as far as the
   wording with its differences reaches.
2. Compression. Each block is compressed alone and with the wording as a raw Zstandard dictionary. The bytes
   that the dictionary saves, against what the wording itself takes, rank the wordings of a text; below
   `LEAST_SAVED` a wording is out. Runs with all differences allowed save more (the tests measure it).
3. The winners are confirmed, best first, by the exact word differences to runs of words of their block.
   Where confirmed wordings overlap, the one with the smaller share of differences counts, then the longer,
   then the one that saves more; all others are rows of their own. Version numbers are words.

Blocks are cut into pieces that overlap by a whole wording, so the work on a text grows with its length.

Defined results: null and empty texts and texts without anchors or without words give no row; a wording
repeated in a text gives a row each. line_no and first_word tell the line in which a run begins and its
first word's number in that line, `saved` the share of the run's bytes that the wording saves. Only doc_id
and text are read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.llm.decontamination import edits

DIFFERENCES = 0.2
LEAST_SAVED = 0.1
# The optimal parser on small tables: blocks are short, and its sizes tell a few shared words from chance.
PARAMETERS = zstd.ZstdCompressionParameters.from_level(
    19, source_size=4096, write_content_size=False, write_checksum=False
)

# Words too common to be anchors while a wording has others, and customary license wordings.
COMMON = frozenset(
    "a an and any any are as at be by can do for from in is it its may no not of on or our shall that the their this to "
    "under use used was we will with you your 0 1 2 3 4 5".split()
)
WORDINGS = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is granted "
        "to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions:",
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
        "software and accompanying documentation covered by this license (the \"Software\") to use, "
        "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works "
        "of the Software, and to permit third-parties to whom the Software is furnished to do so",
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0",
    ),
    "artistic-2.0": ("Licensed under the Artistic License 2.0.",),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of "
        "the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License, or (at your option) any later version.",
    ),
    "lgpl-3.0": ("Licensed under the GNU Lesser General Public License, version 3.",),
    "agpl-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    "bsd-2-clause": (
        "Licensed under the 2-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "bsd-3-clause": (
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
        "the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ),
    "cc0-1.0": ("This work is dedicated to the public domain under the CC0 1.0 license.",),
}
# End of fixed values.

_WORD = re.compile(r"[^\W_]+")
_LINE = re.compile(r"\r?\n")
_NAMES = ("line_no", "license", "wording", "saved", "differences", "first_word")
_FOUND = "struct<line_no:int,license:string,wording:int,saved:double,differences:int,first_word:int>"


def _codes(words: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.encode()) << 16 ^ zlib.adler32(w.encode()) for w in words], np.int64)


def word_codes(text: str) -> np.ndarray:
    return _codes(_WORD.findall(text.lower()))


@dataclass(frozen=True)
class Wording:
    name: str
    number: int
    press: zstd.ZstdCompressor  # with the wording as dictionary
    size: int  # bytes that the wording takes compressed alone
    words: np.ndarray
    distinct: frozenset[int]
    most: int  # word differences
    anchors: tuple[str, ...]

    @property
    def reach(self) -> int:
        """Words of the longest run that can be this wording."""
        return len(self.words) + self.most


@dataclass(frozen=True)
class Place:
    wording: Wording
    differences: int
    start: int
    end: int
    saved: float  # by the block, which ranks it

    def rank(self) -> tuple:
        """Fewest changes, then the longer wording, then the bytes saved, then name and order in the text."""
        size = len(self.wording.words)
        return self.differences / size, -size, -self.saved, self.wording.name, self.wording.number, self.start


def anchors_of(words: list[str], most: int) -> tuple[str, ...]:
    """The most + 1 rarest words: common ones last, long ones first."""
    return tuple(sorted(set(words), key=lambda w: (w in COMMON, -len(w), w))[: most + 1])


def runs_of(wording: Wording, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """Disjoint runs of words within the differences of the wording: differences, start and end."""
    out, rest = [], [(0, len(codes))]
    while rest:
        low, high = rest.pop()
        if high - low < len(wording.words) - wording.most:
            continue
        count, end = edits(wording.words, codes[low:high])
        if count > wording.most:
            continue
        # Backwards from the first end with so few differences: where the run begins.
        end += low
        _, back = edits(wording.words[::-1], codes[low:end][::-1])
        start = end - back
        out.append((count, start, end))
        rest += [(low, start), (end, high)]
    return out


class Scanner:
    """Compressors, words and anchors of all wordings, made once per task."""

    def __init__(self, wordings: dict[str, tuple[str, ...]], least_saved: float = LEAST_SAVED) -> None:
        self.least_saved = least_saved
        self.plain = zstd.ZstdCompressor(compression_params=PARAMETERS)
        self.known: list[Wording] = []
        self.anchors: dict[str, list[int]] = {}
        for name, texts in sorted(wordings.items()):
            for number, text in enumerate(texts):
                words = _WORD.findall(text.lower())
                raw = " ".join(words).encode()
                made = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                press = zstd.ZstdCompressor(compression_params=PARAMETERS, dict_data=made)
                codes, most = _codes(words), int(DIFFERENCES * len(words))
                anchors = anchors_of(words, most)
                for word in anchors:
                    self.anchors.setdefault(word, []).append(len(self.known))
                size = len(self.plain.compress(raw))
                self.known.append(
                    Wording(name, number, press, size, codes, frozenset(codes.tolist()), most, anchors)
                )

    def blocks(self, words: list[str]) -> Iterator[tuple[Wording, int, int]]:
        """Pieces of the words around the anchors of each wording; a run lies wholly in one of them."""
        hits: dict[int, list[int]] = {}
        for at, word in enumerate(words):
            for number in self.anchors.get(word, ()):
                hits.setdefault(number, []).append(at)
        for number, found in hits.items():
            wording = self.known[number]
            reach = wording.reach
            low = high = None
            for at in [*found, None]:
                if low is not None and (at is None or at - reach > high):
                    end = min(high, len(words))
                    for start in range(low, max(low + 1, end - reach), 3 * reach):
                        yield wording, start, min(end, start + 4 * reach)
                    low = None
                if at is not None:
                    low = max(0, at - reach) if low is None else low
                    high = at + reach + 1

    def ranked(self, words: list[str]) -> list[tuple[float, Wording, int, int]]:
        """Share of the wording's bytes saved, wording, start and end of the blocks that save enough, best first."""
        out = []
        for wording, low, high in self.blocks(words):
            part = words[low:high]
            if len(wording.distinct - set(_codes(part).tolist())) > wording.most:
                continue
            block = " ".join(part).encode()
            saved = (len(self.plain.compress(block)) - len(wording.press.compress(block))) / wording.size
            if saved >= self.least_saved:
                out.append((saved, wording, low, high))
        return sorted(out, key=lambda c: (-c[0], c[1].name, c[1].number, c[2]))

    def confirmed(self, words: list[str]) -> list[Place]:
        """Places of all wordings in a text, without those that a better one overlaps."""
        found = [
            Place(wording, count, low + start, low + end, saved)
            for saved, wording, low, high in self.ranked(words)
            for count, start, end in runs_of(wording, _codes(words[low:high]))
        ]
        taken: list[Place] = []
        for place in sorted(found, key=Place.rank):
            at = bisect_left(taken, place.start, key=lambda other: other.start)
            if at and taken[at - 1].end > place.start or at < len(taken) and taken[at].start < place.end:
                continue
            taken.insert(at, place)
        return taken

    def scan_text(self, text: str) -> list[tuple[int, str, int, float, int, int]]:
        """Line, license, wording, share of bytes saved, word differences and first word of each run."""
        lowered = text.lower()
        if self.anchors.keys().isdisjoint(_WORD.findall(lowered)):
            return []
        per_line = [_WORD.findall(line) for line in _LINE.split(lowered)]
        words = [word for line in per_line for word in line]
        begin = np.cumsum([0, *map(len, per_line)])
        out = []
        for place in self.confirmed(words):
            run = " ".join(words[place.start : place.end]).encode()
            saved = round(1 - len(place.wording.press.compress(run)) / len(self.plain.compress(run)), 6)
            line = int(np.searchsorted(begin, place.start, "right")) - 1
            wording = place.wording
            first = place.start - int(begin[line])
            out.append((line, wording.name, wording.number, saved, place.differences, first))
        return out

    def scan(self, block: str) -> tuple[str, int, float, int, int] | None:
        """The best run of a short text: license, wording, share saved, differences and first word."""
        found = self.scan_text(block)
        sizes = {(w.name, w.number): len(w.words) for w in self.known}
        best = min(found, key=lambda f: (f[4] / sizes[f[1:3]], -sizes[f[1:3]], *f[1:3]), default=None)
        return best[1:] if best else None


def scan(documents: DataFrame, wordings: dict[str, tuple[str, ...]] = WORDINGS) -> DataFrame:
    """doc_id, line_no, license, wording, saved, differences, first_word of every confirmed run."""

    @F.arrow_udf(f"array<{_FOUND}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(wordings)
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32())
        kind = pa.list_(pa.struct(list(zip(_NAMES, kinds))))
        for texts in batches:
            found = (scanner.scan_text(text.as_py() or "") for text in texts)
            yield pa.array([[dict(zip(_NAMES, row)) for row in rows] for rows in found], kind)

    found = documents.select("doc_id", F.explode(run(F.col("text"))).alias("found"))
    return found.select("doc_id", "found.*")
