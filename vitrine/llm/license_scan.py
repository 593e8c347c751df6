"""License scan: MinHash bands over overlapping windows, then exact containment.

A text's five-word shingles are cut into overlapping windows. For every size
class of the templates the window has as many shingles as the class's largest
template, up to a third more than its smallest, and starts every quarter of its
size. A template of n shingles that occurs with a containment of 0.75 then has
a window with a Jaccard likeness of at least ``LEAST_LIKENESS`` (0.45): a window
of n shingles misses n / 8 of them at worst (0.625 n shared of 1.375 n), a
larger one has room for the shift (0.75 n of 1.583 n). With ``BANDS`` bands of
``ROWS`` MinHashes such a window collides with the template in a band with a
probability of 1 - (1 - 0.45^ROWS)^BANDS = 0.998, and a verbatim one (likeness
0.75 or more) with 0.9999999999. Each retrieved template is then held against the
exact shingles of the window and a stride on either side.

A template of fewer than five words is one shingle of its own length: it occurs
where the text's run of that length has the same hash, so those runs are
compared as they are, without bands.

Windows are per-text work, so the scan has no shuffle; the templates are a
fixed list that travels inside the function. MinHashes of all windows come from
running minima over power-of-two lengths, in numpy, in chunks of bounded size.

Defined cases: NULL and empty texts, and texts shorter than every template, have
no match; a template without words matches nothing; very long texts are scanned whole, chunk by chunk with
overlap; NULL ids and repeated rows are kept; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vitrine.llm.shingles import SHINGLE_WORDS, shingle_hashes, word_hashes

BANDS, ROWS = 28, 2
CONTAINMENT = 0.75
LEAST_LIKENESS = 0.45
CHUNK = 8192
SEEN = (1 << 20) - 1  # slots of the bit table that most windows end at

# FIXED VALUES: wording of public licenses and notices, with SPDX identifiers (a
# LicenseRef where SPDX lists none).
TEMPLATES = [
    ("mit-line", "MIT", "Released under the MIT License."),
    ("apache-line", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-line", "GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-line", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-line", "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-line", "CC-BY-4.0",
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mit-grant", "MIT",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions:"),
    ("apache-notice", "Apache-2.0",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-disclaimer", "Apache-2.0",
     "Unless required by applicable law or agreed to in writing, software distributed under the "
     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
     "either express or implied."),
    ("gpl-notice", "GPL-3.0-or-later",
     "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of "
     "the License, or (at your option) any later version."),
    ("bsd-redistribution", "BSD-2-Clause",
     "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met:"),
    ("mpl-notice", "MPL-2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
     "of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("all-rights-reserved-line", "LicenseRef-All-Rights-Reserved", "All rights reserved."),
]

_token = re.compile(r"[^\W_]+").findall

FIELDS = [("template", T.StringType()), ("license", T.StringType()), ("containment", T.DoubleType()),
          ("start_word", T.LongType()), ("end_word", T.LongType())]


def text_words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased letter and digit runs."""
    return word_hashes([w.encode("utf-8", "surrogatepass") for w in _token((text or "").lower())])


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; none where there are fewer words."""
    return shingle_hashes(words, size) if len(words) >= size else np.zeros(0, np.uint64)


# Word counts, below a shingle's, of the templates.
SHORT_SIZES = sorted({n for *_, text in TEMPLATES if 0 < (n := len(_token(text))) < SHINGLE_WORDS})


def text_shingles(text: str | None) -> np.ndarray:
    """The text's shingles, then its runs of each of ``SHORT_SIZES``."""
    words = text_words(text)
    return np.concatenate([runs(words, size) for size in (SHINGLE_WORDS, *SHORT_SIZES)])


def template_shingles(text: str) -> tuple[int, np.ndarray]:
    """Words in a shingle of the template, and its distinct shingles."""
    words = text_words(text)
    size = min(SHINGLE_WORDS, max(len(words), 1))
    return size, np.unique(runs(words, size))


class Scanner:
    """Band tables of the templates, and the search in one text's shingles."""

    def __init__(self, templates):
        rng = np.random.default_rng(20240)
        self.factor = rng.integers(0, 1 << 31, BANDS * ROWS, np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32)[:, None]
        self.salt = rng.integers(0, 1 << 32, BANDS, np.uint32)[:, None]
        sized = [(name, spdx, *template_shingles(text)) for name, spdx, text in templates]
        self.templates = [(name, spdx, s) for name, spdx, _, s in sized]
        long = [t for t, (*_, size, s) in enumerate(sized) if size == SHINGLE_WORDS and len(s)]
        # Short templates: (template, words, hash of its one run).
        self.short = [(t, size, s[0]) for t, (*_, size, s) in enumerate(sized) if size < SHINGLE_WORDS and len(s)]
        # Window sizes in shingles: a class's window is its largest template's size.
        self.classes: list[tuple[int, int]] = []
        for n in sorted({len(self.templates[t][2]) for t in long}):
            if self.classes and 3 * n <= 4 * self.smallest:
                self.classes[-1] = (n, max(1, n // 4))
            else:
                self.smallest = n
                self.classes.append((n, max(1, n // 4)))
        keys, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for t in long:
            keys.append(self._bands(self._hashes(self.templates[t][2]).min(1, keepdims=True))[:, 0])
            owners.append(np.full(BANDS, t))
        self.keys = np.concatenate(keys)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.owners = self.keys[order], np.concatenate(owners)[order]
        self.seen = np.zeros(SEEN + 1, bool)
        self.seen[self.keys & np.uint32(SEEN)] = True
        self.stride = {t: next(s for n, s in self.classes if n >= len(self.templates[t][2])) for t in long}
        self.stride.update((t, 1) for t, *_ in self.short)

    def _hashes(self, shingles: np.ndarray) -> np.ndarray:
        """(BANDS * ROWS, n) hash functions of the shingles."""
        low = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
        h = low * self.factor + self.shift
        return h ^ (h >> np.uint32(15))

    def _bands(self, minima: np.ndarray) -> np.ndarray:
        """(BANDS, windows) keys of the bands."""
        key = np.repeat(self.salt, minima.shape[1], 1)
        for r in range(ROWS):
            key *= np.uint32(0x9E3779B1)
            key += minima[r::ROWS]
        key ^= key >> np.uint32(15)
        return key

    def candidates(self, shingles: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, window start, window size) of all windows with a band in common."""
        n, found = len(shingles), set()
        minima, length = self._hashes(shingles), 1
        for size, stride in self.classes:
            size_here = min(size, n)
            while 2 * length <= size_here:  # running minima over the next power of two
                minima = np.minimum(minima[:, :-length], minima[:, length:])
                length *= 2
            last = n - size_here
            shifted = size_here - length
            window = np.minimum(minima[:, :last + 1:stride], minima[:, shifted:shifted + last + 1:stride])
            starts = range(0, last + 1, stride)
            if last % stride:  # the text's end is a window of its own
                end = np.minimum(minima[:, last], minima[:, last + shifted])
                window, starts = np.column_stack([window, end]), [*starts, last]
            keys = self._bands(window)
            at, w = np.nonzero(self.seen[keys & np.uint32(SEEN)])
            hit = keys[at, w]
            for j in range(len(hit)):
                a, z = np.searchsorted(self.keys, hit[j], "left"), np.searchsorted(self.keys, hit[j], "right")
                found.update((int(t), starts[w[j]], size_here) for t in self.owners[a:z])
        return found

    def matches(self, words: np.ndarray) -> list[tuple]:
        """Best verified place of each template in a text's word hashes: (template
        index, containment, first word, end word), the earliest of equals."""
        best: dict[int, tuple] = {}
        for t, size, wanted in self.short:
            hit = np.flatnonzero(runs(words, size) == wanted)
            if len(hit):
                best[t] = (-1.0, int(hit[0]), int(hit[0]) + size)
        if not self.classes:
            return [(t, -s, a, z) for t, (s, a, z) in sorted(best.items())]
        shingles = runs(words, SHINGLE_WORDS)
        reach = self.classes[-1][0] + 2 * self.classes[-1][1]
        for at in range(0, max(len(shingles), 1), CHUNK):
            part = shingles[at:at + CHUNK + reach]  # windows across the cut are in both
            if not len(part):
                break
            for t, start, size in sorted(self.candidates(part)):
                wanted = self.templates[t][2]
                low = max(at + start - self.stride[t], 0)
                region = shingles[low:at + start + size + self.stride[t]]
                hit = np.flatnonzero(np.isin(region, wanted))
                share = len(np.unique(region[hit])) / len(wanted)
                if share >= CONTAINMENT:
                    place = (-share, low + int(hit[0]), low + int(hit[-1]) + SHINGLE_WORDS)
                    best[t] = min(best.get(t, place), place)
        return [(t, -s, a, z) for t, (s, a, z) in sorted(best.items())]


_scanners: dict[tuple, Scanner] = {}


def scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and template found in it: the exact containment
    of the template's shingles at its best place, and the words it spans there."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]
                          + [T.StructField(n, t) for n, t in FIELDS])
    templates = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        scanner = _scanners.setdefault(templates, None) or Scanner(templates)
        _scanners[templates] = scanner
        arrow = to_arrow_schema(schema)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                rows += [(doc_id.as_py(), *templates[t][:2], share, a, z)
                         for t, share, a, z in scanner.matches(text_words(text.as_py()))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
