"""License notices in documents: MinHash bands over text windows, then exact shingle containment.

A template with t shingles is looked for in windows of its scale s, the smallest of SCALES
with s >= t: windows of about 9/8 s shingles every s/8, so that one of them holds any passage of
t shingles whole. If such a window has CONTAINED of the template's shingles, its Jaccard
similarity to the template is 0.45 at least, and with BANDS bands of one minimum each they agree
in a band with probability 1 - 0.55**BANDS, over 0.9999. Shingles of five words are rare enough
that one row a band retrieves few others. Retrieved windows are verified on their shingles.

Templates are whole texts of common licenses (folder ``license_texts``, without holders and
appendices), standard headers, and names with versions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bytes_of
from martloom.llm.decontaminate import NORMAL
from martloom.llm.shingles import SHINGLE, WordHashes, combine, mix

BANDS = 16
CONTAINED = 0.8
WORDS_AT_ONCE = 150_000

TEXTS = sorted(
    (f.name[:-4] + "-text", f.read_text(encoding="utf-8")) for f in files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")
)


def _gnu(kind: str, version: str) -> str:
    """The middle of a GNU header, up to its version; what follows it is the same in all versions."""
    return (
        f"you can redistribute it and/or modify it under the terms of the {kind} as published by the Free Software Foundation, "
        f"either version {version} of the License, or (at your option) any later version"
    )


_GPL, _LGPL, _OLD, _AGPL = ("GNU General Public License", "GNU Lesser General Public License", "GNU Library General Public License", "GNU Affero General Public License")
_GNU = [("gpl-1.0", _GPL, "1"), ("gpl-2.0", _GPL, "2"), ("gpl-3.0", _GPL, "3"), ("lgpl-2.0", _OLD, "2"), ("lgpl-2.1", _LGPL, "2.1"), ("lgpl-3.0", _LGPL, "3"), ("agpl-3.0", _AGPL, "3")]
_CC = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def _cc_name(kind: str, version: str) -> str:
    return _CC[kind] if version == "4.0" else _CC[kind].replace("NoDerivatives", "NoDerivs")


HEADERS = [
    *[(f"{name}-header", _gnu(kind, version)) for name, kind, version in _GNU],
    (
        "gpl-grant",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation",
    ),
    (
        "agpl-3.0-terms",
        "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all "
        "users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive "
        "the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through "
        "some standard or customary means of facilitating copying of software.",
    ),
    (
        "apache-2.0-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "mpl-1.1-header",
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except '
        "in compliance with the License.",
    ),
    (
        "mpl-2.0-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at",
    ),
    *[
        (
            f"gfdl-{version}-header",
            "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, "
            f"Version {version} or any later version published by the Free Software Foundation",
        )
        for version in ("1.1", "1.2", "1.3")
    ],
    *[
        (
            f"cc-{kind}-4.0-terms",
            "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative "
            f"Commons {name} 4.0 International Public License",
        )
        for kind, name in _CC.items()
    ],
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files, to deal in the Software without restriction",
    ),
    (
        "bsd-grant",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ),
]

# Names of licenses with their versions. Of up to eight words, four shingles, CONTAINED asks for all.
NOTICES = [
    ("all-rights-reserved", "All rights reserved."),
    ("mit-notice", "under the MIT License"),
    ("isc-notice", "under the ISC License"),
    ("bsd-notice", "under the BSD License"),
    ("bsd-2-clause-notice", "BSD 2-Clause License"),
    ("bsd-3-clause-notice", "BSD 3-Clause License"),
    ("apache-2.0-notice", "Apache License, Version 2.0"),
    ("bsl-1.0-notice", "Boost Software License, Version 1.0"),
    ("ofl-1.1-notice", "SIL Open Font License, Version 1.1"),
    ("cc0-1.0-notice", "CC0 1.0 Universal"),
    *[(f"{name}-notice", f"{kind}, version {version}") for name, kind, version in _GNU],
    *[(f"{name}-short", f"{kind} v{version}") for name, kind, version in _GNU],
    *[(f"gfdl-{version}-notice", f"GNU Free Documentation License, Version {version}") for version in ("1.1", "1.2", "1.3")],
    *[(f"mpl-{version}-notice", f"Mozilla Public License Version {version}") for version in ("1.0", "1.1", "2.0")],
    *[(f"mpl-{version}-short", f"Mozilla Public License, v. {version}") for version in ("1.0", "1.1", "2.0")],
    *[(f"epl-{version}-notice", f"Eclipse Public License - v {version}") for version in ("1.0", "2.0")],
    *[(f"cc-{kind}-4.0-notice", f"CC {kind} 4.0") for kind in _CC],
]

CC_NAMES = [
    *[(f"cc-{kind}-{version}-notice", f"CC {kind} {version}") for kind in _CC for version in _CC_VERSIONS if version != "4.0"],
    *[(f"cc-{kind}-{version}-name", f"Creative Commons {_cc_name(kind, version)} {version}") for kind in _CC for version in _CC_VERSIONS],
    *[(f"cc-{kind}-{version}-link", f"creativecommons.org/licenses/{kind}/{version}") for kind in _CC for version in _CC_VERSIONS],
]

TEMPLATES = (*HEADERS, *NOTICES)
ALL_TEMPLATES = (*TEMPLATES, *CC_NAMES, *TEXTS)

# Templates that share most of their words; ``Templates.stands`` tells them apart.
FAMILIES = (
    tuple(name for name, _ in HEADERS if name.startswith(("gpl-", "lgpl-", "agpl-3.0-header"))),
    ("gpl-1.0-text", "gpl-2.0-text", "gpl-3.0-text", "agpl-3.0-terms"),
    ("lgpl-2.0-text", "lgpl-2.1-text"),
    ("mpl-1.1-text", "mpl-2.0-text"),
    ("gfdl-1.2-text", "gfdl-1.3-text"),
    ("gfdl-1.1-header", "gfdl-1.2-header", "gfdl-1.3-header"),
    ("cc-by-3.0-us-text", "cc-by-sa-3.0-text"),
    ("cc-by-sa-4.0-text", *[f"cc-{kind}-4.0-terms" for kind in _CC]),
    ("bsd-2-clause-text", "bsd-3-clause-text"),
    ("isc-text", "0bsd-text"),
)


def _scales() -> list[int]:
    out, s = [1], 1
    while s < 100_000:
        s = max(s + 1, int(s * 1.25))
        out.append(s)
    return out


SCALES = _scales()
_SEEDS = (mix(np.arange(1, BANDS + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32) | np.uint32(1)


def minima(shingles: np.ndarray, band: int) -> np.ndarray:
    """Hashes of shingles under one band's function."""
    low = (shingles >> np.uint64(32)).astype(np.uint32) ^ (shingles.astype(np.uint32) * _SEEDS[band])
    return (low ^ (low >> np.uint32(15))) * np.uint32(0x85EBCA6B)


class Templates:
    """Templates by shingle size and scale: their shingles and band minima; of families, what each has and a rival has not."""

    def __init__(self, templates: Sequence[tuple[str, str]], families: Sequence[Sequence[str]] = ()):
        memo = WordHashes()
        sets: dict[str, np.ndarray] = {}
        self.groups: dict[tuple[int, int], list[tuple[str, np.ndarray]]] = {}
        for name, text in templates:
            words = text.encode().translate(NORMAL).split()
            if not words:
                continue
            size = min(SHINGLE, len(words))
            hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
            found = np.unique(combine(hashes, size))
            scale = next(s for s in SCALES if s >= len(words) - size + 1)
            self.groups.setdefault((size, scale), []).append((name, found))
            sets[name] = found
        self.rivals: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for family in families:
            for one in family:
                for other in family:
                    if one != other and one in sets and other in sets:
                        own, its = np.setdiff1d(sets[one], sets[other]), np.setdiff1d(sets[other], sets[one])
                        self.rivals.setdefault(one, []).append((own, its))
        self.least = {key: min(len(found) for _, found in group) for key, group in self.groups.items()}
        self.bands = {
            key: [sorted_index([minima(found, band).min() for _, found in group]) for band in range(bands_of(key[1]))]
            for key, group in self.groups.items()
        }

    def stands(self, name: str, window: np.ndarray) -> bool:
        """Whether a window has some of what sets the template apart from each rival, and no smaller part than of the rival's."""
        for own, its in self.rivals.get(name, ()):
            if len(own):
                mine = np.isin(own, window).mean()
                if not mine or (len(its) and np.isin(its, window).mean() > mine):
                    return False
        return True


def sorted_index(values: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted values, their order, and which upper halves they have."""
    values = np.array(values, np.uint32)
    order = np.argsort(values, kind="stable")
    halves = np.zeros(1 << 16, bool)
    halves[values >> np.uint32(16)] = True
    return values[order], order, halves


def among(values: np.ndarray, known: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """Which values are among a few sorted ones: plain comparisons where these are very few, else first by upper halves."""
    if len(known) <= 8:
        found = values == known[0]
        for one in known[1:]:
            found |= values == one
        return np.flatnonzero(found)
    some = np.flatnonzero(halves[values >> np.uint32(16)])
    at = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
    return some[known[at] == values[some]]


def window_of(scale: int) -> tuple[int, int]:
    """Shingles of a window, and between the starts of two."""
    step = max(1, scale // 8)
    return scale + step - 1, step


def bands_of(scale: int) -> int:
    """A window of one shingle is its own minimum in every band."""
    return 1 if window_of(scale)[0] == 1 else BANDS


def windows(ends: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and document of all windows of documents joined to one array of shingles.

    A document shorter than a window is one; else the last window is moved back to its end.
    """
    width, step = window_of(scale)
    starts = np.concatenate(([0], ends[:-1]))
    size = ends - starts
    count = np.where(size > 0, np.maximum(1, -(-(size - width) // step) + 1), 0)
    doc = np.repeat(np.arange(len(ends)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = np.maximum(starts[doc], np.minimum(starts[doc] + nth * step, ends[doc] - width))
    return start, np.minimum(start + width, ends[doc]), doc


def sliding(levels: list[np.ndarray], start: np.ndarray, stop: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of up to ``width``: by doubling, two overlapping powers of two for a whole window.

    ``levels`` has the values, and what earlier calls found of their minima over powers of two.
    """
    values = levels[0]
    out = np.empty(len(start), values.dtype)
    whole = stop - start == width
    s = start[whole]
    depth = width.bit_length() - 1 if len(s) else 0
    span = 1 << depth
    while len(levels) <= depth:
        level, half = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(level[:-half], level[half:]) if len(level) > half else level[:0])
    level = levels[depth]
    out[whole] = np.minimum(level[s], level[s + width - span]) if len(s) else out[whole]
    short = np.flatnonzero(~whole)
    if len(short):  # whole documents, apart from one another
        edges = np.stack((start[short], stop[short]), 1).ravel()
        padded = np.append(values, values.dtype.type(np.iinfo(values.dtype).max))
        out[short] = np.minimum.reduceat(padded, edges)[::2]
    return out


def find_licenses(texts: list[bytes], templates: Templates, memo: WordHashes, contained: float = CONTAINED) -> list[dict[str, float]]:
    """For every text the templates found and the largest part of each that a window holds."""
    out: list[dict[str, float]] = [{} for _ in texts]
    words = [data.translate(NORMAL).split() for data in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter((memo[w] for own in words for w in own), np.uint64, int(lengths.sum()))
    stops = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(texts)), lengths)
    for size in {key[0] for key in templates.groups}:
        if len(hashes) < size:
            continue
        shingles = combine(hashes, size)
        inside = np.arange(len(shingles)) + size <= stops[owner[: len(shingles)]]
        shingles = shingles[inside]
        ends = np.cumsum(np.maximum(0, lengths - size + 1))
        if not len(shingles):
            continue
        keys = [key for key in templates.groups if key[0] == size]
        cuts = {}
        for key in keys:  # windows of too few shingles for any of the templates are left out
            start, stop, doc = windows(ends, key[1])
            enough = stop - start >= contained * templates.least[key] - 1e-9
            cuts[key] = (start, stop, doc) if enough.all() else (start[enough], stop[enough], doc[enough])
        keys = [key for key in keys if len(cuts[key][0])]
        if not keys:
            continue
        asked: dict[tuple, set] = {key: set() for key in keys}
        for band in range(max(bands_of(key[1]) for key in keys)):
            levels = [minima(shingles, band)]
            for key in keys:
                if band >= bands_of(key[1]):
                    continue
                start, stop, _ = cuts[key]
                least = sliding(levels, start, stop, window_of(key[1])[0])
                known, order, halves = templates.bands[key][band]
                for w in among(least, known, halves).tolist():
                    k = int(np.searchsorted(known, least[w]))
                    while k < len(known) and known[k] == least[w]:
                        asked[key].add((w, int(order[k])))
                        k += 1
        for key in keys:
            start, stop, doc = cuts[key]
            for w, t in asked[key]:
                name, template = templates.groups[key][t]
                window = shingles[start[w] : stop[w]]
                part = float(np.isin(template, window).sum() / len(template))
                if part >= contained and templates.stands(name, window):
                    own = out[doc[w]]
                    own[name] = max(part, own.get(name, 0.0))
    return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED, families: Sequence[Sequence[str]] = ()) -> DataFrame:
    """One row per document: the license templates that a window of its text contains.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; shingles have
    five words (a shorter template is one shingle). A template is found if a window has
    ``contained`` of its shingles; of ``families`` those are found that a window tells from their
    rivals (see ``Templates.stands``). A null or empty text has none; repeated rows are scanned one
    by one; templates without words are not looked for; an empty table gives no rows; other
    columns are not read. Columns: id_col, found (array of license and part, by name).
    """
    shared = docs.sparkSession.sparkContext.broadcast((list(templates), list(families)))
    kind = pa.list_(pa.struct([("license", pa.string()), ("part", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = Templates(*shared.value), WordHashes()
        for batch in batches:
            texts = batch.column("data")
            first = 0
            while first < batch.num_rows:
                last, size = first, 0
                while last < batch.num_rows and (last == first or size < 6 * WORDS_AT_ONCE):
                    size += len(texts[last].as_buffer() or b"")
                    last += 1
                found = find_licenses([texts[i].as_py() for i in range(first, last)], index, memo, contained)
                rows = [[{"license": name, "part": part} for name, part in sorted(own.items())] for own in found]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, last - first), pa.array(rows, kind)], ["id", "found"])
                first = last

    base = docs.select(F.col(id_col).alias("id"), bytes_of(text_col).alias("data"))
    named = base.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, found array<struct<license:string,part:double>>")
    return named.withColumnRenamed("id", id_col)
