"""Licence scans by the Dice coefficient over word bigrams.

A text's units are its lines, its blocks of consecutive non-blank lines, the whole text and,
for every template, the stretches of as many words as the template has that begin with one
of its bigrams; so a notice is found inside a line or wrapped in a paragraph. Units and licence templates are normalised (A-Z lower-cased, anything but a-z and
0-9 separates words) and compared by the sets of their word bigrams. With i common
bigrams, a unit of at least i and a template of b bigrams reach Dice t only if i is at
least t * b / (2 - t), and then only units of at most 2 * i / t - b bigrams; the few units
that pass these bounds are counted exactly. A stretch is only looked at if so many of the
template's bigrams begin in it. Texts stay in their tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import offsets_of, pieces, words_of

# fixed values: customary notices, file headers, tags and the first paragraphs of licence texts
TEMPLATES = {
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "MIT-licensed": "Licensed under the MIT License.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "SPDX-Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX-BSD-2-Clause": "SPDX-License-Identifier: BSD-2-Clause",
    "SPDX-BSD-3-Clause": "SPDX-License-Identifier: BSD-3-Clause",
    "SPDX-CC-BY-4.0": "SPDX-License-Identifier: CC-BY-4.0",
    "SPDX-GPL-2.0": "SPDX-License-Identifier: GPL-2.0-only",
    "SPDX-GPL-3.0": "SPDX-License-Identifier: GPL-3.0-only",
    "SPDX-ISC": "SPDX-License-Identifier: ISC",
    "SPDX-LGPL-2.1": "SPDX-License-Identifier: LGPL-2.1-only",
    "SPDX-MIT": "SPDX-License-Identifier: MIT",
    "SPDX-MPL-2.0": "SPDX-License-Identifier: MPL-2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
}
LEAST = 0.8
SEPARATORS = r"[^a-z0-9\n]+"


def normalised(text: str) -> list[str]:
    """Words of a normalised template."""
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    return "".join(c if c.isascii() and c.isalnum() else " " for c in lowered).split()


def bigrams(text: str) -> set[tuple[str, str]]:
    words = normalised(text)
    return set(zip(words[:-1], words[1:]))


class Templates:
    """Template bigrams as a table over the templates' own words."""

    def __init__(self, texts: Mapping[str, str], least: float):
        self.names, self.least = sorted(texts), least
        sets = [bigrams(texts[n]) for n in self.names]
        self.words = pa.array(sorted({w for s in sets for pair in s for w in pair}), pa.string())
        place = {w: i for i, w in enumerate(self.words.to_pylist())}
        self.pairs = sorted({pair for s in sets for pair in s})
        self.table = np.full((len(place) + 1, len(place) + 1), -1, np.int64)  # the last row: any other word
        for i, (a, b) in enumerate(self.pairs):
            self.table[place[a], place[b]] = i
        self.holds = np.array([[pair in s for s in sets] for pair in self.pairs], bool).reshape(len(self.pairs), len(sets))
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.lengths = [len(normalised(texts[n])) for n in self.names]

    def stretches(self, place: np.ndarray, pair: np.ndarray, ends: np.ndarray, words) -> list[tuple[int, float, int]]:
        """(place, dice, template) of stretches at or over the bound.

        Place, pair and the end of its text list the bigrams found; ``words(first, last)`` gives words.
        """
        out = []
        for k, length in enumerate(self.lengths):
            mine = self.holds[pair, k] if len(pair) else np.zeros(0, bool)
            at, kind, last = place[mine], pair[mine], np.minimum(place[mine] + length, ends[mine])
            upto = np.searchsorted(at, last - 1)
            # with i common bigrams a stretch has at least i
            need = self.least * self.sizes[k] / (2 - self.least) - 1e-9
            for j in np.nonzero(upto - np.arange(len(at)) >= need)[0].tolist():
                common = len(set(kind[j : upto[j]].tolist()))
                if common < need:
                    continue
                own = words(int(at[j]), int(last[j]))
                dice = 2.0 * common / float(len(set(zip(own[:-1], own[1:]))) + self.sizes[k])
                if dice >= self.least:
                    out.append((int(at[j]), dice, k))
        return out

    def matches(self, unit: np.ndarray, pair: np.ndarray, distinct) -> list[tuple[int, float, int]]:
        """(unit, dice, template) at or over the bound; unit and pair list the bigrams found.

        ``distinct(unit)`` counts a unit's distinct bigrams.
        """
        if not len(unit):
            return []
        both = np.unique(unit * len(self.pairs) + pair)
        unit, pair = both // len(self.pairs), both % len(self.pairs)
        starts = np.nonzero(np.diff(unit, prepend=-1))[0]
        common = np.add.reduceat(self.holds[pair].astype(np.int64), starts, axis=0)
        most = 2 * common / self.least - self.sizes
        row, template = np.nonzero((common > 0) & (most >= common - 1e-9))
        out, counted = [], {}
        for r, k in zip(row.tolist(), template.tolist()):
            u = int(unit[starts[r]])
            if u not in counted:
                counted[u] = distinct(u)
            dice = 2.0 * float(common[r, k]) / float(counted[u] + self.sizes[k])
            if dice >= self.least:
                out.append((u, dice, k))
        return out


def scan(texts: pa.Array, templates: Templates) -> tuple[list, list, list]:
    """Best licence of each text, its Dice and the number of matching (unit, licence) pairs."""
    plain = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS, " ")
    split = pc.split_pattern(plain, "\n")
    lines, per_text = split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False)
    words, counts = words_of(lines)
    doc_of_line = np.repeat(np.arange(len(texts)), per_text)
    # a block begins at a line with words after a blank one or at a text's start
    full = counts > 0
    opens = full.copy()
    opens[1:] &= ~full[:-1] | (doc_of_line[1:] != doc_of_line[:-1])
    block_of_line = np.cumsum(opens)
    line = np.repeat(np.arange(len(counts)), counts)
    found = pc.fill_null(pc.index_in(words.cast(pa.string()), value_set=templates.words), len(templates.words))
    codes = found.to_numpy(zero_copy_only=False).astype(np.int64)
    pair = templates.table[codes[:-1], codes[1:]] if len(codes) > 1 else np.zeros(0, np.int64)
    hit = np.nonzero(pair >= 0)[0]
    a, b = line[hit], line[hit + 1] if len(hit) else line[hit]
    best: dict[int, tuple[float, str]] = {}
    hits = np.zeros(len(texts), np.int64)

    def note(doc: int, dice: float, k: int) -> None:
        hits[doc] += 1
        score = (-dice, templates.names[k])
        if doc not in best or score < best[doc]:
            best[doc] = score

    doc_of_word = doc_of_line[line]
    within = hit[doc_of_word[hit] == doc_of_word[hit + 1]] if len(hit) else hit
    ends = np.cumsum(np.bincount(doc_of_word, minlength=len(texts)))
    for place, dice, k in templates.stretches(
        within, pair[within], ends[doc_of_word[within]], lambda first, last: words.slice(first, last - first).to_pylist()
    ):
        note(int(doc_of_word[place]), dice, k)
    for kind in (np.arange(len(counts)), block_of_line, doc_of_line):
        inside = (kind[a] == kind[b]) & (doc_of_line[a] == doc_of_line[b])
        of_word = kind[line]

        def distinct(unit: int) -> int:
            first, last = np.searchsorted(of_word, [unit, unit + 1])
            own = words.slice(first, last - first).to_pylist()
            return len(set(zip(own[:-1], own[1:])))

        for unit, dice, k in templates.matches(kind[a][inside], pair[hit][inside], distinct):
            note(int(doc_of_line[np.searchsorted(kind, unit)]), dice, k)
    names = [best[d][1] if d in best else None for d in range(len(texts))]
    return names, [-best[d][0] if d in best else None for d in range(len(texts))], hits.tolist()


def licence_scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST, carry: Sequence[str] = ()
) -> DataFrame:
    """Best licence of every document with a Dice coefficient of at least ``least``.

    Returns one row per document: ``doc_id, licence`` (null without a match; the first name
    among equals), ``dice`` and ``n_matches`` (pairs of a unit and a template), and the
    carried columns. A one-line block counts as a line and as a block; overlapping stretches
    count each.

    Null or empty text matches nothing. Null and repeated doc_ids are rows like any other.
    Empty table: no rows. Further columns of any name are ignored unless carried.
    """
    carried = [c for c in carry if c not in ("doc_id",)]
    known = Templates(templates, least)
    row = F.struct("doc_id", *carried)
    schema = docs.select(row.alias("_row")).schema["_row"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            names, dices, hits = scan(batch.column("text"), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(names, pa.string()), pa.array(dices, pa.float64()), pa.array(hits, pa.int64())],
                ["_row", "licence", "dice", "n_matches"],
            )

    found = docs.select(row.alias("_row"), "text").mapInArrow(run, f"_row {schema}, licence string, dice double, n_matches bigint")
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), "licence", "dice", "n_matches", *[F.col(f"_row.{c}").alias(c) for c in carried]
    )
