"""Licence scan by a positional index of rare licence words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases of the base scan and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Titles, notices and texts of licences, as words, with the label and
# the phrases without which a text does not count.
TEMPLATES = (
    ("gpl-3.0", ("gnu general public license", "version 3"),
     "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", ("gnu general public license version 3",),
     "gnu general public license version 3 29 june 2007 copyright c 2007 free software "
     "foundation inc everyone is permitted to copy and distribute verbatim copies of "
     "this license document but changing it is not allowed"),
    ("gpl-3.0-or-later", ("gnu general public license", "version 3", "any later version"),
     "you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 "
     "of the license or at your option any later version"),
    ("gpl-2.0", ("gnu general public license", "version 2"),
     "this work is licensed under the gnu general public license version 2"),
    ("gpl-2.0", ("gnu general public license version 2",),
     "gnu general public license version 2 june 1991 copyright c 1989 1991 free software "
     "foundation inc everyone is permitted to copy and distribute verbatim copies of "
     "this license document but changing it is not allowed"),
    ("gpl-2.0-or-later", ("gnu general public license", "version 2", "any later version"),
     "you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 2 "
     "of the license or at your option any later version"),
    ("lgpl-3.0", ("gnu lesser general public license", "version 3"),
     "this work is licensed under the gnu lesser general public license version 3"),
    ("lgpl-3.0-or-later", ("gnu lesser general public license", "version 3", "any later version"),
     "you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation either version 3 "
     "of the license or at your option any later version"),
    ("lgpl-2.1", ("gnu lesser general public license", "version 2 1"),
     "this work is licensed under the gnu lesser general public license version 2 1"),
    ("lgpl-2.1-or-later", ("gnu lesser general public license", "version 2 1", "any later version"),
     "you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation either version 2 1 "
     "of the license or at your option any later version"),
    ("agpl-3.0", ("gnu affero general public license", "version 3"),
     "this work is licensed under the gnu affero general public license version 3"),
    ("agpl-3.0-or-later", ("gnu affero general public license", "version 3", "any later version"),
     "you can redistribute it and or modify it under the terms of the gnu affero general "
     "public license as published by the free software foundation either version 3 "
     "of the license or at your option any later version"),
    ("apache-2.0", ("apache license", "version 2 0"),
     "licensed under the apache license version 2 0"),
    ("apache-2.0", ("apache license version 2 0",),
     "apache license version 2 0 january 2004 http www apache org licenses"),
    ("apache-2.0", ("apache license", "version 2 0", "in compliance with the license"),
     "licensed under the apache license version 2 0 the license you may not use this "
     "file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", ("mit license",),
     "released under the mit license"),
    ("mit", ("mit license",),
     "the mit license mit copyright c"),
    ("mit", ("free of charge", "without restriction"),
     "permission is hereby granted free of charge to any person obtaining a copy of "
     "this software and associated documentation files the software to deal in the "
     "software without restriction including without limitation the rights to use copy "
     "modify merge publish distribute sublicense and or sell copies of the software"),
    ("cc-by-4.0", ("cc by 4 0",),
     "licensed under cc by 4 0"),
    ("cc-by-3.0", ("cc by 3 0",),
     "licensed under cc by 3 0"),
    ("cc-by-nc-4.0", ("cc by nc 4 0",),
     "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", ("cc by sa 4 0",),
     "licensed under cc by sa 4 0"),
    ("cc-by-sa-3.0", ("cc by sa 3 0",),
     "licensed under cc by sa 3 0"),
    ("cc-by-4.0", ("creative commons attribution 4 0",),
     "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-3.0", ("creative commons attribution 3 0",),
     "this work is licensed under a creative commons attribution 3 0 unported license"),
    ("cc-by-sa-4.0", ("creative commons attribution sharealike 4 0",),
     "this work is licensed under a creative commons attribution sharealike 4 0 "
     "international license"),
    ("cc-by-sa-3.0", ("creative commons attribution sharealike 3 0",),
     "this work is licensed under a creative commons attribution sharealike 3 0 "
     "unported license"),
    ("cc-by-nc-4.0", ("creative commons attribution noncommercial 4 0",),
     "this work is licensed under a creative commons attribution noncommercial 4 0 "
     "international license"),
    ("cc0-1.0", ("cc0 1 0",),
     "released under cc0 1 0 universal public domain dedication"),
    ("bsd-3-clause", ("bsd 3 clause license",),
     "released under the bsd 3 clause license"),
    ("bsd-2-clause", ("redistribution and use", "are permitted provided that"),
     "redistribution and use in source and binary forms with or without modification "
     "are permitted provided that the following conditions are met"),
    ("bsd-3-clause", ("neither the name", "endorse or promote products"),
     "neither the name of the copyright holder nor the names of its contributors may be "
     "used to endorse or promote products derived from this software without specific "
     "prior written permission"),
    ("mpl-2.0", ("mozilla public license", "v 2 0"),
     "this source code form is subject to the terms of the mozilla public license v 2 0 "
     "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl-2.0", ("eclipse public license", "2 0"),
     "this program and the accompanying materials are made available under the terms of "
     "the eclipse public license 2 0 which is available at"),
    ("epl-1.0", ("eclipse public license", "v1 0"),
     "this program and the accompanying materials are made available under the terms of "
     "the eclipse public license v1 0 which accompanies this distribution"),
    ("isc", ("and or distribute this software", "with or without fee"),
     "permission to use copy modify and or distribute this software for any purpose "
     "with or without fee is hereby granted provided that the above copyright notice and "
     "this permission notice appear in all copies"),
    ("unlicense", ("unencumbered software", "public domain"),
     "this is free and unencumbered software released into the public domain anyone is "
     "free to copy modify publish use compile sell or distribute this software"),
    ("zlib", ("altered source versions must be plainly marked",),
     "altered source versions must be plainly marked as such and must not be "
     "misrepresented as being the original software"),
    ("bsl-1.0", ("boost software license", "version 1 0"),
     "distributed under the boost software license version 1 0"),
    ("wtfpl", ("do what the fuck you want to public license",),
     "do what the fuck you want to public license"),
)

# Identifiers of licences in a line that begins with SPDX_LINE.
SPDX_LINE = "spdx license identifier"
SPDX_IDS = (
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0",
    "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0",
    "CC-BY-NC-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0",
    "EPL-2.0", "EUPL-1.2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0",
    "MPL-2.0", "MS-PL", "OFL-1.1", "PostgreSQL", "Python-2.0", "Unlicense", "WTFPL", "Zlib",
)
#: Words between the identifiers of one line.
SPDX_JOINED = (b"and", b"or", b"with")

#: Rarest distinct words of a template that its postings hold.
ANCHORS = 4
#: Share of a template's words that must stand there, in their order.
SHARE = 0.8

# A byte of a word stays, A-Z in lower case; any other becomes a blank. Bytes of
# characters beyond ASCII are bytes of words.
_KEPT = (set(range(48, 58)) | set(range(97, 123))) | set(range(128, 256))
_TABLE = bytes(
    x + 32 if 65 <= x <= 90 else x if x in _KEPT else 32 for x in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def phrase_places(words: list[bytes], phrases=PHRASES) -> list[tuple[int, str]]:
    """(start, label) of each place where a phrase's words follow each other."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases:
        own = f" {phrase} ".encode()
        at, counted, word = joined.find(own), 0, 0
        while at >= 0:
            word += joined.count(b" ", counted, at)
            counted = at
            found.append((word, label))
            at = joined.find(own, at + 1)
    return found


def spdx_lines(words: list[bytes]) -> list[tuple[str, int, float]]:
    """(label, start, 1.0) of each identifier of each line of identifiers."""
    start = SPDX_LINE.encode().split()
    if start[0] not in words:
        return []
    ids = {tuple(words_of(x)): x.lower() for x in SPDX_IDS}
    longest = max(map(len, ids))
    found = []
    for at, word in enumerate(words):
        if word != start[0] or words[at : at + len(start)] != start:
            continue
        place = at + len(start)
        while True:
            sizes = [n for n in range(longest, 0, -1) if tuple(words[place : place + n]) in ids]
            if not sizes:
                break
            found.append((ids[tuple(words[place : place + sizes[0]])], at, 1.0))
            place += sizes[0]
            if place >= len(words) or words[place] not in SPDX_JOINED:
                break
            place += 1
    return found


def common_in_order(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, by bits of whole numbers."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    rest = full
    for word in b:
        met = rest & places.get(word, 0)
        rest = ((rest + met) | (rest - met)) & full
    return len(a) - rest.bit_count()


@dataclass
class Index:
    """Postings of each template's rarest words: (template, position in it)."""

    templates: list[tuple[str, list[bytes], list[str]]]
    postings: dict[bytes, list[tuple[int, int]]]

    @classmethod
    def of(cls, idf: dict[bytes, float], anchors: int = ANCHORS) -> Index:
        templates = [(label, t.encode().split(), list(keys)) for label, keys, t in TEMPLATES]
        postings: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, words, _) in enumerate(templates):
            rarest = sorted(dict.fromkeys(words), key=lambda w: -idf.get(w, 0.0))[:anchors]
            for place, word in enumerate(words):
                if word in rarest:
                    postings.setdefault(word, []).append((i, place))
        return cls(templates, postings)

    def matches(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """(label, start, share of words in order) of each verified template.

        Each of the text's licence words votes for where a template would begin. Where
        half of a template's rarest words agree within the drift that some inserted or
        left out words make, its words are looked for in order, and its key phrases.
        """
        if self.postings.keys().isdisjoint(words):
            return []
        votes: dict[int, list[tuple[int, bytes]]] = {}
        for at, word in enumerate(words):
            for template, place in self.postings.get(word, ()):
                votes.setdefault(template, []).append((at - place, word))
        found = []
        for i, cast in votes.items():
            label, own, keys = self.templates[i]
            needed = -(-min(ANCHORS, len(set(own))) // 2)
            drift = max(3, min(16, len(own) // 3))
            cast.sort()
            first, last, agree = 0, 0, Counter()
            while first < len(cast):
                start = cast[first][0]
                while last < len(cast) and cast[last][0] <= start + drift:
                    agree[cast[last][1]] += 1
                    last += 1
                if len(+agree) >= needed:
                    there = words[max(start, 0) : max(start + drift + len(own), 0)]
                    share = common_in_order(own, there) / len(own)
                    held = b" " + b" ".join(there) + b" "
                    if share >= SHARE and all(f" {k} ".encode() in held for k in keys):
                        found.append((label, max(start, 0), share))
                        first, agree = last, Counter()  # the next place is another one
                        continue
                agree[cast[first][1]] -= 1
                first += 1
        return found


def rarity(docs: DataFrame) -> dict[bytes, float]:
    """Inverse document frequency of each template word, from all of ``docs``."""
    vocabulary = {w for _, _, t in TEMPLATES for w in t.encode().split()}

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        rows = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(vocabulary.intersection(words_of(text)))
                rows += 1
        names = [b"", *counts]
        columns = {"word": names, "n": [rows, *(counts[w] for w in names[1:])]}
        yield pa.RecordBatch.from_pydict(columns)

    counts = docs.select("text").mapInArrow(tally, "word binary, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).collect()  # template words
    known = {bytes(r["word"]): r["n"] for r in counts}
    total = known.get(b"", 0)
    return {w: log((total + 1) / (known.get(w, 0) + 1)) for w in vocabulary}


FOUND = (
    "n_words long, base_labels array<string>, base_starts array<long>, "
    "labels array<string>, starts array<long>, score double"
)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``licenses``, which replaces one of that name.

    base_labels and base_starts are the places of the phrases, labels and starts the
    verified templates, and the identifiers of SPDX lines, and where they begin. score
    is the largest share of a template's words that stand there in order, 1 for an
    identifier, 0.5 where only phrases were found, else 0.
    A null text is like an empty one. Rows are scanned one by one, so repeated rows
    and other columns make no difference; an empty table stays empty.
    """
    index = Index.of(rarity(docs))

    def find(batches):
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text)
                base, found = phrase_places(words), index.matches(words) + spdx_lines(words)
                score = max([0.5 if base else 0.0, *(s for _, _, s in found)])
                base_labels, base_starts = [x for _, x in base], [x for x, _ in base]
                labels, starts = [x for x, _, _ in found], [x for _, x, _ in found]
                rows.append((len(words), base_labels, base_starts, labels, starts, score))
            names = [x.split()[0] for x in FOUND.split(", ")]
            yield pd.DataFrame(rows, columns=names)

    find.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return docs.withColumn("licenses", F.pandas_udf(find, FOUND)("text"))
