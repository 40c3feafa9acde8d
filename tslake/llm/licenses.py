"""Licence scan by a positional rare-token index, in DataFrame functions only.

A template is a licence's notice or one of its passages, with mandatory key
phrases. Of the licence words a file has, those of highest inverse document
frequency (over all documents) are looked up: for each template whose mandatory
words the file has, the rarest ``LOOKED_UP`` of them. Every place of the rarest
proposes an alignment (template, place minus template position); the other
places are intersected with it by their relative positions; and an alignment
stands when every mandatory key phrase is found word by word where the template
has it. So a phrase that stands in a file is always found, whatever words the
corpus makes rare. The score is the share of the template's IDF weight found in
place, at best over the templates; a base phrase is always whole, so 1.

Defined results: null text counts as empty: no words, no labels, score 0; rows
are independent, so repeated rows and ids stay; ties between equally rare words
go to the smaller word; an empty table gives no rows. A text's places live in
its own row: nothing but the word counts (one per template word) is shuffled.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import ascii_lower, let

LOOKED_UP = 2
WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase, label and the word whose places are looked at.
BASE = [
    (["cc", "by"], "cc-by", 0),
    (["general", "public", "license"], "gpl", 0),
    (["all", "rights", "reserved"], "reserved", 1),
]


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return re.findall(r"[0-9a-z]+", self.text.lower())

    @property
    def spans(self) -> list[tuple[int, int]]:
        """(first position, words) of the mandatory phrases."""
        found = []
        for phrase in self.phrases:
            part = phrase.split()
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(part)] == part)
            found.append((at, len(part)))
        return found

    @property
    def must(self) -> list[int]:
        return [p + i for p, n in self.spans for i in range(n)]


#: Labels and SPDX identifiers.
SPDX = {
    "agpl-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "apache-2.0": ["Apache-2.0"],
    "bsd-2-clause": ["BSD-2-Clause"],
    "bsd-3-clause": ["BSD-3-Clause"],
    "bsl-1.0": ["BSL-1.0"],
    "cc-by-4.0": ["CC-BY-4.0"],
    "cc-by-nc-4.0": ["CC-BY-NC-4.0"],
    "cc-by-sa-4.0": ["CC-BY-SA-4.0"],
    "cc0-1.0": ["CC0-1.0"],
    "epl-2.0": ["EPL-2.0"],
    "gpl-2.0": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"],
    "gpl-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "mit": ["MIT"],
    "mpl-2.0": ["MPL-2.0"],
    "unlicense": ["Unlicense"],
    "zlib": ["Zlib"],
}
#: Published licence notices, passages and short names.
NOTICES = [
    Template("agpl-3.0", "licensed under the GNU Affero General Public License version 3", ("affero general public license version 3",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("source and binary forms", "are permitted")),
    Template("bsd-3-clause", "released under the BSD 3-Clause License", ("bsd 3 clause license",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial 4 0",)),
    Template("cc0-1.0", "dedicated to the public domain under CC0 1.0 Universal", ("cc0 1 0",)),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", ("permission is hereby granted free of charge", "any person obtaining a copy")),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ("gnu affero general public license as published by the free software foundation either version 3 of the license",)),
    Template("apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", ("apache license version 2 0 january 2004", "terms and conditions for use reproduction and distribution")),
    Template("apache-2.0", 'you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', ("you may not use this file except in compliance with the license", "www apache org licenses license 2 0")),
    Template("apache-2.0", "Apache License 2.0", ("apache license 2 0",)),
    Template("bsd-2-clause", "BSD 2-Clause License", ("bsd 2 clause license",)),
    Template("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("nor the names of its contributors may be used to endorse or promote products derived from this software",)),
    Template("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution", ("redistributions of source code must retain the above copyright notice", "this list of conditions and the following disclaimer")),
    Template("bsl-1.0", "Boost Software License - Version 1.0 - August 17th, 2003", ("boost software license version 1 0",)),
    Template("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("creative commons attribution sharealike 4 0",)),
    Template("cc0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law", ("dedicated the work to the public domain by waiving all of his or her rights",)),
    Template("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", ("eclipse public license 2 0",)),
    Template("gpl-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version", ("gnu general public license as published by the free software foundation either version 2 of the license",)),
    Template("gpl-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ("gnu general public license as published by the free software foundation either version 3 of the license",)),
    Template("gpl-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ("gnu general public license version 2 june 1991",)),
    Template("gpl-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("gnu general public license version 3 29 june 2007",)),
    Template("isc", "ISC License", ("isc license",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license as published by the free software foundation",)),
    Template("mit", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so", ("to deal in the software without restriction", "rights to use copy modify merge publish distribute sublicense and or sell copies of the software")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", ("source code form is subject to the terms of the mozilla public license v 2 0",)),
    Template("mpl-2.0", "Mozilla Public License Version 2.0", ("mozilla public license version 2 0",)),
    Template("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means", ("anyone is free to copy modify publish use compile sell or distribute this software",)),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely", ("in no event will the authors be held liable for any damages arising from the use of this software", "permission is granted to anyone to use this software for any purpose")),
]
TEMPLATES = NOTICES + [
    Template(label, f"SPDX-License-Identifier: {name}", (" ".join(re.findall("[0-9a-z]+", f"spdx-license-identifier {name}".lower())),))
    for label, names in SPDX.items()
    for name in names
]
VOCABULARY = sorted({w for t in TEMPLATES for w in t.words})


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), WORD), "")


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Documents, and documents with each template word (at most
    ``len(VOCABULARY)`` rows come to the driver)."""
    found = F.filter(words(F.coalesce(F.col(text), F.lit(""))), lambda w: w.isin(VOCABULARY))
    rows = (
        docs.select(F.explode(F.array_append(F.array_distinct(found), F.lit(""))).alias("w"))  # "" stands for the document
        .groupBy("w")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    counts = {r["w"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def _array(values: list[Column], kind: str) -> Column:
    return F.array(*values) if values else F.array().cast(kind)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``_license`` of counts, labels and score. A
    column of that name is replaced."""
    total, df = document_frequencies(docs, text)
    idf = {w: math.log((total + 1) / (df.get(w, 0) + 1)) for w in VOCABULARY}
    # of the mandatory words, the first places of the rarest, rarest first
    rare = [[next(p for p in t.must if t.words[p] == w) for w in sorted({t.words[p] for p in t.must}, key=lambda w: (-idf[w], w))[:LOOKED_UP]] for t in TEMPLATES]
    postings = _array(
        [F.struct(F.lit(t.words[rare[k][0]]).alias("w"), F.lit(k).alias("t"), F.lit(rare[k][0]).alias("p")) for k, t in enumerate(TEMPLATES)],
        "array<struct<w:string,t:int,p:int>>",
    )
    templates = F.array(
        *[
            F.struct(
                F.lit(t.label).alias("label"),
                F.array(*map(F.lit, t.words)).alias("words"),
                F.array(*[F.lit(float(idf[w])) for w in t.words]).alias("idf"),
                F.array(*map(F.lit, rare[k])).alias("rare"),
                F.array(*map(F.lit, t.must)).alias("must"),
                F.lit(float(sum(idf[w] for w in t.words))).alias("weight"),
            )
            for k, t in enumerate(TEMPLATES)
        ]
    )
    index_words = sorted({t.words[rare[k][0]] for k, t in enumerate(TEMPLATES)})
    anchors = sorted({*index_words, *(phrase[at] for phrase, _, at in BASE)})

    def in_place(w: Column, a: Column, t: Column, p: Column) -> Column:
        return F.coalesce(F.get(w, a["at"] + p) == F.get(t["words"], p), F.lit(False))

    def matched(w: Column, places: Column) -> Column:
        """(label, score) of the alignments that stand."""
        proposals = F.array_distinct(
            F.flatten(
                F.transform(
                    F.filter(places, lambda i: F.get(w, i).isin(index_words)),
                    lambda i: F.transform(F.filter(postings, lambda q: q["w"] == F.get(w, i)), lambda q: F.struct(q["t"].alias("t"), (i - q["p"]).alias("at"))),
                )
            )
        )

        def stands(a: Column) -> Column:
            return let(
                F.get(templates, a["t"]),
                lambda t: F.when(F.forall(t["rare"], lambda p: in_place(w, a, t, p)), F.forall(t["must"], lambda p: in_place(w, a, t, p))).otherwise(False),
            )

        def scored(a: Column) -> Column:
            return let(
                F.get(templates, a["t"]),
                lambda t: F.struct(
                    t["label"].alias("label"),
                    F.when(
                        t["weight"] > 0,
                        F.aggregate(F.sequence(F.lit(0), F.size(t["words"]) - 1), F.lit(0.0), lambda s, p: s + F.when(in_place(w, a, t, p), F.get(t["idf"], p)).otherwise(0.0))
                        / t["weight"],
                    )
                    .otherwise(1.0)
                    .alias("score"),
                ),
            )

        return F.transform(F.filter(proposals, stands), scored)

    def base(w: Column, places: Column, phrase: list[str], at: int) -> Column:
        """Starts of a base phrase."""
        def whole(i: Column) -> Column:
            test = F.get(w, i) == phrase[at]
            for k, word in enumerate(phrase):
                if k != at:
                    test = test & F.coalesce(F.get(w, i + (k - at)) == word, F.lit(False))
            return test

        return F.transform(F.filter(places, whole), lambda i: i - at)

    def by_places(w: Column, places: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.array(*[base(w, places, phrase, at) for phrase, _, at in BASE]).alias("base"),
            matched(w, places).alias("found"),
        )

    def by_words(w: Column) -> Column:
        places = F.when(F.size(w) > 0, F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).isin(anchors))).otherwise(F.array().cast("array<int>"))
        return let(places, lambda p: by_places(w, p))

    scanned = docs.withColumn("_license", let(words(F.coalesce(F.col(text), F.lit(""))), by_words))
    q = F.col("_license")
    base_labels = F.filter(F.array(*[F.when(F.size(q["base"][k]) > 0, label) for k, (_, label, _) in enumerate(BASE)]), lambda x: x.isNotNull())
    starts = F.flatten(q["base"])
    return scanned.withColumn(
        "_license",
        F.struct(
            q["n_words"].alias("n_words"),
            F.size(starts).cast("long").alias("n_base"),
            F.array_min(starts).cast("long").alias("first_word"),
            F.array_max(starts).cast("long").alias("last_word"),
            F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, q["found"]["label"]))), ",").alias("labels"),
            F.when(F.size(starts) > 0, 1.0).otherwise(F.round(F.coalesce(F.array_max(q["found"]["score"]), F.lit(0.0)), 6)).alias("score"),
        ),
    )


REPORT = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def report(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).select("doc_id", *[F.col("_license")[c].alias(c) for c in REPORT])


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
tpl(t, label, p, w) AS (VALUES {_values([(k, t.label, p, w) for k, t in enumerate(TEMPLATES) for p, w in enumerate(t.words)])}),
must(t, p) AS (VALUES {_values([(k, p) for k, t in enumerate(TEMPLATES) for p in t.must])}),
phrase(b, label, k, w, n) AS (VALUES {_values([(b, label, k, w, len(ph)) for b, (ph, label, _) in enumerate(BASE) for k, w in enumerate(ph)])}),
pos AS (SELECT rid, i, ws[i + 1] AS w FROM (SELECT rid, ws, unnest(range(0, len(ws))) AS i FROM d)),
df AS (SELECT w, count(DISTINCT rid) AS n FROM pos WHERE w IN (SELECT w FROM tpl) GROUP BY w),
idf AS (SELECT v.w, ln(((SELECT count(*) FROM d) + 1) / (coalesce(df.n, 0) + 1)) AS idf FROM (SELECT DISTINCT w FROM tpl) v LEFT JOIN df USING (w)),
rarest AS (SELECT t, p, w FROM must JOIN tpl USING (t, p) JOIN idf USING (w)
           QUALIFY row_number() OVER (PARTITION BY t ORDER BY idf DESC, w, p) = 1),
cand AS (SELECT DISTINCT pos.rid, t, i - p AS off FROM pos JOIN rarest USING (w)),
fit AS (SELECT c.rid, c.t, c.off, tpl.label, tpl.p, idf.idf, coalesce(pos.w = tpl.w, false) AS ok,
          EXISTS (SELECT 1 FROM must m WHERE m.t = tpl.t AND m.p = tpl.p) AS must
        FROM cand c JOIN tpl USING (t) JOIN idf ON idf.w = tpl.w LEFT JOIN pos ON pos.rid = c.rid AND pos.i = c.off + tpl.p),
found AS (SELECT rid, label, coalesce(sum(idf) FILTER (ok), 0) / sum(idf) AS score, sum(idf) AS weight
          FROM fit GROUP BY rid, t, off, label
          HAVING bool_and(ok) FILTER (must)),
base AS (SELECT rid, label, i - k AS off FROM pos JOIN phrase USING (w) GROUP BY rid, b, label, off, n HAVING count(*) = n),
base_by AS (SELECT rid, count(*) AS n, min(off) AS first_word, max(off) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY rid),
all_by AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
           FROM (SELECT rid, label FROM base UNION ALL SELECT rid, label FROM found) GROUP BY rid),
score AS (SELECT rid, max(CASE WHEN weight > 0 THEN score ELSE 1.0 END) AS score FROM found GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE round(coalesce(s.score, 0), 6)::DOUBLE END AS score
FROM d LEFT JOIN base_by b USING (rid) LEFT JOIN all_by a USING (rid) LEFT JOIN score s USING (rid)
"""
