"""Licence scans: known licence sentences become identifiers, sequences of which licence rules recognise."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import field

# Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-copy-url": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-line": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "ccbync-line": "Licensed under CC BY-NC 4.0.",
    "ccby-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
}
# Rules in order of preference; a licence is told by these sentences in this sequence.
RULES = (
    ("apache-header", "Apache-2.0", ("apache-grant", "apache-use", "apache-copy-url", "apache-basis", "apache-see")),
    ("apache-header-split", "Apache-2.0", ("apache-grant", "apache-use", "apache-copy", "apache-basis", "apache-see")),
    ("apache-grant", "Apache-2.0", ("apache-grant",)),
    ("apache-line", "Apache-2.0", ("apache-line",)),
    ("apache-tag", "Apache-2.0", ("spdx-apache",)),
    ("mit-text", "MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("mit-grant", "MIT", ("mit-grant", "mit-notice")),
    ("mit-line", "MIT", ("mit-line",)),
    ("mit-tag", "MIT", ("spdx-mit",)),
    ("gpl3-header", "GPL-3.0-or-later", ("gpl3-free", "gpl-hope", "gpl-implied", "gpl-see")),
    ("gpl3-free", "GPL-3.0-or-later", ("gpl3-free",)),
    ("gpl3-line", "GPL-3.0-only", ("gpl3-line",)),
    ("gpl3-tag", "GPL-3.0-or-later", ("spdx-gpl3",)),
    ("ccbync-line", "CC-BY-NC-4.0", ("ccbync-line",)),
    ("ccby-line", "CC-BY-4.0", ("ccby-line",)),
    ("bsd-redistribution", "BSD", ("bsd-redistribution",)),
)
LONGEST = max(len(r[2]) for r in RULES)

# Sentence ends, each a pattern and what stands for it; \x1e is the mark. Both engines read them alike.
ENDS = (
    (r"([.!?;:])[ \t\r\n]+", "1\x1e"),
    (r"\n[ \t\r]*\n", "\x1e"),
    (r"([^A-Za-z0-9,\x1e])[ \t\r]*\n[ \t\r]*", "1\x1e"),
    (r"\n[ \t\r]*([A-Z][^A-Z])", "\x1e1"),
)


def normalised(sentence: str) -> str:
    """Lower-case letters and digits, one blank between words."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def parts(sentence: str) -> tuple[str, ...]:
    """The normalised parts in which :func:`sentences` gives a sentence, more than one if it holds an end inside."""
    for pattern, put in ENDS:
        sentence = re.sub(pattern, put.replace("1", r"\1"), sentence)
    return tuple(normalised(p) for p in sentence.split("\x1e"))


def anchors() -> tuple[str, ...]:
    """Words so chosen that every known sentence holds one of them."""
    left, chosen = {k: set(normalised(s).split()) for k, s in SENTENCES.items()}, []
    while left:
        words = sorted({w for ws in left.values() for w in ws if len(w) > 5}, key=lambda w: (-sum(w in ws for ws in left.values()), w))
        chosen.append(words[0])
        left = {k: ws for k, ws in left.items() if words[0] not in ws}
    return tuple(chosen)


def sentences(text: Column) -> Column:
    """Normalised sentences of a text, in order.

    A sentence ends at punctuation before a blank, at an empty line, at a line end after a mark, and at a
    line end before a word with one capital; other line ends are wrapped text.
    """
    for pattern, put in ENDS:
        text = F.regexp_replace(text, pattern, put.replace("1", "$1"))
    return F.split(text, "\x1e")


def _words(said: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(said), "[^a-z0-9]+", " "))


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences in documents: (doc_id, digest, licence, rule, first_sentence, last_sentence).

    Every sentence is normalised and looked up among the known ones; the identifiers found, in order
    of their place, are matched with the rules' sequences, other sentences in between not counting. A
    match inside a longer one is left out, equal ones go to the earlier rule. Sentences are numbered from
    1. A known sentence with an end inside ('SPDX-License-Identifier: MIT') is found as its parts next to each
    other and counts as far as the last; lines around a tag do not belong to it. Texts without any anchor word hold no known sentence and are passed over at once. Rows of one id and text (``digest``) are
    one document; NULL and empty texts have no licence; other columns are ignored.

    The two tables joined are the fixed ones above; only found sentences are shuffled, by document.
    """
    spark = docs.sparkSession
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    rows = docs.select(field(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    rows = rows.filter(reduce(Column.__or__, [F.contains(F.lower("text"), F.lit(a)) for a in anchors()]))
    said = rows.select("doc_id", "digest", F.posexplode(sentences(F.col("text"))).alias("sentence", "said"))
    known = F.create_map(*[F.lit(x) for k, s in SENTENCES.items() for x in (normalised(s), k)])
    cut = {k: ps for k, s in SENTENCES.items() if len(ps := parts(s)) > 1}
    pieces = sorted({p for ps in cut.values() for p in ps})
    tags = [ps for k, ps in cut.items() if k.startswith("spdx-")]
    # a tag is a line: wrapped lines before its first part and after its last are left off
    head, tail = (_words(F.substring_index("said", "\n", n)) for n in (-1, 1))
    said = said.select(
        "doc_id", "digest", "sentence", _words(F.col("said")).alias("said"),
        F.when(head.isin(*{ps[0] for ps in tags}), head).when(tail.isin(*{ps[-1] for ps in tags}), tail).alias("line"),
    )
    hits = said.select(
        "doc_id", "digest", (F.col("sentence") + 1).alias("sentence"),
        F.try_element_at(known, F.col("said")).alias("known"),
        F.coalesce(F.when(F.col("said").isin(*pieces), F.col("said")), F.col("line")).alias("piece"),
    )
    hits = hits.filter(F.col("known").isNotNull() | F.col("piece").isNotNull()).distinct()

    in_order = Window.partitionBy("doc_id", "digest").orderBy("sentence")
    following = F.array(*[F.when(F.lead("sentence", i).over(in_order) == F.col("sentence") + i, F.lead("piece", i).over(in_order)) for i in range(1, max(map(len, cut.values())))])
    hits = hits.withColumn("following", following)
    whole = [
        F.when(reduce(Column.__and__, [F.col("following")[i] == p for i, p in enumerate(ps[1:])], F.col("piece") == ps[0]), F.struct(F.lit(k).alias("known"), (F.col("sentence") + len(ps) - 1).alias("end")))
        for k, ps in cut.items()
    ]
    one = F.when(F.col("known").isNotNull(), F.struct("known", F.col("sentence").alias("end")))
    hits = hits.select("doc_id", "digest", "sentence", F.coalesce(one, *whole).alias("hit")).filter("hit IS NOT NULL").select("doc_id", "digest", "sentence", "hit.known", "hit.end")

    ahead = in_order.rowsBetween(0, LONGEST - 1)
    sequences = hits.select(
        "doc_id", "digest", "sentence",
        F.concat(F.array_join(F.collect_list("known").over(ahead), " "), F.lit(" ")).alias("ids"),
        F.collect_list("end").over(ahead).alias("places"),
    )
    rules = F.array(
        *[
            F.when(F.startswith("ids", F.lit(" ".join(ids) + " ")), F.struct(F.lit(i).alias("place"), F.lit(name).alias("rule"), F.lit(licence).alias("licence"), F.element_at("places", len(ids)).alias("last")))
            for i, (name, licence, ids) in enumerate(RULES)
        ]
    )
    best = F.array_sort(F.array_compact(rules), lambda a, b: F.when(a.last != b.last, b.last - a.last).otherwise(a.place - b.place))
    matches = sequences.select("doc_id", "digest", F.col("sentence").alias("first"), F.try_element_at(best, F.lit(1)).alias("m")).filter("m IS NOT NULL")
    before = Window.partitionBy("doc_id", "digest").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("m.last").over(before) >= F.col("m.last"), F.lit(False))
    return matches.withColumn("covered", covered).filter(~F.col("covered")).select(
        "doc_id", "digest", "m.licence", "m.rule", F.col("first").alias("first_sentence"), F.col("m.last").alias("last_sentence")
    )


def recognise_sql() -> str:
    """The same over table ``documents``, in SQL."""
    text = "coalesce(text, '')"
    for pattern, put in ENDS:
        put = put.replace("1", "\\1").replace("\x1e", "' || chr(30) || '")
        pattern = pattern.replace("\\x1e", "' || chr(30) || '")
        text = f"regexp_replace({text}, '{pattern}', '{put}', 'g')"
    known = ", ".join(f"('{normalised(s)}', '{k}')" for k, s in SENTENCES.items())
    rules = ", ".join(f"({i}, '{name}', '{licence}', '{' '.join(ids)} ', {len(ids)})" for i, (name, licence, ids) in enumerate(RULES))
    return f"""
WITH known(said, id) AS (VALUES {known}),
rules(place, rule, licence, ids, n) AS (VALUES {rules}),
docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT doc_id, md5(text) AS digest, string_split({text}, chr(30)) AS p FROM docs),
said AS (SELECT doc_id, digest, unnest(range(1, len(p) + 1)) AS sentence, unnest(p) AS s FROM parts),
hits AS (
  SELECT doc_id, digest, sentence, id FROM said JOIN known ON trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) = known.said),
ahead AS (
  SELECT doc_id, digest, sentence, array_to_string(list(id) OVER w, ' ') || ' ' AS ids, list(sentence) OVER w AS places
  FROM hits WINDOW w AS (PARTITION BY doc_id, digest ORDER BY sentence ROWS BETWEEN CURRENT ROW AND {LONGEST - 1} FOLLOWING)),
matches AS (
  SELECT doc_id, digest, sentence AS first, rule, licence, places[n] AS last
  FROM ahead JOIN rules ON starts_with(ahead.ids, rules.ids)
  QUALIFY row_number() OVER (PARTITION BY doc_id, digest, sentence ORDER BY places[n] DESC, place) = 1),
open AS (
  SELECT *, max(last) OVER (PARTITION BY doc_id, digest ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
  FROM matches)
SELECT doc_id, licence, rule, CAST(first AS INT) AS first_sentence, CAST(last AS INT) AS last_sentence
FROM open WHERE reached IS NULL OR reached < last"""
