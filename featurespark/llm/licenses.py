"""Recognise licences by their sentences: sentence identifiers first, then ordered rules over them.

Comment marks at the start of lines are taken away, and the text is cut into sentences, each normalised (ASCII lower case, runs of
other characters than a-z and 0-9 as one space) and looked up among known licence sentences.  What is left is a
short sequence of identifiers.  A licence is recognised where one of its rules, a list of identifiers, stands in that
sequence in order, with at most ``GAP`` others between two of its own.  Rules are tried from the longest, and one that matches
consumes its identifiers, so that what is a part of a longer text isn't found again as a shorter one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices as the cutting leaves them, in the order of the licences.
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-short": "MIT License",
    "mit-spdx": "SPDX-License-Identifier MIT",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."
    ),
    "mit-as-is": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-spdx": "SPDX-License-Identifier Apache-2.0",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-copy-secure": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    "apache-copy-at": "You may obtain a copy of the License at",
    "apache-as-is": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-licensed": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-licensed": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-free": "This program is free software:",
    "gpl3-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "gpl2-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation;"
    ),
    "gpl2-later": "either version 2 of the License, or (at your option) any later version.",
    "gpl2-only": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published "
        "by the Free Software Foundation."
    ),
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "gpl3-spdx": "SPDX-License-Identifier GPL-3.0-or-later",
    "gpl2-spdx": "SPDX-License-Identifier GPL-2.0-only",
    "lgpl3-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "agpl3-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "bsd-spdx": "SPDX-License-Identifier BSD-3-Clause",
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mpl2-copy-plain": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc-by-4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "reserved": "All rights reserved.",
}
# Ordered rules, the longer ones first.
RULES = [
    ("Apache-2.0", ["apache-header", "apache-use", "apache-copy-at", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-header", "apache-use", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-header", "apache-use", "apache-copy-secure", "apache-as-is", "apache-see"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms", "gpl2-later", "gpl-hope", "gpl-implied"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms", "gpl-hope", "gpl-implied", "gpl-see"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-title-short", "mit-grant", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-header", "apache-use"]),
    ("Apache-2.0", ["apache-header", "apache-as-is"]),
    ("GPL-2.0-or-later", ["gpl2-terms", "gpl2-later"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source"]),
    ("MPL-2.0", ["mpl2", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2", "mpl2-copy-plain"]),
    ("MPL-2.0", ["mpl2"]),
    ("MIT", ["mit-title"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-spdx"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("Apache-2.0", ["apache-spdx"]),
    ("GPL-3.0-or-later", ["gpl3-terms"]),
    ("GPL-3.0-or-later", ["gpl3-spdx"]),
    ("GPL-3.0", ["gpl3-licensed"]),
    ("GPL-2.0-only", ["gpl2-only"]),
    ("GPL-2.0-only", ["gpl2-spdx"]),
    ("GPL-2.0", ["gpl2-licensed"]),
    ("LGPL-3.0-or-later", ["lgpl3-terms"]),
    ("AGPL-3.0-or-later", ["agpl3-terms"]),
    ("BSD-3-Clause", ["bsd-spdx"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-4.0", ["cc-by-4-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("proprietary", ["reserved"]),
]
# Comment marks at the start of a line, and the tag whose colon is no end of a sentence.
COMMENT = "(^|\n)[ \t]*(?:/[*]+|[*]+/?|//+|#+|--+|;+|%+|<!--+)[ \t]*"
TAG, TAGGED = "SPDX-License-Identifier:[ \t]*", "SPDX-License-Identifier "
ENDS = "[.!?:;]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Other identifiers between two of a rule's.
GAP = 3
#: The rule that counts only where no other does: the phrase is part of many open licences' notices.
FALLBACK = "proprietary"


def normalise(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip()


def _known() -> list[str]:
    """The normalised sentences; an identifier's number is its place from 1."""
    return [normalise(s) for s in SENTENCES.values()]


def _patterns() -> list[tuple[str, str, int]]:
    """Of each rule the licence, the pattern in a sequence of numbers, each between spaces of its own, and the gaps that the pattern keeps."""
    number = {name: i + 1 for i, name in enumerate(SENTENCES)}
    gap = f"((?: [0-9]+ ){{0,{GAP}}}?)"
    return [(name, gap.join(f" {number[x]} " for x in rule), len(rule) - 1) for name, rule in RULES]


def _sentences(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, f"({ENDS})[ \\t\\r\\n]+", "$1\n"), "\n", -1)
    clean = lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " "))
    return F.filter(F.transform(parts, clean), lambda s: s != "")


def _unwrapped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "\\n[ \\t]*\\n", ". "), "\\n", " ")


def recognise(docs: DataFrame) -> DataFrame:
    """One row for each document: ``doc_id, n_sentences, sentence_ids, licenses``.

    Two cuttings are tried, by lines and with wrapped lines joined, and the one with more known sentences
    counts (lines, if equal).  ``sentence_ids`` holds their numbers in text order and ``licenses`` the recognised names in
    the order of the rules, once each, joined by a space or ``", "`` and empty if there are none; reserved rights alone count
    as ``proprietary``.  Null and empty texts have no sentences; nothing is limited by length; repeated rows give
    repeated results.
    """
    known = _known()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(text, F.lit(TAG), F.lit(TAGGED)), F.lit(COMMENT), F.lit("$1"))
    table = F.array(*[F.lit(x) for x in known])

    def identify(sentences: Column) -> Column:
        return F.transform(F.filter(sentences, lambda s: s.isin(known)), lambda s: F.array_position(table, s))

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"))
        .withColumn("_lines", _sentences(F.col("_text")))
        .withColumn("_by_line", identify(F.col("_lines")))
        .withColumn("_joined", identify(_sentences(_unwrapped(F.col("_text")))))
        .withColumn("_ids", F.when(F.size("_joined") > F.size("_by_line"), F.col("_joined")).otherwise(F.col("_by_line")))
        .withColumn("sentence_ids", F.array_join(F.col("_ids").cast("array<string>"), " "))
        .withColumn("_key", F.array_join(F.transform("_ids", lambda x: F.concat(F.lit(" "), x.cast("string"), F.lit(" "))), ""))
    )
    rules = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(pattern).alias("pattern"), F.lit("".join(f"${i + 1}" for i in range(gaps))).alias("rest"))
            for name, pattern, gaps in _patterns()
        ]
    )

    def step(so_far: Column, rule: Column) -> Column:
        hit = F.rlike(so_far["key"], rule["pattern"]) & ((rule["name"] != FALLBACK) | (F.size(so_far["names"]) == 0))
        names = F.when(hit, F.array_append(so_far["names"], rule["name"])).otherwise(so_far["names"])
        return F.struct(F.regexp_replace(so_far["key"], rule["pattern"], rule["rest"]).alias("key"), names.alias("names"))

    start = F.struct(F.col("_key").alias("key"), F.array().cast("array<string>").alias("names"))
    names = F.aggregate(rules, start, step, lambda x: F.array_join(F.array_distinct(x["names"]), ", "))
    licenses = F.when(F.col("_key") == "", F.lit("")).otherwise(names)
    return rows.select("doc_id", F.size("_lines").cast("long").alias("n_sentences"), "sentence_ids", licenses.alias("licenses"))


def recognise_sql() -> str:
    quoted = ", ".join(f"'{x}'" for x in _known())
    cut = lambda t: (
        f"list_filter(list_transform(string_split(regexp_replace({t}, '({ENDS})[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)), "
        f"lambda s: trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '')"
    )
    ids = lambda c: f"list_transform(list_filter({c}, lambda s: s IN ({quoted})), lambda s: list_position([{quoted}], s))"
    joined = "replace(regexp_replace(body, '\\n[ \\t]*\\n', '. ', 'g'), chr(10), ' ')"
    body = f"regexp_replace(regexp_replace(coalesce(text, ''), '{TAG}', '{TAGGED}', 'g'), '{COMMENT}', '\\1', 'g')"
    found = "SELECT *, CAST([] AS VARCHAR[]) AS names FROM seq"
    for name, pattern, gaps in _patterns():
        rest = "".join(f"\\{i + 1}" for i in range(gaps))
        only = " AND len(names) = 0" if name == FALLBACK else ""
        found = (
            f"SELECT doc_id, n_sentences, sentence_ids, regexp_replace(key, '{pattern}', '{rest}', 'g') AS key, "
            f"CASE WHEN regexp_matches(key, '{pattern}'){only} AND NOT list_contains(names, '{name}') "
            f"THEN list_append(names, '{name}') ELSE names END AS names FROM ({found})"
        )
    return f"""
WITH cut AS (SELECT doc_id, {cut("body")} AS lines, {cut(joined)} AS joined FROM (SELECT doc_id, {body} AS body FROM documents)),
ids AS (SELECT doc_id, len(lines) AS n_sentences, {ids("lines")} AS a, {ids("joined")} AS b FROM cut),
best AS (SELECT doc_id, n_sentences, CASE WHEN len(b) > len(a) THEN b ELSE a END AS ids FROM ids),
seq AS (SELECT doc_id, n_sentences, array_to_string(ids, ' ') AS sentence_ids,
  coalesce(array_to_string(list_transform(ids, lambda x: ' ' || x || ' '), ''), '') AS key FROM best)
SELECT doc_id, n_sentences, sentence_ids, array_to_string(names, ', ') AS licenses FROM ({found})"""
