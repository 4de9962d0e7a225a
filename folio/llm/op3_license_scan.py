"""Licence scans by sentence rules.

A text is split into sentences at [.!?;] before white space and at blank lines; a single line end may end a sentence or
stand inside it, so line-wise and wrapped sentences are both found, of several at one place the longest. Comment marks are
no letters and go. A sentence is normalised: lower-cased, runs of anything but letters and digits to one space, trimmed.
Normalised sentences that equal a known licence sentence get its identifier; the owner in 'Neither the name of' is free. A
licence rule is an ordered list of identifiers and matches a document whose identifiers hold that list in order, other
licence sentences between them or not. The licences of all rules that match are reported, BSD-2-Clause not where all its
texts go on as BSD-3-Clause, and Proprietary ('All rights reserved') not beside another licence.

Each known sentence holds one of the ANCHORS, parts of single words (checked when the module loads), so texts without
any are settled without being split. Everything is DataFrame operations; the known sentences are a table of this module, so of bounded size.
No document meets another, so there is no shuffle.

Cases: null, empty and other texts without licence sentences give no licences; repeated rows and rows with one doc_id
are each scanned on their own; other columns ride along in scan(), those named sequence, n_sentences or licenses are
replaced, and the query leaves them out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Sentences of public licences by identifier.
SENTENCES = {
    "apache-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-long": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-may-not": "you may not use this file except in compliance with the License",
    "apache-asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-grant-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2",
    "gpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-received": "You should have received a copy of the GNU General Public License along with this program",
    "lgpl-work": "This work is licensed under the GNU Lesser General Public License, version 3",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-licensed": "Licensed under the BSD 3-Clause License",
    "mpl-source": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "rights": "All rights reserved",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-bsd-2": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-bsd-3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-isc": "SPDX-License-Identifier: ISC",
    "spdx-mpl": "SPDX-License-Identifier: MPL-2.0",
    "spdx-gpl2": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "boost": "Distributed under the Boost Software License, Version 1.0",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0",
}
#: Licence and the sentences that show it, in order.
RULES = [
    ("Apache-2.0", ["apache-licensed"]),
    ("Apache-2.0", ["apache-long", "apache-may-not"]),
    ("Apache-2.0", ["apache-may-not", "apache-asis"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-grant-notice"]),
    ("GPL-3.0", ["gpl3-work"]),
    ("GPL-3.0", ["gpl-redistribute", "gpl-received"]),
    ("GPL-2.0", ["gpl2-work"]),
    ("LGPL-3.0", ["lgpl-work"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-licensed"]),
    ("MPL-2.0", ["mpl-source"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-4.0", ["cc-by-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("Proprietary", ["rights"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("MIT", ["spdx-mit"]),
    ("BSD-2-Clause", ["spdx-bsd-2"]),
    ("BSD-3-Clause", ["spdx-bsd-3"]),
    ("ISC", ["spdx-isc"]),
    ("MPL-2.0", ["spdx-mpl"]),
    ("GPL-2.0", ["spdx-gpl2"]),
    ("GPL-3.0", ["spdx-gpl3"]),
    ("BSL-1.0", ["boost"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
]
#: A licence that isn't reported where any other is: the line also stands above open licences.
LAST = "Proprietary"
#: One of these is in each known sentence.
ANCHORS = ["licens", "copyright", "redistribut", "permission", "reserved", "domain"]
#: Further sentences and rules; the SQL holds only those above.
WRAPPED_SENTENCES = {
    "bsd-neither": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-neither-split": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-redistribution-1": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1",
    "bsd-source-bullet": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl2-version": "either version 2 of the License, or (at your option) any later version",
    "agpl3-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "zlib-grant-1": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1",
    "epl-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl-distribution": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0/",
    "lgpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl21-version": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-version": "either version 3 of the License, or (at your option) any later version",
    "agpl3-work": "This work is licensed under the GNU Affero General Public License, version 3",
}
WRAPPED_RULES = [
    ("BSD-2-Clause", ["bsd-redistribution-1", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-source-bullet", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-neither"]),
    ("BSD-3-Clause", ["bsd-source-bullet", "bsd-binary", "bsd-neither"]),
    ("BSD-3-Clause", ["bsd-binary", "bsd-neither-split"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-grant-and"]),
    ("GPL-3.0", ["gpl3-program"]),
    ("GPL-2.0", ["gpl2-redistribute", "gpl2-version"]),
    ("Zlib", ["zlib-grant"]),
    ("Zlib", ["zlib-grant-1"]),
    ("EPL-2.0", ["epl-terms"]),
    ("EPL-2.0", ["epl-distribution"]),
    ("LGPL-2.1", ["lgpl-redistribute", "lgpl21-version"]),
    ("LGPL-3.0", ["lgpl-redistribute", "lgpl3-version"]),
    ("AGPL-3.0", ["agpl3-program"]),
    ("AGPL-3.0", ["agpl3-work"]),
]
#: A licence that isn't reported where another one matches, unless the sequence also matches the pattern, a text of its own.
SUPERSEDES = {"BSD-2-Clause": ("BSD-3-Clause", ",bsd-binary,(?!,bsd-neither)")}
STOP = "\x02"
#: The sentence's owner is any text; its own end is the next 'nor the names'.
OWNER = rf"(?<![^\n{STOP}])neither[ \n]the[ \n]name[ \n]of[ \n](?:(?!neither[ \n])[^{STOP}])*?nor[ \n]the[ \n]names[ \n]of[ \n]its[ \n]contributors"


def plain(sentence: str) -> str:
    """The normal form of a known sentence; they are ASCII."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


KNOWN = {plain(s): k for k, s in SENTENCES.items()}
WRAPPED_KNOWN = {plain(s): k for k, s in WRAPPED_SENTENCES.items()}
assert all(any(a in s for a in ANCHORS) for s in KNOWN | WRAPPED_KNOWN), "a known sentence holds no anchor"
assert all(i in SENTENCES | WRAPPED_SENTENCES for _, ids in RULES + WRAPPED_RULES for i in ids)
assert not any(re.search(r"[.!?;]\s", s) for s in (SENTENCES | WRAPPED_SENTENCES).values()), "a known sentence would be split"


def anchored(c):
    out = F.lit(False)
    for a in ANCHORS:
        out |= c.contains(a)
    return out


def boundaries(lower):
    """The text as words between single marks: a space, a line feed at a line's end in a paragraph, STOP at a sentence's or paragraph's end."""
    c = F.regexp_replace(F.translate(lower, STOP, "-"), r"[.!?;](\s)", f"{STOP}$1")
    c = F.regexp_replace(c, r"\n(?:rem|dnl)[ \t]", "\n")
    c = F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}\n{STOP}]+", " ")
    c = F.regexp_replace(c, rf" ?([\n{STOP}]) ?", "$1")
    c = F.trim(F.regexp_replace(c, rf"\n{{2,}}|\n*{STOP}[\n{STOP}]*", STOP))
    return F.regexp_replace(c, OWNER, "neither the name of the copyright holder nor the names of its contributors")


def scan(docs: DataFrame, known: dict[str, str] | None = None, rules: list | None = None, supersedes: dict | None = None) -> DataFrame:
    """The documents with n_sentences (licence sentences), sequence (their identifiers in order) and licenses (sorted names)."""
    known = KNOWN | WRAPPED_KNOWN if known is None else known
    supersedes = SUPERSEDES if supersedes is None and rules is None else supersedes or {}
    rules = RULES + WRAPPED_RULES if rules is None else rules
    lower = F.lower(F.coalesce("text", F.lit("")))
    forms = "|".join(s.replace(" ", r"[ \n]") for s in sorted(known, key=len, reverse=True))
    seen = F.regexp_extract_all(boundaries(lower), F.lit(rf"(?<![^\n{STOP}])(?:{forms})(?![^\n{STOP}])"), F.lit(0))
    ids = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    found = F.transform(seen, lambda s: F.element_at(ids, F.translate(s, "\n", " ")))
    out = docs.withColumn("sequence", F.when(anchored(lower), found).otherwise(F.array().cast("array<string>")))
    held = F.array_join(F.transform("sequence", lambda x: F.concat(F.lit(","), x, F.lit(","))), "")
    matched = [F.when(held.like("%," + ",%,".join(i) + ",%"), F.lit(name)) for name, i in rules]
    out = out.withColumn("n_sentences", F.size("sequence").cast("long"))
    names = F.array_distinct(F.array_compact(F.array(*matched)))
    for weaker, (stronger, own) in supersedes.items():
        names = F.when(F.array_contains(names, stronger) & ~held.rlike(own), F.array_remove(names, weaker)).otherwise(names)
    names = F.when(F.size(names) > 1, F.array_remove(names, LAST)).otherwise(names)
    return out.withColumn("licenses", F.array_sort(names))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_sentences", F.array_join("sequence", ",").alias("sentences"), F.array_join("licenses", ",").alias("licenses"))


_VALUES = ", ".join(f"('{s}', '{k}')" for s, k in KNOWN.items())
_MATCHED = ", ".join(f"CASE WHEN held LIKE '%,{',%,'.join(i)},%' THEN '{n}' END" for n, i in RULES)
ORACLE = rf"""
WITH k(s, id) AS (VALUES {_VALUES}), t AS (
  SELECT doc_id, place, trim(regexp_replace(regexp_replace(parts[place], '[.!?;]+$', ''), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS s
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS place FROM (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[.!?;]+([ \t\r\n\f\v])', chr(10) || '\1', 'g'), chr(10)) AS parts FROM documents))
), h AS (
  SELECT doc_id, count(id) AS n_sentences, coalesce(string_agg(id, ',' ORDER BY place), '') AS sentences FROM t LEFT JOIN k USING (s) GROUP BY doc_id
)
SELECT doc_id, n_sentences, sentences, coalesce(array_to_string(CASE WHEN len(names) > 1 THEN list_filter(names, lambda x: x <> '{LAST}') ELSE names END, ','), '') AS licenses
FROM (SELECT *, list_sort(list_distinct(list_filter([{_MATCHED}], lambda x: x IS NOT NULL))) AS names FROM (SELECT *, ',' || replace(sentences, ',', ',,') || ',' AS held FROM h))
"""
