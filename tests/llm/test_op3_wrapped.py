import textwrap

import pytest

from folio.llm.op3_license_scan import SENTENCES, WRAPPED_SENTENCES, scan

from .helpers import table

S = SENTENCES | WRAPPED_SENTENCES
BSD = [S["bsd-redistribution"] + ":", "1. " + S["bsd-source"] + ".", "2. " + S["bsd-binary"] + "."]
NEITHER = "3. " + S["bsd-neither"] + "."
TEXTS = {
    ("MIT",): [S["mit-grant"] + ":", S["mit-notice"] + "."],
    ("Apache-2.0",): [f"{S['apache-long']}; {S['apache-may-not']}. You may obtain a copy of the License at", "http://www.apache.org/licenses/LICENSE-2.0", S["apache-asis"] + "."],
    ("BSD-2-Clause",): BSD,
    ("BSD-3-Clause",): [*BSD, NEITHER],
    ("GPL-3.0",): [S["gpl3-program"] + ".", S["gpl-received"] + ". If not, see <https://www.gnu.org/licenses/>."],
    ("GPL-2.0",): [f"This program is free software; {S['gpl2-redistribute']}; {S['gpl2-version']}."],
    ("AGPL-3.0",): [S["agpl3-program"] + "."],
    ("ISC",): [S["isc-grant"] + "."],
    ("BSD-2-Clause", "BSD-3-Clause"): [*BSD, *BSD, NEITHER],
}


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_wrapped_licences(spark, mark):
    rows = []
    for k, paragraphs in enumerate(TEXTS.values()):
        for w, width in enumerate((50, 72, 80)):
            blocks = ["\n".join(mark + x for x in textwrap.wrap(p, width)) for p in paragraphs]
            rows.append((10 * k + w, "Some heading\n\n" + f"\n{mark}\n".join(blocks) + "\n\nint main() {}\n"))
    got = {r.doc_id: tuple(r.licenses) for r in scan(table(spark, rows)).collect()}
    assert got == {10 * k + w: names for k, names in enumerate(TEXTS) for w in range(3)}


def test_lists_without_blank_lines_and_owners(spark):
    own = NEITHER.replace("the copyright holder", "Example Works, Inc.")
    other = NEITHER.replace("the copyright holder", "the Example\n   Foundation")
    rows = [(1, "\n".join([*BSD, own])), (2, "\n".join([*BSD, other])), (3, "\n".join([BSD[0], "* " + BSD[1][3:], "* " + BSD[2][3:], "* " + other[3:]])), (4, "All  rights\treserved."), (5, "All rights\nreserved"), (6, "not\nall rights reserved here"), (7, "All rights\n\nreserved"), (8, ". \n" * 20_000 + "copyright " + "neither the name of " * 5_000)]
    got = {r.doc_id: r.licenses for r in scan(table(spark, rows)).collect()}
    assert got == {1: ["BSD-3-Clause"], 2: ["BSD-3-Clause"], 3: ["BSD-3-Clause"], 4: ["Proprietary"], 5: ["Proprietary"], 6: [], 7: [], 8: []}


BSD2 = """Copyright (c) 2024, Some Author. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ZLIB = """// Permission is granted to anyone to use this software for any purpose,
// including commercial applications, and to alter it and redistribute it
// freely, subject to the following restrictions:
//
// 1. The origin of this software must not be misrepresented
"""
LGPL = """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
"""


def test_headers_as_they_stand(spark):
    rows = [(1, BSD2), (2, ZLIB), (3, LGPL), (4, "# SPDX-License-Identifier: MIT\nimport os\n"), (5, "Copyright X. All rights reserved."), (6, "All rights reserved.\nLicensed under CC BY-NC-SA 4.0\n")]
    got = {r.doc_id: r.licenses for r in scan(table(spark, rows)).collect()}
    assert got == {1: ["BSD-2-Clause"], 2: ["Zlib"], 3: ["LGPL-2.1"], 4: ["MIT"], 5: ["Proprietary"], 6: ["CC-BY-NC-SA-4.0"]}
