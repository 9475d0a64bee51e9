"""The standard licence notices, verbatim, as their licences tell users to apply them."""

from __future__ import annotations

import pytest

from ledgerline.llm import licenses

GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""
BSD = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3 = BSD + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
AGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
AGPL_WRAPPED = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version."""
GPL2 = GPL3.replace("software: you", "software; you").replace(
    "Foundation, either version 3", "Foundation; either version 2")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ISC = """Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
EPL = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/"""
ZLIB = """Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""

NOTICES = [
    (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (APACHE, "Apache-2.0"),
    (BSD, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (MIT, "MIT"), (LGPL, "LGPL-2.1-or-later"),
    (AGPL, "AGPL-3.0-or-later"), (AGPL_WRAPPED, "AGPL-3.0-or-later"), (MPL, "MPL-2.0"),
    (ISC, "ISC"), (EPL, "EPL-2.0"), (ZLIB, "Zlib"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
     "License.", "CC-BY-SA-4.0"),
    ("Copyright 2021 Someone. All rights reserved.", "All-Rights-Reserved"),
    ("This program is free software. Everybody likes it.", ""),
]


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_standard_notices(spark, mark):
    texts = ["Some text before.\n" + "\n".join(mark + line for line in n.split("\n")) + "\n"
             for n, _ in NOTICES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: ",".join(r.l_licenses) for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(NOTICES))] == [name for _, name in NOTICES]


def test_known_sentences_are_cut_as_texts_are(spark):
    known = list(licenses.SENTENCES.values())
    docs = spark.createDataFrame([(k,) for k in known], "text string")
    cut = docs.select(licenses.sentences(docs["text"]).alias("s")).collect()
    assert sorted(r.s[0] for r in cut) == sorted(known) and all(len(r.s) == 1 for r in cut)
    assert len(set(known)) == len(known)


COMPANY = BSD3.replace("the copyright holder", "Example Incorporated")
PROBES = [
    (BSD + "\n\nOther code below.\n\n" + BSD3, "BSD-2-Clause,BSD-3-Clause"),
    ("All rights reserved.\nfoo.\nLicensed under the MIT License.", "All-Rights-Reserved,MIT"),
    ("All rights reserved.\nLicensed under the MIT License.", "MIT"),
    ("A text. All rights reserved. More.\nAll rights reserved.\nLicensed under the MIT License.",
     "All-Rights-Reserved,MIT"),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */",
     "BSD-3-Clause,GPL-2.0-only"),
    ("<!-- SPDX-License-Identifier: Apache-2.0 -->", "Apache-2.0"),
    ("This file is licensed under the MIT license.", "MIT"),
    ("Licensed under the MIT License (see LICENSE).", "MIT"),
    ("You may use it under the terms of the Apache License, Version 2.0 only.", "Apache-2.0"),
    ("Dual use: released under the GNU General Public License version 3 or later.", "GPL-3.0"),
    (COMPANY, "BSD-3-Clause"),
    ("The hermit licenses under-the-table deals.", ""),
    ("It went under the bridge.", ""),
]


def test_positions_names_and_spdx(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PROBES)],
                                 "doc_id long, text string")
    got = {r.doc_id: ",".join(r.l_licenses) for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(PROBES))] == [name for _, name in PROBES]


def test_probes_match_sql(spark, tmp_path):
    """The SQL twin on notices and probes, not on the test tables alone."""
    import duckdb

    texts = [t for t, _ in (*NOTICES, *PROBES)] + ["", None, "x\n" * 50]
    folder = str(tmp_path)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    docs.write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = sorted(con.sql(licenses.OP9_SQL).fetchall())
    assert sorted(map(tuple, licenses.op9_license_scan(spark, folder).collect())) == want


def test_overlapping_rules_are_refused():
    with pytest.raises(ValueError, match="begins"):
        licenses.runs_by_length([("A", ("x", "y")), ("B", ("y", "z"))])
