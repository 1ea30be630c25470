"""Sentence-rule license recognition."""
from pyspark.sql import functions as F

from tessera.llm import licenses as L

CASES = {
    "Text before. Licensed under the Apache License, Version 2.0. After": ["Apache-2.0"],
    '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\n'
    "# You may obtain a copy of the License at\n": ["Apache-2.0"],
    "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
    "This program is licensed under the GNU General Public License, version 3;\nor (at your option) any later version.": ["GPL-3.0-or-later"],
    "or (at your option) any later version. Licensed under the GNU General Public License": ["GPL"],
    "Released under the MIT License.\nAll   rights\treserved.": ["MIT", "Proprietary"],
    "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
    "we licensed under the mit license our things to you": [],
    "": [], None: [],
    "word " * 50_000 + ". Released under the MIT License. " + "word " * 50_000: ["MIT"],
}


def test_rules(docs_of):
    docs = docs_of(list(enumerate(CASES))).withColumn("licences", F.lit("clash"))
    got = {r.doc_id: r.licences for r in L.scan(docs).collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())


def test_specific_rules_use_up_their_sentences(docs_of):
    two = "Licensed under the GNU General Public License, version 3. or any later version.\nLicensed under the GNU General Public License, version 3."
    r = L.scan(docs_of([(1, two), (1, two), (None, two)])).collect()
    assert [x.licences for x in r] == [["GPL-3.0-or-later", "GPL-3.0"]] * 3
    assert r[0].sentence_ids == ["gpl3-notice", "or-later", "gpl3-notice"]
    assert L.document_licences(docs_of([])).count() == 0


WRAPPED = {
    'MIT License\n\nCopyright (c) 2020 A\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software '
    'and associated documentation files (the "Software"), to deal\nin the Software without restriction, subject to the following conditions:\n\n'
    'The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\n'
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.': ["MIT"],
    "This file is released under the MIT License.": ["MIT"],
    "Copyright (c) 2020, A\r\nAll rights reserved.\r\n\r\nRedistribution and use in source and binary forms, with or without\r\n"
    "modification, are permitted provided that the following conditions are met:\r\n\r\n1. Redistributions of source code must retain the above "
    "copyright notice, this\r\n   list of conditions and the following disclaimer.\r\n\r\n2. Redistributions in binary form must reproduce the above "
    "copyright notice,\r\n   this list of conditions and the following disclaimer in the documentation\r\n   and/or other materials provided with "
    "the distribution.\r\n\r\n3. Neither the name of the copyright holder nor the names of its\r\n   contributors may be used to endorse or promote "
    "products derived from\r\n   this software without specific prior written permission.\r\n": ["BSD-3-Clause"],
    " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
    " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n": ["GPL-3.0-or-later"],
    "# This library is free software; you can redistribute it and/or\n# modify it under the terms of the GNU Lesser General Public\n# License as "
    "published by the Free Software Foundation; either\n# version 2.1 of the License, or (at your option) any later version.\n": ["LGPL-2.1-or-later"],
    "/* SPDX-License-Identifier: Apache-2.0 */": ["Apache-2.0"], "// SPDX-License-Identifier: AGPL-3.0-only\n": ["AGPL-3.0-only"],
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.": ["MPL-2.0"],
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the "
    "above\ncopyright notice and this permission notice appear in all copies.": ["ISC"],
    "A heading\nAll rights reserved\nmore": ["Proprietary"], "All rights\n\nreserved": [],
}


def test_wrapped_canonical_texts(docs_of):
    got = {r.doc_id: r.licences for r in L.scan(docs_of(list(enumerate(WRAPPED)))).collect()}
    assert [got[i] for i in range(len(WRAPPED))] == list(WRAPPED.values())


def test_other_columns_pass_through_whatever_their_names(docs_of):
    docs = docs_of([(1, "This file is released under the MIT License."), (2, None)]).selectExpr(
        "*", "doc_id AS _left", "'r' AS _r0", "'s' AS __left", "1 AS licences")
    got = {r.doc_id: (r._left, r._r0, r["__left"], r.licences) for r in L.scan(docs).collect()}
    assert got == {1: (1, "r", "s", ["MIT"]), 2: (2, "r", "s", [])}
