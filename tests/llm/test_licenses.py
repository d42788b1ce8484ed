"""The short reserved-rights notice, and notices without a template among the training sample."""

from cairn.llm import licenses
from cairn.llm import queries as Q

NOTICES = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache", "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "proprietary"}


def test_every_form_of_notice_is_confirmed_and_nothing_else(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(r.doc_id, r.paragraph, r.family) for r in Q.op4_licenses(spark, sf).collect() if r.confirmed}
    wanted = {(d, k, family) for d, t in docs.items() for k, line in enumerate(t.split("\n")) for n, family in NOTICES.items() if n in line}
    assert got == wanted and any(f == "proprietary" for _, _, f in wanted)


def test_notices_without_a_template_dont_push_out_others(spark):
    plain = [f"the {a} river runs past {b} houses on its way" for a in ("long", "wide", "cold", "old") for b in range(60)]
    foreign = [f"Licensed under the Apache License, Version {k}, as changed by house {k} of the free software foundation." for k in range(200)]
    rows = [(k, t) for k, t in enumerate(plain + foreign)] + [(1000 + k, n) for k, n in enumerate(NOTICES)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = licenses.paragraphs(df)
    assert licenses.train(words, licenses.templates(spark))[2] < 0.9
    got = {r.doc_id: r.family for r in licenses.scan_licenses(df).where("confirmed AND doc_id >= 1000").collect()}
    assert got == {1000 + k: f for k, f in enumerate(NOTICES.values())}


FULL = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or later.",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License, which is long enough to be wrapped.",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License, which is long enough to be wrapped.",
    "proprietary": "All rights reserved. No part of this publication may be reproduced without prior written permission of the copyright holder.",
}
SHORT = {
    "mit": ["Licensed under the MIT License.", "Distributed under the MIT licence", "# SPDX-License-Identifier: MIT", "// Released under the MIT license"],
    "apache": ["Licensed under the Apache License 2.0", "/* SPDX-License-Identifier: Apache-2.0 */", "Released under the Apache 2.0 licence."],
    "gpl": ["Licensed under the GPL version 3", "; SPDX-License-Identifier: GPL-3.0-or-later", "licensed under the GNU General Public Licence"],
    "bsd": ["Licensed under the BSD 3-Clause License", "# SPDX-License-Identifier: BSD-3-Clause", "Distributed under the BSD license"],
    "mpl": ["SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License 2.0"],
    "cc-by": ["Licensed under CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc0": ["SPDX-License-Identifier: CC0-1.0"],
}


def wrapped(text, leader, width):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join(leader + x for x in [*lines, line])


def test_recall_per_family_of_wrapped_short_and_marked_notices(spark):
    cases = [(f, t) for f, texts in SHORT.items() for t in texts]
    cases += [(f, wrapped(t, leader, width)) for f, t in FULL.items() for leader, width in (("", 70), (" * ", 60), ("# ", 45), ("", 500))]
    rows = [(k, f"import things\n\n{t}\n\nthe river runs past the old house") for k, (_, t) in enumerate(cases)]
    plain = [(1000 + k, f"the {a} river runs past {b} houses\non its way to the sea\nwhere it is granted no rest {b}") for k, (a, b) in enumerate((a, b) for a in ("long", "wide", "cold") for b in range(80))]
    got = {}
    for r in licenses.scan_licenses(spark.createDataFrame(rows + plain, "doc_id long, text string")).where("confirmed").collect():
        got.setdefault(r.doc_id, set()).add(r.family)
    assert not [d for d in got if d >= 1000]
    found, total = {}, {}
    for k, (family, _) in enumerate(cases):
        total[family] = total.get(family, 0) + 1
        found[family] = found.get(family, 0) + (family in got.get(k, ()))
    missed = [cases[k] for k, (f, _) in enumerate(cases) if f not in got.get(k, ())]
    assert all(found[f] >= 0.9 * total[f] for f in total), missed


def test_joined_lines(spark):
    text = wrapped(FULL["mit"], "// ", 60)
    rows = [(1, text), (2, text.replace("\n", "\n\n")), (None, text), (3, "Released under the MIT License.\n" + text), (3, "short"), (4, None), (5, ""), (6, "software\n" * 5000)]
    rows += [(100 + k, f"the river runs past {k} houses") for k in range(200)]
    got = {}
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed").collect():
        got.setdefault(r.doc_id, set()).add((r.paragraph, r.family))
    assert got == {1: {(0, "mit")}, 3: {(0, "mit"), (1, "mit")}}


def test_every_line_without_a_licence_takes_part_in_training(spark, monkeypatch):
    lines = [f"the river number {k} runs past house {k * 7} on its way" for k in range(5000)]
    notices = [*NOTICES, "a licensed plumber came by", "this is the public domain of birds"]  # held or cued: none of them stands for no licence
    df = spark.createDataFrame([(k, "\n".join(lines[k::10] + notices + lines[:3])) for k in range(10)], "doc_id long, text string")
    seen, fit = [], licenses.LogisticRegression.fit
    monkeypatch.setattr(licenses.LogisticRegression, "fit", lambda self, data: (seen.extend(data.select("label", "weight").collect()), fit(self, data))[1])
    licenses.train(licenses.paragraphs(df), licenses.templates(spark))
    weights = [r.weight for r in seen if r.weight < 1]
    assert 3600 < len(weights) < 3900 and len(set(weights)) == 1 and abs(sum(weights) - licenses.PLAIN_WEIGHT) < 1e-6  # three in four; the rest are held out
