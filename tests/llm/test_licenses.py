"""Licence notices: held-out wordings, the lines of the test documents, unknown notices and plain text."""

import re

import pytest

from marketseries.llm import licenses, queries

PLAIN = ["the river ran past the old mill", "we tested the new engine in the rain", "see the terms and the version of the tests", "a b c d e"] * 20


@pytest.fixture(scope="module")
def model():
    return licenses.train(PLAIN)


def found(spark, model, rows):
    docs = spark.createDataFrame([(k, t, "x", 0.5) for k, t in rows], "doc_id long, text string, family string, probability double")
    return {(r["doc_id"], r["paragraph"]): r["family"] for r in licenses.scan(docs, model).collect()}


def test_wordings(spark, model):
    rows = [
        (1, "the river\nLicensed under the Apache License, Version 2.0.\nran past"), (2, "it is RELEASED under the MIT license, as said"),
        (3, "x\n\nThis work is licensed under the GNU General Public License, version 3."), (4, "Licensed under CC BY-NC 4.0."),
        (5, "All rights reserved."), (6, "Licensed under the Frobnitz Community License, edition 7."), (7, None), (8, ""),
        (9, "the the the the the"), (10, "the old mill ran past the river in the rain"), (None, "Released under the MIT License."),
        (11, "word " * 300 + "Released under the MIT License. " + "word " * 300),
    ]
    assert found(spark, model, rows) == {(1, 1): "Apache", (2, 0): "MIT", (3, 2): "GPL", (4, 0): "CC-BY-NC", (5, 0): "unknown",
                                         (6, 0): "unknown", (None, 0): "MIT", (11, 0): "MIT"}
    assert found(spark, model, []) == {}


def test_wrapped_headers(spark, model):
    """Standard headers with line breaks, as comments too; a blank line ends a notice."""
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n"
           "in the Software without restriction, including without limitation the rights")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:")
    gpl = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
           "the Free Software Foundation, either version 3 of the License, or")
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit), (2, "# " + bsd.replace("\n", "\n# ")), (3, "/*\n * " + gpl.replace("\n", "\n * ") + "\n */"),
            (4, "the old mill\n" * 30 + bsd + "\n" + "ran past the river\n" * 30), (5, "Released under\nthe MIT License.\n\nthe river\nLicensed under CC BY-NC 4.0."),
            (6, "the river ran past\nthe old mill\n" * 20)]
    mine = found(spark, model, rows)
    wanted = {(1, 2): "MIT", (2, 0): "BSD", (3, 1): "GPL", (4, 30): "BSD", (5, 0): "MIT", (5, 4): "CC-BY-NC"}
    assert {k: mine.get(k) for k in wanted} == wanted
    assert {f for k, f in mine.items() if k not in wanted} <= {"unknown"} and not any(k[0] == 6 for k in mine)


def test_families_of_like_wordings(spark, model):
    """Siblings are told apart by the words that differ, whatever the classifier prefers; tags and denials are read."""
    free = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation"
    copy = "You should have received a copy of the GNU {}General Public License along with this program."
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    wanted = {
        free.format("program", ""): "GPL", free.format("program", "Affero "): "AGPL", free.format("library", "Lesser "): "LGPL", free.format("program", "Lesser "): "LGPL",
        copy.format(""): "GPL", copy.format("Lesser "): "LGPL", copy.format("Affero "): "AGPL",
        cc.format(""): "CC-BY", cc.format("-NoDerivatives"): "CC-BY-ND", cc.format("-NonCommercial"): "CC-BY-NC", cc.format("-ShareAlike"): "CC-BY-SA",
        cc.format("-NonCommercial-ShareAlike"): "CC-BY-NC-SA", cc.format("-NonCommercial-NoDerivatives"): "CC-BY-NC-ND",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA", "Licensed under CC BY-ND 4.0.": "CC-BY-ND", "Licensed under CC BY 4.0.": "CC-BY",
        "This code is not released under the MIT License.": "unknown",
        "Licensed under the ISC License.": "ISC", "This is free and unencumbered software released into the public domain.": "Unlicense",
        "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL", "SPDX-License-Identifier: (GPL-2.0 OR MIT)": "GPL",
        "SPDX-License-Identifier: Frob-1.0": "unknown", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.": "BSD",
    }
    lines = list(wanted)
    rows = [(i, line) for i, line in enumerate(lines)] + [(100 + i, "the old mill\n\n" + line + "\n\nran past") for i, line in enumerate(lines)]
    mine = found(spark, model, rows + rows[:3])
    assert {lines[i]: mine.get((i, 0)) for i in range(len(lines))} == wanted
    assert {lines[i]: mine.get((100 + i, 2)) for i in range(len(lines))} == wanted


def test_query_against_patterns(spark):
    """Every line that names a licence is found with its family, others hardly ever."""
    root = "/root/testdata/sf0.01"
    families = {"apache": "Apache", "mit license": "MIT", "gnu general": "GPL", "cc by-nc": "CC-BY-NC"}
    true = {}
    lines = 0
    for r in spark.read.parquet(f"{root}/documents.parquet").collect():
        for n, line in enumerate((r["text"] or "").split("\n")):
            lines += 1
            if re.search("licensed|license", line, re.I):
                true[r["doc_id"], n] = next(f for k, f in families.items() if k in line.lower())
    mine = {(r["doc_id"], r["paragraph"]): r["family"] for r in queries.QUERIES["op4_licenses"](spark, root).collect()}
    assert len(true) > 20 and {k: mine.get(k) for k in true} == true
    extra = [f for k, f in mine.items() if k not in true]
    assert len(extra) < 0.002 * lines and set(extra) <= {"unknown"}
