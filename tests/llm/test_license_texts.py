"""Wrapped headers, whole licence texts, SPDX lines and sibling versions."""

import textwrap

from tidemark.llm.license_scan import TEMPLATES, license_scan
from tidemark.llm.license_texts import FULL, NOTICES

CODE = "\n\nimport os\n\n\ndef main(argv):\n    return os.path.join(*argv)\n"
GPL3, BSD = TEMPLATES[6][1], TEMPLATES[2][1]
TEXTS = dict(reversed(FULL))


def wrapped(text, sign="", width=72):
    return "\n".join(f"{sign}{line}" for line in textwrap.wrap(text, width))


CASES = [
    ("MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + wrapped(TEXTS["MIT"], width=80), "MIT"),
    ("/*\n" + wrapped(TEXTS["MIT"], " * ", 50) + "\n */" + CODE, "MIT"),
    ("# Copyright 2020 Jane Doe\n#\n" + wrapped(GPL3, "# ") + CODE, "GPL-3.0"),
    (wrapped(NOTICES[4][1], "// ", 60) + CODE, "GPL-2.0"),
    (wrapped(BSD, "; ", 60) + CODE, "BSD-3-Clause"),
    ("Copyright (c) 2019, Jane Doe\n\n" + wrapped(TEXTS["BSD-2-Clause"]), "BSD-2-Clause"),
    ("Copyright (c) 2019, Jane Doe\n\n" + wrapped(TEXTS["BSD-3-Clause"]), "BSD-3-Clause"),
    (wrapped(TEXTS["Apache-2.0"]) + "\n\n" + "and many more sections follow here " * 80, "Apache-2.0"),
    (wrapped(TEXTS["GPL-2.0"]) + "\n\n" + "and many more sections follow here " * 80, "GPL-2.0"),
    ("# SPDX-License-Identifier: MIT" + CODE, "MIT"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later" + CODE, "GPL-2.0"),
    ("# Licensed under the MIT license." + CODE, "MIT"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("# Copyright 2020 Jane Doe. Licensed under the Apache License, Version 2.0." + CODE,
     "Apache-2.0"),
    ("Licensed under the Foo Bar License, Version 2.0." + CODE, None),
    ("Permission to enter the garden is granted to any person without a dog." + CODE, None),
    ("# SPDX-License-Identifier: LicenseRef-Foo" + CODE, None),
]


def test_cases(spark):
    rows = [(f"d{i}/x", text) for i, (text, _) in enumerate(CASES)]
    got = {r["path"]: r["license"] for r in license_scan(
        spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {f"d{i}/x": name for i, (_, name) in enumerate(CASES)}


def test_files_inherit_from_a_whole_text(spark):
    rows = [("p/LICENSE", CASES[0][0]), ("p/q/r.py", "code")]
    got = {r["path"]: r for r in license_scan(
        spark.createDataFrame(rows, "path string, text string")).collect()}
    assert (got["p/q/r.py"]["license"], got["p/q/r.py"]["found"]) == ("MIT", "inherited")
