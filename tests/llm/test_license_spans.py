import textwrap

import pytest

from assaysift.llm import licenses

SCAN = licenses.Scanner(licenses.TEMPLATES).scan
T = licenses.TEMPLATES
MIT = T["MIT-text"][1][1]


def found(text):
    return [r[2] for r in SCAN(text) if r[4]]


@pytest.mark.parametrize(
    ("text", "names"),
    [
        (MIT, ["MIT-text"]),
        ("MIT License\n\nCopyright (c) 2020 A. Person\n\n" + "\n".join(textwrap.wrap(MIT, 72)), ["MIT-text"]),
        ("We measured many samples at low temperature and in air, and all of it is Licensed under CC BY-NC 4.0. More prose follows here.", ["CC-BY-NC-4.0"]),
        ("Released under the MIT License.\nLicensed under CC BY-NC 4.0.", ["MIT", "CC-BY-NC-4.0"]),
        ("Released under the MIT License.\na plain line\nanother one\nLicensed under CC BY-NC 4.0.\nAll rights reserved.", ["MIT", "CC-BY-NC-4.0", "all-rights-reserved"]),
        ("# SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
        ("// SPDX-License-Identifier: (MIT OR GPL-2.0-only)", ["MIT", "GPL-2.0-only"]),
        (T["GPL-3.0"][1][0], ["GPL-3.0"]),
        (T["LGPL-3.0"][1][0], ["LGPL-3.0"]),
        (T["LGPL-2.1"][1][1], ["LGPL-2.1"]),
        (T["AGPL-3.0"][1][1], ["AGPL-3.0"]),
        (T["BSD-3-Clause"][1][1], ["BSD-3-Clause"]),
        (T["BSD-2-Clause"][1][1], ["BSD-2-Clause"]),
        ("\n".join(textwrap.wrap(T["BSD-3-Clause"][1][1], 60)), ["BSD-3-Clause"]),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
        ("Licensed under the Apache License, Version 1.0.", []),
        ("Licensed under CC BY-NC 4.0 and CC BY 4.0.", ["CC-BY-NC-4.0", "CC-BY-4.0"]),
        ("It is not licensed under the MIT License", []),
        ("SPDX-License-Identifier: MIT in all files", ["MIT"]),
        ("SPDX-License-Identifier: see the file COPYING", []),
        ("# spdx-license-identifier: gpl-2.0-only WITH Classpath-exception-2.0 OR (MIT AND Zlib) */", ["GPL-2.0-only", "MIT", "Zlib"]),
        ("SPDX-License-Identifier: LicenseRef-Own+ AND", ["LicenseRef-Own+"]),
        (T["MPL-2.0"][1][0], ["MPL-2.0"]),
        (T["ISC"][1][1], ["ISC"]),
        (T["Unlicense"][1][1], ["Unlicense"]),
        (T["EPL-2.0"][1][0], ["EPL-2.0"]),
        ("The licence to drive was the general rule of the public road, version 3.", []),
    ],
)
def test_every_notice_of_a_block(text, names):
    assert found(text) == names


def test_spans_are_where_the_notices_stand():
    text = "Released under the MIT License.\nLicensed under CC BY-NC 4.0."
    assert [text[r[8] : r[8] + r[9]] for r in SCAN(text)] == ["Released under the MIT License", "Licensed under CC BY-NC 4.0"]


@pytest.mark.parametrize("name", list(T))
def test_every_template_is_found_where_it_is_planted(name):
    for notice in T[name][1]:
        text = f"Some prose stands before it, about carbon and its pores.\n\n{notice}\n\nOther prose follows, about rates and cycles."
        assert found(text) == [name], notice


def test_the_template_that_saves_most_is_confirmed_first():
    scanner = licenses.Scanner(T)
    for name, (_, notices) in T.items():
        best = scanner.ranked(notices[-1])
        assert best[0][0] >= next(saved for saved, i in best if scanner.templates[i][0] == name) > 0.3
