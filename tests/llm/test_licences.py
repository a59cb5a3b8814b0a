"""Licence scan against a version that compares all runs with all templates."""

from collections import Counter

import llm_cases as cases
import pytest

from tradewind.llm import licences, queries


def told(run, template):
    """The same licence words, and the same versions where the template has any."""
    words = lambda t: [w.lstrip("v") if w[1:].isdigit() else w for w in licences.WORD.findall(t.lower())]
    names = lambda t: {w for w in words(t) if w in licences.TELLING}
    versions = lambda t: {w for w in words(t) if w.isdigit() and len(w) < 3}
    return names(run) == names(template) and versions(template) in (set(), versions(run))


def plain(text, least=0.8):
    """All runs of units against all templates, without any pruning."""
    units = [(m.start(), m.end()) for m in licences.UNIT.finditer(text)]
    units = [u for u in units if licences.WORD.search(text[u[0] : u[1]])]
    found = []
    for i, (start, _) in enumerate(units):
        for _, end in units[i:]:
            own = Counter(licences.bigrams(text[start:end]))
            for name, template in licences.TEMPLATES:
                other = Counter(licences.bigrams(template))
                total = sum(own.values()) + sum(other.values())
                shared = sum((own & other).values())
                dice = 2 * shared / total
                if dice >= least and told(text[start:end], template):
                    found.append((name, dice, start, end, shared))
    found.sort(key=lambda f: (-f[4], -f[1], f[2], f[3], f[0]))
    taken = []
    for *one, _ in found:
        one = tuple(one)
        if all(one[3] <= other[2] or other[3] <= one[2] for other in taken):
            taken.append(one)
    return sorted(taken, key=lambda f: f[2])


GPL3 = licences._GNU_NOTICE.format(work="program", name="General Public License", version="3")
TEXTS = [
    "Some prose here.\nReleased under the MIT License.\nMore prose follows it.",
    "Prose. Licensed under the Apache License, Version 2.0. Prose again.",
    "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE; VERSION 3",
    "licensed under CC BY-NC 4.0",
    "Copyright 2001 somebody.\n\n" + licences.TEMPLATES[2][1] + "\n\nprint('hello')",
    licences._BSD_CONDITIONS.replace("source", "sauce"),
    GPL3.replace("program", "application"),
    "The license of the software is not stated here; see the general public.",
    "Released under the MIT License. " * 3,
    "",
    "\n\n . \n",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_plain_version(text):
    assert licences.Templates(licences.TEMPLATES).find(text) == plain(text)


def test_bounds_prune_nothing():
    low, high = licences.size_bounds(100, 0.8)
    for n in range(1, 400):
        assert (2 * min(n, 100) / (n + 100) >= 0.8) == (low <= n <= high)


def test_query(spark, tmp_path):
    rows = cases.rows() + [(5000 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]
    folder = cases.stored_documents(cases.table(spark, rows), tmp_path)
    got = queries.op8_licence_dice(spark, folder)
    want = [
        (5000 + i, *m) for i, t in enumerate(TEXTS) for m in plain(t)
    ]
    assert cases.tuples(got, "doc_id", "licence", "dice", "start_at", "end_at") == sorted(want, key=repr)


def test_empty_table_and_columns(spark):
    assert licences.licence_matches(cases.empty(spark)).collect() == []
    docs = cases.table(spark).selectExpr("*", "1 AS licence", "2 AS m")
    assert licences.with_licences(docs).columns == [*docs.columns, "__licences"]


def found_in(text):
    return [name for name, *_ in licences.Templates(licences.TEMPLATES).find(text)]


@pytest.mark.parametrize("at", range(len(licences.TEMPLATES)))
def test_every_wording_is_named_right(at):
    """Within other text, in other case and with other line breaks."""
    name, text = licences.TEMPLATES[at]
    for form in (text, text.upper(), text.replace(" ", "\n", 3), "* " + text.replace("\n", "\n * ")):
        assert found_in(f"Words before it.\n\n{form}\n\nAnd some words after it.") == [name]


BSD3 = f"{licences._BSD_CONDITIONS}\n{licences._BSD_THIRD}\n{licences._BSD_DISCLAIMER}"


@pytest.mark.parametrize(
    "text, names",
    [
        ("Copyright (c) 2001 A. Person. All rights reserved.\n" + BSD3.replace("copyright holder", "University"), ["BSD-3-Clause"]),
        (GPL3.replace("version 3", "version 2"), ["GPL-2.0"]),
        (GPL3.replace("General", "Lesser General").replace("program", "library"), ["LGPL-3.0"]),
        (GPL3.replace("General", "Affero General"), ["AGPL-3.0"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("Licensed under the Mozilla Public License, v. 2.0", []),
    ],
)
def test_variants(text, names):
    assert found_in(text) == names


@pytest.mark.parametrize(
    "text",
    [
        GPL3.replace("version 3", "version 1"),
        "This work is licensed under the GNU General Public License, version 1.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 2.5 Generic License.",
        "Licensed under CC BY-NC 5.0.",
        "Licensed under the Apache License, Version 1.1.",
        "Released under the X11 License.",
        "Released under the Artistic License.",
        "This project is licensed under the terms of the company.",
        licences._EPL_NOTICE.format(version="3.0"),
        "All rights reserved. No part of this software may be copied or used without permission.",
    ],
)
def test_near_misses_are_not_named(text):
    """Better no licence than a wrong one."""
    assert found_in(f"Some words.\n{text}\nMore words.") == []
