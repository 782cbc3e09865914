import textwrap

import duckdb
import pytest

from maskwright.llm.catalog import ORACLES
from maskwright.llm.licences import CRITICAL, RULES, SENTENCES, scan_licences

MIT = next(s for s, i in SENTENCES.items() if i == "MITgrant")
NOTICE = next(s for s, i in SENTENCES.items() if i == "MITnotice")


@pytest.mark.parametrize("text, ids, names, unmatched, unknown", [
    ("Some words. Released under the MIT License. More words", ["MITref"], ["MIT"], 0, 0),
    ("word\nRELEASED under the  MIT license!\nword", ["MITref"], ["MIT"], 0, 0),
    ("Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.", ["Apache2ref", "CCBYNC4ref"],
     ["Apache-2.0", "CC-BY-NC-4.0"], 0, 0),
    (f"MIT License\n\n{MIT.replace(" copy of", chr(10) + "copy of").replace(" publish", chr(10) + "publish")}:\n\n{NOTICE}.", ["MITtitle", "MITgrant", "MITnotice"], ["MIT"], 0, 0),
    (f"{NOTICE}. {MIT}.", ["MITnotice", "MITgrant"], ["MIT"], 1, 0),
    ("Licensed under the Licence of my house. Released under the MIT License.", ["MITref"], ["MIT"], 0, 1),
    ("nothing here", [], [], 0, 0), ("", [], [], 0, 0), (None, [], [], 0, 0),
    ("x. " * 50_000 + "Licensed under CC BY-NC 4.0.", ["CCBYNC4ref"], ["CC-BY-NC-4.0"], 0, 0),
])
def test_texts(spark, text, ids, names, unmatched, unknown):
    df = spark.createDataFrame([(None, text, "a", 1)], "doc_id bigint, text string, found string, left int")
    assert tuple(scan_licences(df).first()) == (None, ids, names, unmatched, unknown)


def test_rules_in_order(spark):
    df = spark.createDataFrame([(1, "permit a. permit b. permit c."), (1, "permit b. stuff. permit c."),
                                (2, "permit c. licence x. permit c. permit b")], "doc_id bigint, text string")
    found = scan_licences(df, sentences={"permit a": "A", "permit b": "B", "permit c": "C"},
                          rules=[("AB", ["A", "B"]), ("BC", ["B", "C"]), ("C", ["C"])])
    assert [tuple(r)[1:] for r in found.collect()] == [
        (["A", "B", "C"], ["AB", "C"], 0, 0), (["B", "C"], ["BC"], 0, 0), (["C", "C", "B"], ["C"], 1, 1)]
    assert scan_licences(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        scan_licences(df, sentences={"no such word": "A"})


def test_tables_agree():
    used = {i for _, ids in RULES for i in ids}
    assert used <= set(SENTENCES.values()) and all(any(c in s for c in CRITICAL) for s in SENTENCES)


def wrapped(text, width, mark):
    return "".join(f"{mark}{line}\n" for line in textwrap.wrap(text, width))


BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
       "following conditions are met:",
       "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
       "disclaimer.",
       "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
       "disclaimer in the documentation and/or other materials provided with the distribution."]
OF = {i: s for s, i in SENTENCES.items()}


@pytest.mark.parametrize("width", [48, 76])
@pytest.mark.parametrize("mark", ["# ", " * ", "// ", "-- ", ";; ", "! ", "REM "])
def test_headers_in_comments(spark, mark, width):
    blank = mark.rstrip() + "\n" if mark != "REM " else "\n"
    holder = f"{mark}Copyright (c) 2020 Foo Bar\n"
    isc = holder + wrapped(OF["ISCgrant"] + ".", width, mark)
    mit = holder + wrapped(MIT + ":", width, mark) + blank + wrapped(NOTICE + ".", width, mark)
    gpl = holder + "".join(wrapped(OF[i] + ".", width, mark) for i in ("GPL2plusgrant", "GPLwarranty", "GPLsee"))
    texts = [(1, isc, "ISC"), (2, holder + blank + isc, "ISC"), (3, mit, "MIT"), (4, gpl, "GPL-2.0-or-later")]
    for k, number in enumerate(("{}. ", "{}) ", "({}) ", "\u2022 ")):
        text = holder + wrapped(BSD[0], width, mark) + "".join(
            wrapped(number.format(n + 1) + s, width, mark) for n, s in enumerate(BSD[1:]))
        texts.append((5 + k, text, "BSD-2-Clause"))
    texts.append((9, f"{BSD[0]} 1. {BSD[1]} 2. {BSD[2]}", "BSD-2-Clause"))
    df = spark.createDataFrame(texts, "doc_id bigint, text string, want string")
    found = {r.doc_id: r for r in scan_licences(df).collect()}
    for k, _, want in texts:
        assert found[k].licences == [want] and found[k].unmatched == 0, (k, found[k])
        assert found[k].unknown == (0 if k == 9 else 2 if k == 2 else 1), (k, found[k])


NAME = ("Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.")
LOOSE = ("THIS SOFTWARE IS PROVIDED BY {} ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
         "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")


def test_owners_and_clauses_that_decide(spark):
    """Any owner; and no name where a clause that is not known might make it another licence."""
    bsd, other = "\n\n".join(BSD), "Redistribution in a spacecraft is permitted to no one."
    rows = [f"{bsd} {NAME.format('Foo Inc.')}", f"{bsd} {NAME.format('the copyright holder')}", f"{bsd} {other}", bsd,
            f"{bsd} {LOOSE.format('THE REGENTS OF FOO')}", f"{bsd} {NAME.format('Bar')} {LOOSE.format('Bar')} More words.",
            "\n".join(f"# {line}" for part in (*BSD, NAME.format("the Foo Project")) for line in textwrap.wrap(part, 60)),
            "SPDX-License-Identifier: MIT OR Apache-2.0", "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0",
            "// SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: (LGPL-2.1-or-later AND MIT)",
            "SPDX-License-Identifier: EUPL-1.2"]
    want = [["BSD-3-Clause"], ["BSD-3-Clause"], [], ["BSD-2-Clause"], ["BSD-2-Clause"], ["BSD-3-Clause"], ["BSD-3-Clause"],
            ["MIT", "Apache-2.0"], [], ["GPL-2.0-or-later"], ["MIT", "LGPL-2.1-or-later"], ["EUPL-1.2"]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    found = {r.doc_id: r for r in scan_licences(df).collect()}
    for k, names in enumerate(want):
        assert sorted(found[k].licences) == sorted(names), (k, found[k])
    assert [found[k].unmatched for k in (0, 1, 3, 4, 5, 6)] == [0] * 6
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id INTEGER, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for k, x in enumerate(enumerate(rows)) if k != 6])
    theirs = {r[0]: r[2] for r in con.sql(ORACLES["op1_licence_scan"]).fetchall()}
    assert theirs == {k: ",".join(found[k].licences) for k in theirs}


def test_lines_that_are_no_run(spark):
    """A blank comment line parts runs, and a number that a licence ends with is none of a list."""
    rows = [(1, "# licensed under the\n#\n# mit license\n# permit"), (2, "Licensed under the GNU General Public License version\n2. More"),
            (3, "words\nReleased under the\nMIT License\nwords")]
    found = {r.doc_id: r for r in scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [found[k].licences for k in (1, 2, 3)] == [["MIT"], ["GPL-2.0-only"], ["MIT"]]
    assert [found[k].sentence_ids for k in (1, 2, 3)] == [["MITtitle"], ["GPL2ref"], ["MITref"]]
