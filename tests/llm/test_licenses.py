from __future__ import annotations

import re

from blotter.llm import licenses as L
from tests.llm.conftest import EDGES, table


def test_equivalent_texts(spark):
    mit = dict(L.KNOWN[:1])["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Some One\n\n" + mit), (2, mit.upper().replace(",", "")), (3, "# " + mit.replace("\n", "\n#  ")),
        (4, "prose before\n\n" + mit.replace("\n\n", "\n") + "\n\nprose after"), (5, mit + " and more"),
        (6, "Licenced under the Apache Licence -- version 2.0\nReleased under the MIT License"), (7, "licensed under cc by nc 4 0"),
    ]
    got = {r.doc_id: (r.text_license, r.licenses) for r in L.find_licenses(table(spark, rows)).collect()}
    assert got == {
        1: ("MIT", ["MIT"]), 2: ("MIT", ["MIT"]), 3: ("MIT", ["MIT"]), 4: (None, ["MIT"]), 5: (None, []),
        6: (None, ["Apache-2.0", "MIT"]), 7: ("CC-BY-NC-4.0", ["CC-BY-NC-4.0"]),
    }


def test_edges(edges, empty):
    rows = L.find_licenses(edges).collect()
    assert len(rows) == len(EDGES) and all(r.licenses == [] and r.text_license is None for r in rows)
    assert L.find_licenses(empty).count() == 0


def test_no_python_runs(edges):
    assert not re.search("Python|Pandas|ArrowEval|MapIn", L.find_licenses(edges)._jdf.queryExecution().toString())


def _full(name, at=0):
    return [t for n, t in L.KNOWN if n == name and len(t) > 400][at]


def test_full_texts(spark):
    """Whole licence texts as files hold them, set in lines of another width."""
    import textwrap

    wrapped = lambda t: "\n\n".join(textwrap.fill(p, 60) for p in t.split("\n\n"))
    whole = ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "Unlicense", "Zlib", "BSL-1.0", "MPL-1.1", "MPL-2.0", "CC0-1.0",
             "CC-BY-SA-4.0", "OFL-1.1", "Artistic-1.0-Perl", *[f"GPL-{v}.0-only" for v in (1, 2, 3)],
             *[f"LGPL-{v}-only" for v in ("2.0", "2.1", "3.0")], "GFDL-1.2-only", "GFDL-1.3-only")
    mit = _full("MIT")
    rows = [
        ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2014 Some One\n\n" + wrapped(mit)),
        ("MIT", "# MIT License\n\n© 2014 Some One. All rights reserved.\n\n" + mit.replace("COPYRIGHT HOLDERS", "COPYRIGHT\nHOLDERS")),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n" + wrapped(_full("BSD-3-Clause"))),
        ("Apache-2.0", _full("Apache-2.0").replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Some One")),
        ("GPL-2.0-only", _full("GPL-2.0-only").replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")),
        *[(n, _full(n)) for n in whole],
        *[(n, "\n".join("// " + x for x in _full(n).split("\n"))) for n in whole],
    ]
    got = {r.doc_id: r.text_license for r in L.find_licenses(table(spark, [(i, t) for i, (_, t) in enumerate(rows)])).collect()}
    assert [got[i] for i in range(len(rows))] == [n for n, _ in rows]


def test_a_million_of_one_character(spark):
    """Runs of marks, blanks, blank lines, letters: no recursion, no crash."""
    notice = "Released under the MIT License"
    runs = ["-", " ", "\n", " \n", "\t", "x", "“", "#-", "\n-"]
    rows = [(i, notice + "\n\n" + r * (1_000_000 // len(r)) + "\n\n" + notice) for i, r in enumerate(runs)]
    got = {r.doc_id: r.licenses for r in L.find_licenses(table(spark, rows)).collect()}
    assert got == {i: ["MIT"] for i in range(len(runs))}


def test_repeated_and_null_ids(spark):
    rows = [(None, "Released under the MIT License"), (None, "x"), (1, "x"), (1, "Released under the MIT License"), (1, "x")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.licenses) for r in L.find_licenses(table(spark, rows)).collect())
    assert got == sorted((i is None, i or 0, ["MIT"] if t != "x" else []) for i, t in rows)


def test_file_names_all_notices():
    spdx = {n for n, t in L.KNOWN if t == f"SPDX-License-Identifier: {n}"}
    assert {n for n, _ in L.KNOWN} <= spdx
