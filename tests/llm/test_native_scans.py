"""Line templates and license sentences, against the same scans as SQL."""

import glob

import duckdb
import pytest

from tallyhouse.llm import line_templates
from tallyhouse.llm._shared import drop_staged
from tallyhouse.llm.license_scan import MARKERS, PARTS, SENTENCES, license_scan_sql, scan_licenses
from tallyhouse.llm.line_templates import line_dedup_sql, line_report, without_boilerplate
from tallyhouse.sources.storage import shared_folder
from tests.llm.brute import documents, prose

MENU = "Home About Contact Search our site"
VIEWS = "This page was viewed {} times by our {} readers"


def by_sql(rows, sql):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows]) if rows else None
    result = connection.sql(sql)
    names = sorted(result.columns)
    return sorted((tuple(row[result.columns.index(n)] for n in names) for row in result.fetchall()), key=repr)


def by_spark(df):
    return sorted((tuple(row[n] for n in sorted(df.columns)) for row in df.collect()), key=repr)


LINES = [
    (1, f"{MENU}\n{prose(1, 30)}\n{VIEWS.format(17, 'loyal')}"),
    (2, f"{prose(2, 30)}\n{MENU}\n{MENU}\n{VIEWS.format(9, 'dear')}"),
    (3, f"{MENU}\n{VIEWS.format('3,100', 'loyal')}\n{prose(3, 8)}"),
    (4, f"{MENU}"),
    (5, None),
    (6, ""),
    (7, "a\nb\nc\n\n \n" + prose(4, 20)),
    (8, "\n".join([prose(5, 12), prose(5, 12), MENU.replace(" ", "\t ")])),
    (9, "\n".join(prose(k, 9) for k in range(3000)) + f"\n{MENU}"),
    (None, MENU + "\nlonely words that nobody else has"),
]


def test_lines_match_sql(spark):
    assert by_spark(line_report(documents(spark, LINES))) == by_sql(LINES, line_dedup_sql())


def test_template_drops_all_but_its_first_line(spark):
    rows = [r for r in LINES if r[0] is not None]
    kept = {r.doc_id: r.text for r in without_boilerplate(documents(spark, rows)).collect()}
    assert kept[1] == LINES[0][1]
    assert kept[2] == prose(2, 30)
    assert kept[3] == prose(3, 8)
    assert 4 not in kept and kept[5] is None and kept[6] == "" and kept[7] == LINES[6][1]


def test_clean_documents_and_columns_stay(spark):
    docs = documents(spark, [(k, "\n".join(prose(50 * k + j, 14) for j in range(5))) for k in range(60)])
    docs = docs.selectExpr("*", "1 AS id", "2 AS key", "3 AS pos", "4 AS dropped", "5 AS leaf")
    kept = without_boilerplate(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.collect())
    assert without_boilerplate(documents(spark, [])).count() == 0


def test_repeated_rows_are_treated_alike(spark):
    rows = [(1, MENU), (2, MENU), (3, MENU), (3, MENU)]
    assert [(r.doc_id, r.n_dropped) for r in line_report(documents(spark, rows)).orderBy("doc_id").collect()] == [(1, 0), (2, 1), (3, 1), (3, 1)]


LICENSES = [
    (1, "Released under the MIT License.\nMore text. And more."),
    (2, "Intro here! Licensed under the Apache License, Version 2.0. Bye."),
    (3, "This work is licensed under the GNU General Public License,\nversion 3.\nEnd"),
    (4, None),
    (5, ""),
    (6, "the license of this is unknown. permission denied"),
    (7, "Licensed under CC BY-NC 4.0\nnext line without a stop"),
    (8, "All rights reserved. " + prose(1, 30_000) + ". MIT License."),
    (9, "\n\n".join(t[0].capitalize() + "." for n, t in SENTENCES.items() if n.startswith("mit-"))),
    (10, "Licensed under the Apache License, Version 2.0. A. B. C. D. E. You may not use this file except in compliance with the License."),
    (11, "MIT License. MIT License; mit  LICENSE!"),
    (None, "Apache License, Version 2.0."),
]


def test_licenses_match_sql(spark):
    assert by_spark(scan_licenses(documents(spark, LICENSES))) == by_sql(LICENSES, license_scan_sql())


def test_licenses_found(spark):
    docs = documents(spark, LICENSES).selectExpr("*", "1 AS sequence", "2 AS licenses")
    found = {r.doc_id: r.licenses for r in scan_licenses(docs).collect()}
    assert found == {1: "MIT", 2: "Apache-2.0", 3: "GPL-3.0", 4: "", 5: "", 6: "", 7: "CC-BY-NC-4.0", 8: "MIT,Proprietary", 9: "MIT",
                     10: "Apache-2.0", 11: "MIT", None: "Apache-2.0"}
    assert scan_licenses(documents(spark, [])).count() == 0


@pytest.mark.parametrize("form", [form for forms in SENTENCES.values() for form in forms])
def test_every_known_sentence_has_a_marker(form):
    assert any(marker in form for marker in MARKERS)


FREE = """This {what} is free software{sign} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{then} either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
{kind}General Public License for more details.

You should have received a copy of the GNU {kind}General Public License
along with this {what}.  If not, see <https://www.gnu.org/licenses/>.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
BSD2 = """
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
HEADERS = [
    ("GPL-3.0-or-later", FREE.format(what="program", sign=":", kind="", then=",", version="3")),
    ("GPL-3.0-or-later", FREE.format(what="program", sign=";", kind="", then=";", version="3")),
    ("GPL-2.0-or-later", FREE.format(what="program", sign=";", kind="", then=";", version="2")),
    ("LGPL-2.1-or-later", FREE.format(what="library", sign=";", kind="Lesser ", then=";", version="2.1")),
    ("LGPL-2.0-or-later", FREE.format(what="library", sign=";", kind="Library ", then=";", version="2")),
    ("LGPL-3.0-or-later", FREE.format(what="library", sign=":", kind="Lesser ", then=",", version="3")),
    ("AGPL-3.0-or-later", FREE.format(what="program", sign=":", kind="Affero ", then=",", version="3")),
    ("MPL-2.0", MPL),
    ("Apache-2.0", APACHE),
    ("BSD", BSD),
    ("BSD-2-Clause", BSD + BSD2),
    ("BSD-3-Clause", BSD + BSD2 + BSD3),
    ("ISC", ISC),
    ("EPL-2.0", EPL),
    ("Unlicense", UNLICENSE),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0\n"),
    ("GPL-2.0", "Some words.\nSPDX-License-Identifier: GPL-2.0-only\nint main\n"),
]


SHAPES = [str, lambda t: t.replace("\n", " "), lambda t: "".join(f" * {line}\n" for line in t.splitlines())]


def test_verbatim_headers(spark):
    # A name is a sentence or line of its own, so its text is not joined to one line.
    rows = [(100 * k + n, shape(t)) for k, (_, t) in enumerate(HEADERS) for n, shape in enumerate(SHAPES) if n != 1 or "SPDX" not in t]
    found = {r.doc_id: r.licenses for r in scan_licenses(documents(spark, rows)).collect()}
    assert found == {i: HEADERS[i // 100][0] for i, _ in rows}
    assert by_spark(scan_licenses(documents(spark, rows))) == by_sql(rows, license_scan_sql())


def test_parts_alone_say_nothing(spark):
    rows = [(1, HEADERS[0][1]), (2, "This file is free software. More."), (3, "Version 2 of the License. Either way."), (4, "2.0. v. 2.0"), (5, "Isc. MIT, no licence")]
    found = {r.doc_id: (r.sequence, r.licenses) for r in scan_licenses(documents(spark, rows)).collect()}
    assert found[1] == (";free-software;gpl3-terms;hope;implied;gpl-details;", "GPL-3.0-or-later")
    assert found[2] == (";free-software;", "") and found[3] == (";version2-only;", "") and found[4] == (";", "")
    assert found[5] == (";spdx-isc;", "")
    assert by_spark(scan_licenses(documents(spark, rows))) == by_sql(rows, license_scan_sql())


@pytest.mark.parametrize("form", [form for forms in PARTS.values() for form in forms])
def test_every_part_has_a_marker(form):
    assert any(marker in form for marker in MARKERS)


def test_both_run_without_python(spark):
    for df in (line_report(documents(spark, LINES)), scan_licenses(documents(spark, LICENSES))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


UNLIKE = [
    (1, "He went to the store"), (2, "He went to bed early"), (3, "He went to his house"),
    (4, "\n".join(f"The price of our {x} is low today" for x in ("tea", "rice", "salt", "corn"))),
    (10, f"{prose(7, 9)}\n{MENU}"), (11, MENU), (12, f"{MENU}\n{prose(8, 9)}"),
    *((20 + k, f"{prose(20 + k, 9)}\nThis post was written by {x} for our daily paper") for k, x in enumerate(("Ann", "Bob", "Cy"))),
    # Two lines of one document and one of another are two documents.
    (30, "Here is what we sell now\nHere is what we sell today"), (31, "Here is what we sell here"), (32, "Here is what they buy there"),
]


def test_unlike_lines_stay(spark):
    kept = {r.doc_id: r.text for r in without_boilerplate(documents(spark, UNLIKE)).collect()}
    given = dict(UNLIKE)
    same = [1, 2, 3, 4, 10, 20, 30, 31, 32]
    assert {i: kept.get(i) for i in same} == {i: given[i] for i in same}
    assert 11 not in kept and kept[12] == prose(8, 9) and kept[21] == prose(21, 9) and kept[22] == prose(22, 9)
    assert by_spark(line_report(documents(spark, UNLIKE))) == by_sql(UNLIKE, line_dedup_sql())


def test_short_lines_go_when_equal(spark):
    short = ["Read more", "All rights reserved.", "Share this article"]
    rows = [(k, "\n".join([*short, "Page 3", "}", "", f"{prose(100 + k, 9)}", f"Part {'abc'[k % 3]}{k}"])) for k in range(50)]
    rows += [(60, "Share that article\nRead\nRead  more"), (61, "Read"), (61, "Read"), (None, "Read"), (None, "Menu"), (None, "Menu\n"), (62, "Menu")]
    report = {r.doc_id: r.n_dropped for r in line_report(documents(spark, [r for r in rows if r[0] is not None])).collect()}
    assert sum(report[k] for k in range(50)) == 147 and report[0] == 0 and report[60] == 1 and report[61] == 0
    kept = {r.doc_id: r.text for r in without_boilerplate(documents(spark, rows[:50])).collect()}
    assert all(kept[k] == rows[k][1].split("\n", 3)[3] for k in range(1, 50)) and kept[0] == rows[0][1]
    assert by_spark(line_report(documents(spark, rows))) == by_sql(rows, line_dedup_sql())


def test_staged_tables_can_be_dropped(spark):
    before = set(glob.glob(f"{shared_folder(spark)}/llm-*"))
    rows = by_spark(line_report(documents(spark, LINES)))
    assert rows and set(glob.glob(f"{shared_folder(spark)}/llm-*")) - before
    drop_staged(spark)
    assert not set(glob.glob(f"{shared_folder(spark)}/llm-*")) - before


def test_wide_tables_are_not_broadcast(spark):
    few = spark.createDataFrame([(1, "x" * 1000, [1, 2])] * 10, "id long, text string, places array<int>")
    assert "broadcast" in line_templates._small(few)._jdf.queryExecution().logical().toString()
    wide = spark.range(40).selectExpr("id", "repeat('x', 1000000) AS text")
    assert "broadcast" not in line_templates._small(wide)._jdf.queryExecution().logical().toString()
