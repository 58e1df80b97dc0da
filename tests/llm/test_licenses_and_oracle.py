from __future__ import annotations

import glob
import os
import re
from importlib.resources import files

import duckdb
import pytest

from tessera.llm.license_scan import scan_licenses
from tessera.llm.license_texts import _MIT, _UNLICENSE, FILES, TEXTS
from tessera.llm.oracle import ORACLE_SQL
from tessera.llm.queries import QUERIES


def test_licenses_of_odd_rows(docs, odd_texts):
    mit = "Copyright (c) 2020 Somebody\r\n\r\n" + _MIT.upper().replace("\n", "\n  ").replace('"', "'")
    british = TEXTS[3][1].replace("software", "Software,")
    more = [(100, mit), (101, "prose\nReleased under the MIT LICENCE!\nmore prose"), (102, "Licensed under CC BY-NC 4.0"), (103, british), (104, "the MIT License is nice"),
            (105, "x\n\n(c) 1999 A\nLicensed under the Apache Licence, version 2.0\n\nThis work is licensed under the GNU General Public License, version 3."), (100, mit)]
    rows = scan_licenses(docs(odd_texts + more)).collect()
    assert len(rows) == len(odd_texts) + len(more)
    assert all(r["license_ids"] == "" and r["n_licenses"] == 0 and r["whole_license"] is None for r in rows if r["doc_id"] is None or r["doc_id"] < 100)
    by = {r["doc_id"]: (r["license_ids"], r["n_licenses"], r["whole_license"]) for r in rows if r["doc_id"] and r["doc_id"] >= 100}
    assert by == {100: ("MIT", 1, "MIT"), 101: ("MIT", 1, None), 102: ("CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"), 103: ("ISC", 1, "ISC"), 104: ("", 0, None), 105: ("Apache-2.0,GPL-3.0", 2, None)}
    assert scan_licenses(docs([])).count() == 0


def test_whole_texts_and_file_headers(docs):
    """Every text file, whole and with other line breaks, and headers of source files."""
    texts = [(i, files("tessera.llm").joinpath("licenses", f"{spdx}.txt").read_text("utf-8")) for i, spdx in enumerate(FILES)]
    texts += [(100 + i, re.sub(r"(?<=\S)[ ]+(?=\S)", "  ", t).replace("\n", "\r\n")) for i, t in texts]
    header = ("# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
              "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n#\n# This program is distributed in the hope\nimport os\n")
    rows = scan_licenses(docs([*texts, (200, header), (201, _UNLICENSE)])).collect()
    by = {r["doc_id"]: (r["license_ids"], r["whole_license"]) for r in rows}
    assert by == {**{n + i: (spdx, spdx) for i, spdx in enumerate(FILES) for n in (0, 100)}, 200: ("GPL-3.0", None), 201: ("Unlicense", "Unlicense")}


def test_texts_of_several_blocks_inside_documents(docs):
    bsd = {spdx: t for spdx, t in TEXTS if spdx.startswith("BSD")}
    source = "/*\n * tool.c - a tool\n *\n * Copyright (c) 2020 Somebody\n *\n" + "".join(f" * {x}\n" for x in _MIT.split("\n")) + " */\n\nint main() {}\n"
    readme = "# Tool\n\nWhat it does.\n\n## License\n\n" + bsd["BSD-3-Clause"] + "\n\n## Thanks\n\n" + bsd["BSD-2-Clause"]
    cut = "x\n\n" + _MIT[:_MIT.rindex("\n\n")] + "\n\nend"
    rows = scan_licenses(docs([(1, source), (2, readme), (3, cut), (4, "a\n\n" + _MIT)])).collect()
    assert {r["doc_id"]: (r["license_ids"], r["n_licenses"], r["whole_license"]) for r in rows} == {1: ("MIT", 1, None), 2: ("BSD-2-Clause,BSD-3-Clause", 2, None), 3: ("", 0, None), 4: ("MIT", 1, None)}


def test_a_text_that_repeats_a_licence(docs):
    """Many starts of the same known text, and of ones that break off."""
    first = _MIT.split("\n\n")[0]
    rows = scan_licenses(docs([(1, "\n\n".join([_MIT] * 300)), (2, "\n\n".join([first] * 500)), (3, "\n\n".join([first] * 500 + [_MIT]))])).collect()
    assert {r["doc_id"]: (r["license_ids"], r["n_licenses"]) for r in rows} == {1: ("MIT", 1), 2: ("", 0), 3: ("MIT", 1)}


def test_own_license_table(spark, docs):
    own = spark.createDataFrame([("B", "Own Licence"), ("A", "own license."), ("C", None), ("D", "!!")], "license_id string, text string")
    rows = scan_licenses(docs([(1, "OWN LICENSE"), (2, "!!"), (3, "own")]), own).collect()
    assert {r["doc_id"]: r["license_ids"] for r in rows} == {1: "A", 2: "", 3: ""}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(str, want))


def test_every_operator_is_registered():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 14)] == [1] * 13
