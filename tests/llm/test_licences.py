import re
import textwrap

import duckdb
from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import licences, oracle

MIT = licences.KNOWN[0][1]
GONE = ["Copyright 2020", "# Copyright (c) <year> <owner>", "Copyright © X", "(c) 2001-2003 X", "(C) X, 1999", "(c) Copyright X"]
GONE += ["© X", "Copyright The Foo Authors", "copyright: Joyent, Inc. and others", "Copyright [yyyy] [name]", "* All rights reserved."]
KEPT = ["copyright notice and this permission notice appear in all copies.", "COPYRIGHT HOLDERS BE LIABLE", "copyright", "(c) You must retain"]
KEPT += ["copyright, patent, trademark", '"Copyright" also means copyright-like laws', "copyrighted 2020", "all rights reserved to them stay", "(c)"]
TEXTS = [
    MIT,
    MIT.upper().replace(",", " ;").replace(" the ", "\n the\n").replace("MIT LICENSE", "MIT  Licence"),
    "Copyright (c) 2020 Somebody\n" + MIT + "\n\n(C) Another, 1999\nAll rights reserved.",
    "Some code\nReleased under the MIT Licence!\nmore\n  licensed under the Apache License (Version 2.0)\nreleased under the mit license",
    MIT + " But not quite.",
    "Copyright 2020",
    "We were Released under the MIT License. Once.",
    *frames.ODD_TEXTS,
]


def test_whole_texts_and_lines(spark):
    got = licences.scan(frames.clashing(frames.docs(spark, TEXTS))).orderBy("id").collect()
    assert len(got) == len(TEXTS)
    found = [(r.licence, r.notices, r.n_notices) for r in got]
    assert found[0] == ("MIT", [], 0)
    assert found[1][0] == found[2][0] == "MIT"
    assert found[3] == (None, ["Apache-2.0", "MIT"], 3)
    assert set(map(str, found[4:])) == {str((None, [], 0))}


def test_canonical_form(spark):
    df = spark.createDataFrame([("The  ORGANISATION's Licence — centre\n***\n\n© 2001 x\nhttp://a.b",)], "t string")
    lines = df.select(licences.canonical_lines(F.col("t")).alias("x")).first().x
    assert lines == ["the organization s license center", "https a b"]


def test_odd_rows_other_lists_and_empty_tables(spark):
    known = licences.known_digests(spark, [("X", "My Licence"), ("Y", "my license"), ("Z", "Copyright only")])
    assert [r.licence for r in known.collect()] == ["X"]
    df = spark.createDataFrame([(1, "My license."), (1, "My license."), (1, "other"), (None, "MY LICENCE"), (2, None)], "doc_id long, text string")
    got = sorted((str(r.id), str(r.licence)) for r in licences.scan(df, known).collect())
    assert got == [("1", "None"), ("1", "X"), ("1", "X"), ("2", "None"), ("None", "X")]
    assert licences.scan(frames.odd(spark)).count() == frames.odd(spark).count()
    assert licences.scan(df.limit(0)).count() == 0
    assert licences.scan(df, known.limit(0)).where("licence is not null").count() == 0
    shuffled = licences.scan(df, known, max_broadcast_rows=0)
    assert sorted((str(r.id), str(r.licence)) for r in shuffled.collect()) == got


def wrapped(text: str, width: int) -> str:
    return "\n".join(textwrap.fill(line, width, break_long_words=False, break_on_hyphens=False) for line in text.split("\n"))


def test_texts_wrapped_at_any_width(spark):
    whole = [(name, text) for name, text in licences.KNOWN if len(text) > 200]
    rows = [(name, wrapped(text, width)) for name, text in whole for width in (1, 12, *range(20, 101))]
    rows += [(name, "Copyright (c) 2020 Somebody\n" + wrapped(text, 72).upper()) for name, text in whole]
    got = licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).select("id", "licence").collect()
    assert len(got) == len(rows) and [r for r in got if r.licence != r.id] == []
    assert any("\ncopyright notice and this permission notice appear" in text for _, text in rows)


#: Ways to write the same: each text below must be known however it is written.
SAME = [
    lambda t: re.sub(r"(?i)copyright holder", "copyright owner", t),
    lambda t: re.sub(r"(?i)copyright holder", "copyright\\nHolder", t),
    lambda t: t.replace("sublicens", "sub-licens").replace("Sublicens", "sub licens"),
    lambda t: re.sub(r"(?i)license", "licence", t),
    lambda t: t.replace("noncommercial", "non-commercial").replace("percent", "per cent"),
    lambda t: re.sub(r"(?i)\b(warran)(t)", r"\1-\n   \2", t),
    lambda t: t.replace('"', "''").replace(",", " ,").replace("-", " "),
]


def test_each_known_text_under_each_equivalence(spark):
    whole = [(name, text) for name, text in licences.KNOWN if len(text) > 200]
    whole += [(path.stem, path.read_text("utf-8")) for path in sorted(licences.FILES.glob("*.txt"))]
    rows = [(name, same(text)) for name, text in whole for same in SAME]
    bsd3 = dict(licences.KNOWN[:6])["BSD-3-Clause"]
    rows += [("MIT", MIT.replace("COPYRIGHT HOLDERS", "COPYRIGHT OWNERS")), ("MIT", MIT.replace("sublicense", "sub-license"))]
    rows += [("BSD-3-Clause", bsd3.replace("HOLDER", "OWNER").replace("holder", "owner"))]
    got = licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).select("id", "licence").collect()
    assert len(got) == len(rows) and [r for r in got if r.licence != r.id] == []


def test_sql_follows(spark):
    files = [path.read_text("utf-8") for path in sorted(licences.FILES.glob("*L*-[13].*.txt"))]
    texts = [*TEXTS, *(same(t) for _, t in licences.KNOWN[:6] for same in SAME), *files, *(wrapped(t, 40) for _, t in licences.KNOWN[:6])]
    texts += ["\n".join([*GONE, t, *GONE]) for t in (MIT, "Licensed under CC BY 4.0", "1 2 3\n4")]
    texts += [MIT + "\n" + t for t in (*GONE, *KEPT)] + ["the MIT License", "Released under\nthe MIT License", "SPDX-License-Identifier: MPL-2.0\nMPL 2.0"]
    df = frames.docs(spark, texts)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = sorted(con.sql(oracle.oracle_sql()["op7_licence_scan"]).project("doc_id, licence, notices, n_notices").fetchall())
    got = licences.scan(df).select("id", "licence", F.array_join("notices", ",").alias("notices"), "n_notices").collect()
    assert sorted(map(tuple, got)) == want
    assert sum(r.licence is not None for r in got) > 60


def test_numbers_stay_apart(spark):
    rows = [(None, "Licensed under the Apache License, Version 20."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0.")]
    got = licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert [r.notices for r in sorted(got, key=lambda r: str(r.id))] == [["Apache-2.0"], []]


def test_copyright_lines(spark):
    df = spark.createDataFrame([(x,) for x in GONE + KEPT], "t string")
    empty = [r.t for r in df.where(F.size(licences.canonical_lines(F.col("t"))) == 0).collect()]
    assert sorted(empty) == sorted(GONE)


def test_titles_and_whole_texts_from_files(spark):
    mit, bsd3 = MIT.split("\n")[1], dict(licences.KNOWN[:6])["BSD-3-Clause"]
    rows = [("MIT", t + mit) for t in ("", "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n", "(The MIT License)\n")]
    rows += [("BSD-3-Clause", t + bsd3) for t in ("", "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n", "The BSD License\n")]
    rows += [("BSD-3-Clause", "New BSD License\n" + bsd3.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "))]
    for path in licences.FILES.glob("*.txt"):
        text = path.read_text()
        body = text.split("END OF TERMS AND CONDITIONS")[0]
        start = re.search(licences._BODY_STARTS, body)
        rows += [(path.stem, text), (path.stem, body), (path.stem, body[start.start() if start else 0 :].upper())]
    for name in ("GPL-2.0-only", "LGPL-2.1-only"):
        text = (licences.FILES / f"{name}.txt").read_text()
        rows.append((name, re.sub(r"51 Franklin.*USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA", text)))
    for name in ("Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only"):
        body = (licences.FILES / f"{name}.txt").read_text().split("END OF TERMS AND CONDITIONS")[0]
        parts = body[re.search(licences._BODY_STARTS, body).start() :].split("\n\n")
        rows += [(name, "\n\n".join(textwrap.fill(" ".join(x.split()), w, break_on_hyphens=False) for x in parts)) for w in range(20, 121, 4)]
    got = licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).select("id", "licence").collect()
    assert len(got) == len(rows) and [r for r in got if r.licence != r.id] == []


def test_notices_of_other_licences(spark):
    text = "SPDX-License-Identifier: MPL-2.0\nThis project is licensed under the BSD 3-Clause License.\nLicensed under CC BY-SA 3.0\nreleased under the GNU GPL v2"
    got = licences.scan(frames.docs(spark, [text, MIT])).orderBy("id").collect()
    assert got[0].notices == ["BSD-3-Clause", "CC-BY-SA-3.0", "GPL-2.0-only", "MPL-2.0"] and got[0].n_notices == 4
    assert (got[1].licence, got[1].notices) == ("MIT", [])
