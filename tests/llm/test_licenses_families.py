"""Licence families that differ by a word, and notices wrapped over lines."""

import random

from outcomelab.llm import licenses

from test_llm_operators import vocabulary

CASES = {
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 2.0.": "",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
    "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "Released under the BSD 2-Clause License.": "BSD-2-Clause",
    "Released under the BSD 3-Clause License.": "BSD-3-Clause",
    "Released under the ISC License.": "ISC",
    "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
    "Licensed under CC0 1.0.": "CC0-1.0",
    "Licensed under the Apache License, Version 1.1.": "",
    "Released under the License.": "",
    "# Permission is hereby granted, free of charge, to any person\n# obtaining a copy of this software and\n"
    "# associated documentation files": "MIT",
    "Licensed under the Apache\nLicense, Version 2.0.": "Apache-2.0",
    "Licensed under the Apache\n\nLicense, Version 2.0.": "",
}


def test_families_and_wrapped_lines(spark):
    rng, v = random.Random(4), vocabulary()
    other = [" ".join(rng.choice(v) for _ in range(30)) for _ in range(60)]
    rows = [(k, f"{other[k]}\n{t}\n{other[-k]}") for k, t in enumerate(CASES)] + [(100 + k, t) for k, t in enumerate(other)]
    rows += [(200, "Released under the MIT License.\nwords between\nReleased under the MIT License.\n\n"
                   "Released under\nthe MIT License.")]
    got = {r.doc_id: (r.n_license, r.families) for r in
           licenses.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (t, f) in enumerate(CASES.items()):
        assert got[k] == (int(f != ""), f), t
    assert all(got[100 + k] == (0, "") for k in range(60))
    assert got[200] == (3, "MIT")


def test_templates_tell_only_their_family(spark):
    every = [(f, t) for f in licenses.FAMILIES for t in licenses.TEMPLATES[f]]
    df = spark.createDataFrame(every, "family string, line string")
    w = licenses._bare(licenses._tokens(df.line))
    tells = df.select("family", "line", licenses._tells(licenses._spelled(w)).alias("tells"),
                      df.line.rlike(licenses._ANCHOR).alias("anchor")).collect()
    for r in tells:
        assert [f for f, t in zip(licenses.FAMILIES, r.tells) if t] == [r.family], r.line
        assert r.anchor, r.line


def test_unknown_is_learnt_from_every_line_that_is_scored(spark):
    # more distinct lines than the 4,000 that a sample once was bounded by, one of them twice
    lines = [f"the gnu of herd {k} stood by gate {k % 7}" for k in range(4_500)]
    docs = spark.createDataFrame([(k, f"{x}\n\nno anchor {k}\n{lines[0]}\nReleased under the MIT License.")
                                  for k, x in enumerate(lines)], "doc_id long, text string")
    got = licenses.unknown_lines(licenses.anchored(docs)).groupBy("held").count().collect()
    assert sum(r["count"] for r in got) == 4_500
    assert 1_300 < {r.held: r["count"] for r in got}[True] < 1_700
    _, threshold = licenses.fit(spark, licenses.anchored(docs))
    assert 0.5 <= threshold <= 0.9
