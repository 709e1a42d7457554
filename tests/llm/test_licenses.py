import math
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from sparkload.llm.licence_texts import APACHE_2, BODIES, MIT
from sparkload.llm.licenses import FILE_SHARE, LEAST_SIMILARITY, LEAST_WHOLE, MARKERS, TEMPLATES, own_licences, scan_licences, terms_of

SCHEMA = "doc_id long, path string, text string, directory string"
PROSE = "some words that go on about the work and the version of it, under no terms at all.\n"
ROWS = [
    (1, "a/LICENSE", "Released under the MIT License"),
    (2, "a/x.txt", PROSE * 3),
    (3, "a/b/y.txt", PROSE * 2),
    (4, "a/b/c/z.txt", PROSE + "Licensed under the Apache License, Version 2.0.\n" + PROSE * 9),
    (5, "a/b/c/w.txt", PROSE),
    (6, "a/d/COPYING", "This work is licensed under the GNU General Public License, version 3.\nThanks."),
    (7, "a/d/NOTICE", "This work is licensed under the GNU General Public License, version 2.\nThanks."),
    (8, "a/d/e/f/g.txt", "license license license of nothing in particular whatever it may be called"),
    (9, "top.txt", PROSE + "copyright of somebody"),
    (10, None, "Licensed under CC BY-NC 4.0"),
    (11, "q/r.txt", None),
    (12, "q/s.txt", ""),
    (12, "q/s.txt", ""),
    (None, "a/t.txt", PROSE),
    (13, "a/d/u.txt", "word " * 30_000 + "\nSPDX-License-Identifier: MIT\n" + "licence " * 20_000),
    (14, "q/CC", "LICENSED UNDER CC BY 4.0"),
    (15, "h/first.py", "Licensed under the Apache License, Version 2.0\n" + PROSE * 9),
    (16, "h/wrapped.py", PROSE * 4 + "Licensed under a Creative Commons\nAttribution-ShareAlike 4.0\nInternational License\n" + PROSE * 4),
    (17, "h/inside.py", PROSE.strip() + " Released under the MIT License. " + PROSE),
    (18, "m/terms.txt", "Copyright (c) 2019 Somebody Else\n\n" + MIT.replace(". ", ".\n")),
    (19, "m/n/x.txt", PROSE),
    (20, "p/terms.txt", "\n".join(APACHE_2[k : k + 70] for k in range(0, len(APACHE_2), 70))),
    (21, "p/x.txt", PROSE),
    (22, "b/terms.txt", "Copyright 2001 X. All rights reserved.\n" + dict(BODIES)["BSD-3-Clause"]),
    (23, "b/c/x.txt", PROSE),
]


def brute_force(rows):
    marked = re.compile("(^|[^a-z0-9])(" + "|".join(MARKERS) + ")($|[^a-z0-9])")
    vocabulary = {t for _, text in (*TEMPLATES, *BODIES) for t in terms_of(text)}
    df = Counter(t for _, _, text in rows for t in set(terms_of(text or "")) & vocabulary)
    n = len(rows)
    idf = {t: math.log((1 + n) / (1 + df[t])) for t in vocabulary}

    def similar(text, whole):
        words = Counter(terms_of(text))
        square = sum((c * idf[t]) ** 2 if t in vocabulary else c * math.log(1 + n) ** 2 for t, c in words.items())
        found = []
        for k, (licence, template) in enumerate((*TEMPLATES, *BODIES)):
            if (k >= len(TEMPLATES)) != whole:
                continue
            own = Counter(terms_of(template))
            length = math.sqrt(sum((c * idf[t]) ** 2 for t, c in own.items()))
            dot = sum(words[t] * c * idf[t] ** 2 for t, c in own.items())
            value = round(dot / math.sqrt(square) / length, 6) if square and length else 0.0
            if value >= (LEAST_WHOLE if whole else LEAST_SIMILARITY):
                found.append((value, -k, sum(words.values()), licence, whole))
        return found

    own, files = [], {}
    for i, path, text in rows:
        found, text = [], text or ""
        if marked.search(text.lower()):
            lines = re.sub(r"([.!?;])[ \t\r\n]+", "\\1\n", text).split("\n")
            for at in range(len(lines)):
                for end in range(at + 1, min(at + 3, len(lines)) + 1):
                    if any(marked.search(x.lower()) for x in lines[at:end]):
                        found += similar(" ".join(lines[at:end]), False)
            found += similar(text, True)
        best = max(found, default=None)
        directory = re.sub("/?[^/]*$", "", path or "")
        own.append((i, directory, best and best[3], best and best[0]))
        named = re.search(r"(?i)(^|/)(licen[cs]e|copying)([-_.][^/]*)?$", path or "")
        if best and (named or best[4] or best[2] / len(terms_of(text)) >= FILE_SHARE):
            files.setdefault(directory, []).append((best[0], -(i if i is not None else 2**63 - 1), best[3]))
    out = []
    for i, directory, licence, value in own:
        above, found = directory, None
        while licence is None:
            if above in files:
                found = max(files[above])[2]
                break
            if not above:
                break
            above = above.rpartition("/")[0]
        origin = "own" if licence else "inherited" if found else "none"
        out.append((i, licence or found, value, origin, above if origin == "inherited" else None))
    return out


def test_rows_equal_brute_force(spark):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA).repartition(3)
    got = [tuple(r) for r in scan_licences(docs, F.col("path")).collect()]
    want = brute_force(ROWS)
    assert sorted(got, key=str) == sorted(want, key=str)
    by_id = {r[0]: r[1:] for r in want}
    assert by_id[3] == ("MIT", None, "inherited", "a") and by_id[4][0] == "Apache-2.0" and by_id[5][2:] == ("inherited", "a")
    assert by_id[6][0] == "GPL-3.0" and by_id[7][0] == "GPL-2.0" and by_id[8][2:] == ("inherited", "a/d") and by_id[2][0] == "MIT"
    assert by_id[10][0] == "CC-BY-NC-4.0" and by_id[9][0] == "CC-BY-NC-4.0" and by_id[14][0] == "CC-BY-4.0"
    assert by_id[15][0] == "Apache-2.0" and by_id[16][0] == "CC-BY-SA-4.0" and by_id[17][0] == "MIT"
    assert by_id[18][0] == "MIT" and by_id[19][2:] == ("inherited", "m") and by_id[19][0] == "MIT"
    assert by_id[20][0] == "Apache-2.0" and by_id[21][0] == "Apache-2.0" and by_id[22][0] == by_id[23][0] == "BSD-3-Clause"


def test_empty_table(spark):
    found = scan_licences(spark.createDataFrame([], SCHEMA), F.col("path"))
    assert found.columns == ["doc_id", "licence", "similarity", "origin", "directory"] and found.count() == 0


def test_no_python_on_the_way(spark):
    plan = scan_licences(spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA), F.col("path"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_many_lines_take_linear_work(spark):
    text = "a licence of some kind\n" * 100_000 + "Released under the MIT License\n" + "\n".join(f"licence {k}" for k in range(20_000))
    docs = spark.createDataFrame([(1, "x/y", text, None), *[(k, "x/z", PROSE, None) for k in range(2, 9)]], SCHEMA)
    start = time.perf_counter()
    (row,) = own_licences(docs, F.col("path")).filter("id = 1").collect()
    assert row.licence == "MIT" and time.perf_counter() - start < 60
