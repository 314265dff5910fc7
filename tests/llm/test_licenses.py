import random
from collections import Counter

import pytest
from conftest import SF

from setforge.llm import licenses
from setforge.llm.licenses import TEMPLATES, WORDS, Templates, licensed, op7_license_scan


def test_headers_files_and_directories(spark):
    rows = [
        ("a/LICENSE", "MIT text\nReleased under the MIT License."),
        ("a/b/x.py", "hello"),
        ("a/b/c/y.py", "x"),
        ("a/b/c/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
        ("a/b/c/own.py", "# This program is free software: you can redistribute it and/or modify it under the terms\n# of the GNU General Public License as published by the Free Software Foundation, either\n# version 3 of the License, or (at your option) any later version.\nimport os\n" + "value = other thing entirely\n" * 40),
        ("ab/z.py", "the license of this text is not given"),
        ("z.py", None),
        ("", ""),
        (None, "All rights reserved."),
        ("a/b/x.py", "hello"),
    ]
    got = [tuple(r) for r in licensed(spark.createDataFrame(rows, "path string, text string")).collect()]
    by = {r[0]: (r[1], *r[3:]) for r in got}
    assert len(got) == len(rows)
    assert by["a/LICENSE"] == ("MIT", "file", None) and by["a/b/x.py"] == ("MIT", "inherited", "a")
    assert by["a/b/c/y.py"] == ("Apache-2.0", "inherited", "a/b/c") and by["a/b/c/own.py"] == ("GPL-3.0", "header", None)
    assert by["ab/z.py"] == by["z.py"] == by[""] == (None, None, None)
    assert by[None] == ("proprietary", "file", None)


def test_headers_at_two_sizes(spark):
    notices = {
        "// Copyright 2021 Jane Doe. All rights reserved.": "proprietary",
        "All rights reserved worldwide": "proprietary",
        "code of Zyxwv Qrst, released under the MIT license since 2019 by Abcde": "MIT",
        "all rights of the people and seats reserved for the guests": None,
    }
    got = []
    for n in (600, 6000):
        rows = [(f"d{i}/x.py", f"copyright of file{i}\nvalue{i} is the sum of the parts and it returns name{i % 50}\n") for i in range(n)]
        for i in range(0, n, 150):
            for k, notice in enumerate(notices):
                rows.append((f"{k}/{i}.py", f"{notice}\n" + rows[i][1] * 3))
        out = licensed(spark.createDataFrame(rows, "path string, text string")).where("path not like 'd%'").select("path", "licence", "score").collect()
        got.append({k: {r.licence for r in out if r.path.startswith(f"{k}/")} for k in range(len(notices))})
    assert got[0] == got[1] == {k: {v} for k, v in enumerate(notices.values())}


def test_runs_of_words_are_those_of_brute_force():
    rng = random.Random(0)
    model = Templates(TEMPLATES)
    model.weigh(100, {w: rng.randrange(1, 100) for w in model.words[::2]} | {"and": 90, "x": 50})
    for _ in range(60):
        words = rng.choices([*model.words, "x", "y"], k=rng.randrange(0, 40))
        words += (taken := rng.choice([WORDS(t.lower()) for ts in TEMPLATES.values() for t in ts]))[: rng.randrange(1, len(taken) + 1)] + rng.choices(["x", "y", "and"], k=5)
        want = 0.0
        for t, m in enumerate(model.sizes):
            for i in range(len(words) - m + 1):
                bag = Counter(words[i : i + m])
                if 4 * sum((bag & model.bags[t]).values()) >= 3 * m and (score := model.cosines(bag)[t]) >= 0.6:
                    want = max(want, score)
        assert abs(model.run(words, 0.6)[0] - want) < 1e-9


def test_documents_with_notices(spark, documents):
    got = {r.doc_id: r for r in op7_license_scan(spark, SF).collect()}
    notices = {"Licensed under the Apache License": "Apache-2.0", "Released under the MIT License": "MIT", "GNU General Public License, version 3": "GPL-3.0", "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0", "All rights reserved.": "proprietary"}
    for doc_id, text in documents:
        want = {v for k, v in notices.items() if k in (text or "")}
        own = got[doc_id].licence if got[doc_id].origin in ("file", "header") else None
        assert own in want if want else own is None


def test_a_notice_among_unrelated_documents(spark):
    """Files without path license nobody; one hot folder takes its licence whole, keys are carried along."""
    rows = [(i, None if i % 2 else f"hot/{i}.py", "a text about the weather of the year") for i in range(400)]
    rows += [(900, None, "Released under the MIT License."), (901, "hot/LICENSE", "Licensed under the Apache License, Version 2.0."), (None, None, None)]
    files = spark.createDataFrame(rows, "k long, path string, text string")
    got = licensed(files, keys=["k"]).collect()
    assert len(got) == len(rows)
    by = {r.k: (r.licence, r.origin, r.licence_dir) for r in got}
    assert {by[i] for i in range(1, 400, 2)} | {by[None]} == {(None, None, None)}
    assert {by[i] for i in range(0, 400, 2)} == {("Apache-2.0", "inherited", "hot")}
    assert by[900] == ("MIT", "file", None) and by[901] == ("Apache-2.0", "file", None)
    with pytest.raises(ValueError):
        licensed(files.withColumn("score", files.k), keys=["score"])


def test_query_inherits_nothing(spark):
    rows = op7_license_scan(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.origin in (None, "file", "header") and (r.origin is None) == (r.licence is None) for r in rows)


def test_no_rows(spark, nothing, odd):
    assert licensed(nothing.selectExpr("source AS path", "text", "lang")).count() == 0
    assert licensed(odd.selectExpr("source AS path", "text", "lang AS dir", "doc_id AS score")).count() == odd.count()


def test_texts_without_paths_look_for_no_directory(spark, monkeypatch):
    rows = [(1, "Released under the MIT License."), (2, "the weather of the year"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with_paths = licensed(docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS path", "text"), keys=["doc_id"])
    written = []
    monkeypatch.setattr(licenses, "stage", lambda df, keep=licenses.stage: (written.append(df.columns), keep(df))[1])
    got = licensed(docs, keys=["doc_id"])
    assert written == [["word", "files"]] and got.dtypes == with_paths.dtypes
    assert sorted(got.collect(), key=lambda r: r.doc_id) == sorted(with_paths.collect(), key=lambda r: r.doc_id)
    assert got.where("licence = 'MIT' AND origin = 'file'").count() == 1
