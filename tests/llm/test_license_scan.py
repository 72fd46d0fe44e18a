import math
import re
from collections import Counter

from tidewatch.llm import license_scan as ls

APACHE = "Licensed under the Apache License, Version 2.0."


def files(spark, rows):
    return spark.createDataFrame(rows, "path string, text string")


def brute(rows, threshold=ls.THRESHOLD):
    """path -> (license, basis, score, found_in), with every unit compared with every template."""
    index = ls.TemplateIndex()

    def best(text):
        bag = Counter(t for t in re.split(ls.SEPARATOR, text.lower()) if t and t not in ls.STOP_WORDS)
        norm = math.sqrt(sum((n * index.idf.get(t, index.other)) ** 2 for t, n in bag.items()))
        found = [(round(sum(n * index.idf[t] * index.weight[t][k] for t, n in bag.items() if t in index.idf) / norm, 9), -k)
                 for k in range(len(index.names))] if norm else [(0, 0)]
        return max(found)
    own = {}
    for path, text in rows:
        text = text or ""
        for unit, part in enumerate([text, *text.split("\n")]):
            score, k = best(part)
            if score >= threshold:
                own[path] = max(own.get(path, (False,)), (unit == 0, score, -unit, index.names[-k]))
    out = {}
    for path, _ in rows:
        if path in own:
            whole, score, _, name = own[path]
            out[path] = (name, "file" if whole else "header", score, path)
            continue
        folder = path.rpartition("/")[0]
        out[path] = (None, None, None, None)
        while True:
            here = [(-own[p][1], p) for p in own if p.rpartition("/")[0] == folder and re.match(ls.LICENSE_FILE, p.rpartition("/")[2])]
            if here:
                score, p = min(here)
                out[path] = (own[p][3], "inherited", -score, p)
                break
            if not folder:
                break
            folder = folder.rpartition("/")[0]
    return out


def check(spark, rows):
    found = {r.path: (r.license, r.basis, r.score, r.found_in) for r in ls.scan(files(spark, rows)).collect()}
    expected = brute(rows)
    assert set(found) == set(expected)
    for path, (name, basis, score, where) in expected.items():
        assert found[path][0] == name and found[path][1] == basis and found[path][3] == where, path
        assert score is None or abs(found[path][2] - score) < 1e-8


def test_templates_and_inheritance(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    rows = [("LICENSE", APACHE), ("a.py", "no licence here"), ("lib/COPYING.txt", "Released under the MIT License.\n"), ("lib/x/y/z.c", "int main;"),
            ("lib/x/license", "nothing known"), ("lib/x/w.c", f"// {mit}\ncode"), ("lib/NOTICE", "Licensed under CC BY-NC 4.0."),
            ("lib2/q", "SPDX-License-Identifier: GPL-2.0-only\nrest of it"), ("deep/a/b/c/d/e", ""), ("lib/x/y/LICENSE", None),
            ("doc/text", "words about the license, the version and the public work in general " * 40 + "\n" + APACHE + "\nmore")]
    check(spark, rows)
    got = {r.path: r for r in ls.scan(files(spark, rows)).collect()}
    assert (got["LICENSE"].license, got["LICENSE"].basis) == ("Apache-2.0", "file")
    assert (got["lib/x/y/z.c"].basis, got["deep/a/b/c/d/e"].found_in) == ("inherited", "LICENSE")
    assert (got["doc/text"].license, got["doc/text"].basis) == ("Apache-2.0", "header")


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check(spark, [(f"{r.source}/{'LICENSE' if r.doc_id % 7 == 0 else 'f'}-{r.doc_id}", r.text) for r in docs])


def test_odd_rows(spark):
    rows = [("a/LICENSE", APACHE), ("a/f", None), ("a/g", ""), ("a/h", "word " * 50_000), ("a/f", None), ("license version license " * 3000, "x"), (None, APACHE)]
    wide = files(spark, rows).selectExpr("*", "1 as license", "2 as unit", "3 as term", "4 as score")
    got = {r.path: r.basis for r in ls.scan(wide).collect()}
    assert got[""] == "file" and got["a/f"] == got["a/g"] == got["a/h"] == "inherited" and len(got) == 6
    assert ls.scan(files(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    text = ls.scores(files(spark, [("a", APACHE)]), ls.TemplateIndex(), 0.75)._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text
