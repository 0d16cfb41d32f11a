import re

from adfuse.llm import license_scan as L
from edge import edge_rows, empty, frame

MIT = next(t.text for t in L.TEMPLATES if t.text.startswith("Permission is hereby granted, free of charge"))


def brute(text):
    """All places of the base phrases, word by word."""
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(L.WORD, fold)
    found = [
        (k, t.label)
        for t in L.TEMPLATES
        if t.exact
        for k in range(len(words))
        if words[k : k + len(t.words)] == t.words
    ]
    at = [k for k, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_base_places(spark):
    rows = edge_rows() + [
        (21, "Under the MIT license. under the mit-license, CC BY-NC; Apache License (Version 2.0)"),
        (22, "cc by nc " * 4000),
        (23, "cc by"),
        (24, "under the mit licensé"),
    ]
    got = L.scan_licenses(frame(spark, rows)).collect()
    want = sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert sorted(
        ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str
    ) == want
    assert L.scan_licenses(empty(spark)).count() == 0


def test_votes_find_edited_and_shifted_copies(spark):
    words = MIT.split()
    edited = " ".join(words[:12] + ["an", "extra", "remark"] + words[12:30] + words[32:])
    rows = [
        (1, "intro words " * 30 + MIT + " outro"),
        (2, edited),
        (3, " ".join(words[:20])),  # a third of the notice is not the notice
        (4, "This work is licensed under the GNU General Public License, version 2."),
        (5, "This work is licensed under the GNU General Public License, version 3."),
        (6, " ".join(reversed(words))),
    ]
    got = {r.doc_id: r for r in L.scan_licenses(frame(spark, rows)).collect()}
    assert got[1].labels == "mit" and got[1].score == 1.0
    (m,) = got[1].matches
    assert (m.first, m.last) == (60, 60 + len(L.Template("", MIT).words) - 1)
    assert got[2].labels == "mit" and 0.6 < got[2].score < 1
    assert got[3].labels == "" and got[3].score == 0 and got[6].labels == ""
    assert got[4].labels == "gpl-2" and got[5].labels == "gpl-3"


NOTICE = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0}General Public "
    "License as published by the Free Software Foundation; either version {1} of the License, or (at your option) any "
    "later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."
)


def test_standard_notices(spark):
    want = [
        (NOTICE.format("", "2"), "gpl-2"),
        (NOTICE.format("", "3"), "gpl-3"),
        (NOTICE.format("Lesser ", "2.1"), "lgpl"),
        (NOTICE.format("Lesser ", "3"), "lgpl"),
        (NOTICE.format("Library ", "2"), "lgpl"),
        (NOTICE.format("Affero ", "3"), "agpl-3"),
        ("under the terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation.", "gpl-2"),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n", "gpl-3"),
        ("                    GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n", "agpl-3"),
        ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND' + L.WHOLE[-1][1].split("of any kind")[1], "mit"),
        ("a mention of the GNU General Public License, version 2, and no more", ""),
    ]
    rows = [(k, "// some words before\n" + text) for k, (text, _) in enumerate(want)]
    got = {r.doc_id: r.labels for r in L.scan_licenses(frame(spark, rows)).collect()}
    assert [got[k] for k in range(len(want))] == [label for _, label in want]


def test_whole_texts(spark):
    rows = []
    for k, (_, text) in enumerate(L.WHOLE):
        words = text.split()
        rows += [(k, "some words before " + text), (100 + k, " ".join(w for i, w in enumerate(words) if i % 40))]
    got = {r.doc_id: r for r in L.scan_licenses(frame(spark, rows, extra=False)).collect()}
    for k, (label, text) in enumerate(L.WHOLE):
        n = len(text.split())
        assert got[k].labels == label and got[k].score == 1.0
        assert (3, 2 + n, label, 1.0) in [tuple(m) for m in got[k].matches]
        assert label in got[100 + k].labels.split(",") and 0.6 < got[100 + k].score <= 1
        if n > 600:  # the first words of shorter texts are a notice that is covered better
            (m,) = [m for m in got[100 + k].matches if m.last - m.first > 0.8 * n]
            assert m.label == label and 0.6 < m.cover < 1


def test_plan_has_no_python(spark):
    plan = L.scan_licenses(frame(spark, edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "BroadcastHashJoin" in plan
