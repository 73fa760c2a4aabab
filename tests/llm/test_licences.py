import hashlib
import textwrap

import cases

from headway.llm import licences, queries
from headway.llm.licence_texts import KNOWN


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], cases.SCHEMA)
    return {r.doc_id: r for r in licences.licence_scan(docs).collect()}


def test_whole_texts_with_other_case_marks_spelling_and_holders(spark):
    mit = next(t for n, t in KNOWN if n == "MIT")
    out = scan(spark, [
        mit, mit.upper().replace(",", " ;"), "Copyright (c) 2020 Some One\n\n" + mit, "(c) X\n© Y\n" + mit.replace("\n", "\n\n  "),
        mit + " And more.", mit[:-20], "prose without any",
    ])
    assert [out[i].licence for i in range(7)] == ["MIT"] * 4 + [None] * 3
    assert len({out[i].digest for i in range(4)}) == 1


def test_notice_lines(spark):
    out = scan(spark, [
        "Some prose.\nReleased under the MIT Licence.\nMore.", "This work is licensed under the GNU General Public License, version 3.",
        "a\nLICENSED UNDER CC-BY-NC v4.0\nReleased under the MIT License!", "He licensed under the table.", "SPDX-License-Identifier: ISC",
    ])
    assert [list(out[i].notices) for i in range(5)] == [["MIT"], ["GPL-3.0"], ["CC-BY-NC-4.0", "MIT"], [], ["ISC"]]
    assert out[1].licence == "GPL-3.0" and out[0].licence is None


def test_no_digest_stands_for_two_licences(spark):
    known = licences.known_licences(spark).collect()
    assert len({r.digest for r in known}) == len(known)
    rows = spark.createDataFrame(KNOWN, "licence string, text string")
    found = scan(spark, [r.text for r in rows.collect()])
    assert [found[i].licence for i in range(len(KNOWN))] == [n for n, _ in KNOWN]


def test_awkward_rows(spark):
    docs = cases.clashing(cases.documents(spark))
    out = licences.licence_scan(docs)
    assert out.count() == docs.count()
    assert out.filter("licence IS NOT NULL OR size(notices) > 0").count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.digest for r in out.filter("doc_id IN (1000, 1001, 1002)").collect()} == {empty}
    assert licences.licence_scan(docs.limit(0)).count() == 0


def wrapped(text, width):
    paragraphs = text.split("\n\n")
    return "\n\n".join(textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in paragraphs)


# First words and licence of texts that must be known in full, by hand.
WHOLE = {
    "Apache License Version 2.0, January 2004": "Apache-2.0",
    "GNU GENERAL PUBLIC LICENSE Version 2, June 1991": "GPL-2.0",
    "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007": "GPL-3.0",
    "Mozilla Public License Version 2.0": "MPL-2.0",
    "Creative Commons Legal Code CC0 1.0 Universal": "CC0-1.0",
    "Permission is hereby granted, free of charge, to any person": "MIT",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "Redistribution and use in source and binary forms": "BSD-2-Clause",
}


def whole(start):
    found = [t for _, t in KNOWN if " ".join(t.split()).startswith(start)]
    assert found and all(len(t.split()) > 150 for t in found)
    return min(found, key=len)


def test_whole_texts_rewrapped_commented_and_with_other_marks(spark):
    texts, want = [], []
    for start, name in WHOLE.items():
        text = whole(start)
        texts += [
            wrapped(text, 30), wrapped(text, 57), wrapped(text, 100),
            "\n".join(f"# {line}" for line in text.split("\n")),
            text.replace('"', "\u201c").replace("'", "\u2019").replace(" - ", " \u2014 ").replace("  ", "\u00a0 "),
            text.replace("\n", "\r\n"), text.upper(),
        ]
        want += [name] * 7
    out = scan(spark, texts)
    assert [out[i].licence for i in range(len(texts))] == want


def test_copyright_lines_by_hand():
    body = whole("Permission is hereby granted")
    same = licences.digest(body)
    for head in (
        "# Copyright (c) 2020 A B", " * Copyright 2019-2021, A B", "// (c) A B", "\u00a9 2020 A", "Copyright (c) <year> <holders>",
        "Copyright (c) A B\nAll rights reserved.", "Copyright A B\n", "(C) 2001 A\nCopyright (C) 2002 B",
    ):
        assert licences.digest(f"{head}\n{body}") == same, head
    for line in ("copyright holders be liable", "(c) you must retain the notices", "copyright law of this state and", "rights"):
        assert licences.canonical(licences.words(f"some\n{line}\nmore")).split()[1:-1] == [
            w.encode() for w in line.replace("(", "").replace(")", "").split() if w != "the"
        ]


def test_notices_without_the_word_licence_and_very_long_lines(spark):
    out = scan(spark, ["Released under MIT.\nprose", "a\n\u2022 Available under Apache 2.0 \u2022", "under " * 200_000, "x" * 1_000_000])
    assert [list(out[i].notices) for i in range(4)] == [["MIT"], ["Apache-2.0"], [], []]


def test_every_known_text_has_a_telling_word():
    telling = licences.telling_words()
    assert all(not telling.isdisjoint(licences.words(t)) for _, t in KNOWN)


def test_registered_query_by_hand(spark, tmp_path):
    mit = whole("Permission is hereby granted")
    texts = ["Copyright (c) 2020 A\n" + wrapped(mit, 40), "Released under the MIT License.\nprose", None, "", "Licensed under CC BY 4.0."]
    spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], cases.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in queries.op10_licence_scan(spark, str(tmp_path)).collect()}
    assert [out[i].licence for i in range(5)] == ["MIT", None, None, None, "CC-BY-4.0"]
    assert [out[i].notices for i in range(5)] == ["", "MIT", "", "", "CC-BY-4.0"]
    assert out[2].digest == out[3].digest == hashlib.sha256(b"").hexdigest()
