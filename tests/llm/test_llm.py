"""The operators of tidemark.llm against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tests.compare import connect, difference
from tidemark.llm import (
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    pieces,
    queries,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    token_counts,
    warc,
)

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, size int"
LONG = "very long words and more of them " * 6000
EDGES = [
    (1, None, "en", None, None, 1, 1),
    (2, "", None, "s", 0, 2, None),
    (3, "one two three four five six seven", "en", "s", 33, None, 3),
    (3, "one two three four five six seven", "en", "s", 33, None, 3),
    (4, "ONE two\tthree four\nfive six seven", "en", "s", 33, 4, 4),
    (None, "one two three four five six seven", None, None, 1, 1, 1),
    (5, LONG, "en", "s", len(LONG), 5, 5),
    (6, LONG, "en", "s", len(LONG), 6, 6),
    (7, "!!! 123  ", "de", "s", 9, 7, 7),
    (8, "naïve été 中文 😀 \x00 ▁", "fr", "s", 9, 8, 8),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def texts_of(spark):
    return {r.doc_id: r.text or "" for r in table(spark, "documents").select("doc_id", "text").collect()}


# -- 1 ---------------------------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    lattice = language_id.lattice(pieces.default_model())
    probs = np.random.RandomState(1).rand(lattice.size + 1, 1)

    def brute(word):
        if not word:
            return 1.0
        heads = [(word[:n], lattice.ids.get(word[:n])) for n in range(1, len(word) + 1)]
        total = sum(probs[p, 0] * brute(word[len(h) :]) for h, p in heads if p is not None)
        return total if heads[0][1] is not None else total + probs[lattice.size, 0] * brute(word[1:])

    for word in ("a", "other", "été", "x中y"):
        assert language_id.forward(lattice.edges(word), probs)[-1][0] == pytest.approx(brute(pieces.BLANK + word))

    words = ["a", "other", "été", "x中y", "a", "𝄞", "z" * 32]
    wide = np.random.RandomState(2).rand(lattice.size + 1, 3)
    found = language_id.word_sums(words, pieces.default_model(), wide)
    for word, sums in zip(words, found):
        assert sums == pytest.approx(language_id.forward(lattice.edges(word), wide)[-1])


@needs_tables
def test_language_accuracy_on_held_out(spark):
    docs = table(spark, "documents")
    found = language_id.op1(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right = found.where("lang = lang_pred").count()
    assert right >= 0.9 * found.count() > 0


def test_language_edges(edges, empty):
    rows = language_id.op1(edges).collect()
    assert len(rows) == len(EDGES)
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 7))
    assert all(0 <= r.score <= 1 for r in rows)
    assert language_id.op1(empty).count() == 0
    assert language_id.keep_identified(edges).columns == edges.columns


# -- 2 ---------------------------------------------------------------------------------------


def brute_components(docs):
    sets = []
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets.append((doc_id, grams))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((d, len(s), least[root(i)]) for i, (d, s) in enumerate(sets))


def test_join_equals_brute_force(spark):
    rng = random.Random(4)
    docs = []
    for family in range(12):
        words = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 14)):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(["x", "y", "AA"])
            docs.append((len(docs), " ".join(copy)))
    docs += [(900, " ".join(["a", "b"] * 40)), (901, " ".join(["a", "b"] * 41)), (902, ""), (903, " ")]
    found = ngram_join.join_components(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted(tuple(r) for r in found.collect()) == brute_components(docs)


def test_join_edges(edges, empty):
    rows = ngram_join.join_components(edges).collect()
    assert len(rows) == len(EDGES)
    by_id = {r.doc_id: tuple(r)[1:] for r in rows}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2)
    assert by_id[3] == by_id[4] == by_id[None] == (3, 3)
    assert by_id[5] == by_id[6] and by_id[6][1] == 5
    assert ngram_join.join_components(empty).count() == 0


def test_sets_of_a_crowded_ngram_meet_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    docs = []
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(2, 6)):
            copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 40)}"
        docs.append((len(docs), " ".join(copy)))
    expected = brute_components(docs)
    compared, check = [], ngram_join.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return check(pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", counted)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in ngram_join.join_components(df).collect()) == expected
    sets = [s for s in ngram_join.shingle_sets(pa.array([t for _, t in docs]))]
    links = sum(
        100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for k, a in enumerate(sets) for b in sets[:k]
    )
    assert len({c for _, _, c in expected}) > 50 and compared[-1] <= 3 * links
    monkeypatch.setattr(ngram_join, "CROWDED", 2)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    assert sorted(tuple(r) for r in ngram_join.join_components(df).collect()) == expected


# -- 3 and 5 ---------------------------------------------------------------------------------


def odd_texts():
    rng = random.Random(2)
    letters = "abcdetho \n😀é中▁"
    return ["", " ", "  a  b ", "a" * 300, "<s> <0x41>", "x" + " " * 90 + "y", LONG[:3000]] + [
        "".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(300)
    ]


def test_encoding_and_counts_equal_the_library():
    import sentencepiece

    model = pieces.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = odd_texts()
    want = library.encode(texts, num_threads=1)
    ids, borders = sentencepiece_codec.encoder(model).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(borders, borders[1:])] == want
    assert sentencepiece_codec.decode_ids(model, ids, borders) == [t.replace("▁", " ") for t in texts]
    machine = token_counts.transducer(model)
    for text, one in zip(texts, want):
        written = token_counts._written(text)
        assert machine.count_all(pieces.SEGMENT.findall(written)) == len(one)
        for size in (2, 7):
            maps = [token_counts.chunk_map(machine, written[i : i + size]) for i in range(0, len(written), size)]
            if maps:
                assert token_counts.total(machine, token_counts.scan(machine, maps)) == len(one)


def test_codec_edges(edges, empty):
    rows = sentencepiece_codec.op3(edges).collect()
    assert len(rows) == len(EDGES)
    assert all(r.exact for r in rows if r.doc_id != 8)
    assert {r.doc_id: r.n_tokens for r in rows}[1] == 0
    assert sentencepiece_codec.op3(empty).count() == 0


def test_count_edges(edges, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rows = token_counts.count_tokens(edges, chunk_chars=5000).collect()
    want = sorted(
        (str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in EDGES
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)
    assert token_counts.count_tokens(empty).count() == 0


# -- 4 ---------------------------------------------------------------------------------------

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def test_licenses(spark, edges, empty):
    docs = [
        (1, MIT),
        (2, "Words\nLicensed under CC BY-NC 4.0.\nmore words. Licensed under the Apache License, Version 2.0. End"),
        (3, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. All rights reserved."),
        (4, "a license is discussed here"),
        (5, None),
    ]
    rows = license_scan.op4(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.licenses, r.unmatched) for r in rows} == {
        1: ("MIT", "mit-title"),
        2: ("Apache-2.0,CC-BY-NC-4.0", ""),
        3: ("MPL-2.0", "all-rights-reserved"),
    }
    assert license_scan.op4(edges).count() == 0
    assert license_scan.op4(empty).count() == 0


def test_every_licence_rule_has_a_text_that_matches(spark):
    known, sequences = license_scan.sentence_rules(spark)
    texts = dict(license_scan.SENTENCES)
    docs = [
        (n, "\n\n".join(texts[x].replace("{v}", "3.0") for x in rule)) for n, (_, rule) in enumerate(license_scan.RULES)
    ]
    rows = license_scan.op4(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    want = {n: name.replace("{v}", "3.0") for n, (name, _) in enumerate(license_scan.RULES)}
    assert {r.doc_id: r.licenses for r in rows} == want and all(r.unmatched == "" for r in rows)


def test_standard_licence_notices(spark):
    notice = """# This {what} is free software{sign} you can redistribute it and/or modify
# it under the terms of the GNU {kind} Public License as published by
# the Free Software Foundation{second} either version {v} of the License, or
# (at your option) any later version.
#
# This {what} is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU {kind} Public License for more details.
"""
    def text(kind, v, what="program", sign=":", second=","):
        return "#!/bin/sh\n" + notice.format(kind=kind, v=v, what=what, sign=sign, second=second)

    docs = [
        (1, text("General", 3)), (2, text("General", 2, sign=";", second=";")),
        (3, text("Affero General", 3)), (4, text("Lesser General", 2.1, "library", ";", ";")),
        (5, "// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR mit\nint x"),
        (6, "/* SPDX-License-Identifier: GPL-2.0+ */ <!-- SPDX-License-Identifier: Foo-1.0-->"),
        (7, "some words here\nLicensed under the Apache License,\nVersion 2.0\nand more words"),
    ]
    rows = license_scan.op4(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.licenses, r.unmatched) for r in rows} == {
        1: ("GPL-3-or-later", ""), 2: ("GPL-2-or-later", ""), 3: ("AGPL-3-or-later", ""),
        4: ("LGPL-2.1-or-later", ""), 5: ("GPL-2.0-only,MIT", ""), 6: ("GPL-2.0+", "spdx-foo-1.0"),
        7: ("Apache-2.0", ""),
    }


# -- 6 ---------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    pages = [
        (5, "http://a/é\r\nx", "same", 1), (2, None, "same", 2), (2, "http://b", "same", 2),
        (7, "http://c", None, 3), (8, "", "", 4), (None, "http://d", "same", 5), (9, "u", LONG, 6),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string, sha int")
    files = warc.cut(warc.write(frame, warc.new_folder(spark, "warc")), "files")
    rows = warc.read(files).collect()
    assert len(rows) == len(pages)
    kinds = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in rows)
    assert kinds == sorted([
        ("5", "revisit", "2"), ("2", "response", "None"), ("2", "response", "None"), ("7", "response", "None"),
        ("8", "revisit", "7"), ("None", "revisit", "2"), ("9", "response", "None"),
    ])
    for r in rows:
        payload = (next(p[2] for p in pages if p[0] == r.page_id) or "").encode()
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r.payload is None or bytes(r.payload) == payload
    assert warc.op6(frame.limit(0)).count() == 0
    plain = warc.read(warc.cut(warc.write(frame, warc.new_folder(spark, "warc"), least_bytes=5), "files"))
    assert {r.record_type for r in plain.collect()} == {"response"}


def test_damaged_archives_are_refused():
    import io

    good = warc.record(1, "http://a", b"payload", None, False)

    def found(data):
        return [warc.content(*r) for r in warc.records(io.BytesIO(data))]

    size = len(good) - good.find(b"\r\n\r\n") - 8
    packed = warc.member(good) + warc.member(good)
    assert found(packed) == [(b"payload", 7)] * 2
    for bad in (
        warc.member(good.replace(b"payload", b"paxload")),
        packed[:-9],
        warc.member(good[:-1]),
        warc.member(good.replace(b"Content-Length: %d" % size, b"Content-Length: %d" % (size - 1), 1)),
        warc.member(b"no record\r\n\r\n"),
        b"not gzip",
    ):
        with pytest.raises(warc.Damaged):
            found(bad)


def test_archives_are_gzip_members(spark):
    """What another reader sees: one member for each record, reached by its offset."""
    import zlib

    pages = table(spark, "pages")
    files = warc.cut(warc.write(pages, warc.new_folder(spark, "warc")), "files").collect()
    members = 0
    for file in files:
        raw = Path(file.path.removeprefix("file://")).read_bytes()
        assert len(raw) == file.bytes
        while raw:
            unpacker = zlib.decompressobj(31)
            record = unpacker.decompress(raw)
            assert unpacker.eof and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            raw, members = unpacker.unused_data, members + 1
    assert members == sum(f.records for f in files) == pages.count()


def test_archives_of_other_writers(spark, tmp_path, monkeypatch):
    import io

    def one(kind, block, *extra):
        head = ["WARC/1.0", f"WARC-Type: {kind}", *extra, f"Content-Length: {len(block)}"]
        return warc.member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    body = b"<p>" + bytes(range(256)) * 900 + b"</p>"
    hexadecimal = hashlib.sha1(body).hexdigest()
    data = (
        one("warcinfo", b"software: other\r\n")
        + one("request", b"GET / HTTP/1.1\r\n\r\n" * 50_000)
        + one("response", b"HTTP/1.1 200 OK\r\n\r\n" + body, "WARC-Record-ID: <urn:uuid:a-b>", f"WARC-Payload-Digest: sha1:{hexadecimal}")
        + one("metadata", b"")
        + one("revisit", b"", "WARC-Record-ID: <urn:uuid:c>", "WARC-Refers-To: <urn:uuid:a-b>")
        + one("response", b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nab", "WARC-Payload-Digest: md5:00")
    )
    path = tmp_path / "other.warc.gz"
    path.write_bytes(data)
    rows = warc.read(spark.createDataFrame([(f"file://{path}",)], "path string")).collect()
    assert [(r.page_id, r.record_id, r.record_type, r.payload_bytes) for r in rows] == [
        (None, "<urn:uuid:a-b>", "response", len(body)), (None, "<urn:uuid:c>", "revisit", None), (None, None, "response", 2),
    ]
    assert bytes(rows[0].payload) == body and rows[1].payload is None
    monkeypatch.setattr(warc, "READ_BYTES", 7)  # pieces that end anywhere
    assert [len(b) for _, b in warc.records(io.BytesIO(data))] == [len(body) + 19, 0, 40]


# -- 7 ---------------------------------------------------------------------------------------


def brute_substrings(docs, length=100):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(data[p : p + length])
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone]) if len(data) else b""
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_substrings_equal_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("ab c") for _ in range(400)) for _ in range(3)] + ["xy" * 300, "a" * 500]
    docs = [(1, ""), (2, "short")]
    for i in range(40):
        parts = []
        for _ in range(2):
            text = rng.choice(base)
            x, y = sorted((rng.randrange(len(text)), rng.randrange(len(text))))
            parts.append(text[x:y])
        docs.append((3 * i + 3, rng.choice(["", "é", "q"]).join(parts)))
    docs.append((500, docs[9][1]))
    found = suffix_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id bigint, text string"), with_bytes=True)
    rows = found.collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == brute_substrings(docs)
    assert all(r.kept is None or hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in rows)


def test_substring_edges(edges, empty):
    rows = suffix_dedup.dedup_substrings(edges).collect()
    assert len(rows) == len(EDGES)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].n_removed == by_id[6].n_bytes and by_id[6].n_spans == 1
    assert by_id[1].n_bytes == by_id[2].n_removed == by_id[3].n_removed == 0
    assert suffix_dedup.dedup_substrings(empty).count() == 0


# -- 8 ---------------------------------------------------------------------------------------


def test_patience_alignment():
    assert line_dedup.aligned([1, 3, 5], [7, 1, 3, 9, 5]) == [(0, 1), (1, 2), (2, 4)]
    assert line_dedup.aligned([1, 1, 2], [1, 1, 2]) == [(0, 0), (1, 1), (2, 2)]
    assert line_dedup.aligned([1, 2], [2, 1]) in ([(0, 1)], [(1, 0)])
    assert line_dedup.common_blocks([2, 4, 7], [2, 9, 4, 7]) == [2, 3]
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(9))] for _ in "ab")
        pairs = line_dedup.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_repeated_common_lines_are_aligned():
    assert line_dedup.aligned([8, 1, 9], [6, 1, 5, 1, 4]) == [(1, 1)]
    assert len(line_dedup.common_blocks([2, 1, 4, 1, 6], [8, 1, 10])) == 1
    assert len(line_dedup.common_blocks([2, 1, 3, 4], [8, 1, 3, 10, 1, 3, 12])) == 2
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in "ab")
        pairs, lengths = line_dedup.longest_common(a, b), np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                lengths[i + 1, j + 1] = lengths[i, j] + 1 if x == y else max(lengths[i, j + 1], lengths[i + 1, j])
        assert len(pairs) == lengths[-1, -1] and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_line_dedup(spark, edges, empty):
    one, two, three = ("this is the first shared line", "here is another shared line", "and a third line with words")
    docs = [
        (1, f"{one}\n{two}\nonly in the first document"), (2, f"begin of the second one\n{one}\nx\n{two}"),
        (3, f"{three}\n{one}"), (4, f"{three}\n{one}"), (5, "nothing in common here at all"), (6, "x\ny"),
    ]
    frame = spark.createDataFrame([(d, t, len(t)) for d, t in docs], "doc_id bigint, text string, n_chars bigint")
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(frame).collect()}
    assert rows[1].text == docs[0][1] and rows[5].text == docs[4][1] and rows[6].n_removed == 0
    assert rows[2].text == "begin of the second one\nx"
    assert rows[3].text == three and rows[4].text == ""
    kept = {r.doc_id: r for r in line_dedup.keep_rest(frame).collect()}
    assert sorted(kept) == [1, 2, 3, 5, 6] and kept[3].n_chars == len(three)
    assert line_dedup.op8(edges).count() == len(EDGES)
    assert line_dedup.dedup_lines(edges).select(*edges.columns).schema["n_chars"] == edges.schema["n_chars"]
    assert line_dedup.op8(empty).count() == 0


def brute_lines(spark, docs):
    """Places deleted in each document (ids and texts are distinct), over all pairs."""
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").select("doc_id", line_dedup.line_hashes())
    lines = {r[0]: r[1] for r in frame.collect()}
    holders = Counter(x for found in lines.values() for x in set(found))
    orders = {}
    for d, found in lines.items():
        text = dict(docs)[d].split("\n")
        known = [i for i, x in enumerate(found) if holders[x] > 1 or not text[i].strip(" ")]
        orders[d] = line_dedup.order_of(found, known)
    out = {}
    for d, (tokens, places) in orders.items():
        gone = {i for e in orders if e < d for i in line_dedup.found_in(orders[e][0], tokens)}
        out[d] = sorted(places[i] for i in gone)
    return out


def test_lines_are_tried_against_all_earlier_holders(spark):
    one, two = "this is the first shared line", "here is another shared line"
    # two orders of the lines: the third document has that of the second one, not of the earliest
    docs = [(1, f"{one}\n{two}"), (2, f"{two}\nwords\n{one}"), (3, f"{two}\nmore\n{one}")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(frame).collect()}
    assert [rows[d].n_removed for d in (1, 2, 3)] == [0, 1, 2] and rows[3].text == "more"
    rng = random.Random(3)
    pool = [f"a shared line with number {n}" for n in range(7)] + ["short", "a few", "", " "]
    docs = [
        (d, "\n".join([f"only in {d}, long enough"] + [
            rng.choice(pool) if rng.random() < 0.8 else f"{d} {n} alone" for n in range(rng.randrange(9))
        ]))
        for d in range(120)
    ]
    want = brute_lines(spark, docs)
    rows = line_dedup.deletions(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.least_id: r.places for r in rows} == {d: x for d, x in want.items() if x}


def test_blocks_of_short_lines(spark):
    verse = "roses are red\nviolets blue\nsugar"
    docs = [(1, f"{verse}\none"), (2, f"two\r\n{verse}\r\nthree"), (3, "four\nroses are red\nfive")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert rows == {1: docs[0][1], 2: "two\r\nthree", 3: docs[2][1]}


# -- 9 ---------------------------------------------------------------------------------------


def slow_edits(item, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
        before = row
    return min(before)


def test_least_edits_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(300):
        item, text = (bytes(rng.choice(b"abc") for _ in range(rng.randint(k, 20))) for k in (1, 0))
        assert decontaminate.least_edits(item, text) == slow_edits(item, text)


def test_recall_of_edited_passages(spark, edges, empty):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(12, 60))) for i in range(40)] + [(90, "tiny"), (91, None), (92, "")]
    docs, planted = [], set()
    for n in range(240):
        text = prose(60)
        if n % 2:
            item_id, passage = items[n % 40]
            letters = list(passage)
            for _ in range(int(0.09 * len(passage.replace(" ", "")))):
                letters[rng.randrange(len(letters))] = rng.choice("etaoinshrdlu")
            text = f"{text} {''.join(letters)} {prose(30)}"
            if slow_edits(passage.replace(" ", "").encode(), "".join(letters).replace(" ", "").encode()) <= 0.1 * len(passage.replace(" ", "")):
                planted.add((n, item_id))
        docs.append((n, text))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(frame, bench).collect()}
    assert found <= planted | {(n, items[n % 40][0]) for n in range(1, 240, 2)}
    assert len(found & planted) >= 0.9 * len(planted) > 50
    left = {r.doc_id for r in decontaminate.drop_contaminated(frame, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in found}
    assert decontaminate.matches(edges, bench).count() == 0
    assert decontaminate.drop_contaminated(edges, bench).count() == len(EDGES)
    assert decontaminate.matches(empty, bench).count() == 0
    assert decontaminate.matches(frame, bench.limit(0)).count() == 0


# -- 10 --------------------------------------------------------------------------------------


def brute_print(text):
    import re

    import xxhash

    counts, total = [0] * 64, 0
    for term in dict.fromkeys(re.split(r"[\x20\x09-\x0D]+", text.lower())):
        h, w = xxhash.xxh64(term.encode(), seed=42).intdigest(), len(term)
        total += w
        for k in range(64):
            counts[k] += (h >> k & 1) * w
    return sum(1 << k for k in range(64) if 2 * counts[k] > total)


@needs_tables
def test_fingerprints_equal_brute_force(spark):
    texts = texts_of(spark)
    ids = sorted(texts)
    rows = {r.doc_id: r for r in simhash.op10(table(spark, "documents")).collect()}
    assert sorted(rows) == ids
    prints = {i: brute_print(texts[i]) for i in ids}
    for i, after in zip(ids, ids[1:] + ids[:1]):
        text, half = texts[i], len(texts[i]) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        row = rows[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == f"{prints[i]:016x}" and row.edited_fingerprint == f"{brute_print(edited):016x}"
        assert row.near_next == 1 - (prints[i] ^ prints[after]).bit_count() / 64
        if i % 100 == 0:
            assert row.n_within == sum((prints[i] ^ p).bit_count() <= 3 for p in prints.values()) - 1


def test_next_document_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(simhash, "RANGE_ROWS", 7)
    docs = [(i * i % 1009, f"text {i}") for i in range(100)]
    rows = simhash.with_next(spark.createDataFrame(docs, "doc_id bigint, text string")).where("not guest").collect()
    ordered = sorted(set(docs)) if len(set(d for d, _ in docs)) == len(docs) else sorted(docs)
    want = dict(zip([t for _, t in ordered], [t for _, t in ordered[1:] + ordered[:1]]))
    assert {r.text: r.next_text for r in rows} == want


def test_fingerprint_edges(edges, empty, spark):
    rows = simhash.op10(edges).collect()
    assert len(rows) == len(EDGES)
    assert {r.doc_id: r.fingerprint for r in rows}[1] == "0" * 16
    assert simhash.op10(empty).count() == 0
    alone = simhash.op10(spark.createDataFrame([(1, "a bc")], "doc_id bigint, text string")).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"a a ").hexdigest()


def test_block_tables_find_all(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(10)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    frame = spark.createDataFrame([(p,) for p in signed] + [(None,)], "fingerprint bigint")
    for radius, extra in ((3, 1), (3, 2), (0, 1)):
        found = sorted((r.query, r.fingerprint) for r in simhash.within_radius(frame, frame, radius, extra).collect())
        want = sorted((a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
        assert found == want


# -- queries and pipeline --------------------------------------------------------------------


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    mine = queries.QUERIES[name](spark, FOLDER).toArrow()
    assert difference(mine, connect(FOLDER).sql(queries.ORACLES[name]).to_arrow_table()) is None


@needs_tables
def test_pipeline_stages(spark):
    import corpus_pipeline
    import sentencepiece

    docs = table(spark, "documents")
    columns = docs.columns
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    items = [r.text for r in table(spark, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = language_id_free(stage(spark, docs, FOLDER))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and after
        if name != "sentencepiece":
            assert docs.columns == columns
        if name == "ngram_join":
            assert set(after) == {d for d, _, c in brute_components(sorted(before.items())) if d == c}
        if name == "decontamination":
            assert not any(i in r.text for r in after.values() for i in items)
        if name == "sentencepiece":
            assert all(r.ids == library.encode(before[d]) and r.exact for d, r in after.items())


def language_id_free(df):
    from tidemark.llm.shared import cut

    return cut(df, "test-stage")


def test_ngrams_are_made_of_little_text_at_a_time(monkeypatch):
    made, sets = [], ngram_join.shingle_sets
    monkeypatch.setattr(ngram_join, "shingle_sets", lambda c, n: made.append((len(c), sum(map(len, c.to_pylist())))) or sets(c, n))
    rows = SimpleNamespace(mapInArrow=lambda run, schema: run)
    texts = [f"{k} " * 300_000 for k in range(8)]
    batch = pa.record_batch({"doc_id": list(range(8)), "text": texts})
    held = SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    for run in (ngram_join.members_of(rows, 5, 0), ngram_join.prefixes(rows, 5, 80, 0, held)):
        assert sum(out.num_rows for out in run(iter([batch]))) >= 8
    assert sum(n for n, _ in made) == 16 and max(size for _, size in made) <= 2 << 20


def near_copies(seed: int, families: int, most: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    docs = []
    for f in range(families):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 90))]
        for _ in range(rng.randint(1, most)):
            copy = list(words)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9)}"
            docs.append((len(docs), " ".join(copy)))
    return docs


def test_prefix_rows_move_packed(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PACKED", 3000)
    docs = near_copies(11, 60, 12)
    docs += [(1000 + d, t) for d, t in docs[::3]]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    held = SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    rows = [tuple(r) for r in ngram_join.prefixes(df, 5, 80, 0, held).collect()]
    packs = ngram_join.prefixes(df, 5, 80, 0, held, 4)
    blobs = [r.rows for r in packs.collect()]
    table = ngram_join.unpacked(blobs)
    assert sorted(zip(table["gram"].view(np.int64).tolist(), *(table[c].tolist() for c in ("node", "size", "pos")))) == sorted(rows)
    # a row for each range and some thousand n-grams, not one for each n-gram
    assert len(blobs) <= 16 * (len(rows) // 3000 + 3) < len(rows) / 50
    by_gram = {}
    for gram, node, size, pos in set(rows):
        by_gram.setdefault(gram, []).append((size, node, pos))
    expected = []
    for gram, sets in by_gram.items():
        sets.sort()
        reach = [x[0] >= y[0] * (0.8 - 1e-9) for x, y in zip(sets, sets[1:])]
        for k, (size, node, pos) in enumerate(sets):
            below = k > 0 and reach[k - 1]
            if below or (k < len(reach) and reach[k]):
                expected.append((gram, node, size, pos, sets[k - 1] if below else None))
    found = [(*r[:4], r.before and tuple(r.before)) for r in ngram_join.with_neighbours(packs, 80).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr) and any(r[4] is None for r in found)


def test_ngrams_within_one_component_move_no_more(spark, monkeypatch):
    written, keep = {}, ngram_join.cut

    def counted(frame, what="table"):
        out = keep(frame, what)
        written.setdefault(what, []).append(out)
        return out

    monkeypatch.setattr(ngram_join, "cut", counted)
    monkeypatch.setattr(ngram_join, "FEWER", 1 << 30)
    docs = near_copies(12, 12, 25)
    found = ngram_join.join_components(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted(tuple(r) for r in found.collect()) == brute_components(docs)
    rounds = [{(r.gram, r.node) for r in t.collect()} for t in written["unsettled"]]
    assert len(rounds) > 1 and all(later <= earlier for earlier, later in zip(rounds, rounds[1:]))
    assert len(rounds[0]) < written["prefixes"][0].count() / 2


def test_few_copies_leave_texts_in_place(spark):
    import corpus_pipeline

    rng = random.Random(13)
    docs = [(d, " ".join(rng.choice("abcdefghij") for _ in range(12))) for d in range(900)] + [(900, "x y z"), (901, "x y z")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, 2048)  # less than the table of all groups has, more than that of the copies
    try:
        left = corpus_pipeline.remove_near_duplicates(spark, df, "")
        assert "SortMergeJoin" not in left._jdf.queryExecution().executedPlan().toString()
        assert {r.doc_id for r in left.collect()} == {d for d, _, c in brute_components(docs) if d == c}
    finally:
        spark.conf.set(name, before)
