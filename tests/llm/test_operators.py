"""The operators against brute force on a small table with nulls, empty and
long texts, ties, repeated rows and clashing extra columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from weir.llm import op1_substrings as op1  # noqa: E402
from weir.llm import op2_licenses as op2  # noqa: E402
from weir.llm import op3_passages as op3  # noqa: E402
from weir.llm import op4_jaccard as op4  # noqa: E402
from weir.llm import op5_quality as op5  # noqa: E402
from weir.llm import op6_token_files as op6  # noqa: E402
from weir.llm import op7_mixing as op7  # noqa: E402
from weir.llm import op8_packing as op8  # noqa: E402
from weir.llm import op9_embeddings as op9  # noqa: E402
from weir.llm import op10_lines as op10  # noqa: E402
from weir.llm import text  # noqa: E402
from weir.llm.common import by_group  # noqa: E402
from weir.session import run_dir  # noqa: E402

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "one two"), (9005, "one two"), (9006, "x\n" * 400), (9007, "é" * 120), (9008, "é" * 120), (None, "a lone text without an id")]


def rows():
    got = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()
    return got + ODD + [(9010, got[3][1]), (9010, got[3][1])]


@pytest.fixture(scope="module")
def docs(spark):
    # names that operators use themselves must not clash
    extra = [(i, t, "src", "en", 1, "k", 2.0) for i, t in rows()]
    return spark.createDataFrame(extra, "doc_id long, text string, source string, lang string, n_chars long, kept string, score double").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def key(i):
    return (i is None, i or 0)


def test_substrings(docs, empty):
    got = op1.substring_dedup(docs).collect()
    assert op1.substring_dedup(empty).count() == 0
    data = sorted(((i, (t or "").encode()) for i, t in rows()), key=lambda x: key(x[0]))
    seen, want, fresh, last = set(), Counter(), set(), None
    for i, b in data:
        if i != last:  # rows that share an id do not remove from each other
            seen |= fresh
            fresh, last = set(), i
        gone = np.zeros(len(b), dtype=bool)
        for j in range(len(b) - 49):
            if b[j : j + 50] in seen:
                gone[j : j + 50] = True
            fresh.add(b[j : j + 50])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[(i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_loser_tree_gives_order_and_shared_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(50):
        runs = []
        for _ in range(rng.integers(1, 7)):
            ks = sorted({bytes(rng.integers(0, 3, 8, dtype=np.uint8)) for _ in range(rng.integers(1, 9))})
            lcp, rest = op1.front_code(np.frombuffer(b"".join(ks), np.uint8).reshape(-1, 8))
            assert op1.front_decode(lcp, rest, 8) == ks
            runs.append((ks, lcp))
        run, at, lcp = op1.loser_tree_merge(runs)
        want = sorted(k for r in runs for k in r[0])
        assert [runs[r][0][p] for r, p in zip(run, at)] == want
        shared = [0] + [next((i for i in range(8) if a[i] != b[i]), 8) for a, b in zip(want, want[1:])]
        assert lcp.tolist() == shared


def test_licenses(spark, empty):
    texts = [
        ("Some words.\nLicensed under the Apache License, Version 2.0.\nMore.", "Apache-2.0"),
        ("Released under the MIT License. Licensed under CC BY-NC 4.0.", "MIT AND CC-BY-NC"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("// SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
        ("He lost his driving license and had no permission.", ""),
        (None, ""), ("", ""),
    ]
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(texts)], "doc_id long, text string, license string")
    assert [r.license for r in op2.scan_licenses(df).orderBy("doc_id").collect()] == [w for _, w in texts]
    assert op2.scan_licenses(empty).count() == 0
    run = ["mit-grant", "mit-include", "mit-as-is", "mit-liability"]
    assert op2.recognise(run, op2.RULES) == ["MIT"]
    assert op2.recognise(["mit-title", *run], op2.RULES) == ["MIT", "MIT"]


GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} version {2} of the License{3}.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
LATER = ", or\n(at your option) any later version"
APACHE = """Copyright 2020 A. Writer

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD = """Copyright (c) 2020, A Writer
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
{0} Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.
{0} Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation.
{1}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
ENDORSE = """* Neither the name of the copyright holder nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


@pytest.mark.parametrize("leader", ["", "# ", " * ", "// ", ";; ", "dnl "])
def test_licenses_wrapped(leader):
    texts = [
        (APACHE, ["Apache-2.0"]),
        (MIT_TEXT, ["MIT"]),
        (BSD.format("*", ENDORSE), ["BSD-3-Clause"]),
        (BSD.format("1.", ""), ["BSD-2-Clause"]),
        (ISC, ["ISC"]),
        (MPL, ["MPL-2.0"]),
        (GPL.format(":", ", either", 3, LATER), ["GPL-3.0-or-later"]),
        (GPL.format(";", "; either", 2, LATER), ["GPL-2.0-or-later"]),
        (GPL.format(";", ";", 2, ""), ["GPL-2.0-only"]),
        (GPL.format(":", ", either", 3, LATER).replace("GNU General", "GNU Lesser General"), ["LGPL-3.0-or-later"]),
        (GPL.format(":", ", either", "2.1", LATER).replace("GNU General", "GNU Lesser General"), ["LGPL-2.1-or-later"]),
        (GPL.format(":", ", either", 3, LATER).replace("GNU General", "GNU Affero General"), ["AGPL-3.0-or-later"]),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike\n4.0 International License.", ["CC-BY-NC-SA"]),
        ("This work is licensed under a Creative Commons\nAttribution 4.0 International License.", ["CC-BY"]),
        ("This is free and unencumbered software released into\nthe public domain.", ["Unlicense"]),
        ("Released under the GNU General Public License", ["GPL"]),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nCopyright 2020 A", ["(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0"]),
        ("Home\nMIT License\nContact us", ["MIT"]),
        ("Some page\nCopyright 2020 A Writer\nAll rights reserved.", ["Proprietary"]),
    ]
    known = op2.compiled([*op2.SENTENCES, *op2.NOTICES])
    for text, want in texts:
        text = "".join(leader + x for x in text.splitlines(True))
        got = op2.recognise(op2.identifiers(text, known), op2.RULES)
        assert got == want, (text, got)


NOTICES = [
    ("This project is licensed under the MIT License.", "MIT"),
    ("This project is licensed under the Apache License 2.0.", "Apache-2.0"),
    ("This software is released under the MIT license - see the LICENSE file for details.", "MIT"),
    ("Licensed under the MIT License (see LICENSE).", "MIT"),
    ("This article is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA"),
    ("The code is available under the GPLv3.", "GPL-3.0"),
    ("All of our tools are distributed under the terms of the GNU LGPL v2.1 or later.", "LGPL-2.1"),
    ("Copyright 2020 A Writer, distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("The data set is published under CC0 1.0 Universal.", "CC0-1.0"),
    ("foo is dual licensed under the Apache License, Version 2.0 and you may choose", "Apache-2.0"),
    ("Licensed under the\nEclipse Public License - v 2.0", "EPL-2.0"),
    ("This project is not licensed under the MIT License.", ""),
    ("It is no longer available under the GPLv2.", ""),
    ("This was never released under the Apache License 2.0.", ""),
    ("Code without a note isn't covered by the MIT license.", ""),
    ("She was licensed under the state law in 2004.", ""),
    ("The bridge is available under certain conditions.", ""),
    ("They studied under the MIT professor.", ""),
]


@pytest.mark.parametrize("text, want", NOTICES)
def test_license_notices(spark, text, want):
    known = op2.compiled([*op2.SENTENCES, *op2.NOTICES])
    assert op2.joined(op2.recognise(op2.identifiers(text, known), op2.RULES)) == want


def test_license_rules_with_gaps():
    run = ["bsd-grant", "bsd-source", "all-rights", "bsd-binary", "bsd-as-is"]
    assert op2.recognise(run, op2.RULES) == ["BSD-2-Clause", "Proprietary"]
    far = ["mpl-notice", *["isc-title"] * (op2.GAP + 1), "mpl-copy"]
    assert op2.recognise(far, [("MPL-2.0", ("mpl-notice", "mpl-copy"))]) == []


def test_license_rows(spark):
    df = spark.createDataFrame([(None, "MIT License"), (7, "MIT License"), (7, "MIT License"), (8, "x " * 500_000 + "\nMIT License")], "doc_id long, text string")
    got = op2.scan_licenses(df).collect()
    assert Counter((r.doc_id, r.license) for r in got) == Counter([(None, "MIT"), (7, "MIT"), (7, "MIT"), (8, "MIT")])


def test_license_expressions_joined():
    assert op2.joined(["MIT OR Apache-2.0", "BSD-3-Clause", "BSD-3-Clause"]) == "(MIT OR Apache-2.0) AND BSD-3-Clause"


def test_passages(docs, empty):
    got = op3.near_passages(docs).collect()
    assert op3.near_passages(empty).count() == 0
    ws = {i: WORD.findall((t or "").translate(LOWER)) for i, t in rows() if i is not None}
    for r in got:
        a = {tuple(ws[r.doc_id][i : i + 5]) for i in range(r.start_word, r.end_word - 4)}
        b = {tuple(ws[r.rep_doc_id][i : i + 5]) for i in range(r.rep_start_word, r.rep_end_word - 4)}
        assert r.rep_doc_id < r.doc_id and r.end_word - r.start_word >= 50
        assert r.similarity >= 0.75 and abs(len(a & b) / len(a | b) - r.similarity) < 1e-9
    seen, need = set(), set()
    for i in sorted(ws):
        own = {tuple(ws[i][j : j + 50]) for j in range(len(ws[i]) - 49)}
        if own & seen:
            need.add(i)
        seen |= own
    assert len(need - {r.doc_id for r in got}) <= 0.02 * len(need)


def _planted(n, seed):
    """(text, text, words that differ) of near passages at a similarity of
    0.75 to 0.85 between words of their own."""
    rng = np.random.default_rng(seed)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    for _ in range(n):
        a = word(100)
        while True:
            b = list(a)
            for i in rng.choice(np.arange(8, 92), int(rng.integers(2, 5)), replace=False):
                b[i] = word(1)[0]
            x, y = ({tuple(z[i : i + 5]) for i in range(96)} for z in (a, b))
            if 0.75 <= len(x & y) / len(x | y) <= 0.85:
                break
        yield " ".join(word(30) + a + word(30)), " ".join(word(50) + b + word(20))


def test_passages_near_the_threshold(spark):
    texts = [t for pair in _planted(150, 3) for t in pair]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.rep_doc_id for r in op3.near_passages(df).collect()}
    assert found == {i: i - 1 for i in range(1, 300, 2)}


def test_passages_behind_frequent_phrases(spark):
    # two documents share a passage; more, with smaller and intermediate ids, share thirds of it
    rng = np.random.default_rng(5)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    texts, want = [], set()
    for _ in range(6):
        p = word(100)
        parts = [word(60) + p[a : a + 35] + word(60) for a in range(0, 100, 15) for _ in range(3)]
        first, last = word(40) + p + word(30), word(20) + p + word(50)
        group = [*parts[::3], first, *parts[1::3], last, *parts[2::3]]
        want.add((len(texts) + group.index(last), len(texts) + group.index(first)))
        texts += [" ".join(t) for t in group]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.rep_doc_id) for r in op3.near_passages(df).collect()} == want


@pytest.mark.parametrize("direct", [64, 2])
def test_passages_pair_every_entry(monkeypatch, direct):
    monkeypatch.setattr(op3, "DIRECT", direct)
    e = np.zeros(9, dtype=op3.ENTRY)
    e["key"], e["c"] = 8, 3
    e["doc"], e["th"] = [5, 1, 2, 3, 4, 9, 9, 1, 7], [50, 10, 20, 30, 40, 10, 10, 10, 20]
    copies, left = op3._copies(e)
    assert sorted(copies[["doc", "rep"]].tolist()) == [(7, 2), (9, 1)]
    pairs, frequent = op3._all_pairs(left)
    got = pairs[["doc", "rep"]].tolist()
    for x in frequent:
        block = np.arange(len(x)) // 2
        for a in range(3):
            for b in range(a, 3):
                in_two = (block == a) | (block == b)
                got += op3._cross(x[in_two], block[in_two], a != b)[["doc", "rep"]].tolist()
    assert sorted(got) == [(a, b) for a in range(1, 6) for b in range(1, a)]


def test_passages_of_a_frequent_key(spark, monkeypatch):
    monkeypatch.setattr(op3, "DIRECT", 2)
    monkeypatch.setattr(op3, "BLOCK", 2)
    rng = np.random.default_rng(6)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    p = word(120)
    df = spark.createDataFrame([(i, " ".join(word(20) + p + word(20))) for i in range(7)], "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.rep_doc_id) for r in op3.near_passages(df).collect()}
    assert got == {(a, b) for a in range(7) for b in range(a)}


def _joint(texts, least=46):
    """The joint windows of all pairs of functions over ``texts``."""
    found, codes = [], {}
    for doc, t in enumerate(texts):
        s = op3.shingle_sequence(op3.words(t.encode()), op3.SHINGLE)
        codes[doc, doc] = (s >> np.uint64(56)).astype(np.uint8)
        for f in range(op3.HASHES):
            h = (op3.mix(s + np.uint64(0x9E3779B97F4A7C15 * (f + 1) % (1 << 64))) & ~np.uint64(7)) | np.uint64(f)
            l, c, r = op3.compact_windows(h, np.zeros(len(s), np.int64), np.full(len(s), len(s)), least)
            e = np.zeros(len(c), dtype=op3.ENTRY)
            e["key"], e["doc"], e["th"], e["l"], e["c"], e["r"] = h[c], doc, doc, l, c, r
            found.append(e)
    some = [(f, g) for f in range(op3.HASHES) for g in range(f + 1, op3.HASHES)]
    return np.concatenate(list(op3.joint_windows(op3._shared(np.concatenate(found)), codes, least, some)))


def test_passages_frequent_phrases_make_few_pairs():
    # every text has the same two phrases; only the last two share a passage
    rng = np.random.default_rng(8)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    first, second, p = word(16), word(16), word(70)
    texts = [" ".join(word(30) + first + word(12) + second + word(30)) for _ in range(300)]
    texts += [" ".join(word(30) + p + word(20)), " ".join(word(10) + p + word(30))]
    w = _joint(texts)
    sizes = np.unique(w["key"], return_counts=True)[1]
    pairs, frequent = op3._all_pairs(w, 11)
    assert (301, 300) in {tuple(x) for x in pairs[["doc", "rep"]].tolist()} and not frequent
    assert 1000 < (sizes * (sizes - 1) // 2).sum() > 4 * len(pairs)


def test_passages_joint_windows_keep_near_passages():
    texts = [t for pair in _planted(150, 4) for t in pair]
    pairs, _ = op3._all_pairs(_joint(texts), 11)
    assert {tuple(x) for x in pairs[["doc", "rep"]].tolist()} == {(i, i - 1) for i in range(1, 300, 2)}


def test_groups_go_on_by_bytes(spark):
    def run(key, t):
        for _ in range(40):
            yield {"n": [key[0]], "data": [bytes(1000)]}

    df = spark.range(3).select(F.col("id").alias("k"))
    got = by_group(df, ["k"], run, "n long, data binary", bytes_out=2500)
    assert Counter(r.n for r in got.collect()) == {0: 40, 1: 40, 2: 40}


def test_passages_ends_of_distinct_shingles():
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, m, n).astype(np.uint64) for m, n in ((3, 50), (1000, 60), (1, 46), (20, 200))]
    sizes = np.array([len(t) for t in texts])
    got = op3._distinct_ends(np.concatenate(texts), np.cumsum(sizes) - sizes, sizes)
    assert got.tolist() == [max(t.tolist().index(x) for x in t.tolist()) + 1 for t in texts]


def test_matching_spans_with_changes_close_together():
    # 60 of 70 shingles shared; the runs before and after the changes are too short alone
    a = np.arange(1, 101, dtype=np.int64)
    b = a.copy()
    for i, j in ((20, 25), (28, 33), (70, 100)):
        b[i:j] = -a[i:j]
    assert op3.matching_spans(a, b, 46, 75) == [(0, 70, 0, 70, 60, 80)]


def _links(data):
    sets = []
    for _, t in data:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    n = len(data)
    adj = defaultdict(set)
    for a in range(n):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
                adj[a].add(b)
                adj[b].add(a)
    label = list(range(n))
    for s in range(n):
        stack, comp = [s], {s}
        while stack:
            for y in adj[stack.pop()]:
                if y not in comp:
                    comp.add(y)
                    stack.append(y)
        ids = [data[x][0] for x in comp if data[x][0] is not None]
        label[s] = min(ids) if ids else None
    return Counter((data[x][0], len(sets[x]), label[x], len(adj[x])) for x in range(n))


def test_jaccard(docs, empty):
    got = op4.jaccard_join(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component, r.n_links) for r in got) == _links(rows())
    assert op4.jaccard_join(empty).count() == 0


def test_jaccard_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(op4, "BLOCK", 8)
    written = []
    write = op4.Stage.write
    monkeypatch.setattr(op4.Stage, "write", lambda self, df, name: written.append(name) or write(self, df, name))
    data = [(i, " ".join(f"w{j}" for j in range(40)) + f" x{i}") for i in range(30)] + [(i, f"text {i} " * 9) for i in range(30, 40)]
    got = op4.jaccard_join(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component, r.n_links) for r in got) == _links(data)
    # a region of several blocks is not sent out all at once
    assert {"links-0", "links-1"} <= set(written)


ODD_TEXTS = [
    b"", b"  ", b"one", b"A b", b"\x00\x00 \x00", b"x" * 31 + b" " + b"Y" * 32 + b" " + b"z" * 33 + b" " + b"w" * 100 + b" q Q",
    b"a\x0bb\x0cc\rd\te\nf", b"\xc2\xa0a \xff\xfe b C D e\x1cf", b" lead trail of four words ", b"1 2 3 4 5", b"r " * 300,
]


def test_shingles_of_many_texts_at_once():
    rng = np.random.default_rng(3)
    made = [bytes(rng.choice(list(b"aBcdefghijk\xc3 \n\t "), rng.integers(0, 400)).tolist()) for _ in range(400)]
    for texts in (ODD_TEXTS + made, ODD_TEXTS[::-1], [], [b""], [b" ", b""]):
        each = [text.shingle_sequence(text.words(t)) for t in texts]
        for got, want in ((text.shingle_sequences(texts), each), (text.shingle_sets(texts), [np.unique(x) for x in each])):
            assert got[1].tolist() == [len(x) for x in want]
            assert got[0].tolist() == [x for w in want for x in w.tolist()]


def test_jaccard_prefixes_of_many_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1)) for n in (0, 1, 3, 4, 5, 40, 0, 400)]
    common = np.unique(np.concatenate([s[:: max(1, len(s) // 7)] for s in sets] + [sets[4]]))
    for c in (common, common[:0]):
        flat, sizes = op4.prefixes(np.concatenate(sets), np.array([len(s) for s in sets]), c)
        assert len(flat) == sizes.sum()
        for s, got in zip(sets, np.split(flat, np.cumsum(sizes)[:-1])):
            size = len(s) - (op4.PERCENT * len(s) + 99) // 100 + 1 if len(s) else 0
            assert set(got.tolist()) == set(sorted(s.tolist(), key=lambda x: (x in set(c.tolist()), x))[:size])


def test_jaccard_regions_of_pairs_are_found_at_once(monkeypatch):
    """Pairs that meet in several regions are not looked at one by one."""
    monkeypatch.setattr(op4.np, "intersect1d", None)
    rng = np.random.default_rng(5)
    n, body = 300, np.arange(100)
    sets = [np.append(body, 1000 + k) for k in range(n)]
    regions = [np.unique(np.append(rng.integers(0, 40, 3), 20)) for _ in range(n)]
    table = pa.table(
        {"n": [101] * n, "point": range(n), "copies": rng.integers(1, 4, n), "block": [0] * n, "shingles": [s.tolist() for s in sets], "regions": [r.tolist() for r in regions]}
    )
    (got,) = op4._links((20, 0, 0), table)
    links = dict(zip(got["point"].tolist(), got["links"].tolist()))
    copies = table["copies"].to_pylist()
    for i in range(n):
        assert links[i] == sum(copies[j] for j in range(n) if j != i and min(set(regions[i].tolist()) & set(regions[j].tolist())) == 20)


@pytest.mark.parametrize("cells", [op4.Incidence.CELLS, 1e-9, 10**9])
def test_overlaps_by_products_and_by_pairs(monkeypatch, cells):
    """Shingles that few points of a region hold are counted pair by pair, the
    others multiplied; both give the same."""
    monkeypatch.setattr(op4.Incidence, "CELLS", cells)
    monkeypatch.setattr(op4.Incidence, "TOGETHER", 1000)
    rng = np.random.default_rng(6)
    for m, most, names in ((1, 5, 10), (3, 4, 8), (200, 40, 3000), (200, 40, 150), (40, 0, 1)):
        sets = [np.unique(rng.integers(0, names, rng.integers(0, most + 1)).astype(np.uint64)) for _ in range(m)]
        inc = op4.Incidence(np.concatenate(sets), np.append(0, np.cumsum([len(x) for x in sets])).astype(int))
        a, b = rng.permutation(m)[: m // 2 + 1], rng.permutation(m)
        want = [[len(np.intersect1d(sets[x], sets[y])) for y in b] for x in a]
        assert (inc.overlap(a, b) == want)[a[:, None] != b[None, :]].all()


def test_jaccard_points_go_where_their_pairs_are_counted(spark, monkeypatch):
    """A pair that shares several regions sends its sets to the smallest only."""
    sent = []
    write = op4.Stage.write
    monkeypatch.setattr(op4.Stage, "write", lambda self, df, name: sent.append((name, write(self, df, name))) or sent[-1][1])
    monkeypatch.setattr(op4.Stage, "drop", lambda self, name: None)
    rng = np.random.default_rng(7)
    body = [f"w{j}" for j in range(400)]
    data = []
    for i in range(40):
        words = list(body)
        for j in rng.integers(0, 400, 8):
            words[j] = f"x{i}-{j}"
        data.append((i, " ".join(words)))
    got = op4.jaccard_join(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component, r.n_links) for r in got) == _links(data)
    staged = dict(sent)
    assert staged["met"].select(F.max(F.size("regions"))).first()[0] > 3
    many = staged["possible"].groupBy("region").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    meet = staged["met"].select(F.explode("regions").alias("region")).groupBy("region").count()
    assert many < meet.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0] / 2


def test_metric_join_is_exact():
    rng = np.random.default_rng(2)
    base = [rng.choice(5000, 60, replace=False) for _ in range(12)]
    sets = []
    for _ in range(400):
        s = set(base[rng.integers(12)].tolist())
        for _ in range(rng.integers(0, 14)):
            s.discard(next(iter(s)))
            s.add(int(rng.integers(5000)))
        sets.append(np.array(sorted(s), dtype=np.uint64))
    n = np.array([len(s) for s in sets])
    inc = op4.Incidence(np.concatenate(sets), np.append(0, np.cumsum(n)))
    got = {(min(a, b), max(a, b)) for i, j in op4.metric_join(inc, n, 0.25) for a, b in zip(i.tolist(), j.tolist())}
    want = set()
    for a in range(400):
        for b in range(a):
            i = len(np.intersect1d(sets[a], sets[b]))
            if 100 * i >= 75 * (n[a] + n[b] - i):
                want.add((b, a))
    assert got == want


def test_quality_base_columns(spark, docs, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    repeated = spark.createDataFrame([(1, "a b c d e f g h i " * 5), (2, "one\none\n \n \ntwo # $")], "doc_id long, text string")
    for df, data in ((docs.drop("kept", "score"), rows()), (repeated, [(r.doc_id, r.text) for r in repeated.collect()])):
        want = Counter()
        for i, t in data:
            t = t or ""
            w = WORD.findall(t)
            lines = [x for x in t.split("\n") if WORD.search(x)]
            win = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
            hit = {j + k for j in range(len(w) - 7) if win[tuple(w[j : j + 8])] > 1 for k in range(8)}
            fail = len(w) < 20 or 100 * len(hit) > 30 * len(w)
            want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), fail)] += 1
        got = op5.quality(df, labels).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
        assert not any(r.kept and r.base_failed for r in got)
    assert op5.quality(empty, labels).count() == 0
    assert op5.quality(repeated, labels.where("false")).count() == 2


def test_quality_held_out(spark):
    # about 850 trusted rows fit the target; smaller tables have too few
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = op5.quality(docs.select("doc_id", "text"), fit).join(held, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    share = {r.quality: r.k for r in got.collect()}
    assert share[1] >= 0.98 and share.get(0, 0) <= 0.1


def test_quality_uses_every_label(spark):
    ids = spark.range(50_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    got = op5.labelled_ids(ids.union(ids)).groupBy("good", "half").count().collect()
    assert len(got) == 4 and sum(r["count"] for r in got) == 50_000
    assert all(r["count"] > 12_000 for r in got)


def test_quality_shuffles_text_once(spark, monkeypatch):
    plans = {}
    write = op5.Stage.write

    def kept(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(op5.Stage, "write", kept)
    texts = [(i, f"{'good' if i % 2 else 'bad'} " * 10 + " ".join(f"w{(i * j) % 97}" for j in range(30))) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    op5.quality(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))).collect()
    # texts are scored where they lie; ids and scores meet the labels
    assert "Exchange" not in plans["scored"] and "Join" not in plans["scored"]
    assert "text" not in plans["scores"]


def _ids(t, end):
    return np.array([*_tok().encode(t or "", add_special_tokens=False).ids, end], dtype="<u4")


def _tok():
    return tokenizers.Tokenizer.from_file(TOKENIZER)


def test_token_files(spark, docs, empty, workdir):
    op6.write_token_files(docs, workdir, TOKENIZER, segment_bytes=20_000)
    got = op6.scan(spark, workdir).orderBy("start").collect()
    tok = _tok()
    enc = {i: None for i, _ in rows()}
    by = defaultdict(list)
    for i, t in rows():
        by[i].append(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    assert [key(r.doc_id)[1] for r in got if r.doc_id is not None] == sorted(i for i, _ in rows() if i is not None)
    at = 0
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(x.tobytes())) for x in by[r.doc_id]}
        at += r.n_tokens
    assert len(got) == len(rows()) and len(enc) == len(by)
    ask = spark.createDataFrame([(9004,), (1,), (9010,), (123456,), (None,)], "doc_id long")
    found = op6.lookup(spark, workdir, ask).collect()
    assert sorted(r.doc_id for r in found) == [1, 9004, 9010, 9010]
    assert all(any(bytes(r.ids) == x.tobytes() for x in by[r.doc_id]) for r in found)
    op6.write_token_files(empty, f"{workdir}-empty", TOKENIZER)
    assert op6.scan(spark, f"{workdir}-empty").count() == 0


def test_minimal_perfect_hash():
    keys = np.random.default_rng(3).choice(1 << 60, 5000, replace=False).astype(np.uint64)
    sizes, bits = op6.build_mph(keys)
    slots = op6.Mph(sizes.tobytes(), bits.tobytes()).slot(keys)
    assert sorted(slots.tolist()) == list(range(5000))


def test_mixing(spark, empty):
    rng = np.random.default_rng(4)
    data = [(i, s, " ".join(["w"] * int(rng.integers(0, 60)))) for i, s in enumerate(rng.choice(["a", "b", "c", "d", None], 3000, p=[0.4, 0.3, 0.2, 0.05, 0.05]).tolist())]
    df = spark.createDataFrame([*data, (3000, "a", None), (None, "b", "x y"), (5, "a", "x y")], "doc_id long, source string, text string")
    got = op7.mix(df).collect()
    again = op7.mix(df.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == 3003
    size = Counter()
    for r in got:
        size[r.source] += r.size
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, target, free = 1.5 * sum(size.values()), {}, set(order)
    while True:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * size[s]}
        if not over:
            break
        target |= {s: 2 * size[s] for s in over}
        free -= over
    target |= {s: weight[s] * level for s in free}
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, r.target) and r.taken in (0, r.size, 2 * r.size)
        assert r.source_size == size[r.source]
    assert all(abs(taken[s] - target[s]) <= 60 for s in order)
    assert op7.mix(empty).count() == 0


def test_packing(docs, empty):
    got = op8.pack(docs, TOKENIZER).collect()
    by = defaultdict(Counter)
    tok = _tok()
    for i, t in rows():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for s in range(0, len(ids), 2048):
            x = ids[s : s + 2048]
            by[i][(s, len(x), zlib.crc32(x.tobytes()), len(ids))] += 1
    have = defaultdict(Counter)
    for r in got:
        have[r.doc_id][(r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    assert have == by
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(seqs) <= -(-total // 2048) * 1.05 + 1
    whole = op8.sequences(docs, TOKENIZER).collect()
    assert sum(r.n_tokens for r in whole) == total and all(len(r.ids) == 4 * r.n_tokens for r in whole)
    assert op8.pack(empty, TOKENIZER).count() == 0


def test_packing_plan_uses_every_length():
    hist = {5: 100, 2048: 7, 1000: 33, 1048: 20, 3: 1}
    used = Counter()
    for lengths, n in op8.plan(hist, 2048):
        assert sum(lengths) <= 2048
        for x in lengths:
            used[x] += n
    assert used == hist


def test_embeddings(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base[rng.integers(0, 40, 800)] + 0.08 * rng.normal(size=(800, 16)), rng.normal(size=(200, 16))]).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, x[0].tolist()), (2001, None), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [1.0, None] * 8), (2005, []), (2006, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<float>, n_links int")
    got = {r.vec_id: r for r in op9.near_duplicates(df).collect()}
    y = np.concatenate([x, x[:1]]).astype(np.float64)
    y /= np.linalg.norm(y, axis=1)[:, None]
    link = y @ y.T >= 0.9
    np.fill_diagonal(link, False)
    ids = [*range(1000), 2000]
    found = sum(got[i].n_links for i in ids)
    assert 0.97 * link.sum() <= found <= link.sum()
    assert all(got[i].n_links <= link[k].sum() for k, i in enumerate(ids))
    for i in (2001, 2002, 2003, 2004, 2005, 2006):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert op9.near_duplicates(df.where("false")).count() == 0


def _embedded(spark, x):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r for r in op9.near_duplicates(df).collect()}
    y = x / np.linalg.norm(x, axis=1)[:, None]
    link = y @ y.T >= 0.9
    np.fill_diagonal(link, False)
    return got, link.sum(axis=1)


def test_embeddings_dense_group(spark):
    # more than a cell of vectors that are all linked with each other
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=16) + 0.06 * rng.normal(size=(2600, 16)), rng.normal(size=(60, 16))])
    got, links = _embedded(spark, x)
    assert links[:2600].min() >= 2599
    assert [got[i].n_links for i in range(len(x))] == links.tolist()
    assert {got[i].component_id for i in range(2600)} == {0}


def test_embeddings_count_every_link(spark):
    # groups that cells share: a link is counted once, wherever its pair meets
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 24))
    x = base[rng.integers(0, 30, 4000)] + 0.3 * rng.normal(size=(4000, 24))
    got, links = _embedded(spark, x)
    assert links.sum() > 10_000
    assert [got[i].n_links for i in range(len(x))] == links.tolist()


def _scattered(rng, n, dim, pairs):
    """Vectors without structure, some with a near copy, and groups of a few."""
    x = rng.normal(size=(n, dim))
    near = x[:pairs] + 0.25 * rng.normal(size=(pairs, dim)) * np.linalg.norm(x[:pairs], axis=1)[:, None] / np.sqrt(dim)
    few = np.repeat(x[pairs : pairs + 40], 4, axis=0) + 0.1 * rng.normal(size=(160, dim))
    return np.concatenate([x, near, few])


def test_embeddings_without_structure(spark, monkeypatch):
    """Regions that no split makes cheaper are searched over the graph."""
    searched = []
    graph_links = op9.graph_links
    monkeypatch.setattr(op9, "graph_links", lambda *a: searched.append(a[2]) or graph_links(*a))
    x = _scattered(np.random.default_rng(3), 5000, 32, 800)
    got, links = _embedded(spark, x)
    assert searched  # by the graph, not block by block
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.95 * links.sum() > 1000
    # the audit's answer to a search that finds too little: more overlap, then every block
    searched.clear()
    monkeypatch.setattr(op9, "audit", lambda *_: 0.0)
    got, links = _embedded(spark, x)
    assert searched == [op9.OVERLAP, op9.OVERLAP + 1, op9.OVERLAP + 2]
    assert [got[i].n_links for i in range(len(x))] == links.tolist()


def test_embeddings_audit_counts_what_is_missing(spark):
    x = _scattered(np.random.default_rng(4), 500, 16, 200)
    rows = [(0, i, True, v.tolist(), 1) for i, v in enumerate(x)]
    loose = spark.createDataFrame(rows, "u long, point long, home boolean, v array<double>, copies long")
    y = x / np.linalg.norm(x, axis=1)[:, None]
    link = y @ y.T >= 0.9
    np.fill_diagonal(link, False)
    every = spark.createDataFrame([(0, i, 0, int(n)) for i, n in enumerate(link.sum(axis=1)) if n], "u long, point long, low long, links long")
    assert op9.audit(loose, every, 1000) == 1.0
    half = every.withColumn("links", F.floor(F.col("links") / 2))
    assert op9.audit(loose, half, 1000) < 0.7
    assert op9.audit(loose, every.where("false"), 1000) == 0.0


def test_pruned_graph_reaches_near_vectors():
    x = op9.matrix(pa.array(list(_scattered(np.random.default_rng(5), 800, 16, 300))))
    adj = op9.pruned_graph(x)
    assert adj.shape[1] <= op9.DEGREE
    q, v = op9.range_search(x, adj, 0.9)
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    assert link[q, v].all() and len(q) >= 0.97 * link.sum()


def test_graph_reaches_all_of_a_group():
    # in a group of near copies, many are among nobody's nearest neighbours
    rng = np.random.default_rng(6)
    one = rng.normal(size=64)
    x = np.concatenate([one + 0.11 * rng.normal(size=(230, 64)), rng.normal(size=(900, 64))])
    x = op9.matrix(pa.array(list(x)))
    adj = op9.pruned_graph(x)
    a, k = np.nonzero(adj >= 0)
    q, v = op9.range_search(x, op9.undirected(a, adj[a, k], len(x)), 0.9)
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    assert link.sum() > 50_000 and link[q, v].all() and len(q) >= 0.99 * link.sum()


def test_embeddings_repeated_and_null_ids(spark):
    a, b = [1.0, 0.0, 0.2], [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(1, a), (1, a), (None, a), (None, b), (2, b), (3, [0.5, -1.0, 3.0])], "vec_id long, embedding array<double>")
    got = Counter(map(tuple, op9.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()))
    assert got == Counter([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, 2, False), (2, 1, 2, True), (3, 0, 3, True)])


def test_lines(docs, empty):
    got = op10.line_dedup(docs.drop("kept", "score")).collect()
    assert op10.line_dedup(empty).count() == 0
    seen1, seen2, want, done = set(), set(), Counter(), {}
    for i, t in sorted(rows(), key=lambda x: key(x[0])):
        if (i, t) not in done:
            lines = (t or "").split("\n")
            seq = [(j, x) for j, x in enumerate(lines) if WORD.search(x)]
            gone = set()
            for a, (_, x) in enumerate(seq):
                if x in seen1 and len(WORD.findall(x)) >= 20:
                    gone.add(a)
                seen1.add(x)
                if a + 1 < len(seq):
                    if (x, seq[a + 1][1]) in seen2:
                        gone |= {a, a + 1}
                    seen2.add((x, seq[a + 1][1]))
            out = {seq[a][0] for a in gone}
            kept = None if t is None else "\n".join(x for j, x in enumerate(lines) if j not in out)
            done[(i, t)] = (i, kept, len(seq), len(gone), sum(a - 1 not in gone for a in gone))
        want[done[(i, t)]] += 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed, r.n_runs) for r in got) == want


@pytest.mark.parametrize("least", [1, 3, 5])
def test_lines_any_run_length(spark, least):
    import random

    rng = random.Random(least)
    data = []
    for i in range(60):
        lines = [f"l{rng.randint(0, 60)}" for _ in range(rng.randint(0, 25))]
        if i and rng.random() < 0.7:  # a run of an earlier text
            src = rng.choice(data)[1].split("\n")
            a = rng.randint(0, len(src))
            lines[(at := rng.randint(0, len(lines))) : at] = src[a : a + rng.randint(1, 12)]
        data.append((i, "\n".join(lines)))
    data.append((100, "漢" * 250 + "\nx1"))
    data.append((101, "x2\n" + "漢" * 250 + "\nx3"))
    seen, single, want = set(), set(), {}
    for i, t in data:
        seq = [(j, x) for j, x in enumerate(t.split("\n")) if x.strip()]
        gone = set()
        for a in range(len(seq)):
            run = tuple(x for _, x in seq[a : a + least])
            if len(run) == least:
                if run in seen:
                    gone |= set(range(a, a + least))
                seen.add(run)
            if seq[a][1] in single and len(seq[a][1]) >= 200:
                gone.add(a)
            single.add(seq[a][1])
        out = {seq[a][0] for a in gone}
        want[i] = ("\n".join(x for j, x in enumerate(t.split("\n")) if j not in out), len(gone))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text, r.n_removed) for r in op10.line_dedup(df, min_lines=least).collect()}
    assert got == want and sum(n for _, n in got.values()) > 20 and got[101][1] == 1


def test_pipeline_stages(spark, docs):
    stage, d = run_dir(spark, "pipeline-test"), docs.select(*corpus_pipeline.COLUMNS)
    ids = {i for i, _ in rows()}
    for n, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, d, SF)
        out.write.parquet(f"{stage}/{n}")
        new = spark.read.parquet(f"{stage}/{n}")
        assert {r.doc_id for r in new.select("doc_id").distinct().collect()} <= ids, name
        if n < 4:
            assert new.columns == corpus_pipeline.COLUMNS
        if name == "jaccard_dedup":
            left = _links([(r.doc_id, r.text) for r in new.collect()])
            assert all(k[3] == 0 for k in left)
        d = new
    assert d.count() > 0
    assert all(step(spark, docs.where("false").select(*corpus_pipeline.COLUMNS), SF).count() == 0 for _, step in corpus_pipeline.STAGES)


def test_pipeline_deals_prefixes_without_a_row_each(spark, monkeypatch):
    """In stage 3 the shingles of the prefixes meet packed, not as rows."""
    plans = {}
    write = op4.Stage.write

    def seen(self, df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(op4.Stage, "write", seen)
    long = " ".join(f"w{j}" for j in range(60))
    data = [(1, long), (2, long + " more"), (3, " ".join(f"v{j}" for j in range(60))), (4, ""), (None, "a b c d e f")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.jaccard_dedup(spark, df, None).collect()
    assert Counter(r.doc_id for r in got) == Counter([1, 3, 4, None])
    assert "MapInArrow" in plans["met"] and "Generate" not in plans["met"]
