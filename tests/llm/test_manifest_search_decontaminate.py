"""Operators 11 to 13 against brute force and their SQL."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from oracle_check import TABLES, rows_of  # noqa: E402
from weir.llm import op11_manifest as op11  # noqa: E402
from weir.llm import op12_search as op12  # noqa: E402
from weir.llm import op13_decontaminate as op13  # noqa: E402
from weir.llm.oracle import ORACLE  # noqa: E402
from weir.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, rows) == rows_of(cols, res.fetchall())


# ---- op11 ------------------------------------------------------------------------


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """Root and, for every leaf, its siblings (before, after) level by level."""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, a in enumerate(at):
            lo = a - a % 16
            proofs[i].append(("".join(level[lo:a]), "".join(level[a + 1 : lo + 16])))
        level = [_h(*level[i : i + 16]) for i in range(0, len(level), 16)]
        at = [a // 16 for a in at]
    return level[0], proofs


def _leaf(*fields):
    return _h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def _manifest(rows, tampered):
    """(doc_id, leaf, subroot, root, proof digest, folded root) of every row."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0], _leaf(*r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subs = [_tree([x[1] for x in by[s]]) for s in order]
    root, over = _tree([s for s, _ in subs])
    out = Counter()
    for s, (sub, proofs), above in zip(order, subs, over):
        for (i, leaf, r), proof in zip(by[s], proofs):
            whole = proof + above
            node = _leaf(*tampered(r))
            for b, a in whole:
                node = _h(b, node, a)
            out[(i, leaf, sub, root, _h(*[b + a for b, a in whole]), node, node == root)] += 1
    return out


def _tampered(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
    return (*r[:4], r[4].translate(LOWER)) if hit and r[4] is not None else r


def test_manifest(spark):
    rng = random.Random(3)
    # a source of several superblocks, one with 257 leaves, lone leaves, many sources
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(700)]
    rows += [(1000 + i, "next", None, None, None if i % 7 == 0 else "É" * i) for i in range(257)]
    rows += [(2000 + i, f"s{i:03}", "xx", 1, "One") for i in range(300)]
    rows += [(None, None, None, None, None), (None, "hot", "de", 2, "a"), (5, "hot", "en", 5, "Text 5"), (5, "hot", "en", 5, "Other")]
    rows += [(7, "", "en", 0, ""), (8, None, "en", 9, "LONG " * 200_000)]
    rng.shuffle(rows)
    names = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos long, tree string"
    df = spark.createDataFrame([(*r, "x", 1, "t") for r in rows], names).repartition(5)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    for depth in (1, 2):
        got = op11.merkle_manifest(df, received={"text": F.when(hit, op11.lower_az(F.col("text")))}, depth=depth, proofs=True).collect()
        have = Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got)
        assert have == _manifest(rows, _tampered)
        assert 0 < sum(not r.verified for r in got) < len(got)
        for r in got[:50]:
            assert op11.fold(r.leaf, r.proof) == r.root and op11.proof_digest(r.proof) == r.proof_sha256
    assert op11.merkle_manifest(df.where("false")).count() == 0


def test_manifest_of_one_row(spark):
    df = spark.createDataFrame([(1, "a", "en", 3, "abc")], "doc_id long, source string, lang string, n_chars long, text string")
    (r,) = op11.merkle_manifest(df).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == _h("") and r.verified


# ---- op12 ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _search(docs, items, k=10):
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(LOWER)))
    out = Counter()
    for item, ws in asked.items():
        weights = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in ws if df[w]}
        scored = []
        for i, c, n in counted:
            m = 10 + (90 * n * n_docs) // n_terms
            s = sum(x * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w, x in weights.items() if w in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1):
            out[(item, rank, None if none else i, -s)] += 1
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    # a few frequent words, many rare ones, documents that hold whole items
    words = [f"w{i}" for i in range(400)]
    odds = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(rng.choices(words, odds, k=rng.randint(1, 120)))) for i in range(1500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(2, 25)))) for i in range(40)]
    docs += [(2000 + i, t.upper() + ", " + docs[i][1]) for i, (_, t) in enumerate(items)] * 2
    docs += [(None, "w5 w6 w7"), (None, None), (3000, ""), (3001, " -- \x00\x7f"), (3002, "w1 " * 60_000), (3003, "É-é w399_w398")]
    items += [(3, "w1 extra"), (100, None), (101, ""), (102, "nowhere"), (103, "É é"), (None, "w398 w399")]
    rng.shuffle(docs)
    return docs, items


def test_search(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(op12, "SHARD_DOCS", 97)  # many shards a task
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, item string").repartition(4)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, score long")
    want = _search(docs, items)
    got = Counter(map(tuple, op12.search(d, q).select("item_id", "rank", "doc_id", "score").collect()))
    assert got == want
    monkeypatch.setattr(op12, "BLOCK_ITEMS", 7)  # several blocks of items
    assert Counter(map(tuple, op12.search(d, q).select("item_id", "rank", "doc_id", "score").collect())) == want
    assert op12.search(d.where("false"), q).count() == 0
    assert op12.search(d, q.where("false")).count() == 0


def _shard(docs, vocabulary, items, k=10):
    b = op12._ShardBuilder(vocabulary)
    for i, t in docs:
        b.add(i, t.encode())
    row = {n: np.asarray(v[0]) for n, v in b.row().items() if n not in ("n_docs", "n_terms")}
    total = [op12.terms(t.encode()) for _, t in docs]
    n_docs, n_terms = sum(map(bool, total)), sum(map(len, total))
    df = dict(zip(row["term"].tolist(), row["cnt"].tolist()))
    plans, pairs = op12.plan_pairs([[vocabulary[w] for w in sorted(set(op12.terms(t.encode())))] for _, t in items], df, n_docs)
    row["ratio"] = op12.ratio(row["tf"].astype(np.int64), row["lens"][row["post"]], n_docs, n_terms)
    s = op12.Shard(row)
    s.top = np.maximum.reduceat(s.ratio, s.start[:-1])
    s.add_pairs(pairs, {t: op12.weight(n_docs, f) for t, f in df.items()})
    return s, plans


def test_pair_bounds_hold_and_tighten(corpus):
    """No document scores more than the bounds of its units; the bounds with
    pairs are below those of the terms alone; a threshold loses nothing."""
    docs = [(i, t) for i, t in corpus[0] if t and i is not None and i < 1500]
    items = [(i, t) for i, t in corpus[1] if t and i is not None and i < 40]
    vocabulary = {w: n for n, w in enumerate(sorted({w for _, t in items for w in op12.terms(t.encode())}))}
    s, plans = _shard(docs, vocabulary, items)
    tighter = 0
    for q in plans:
        every, scores = s.search(q, 1)
        slot = op12._lookup(s.term, q.terms)
        alone = np.where(slot >= 0, q.weights * s.top[slot], 0)
        at = op12._lookup(s.pair, q.pairs[:, 2])
        joint = np.where(at >= 0, s.pair_top[at], 0)
        paired = np.maximum(joint, np.maximum(alone[q.pairs[:, 0]], alone[q.pairs[:, 1]])).sum() + alone[q.singles].sum()
        assert scores.max() <= paired <= alone.sum()
        tighter += paired < alone.sum()
        least = int(np.sort(scores)[-10])
        some, best = s.search(q, least)
        keep = scores >= least
        assert dict(zip(some, best)) == dict(zip(every[keep], scores[keep]))
        seeds = s.seeds(q, 10)
        assert set(seeds.tolist()) <= set(scores.tolist())
    assert tighter > len(plans) // 2


# ---- op13 ------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _windows(items, window=10):
    out = defaultdict(set)
    for i, t in items:
        ws = WORD.findall((t or "").translate(LOWER))
        if ws:
            k = min(len(ws), window)
            for a in range(len(ws) - k + 1):
                out[tuple(ws[a : a + k])].add("" if i is None else str(i))
    return out


def _hits(text, wins, sizes):
    ws = WORD.findall((text or "").translate(LOWER))
    hit, found = [False] * len(ws), set()
    for k in sizes:
        for a in range(len(ws) - k + 1):
            w = tuple(ws[a : a + k])
            if w in wins:
                found |= wins[w]
                hit[a : a + k] = [True] * k
    return hit, found


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(5)
    words = [f"v{i}" for i in range(30)]  # few words: runs repeat within and between items

    def some(n):
        return rng.choices(words, k=n)

    items = [(i, " ".join(some(rng.randint(10, 40)))) for i in range(30)]
    items += [(100 + i, " ".join(some(n))) for i, n in enumerate((1, 2, 2, 3, 5, 9, 9))]
    items += [(200, "ab ab ab ab ab ab ab ab ab ab ab ab"), (201, items[0][1]), (0, items[1][1]), (202, None), (203, " ,"), (None, "q r s t")]
    docs = []
    for i in range(400):
        t = some(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            src = rng.choice(items)[1] or ""
            ws = src.split()
            a = rng.randint(0, len(ws))
            t[(at := rng.randint(0, len(t))) : at] = ws[a : a + rng.randint(5, 30)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(t).upper()))
    docs += [(500, None), (501, ""), (502, "ab " * 300), (503, "Q-r_S!t"), (503, "Q-r_S!t"), (504, "zz " * 50_000 + items[2][1]), (None, "é " * 5)]
    return docs, items


@pytest.mark.parametrize("block", [op13.BLOCK_WORDS, 40])  # one automaton, several
@pytest.mark.parametrize("short", [True, False])
def test_decontaminate(spark, leaks, monkeypatch, block, short):
    docs, items = leaks
    if not short:
        items = [(i, t) for i, t in items if i is not None and (i < 100 or i >= 200)]
    monkeypatch.setattr(op13, "BLOCK_WORDS", block)
    d = spark.createDataFrame([(i, t, "x", 1, [1]) for i, t in docs], "doc_id long, text string, items string, row int, spans array<int>").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, length int")
    got = op13.decontaminate(d, b).collect()
    wins = _windows(items)
    sizes = {len(w) for w in wins}
    want = Counter()
    for i, t in docs:
        hit, found = _hits(t, wins, sizes)
        want[(i, len(hit), sum(hit), tuple(sorted(found)), any(hit))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == want
    for r in got:
        assert sum(s["last"] - s["first"] for s in r.spans) == r.n_hit
        if not r.contaminated:
            assert r.cleaned == r.text
        elif r.n_hit > 0.5 * r.n_words:
            assert r.cleaned is None
        else:  # the words outside the spans, as they stand in the text
            gone = {i for s in r.spans for i in range(s["first"], s["last"])}
            ws = op13.words(r.text.encode())
            assert op13.words(r.cleaned.encode()) == [w for i, w in enumerate(ws) if i not in gone]
    assert op13.decontaminate(d.where("false"), b).count() == 0
    assert all(not r.contaminated for r in op13.decontaminate(d, b.where("false")).collect())


def test_suffix_automaton_accepts_the_runs_of_the_items_only():
    rng = random.Random(1)
    items = {i: [b"abcd"[c : c + 1] for c in rng.choices(range(4), k=rng.randint(1, 14))] for i in range(25)}
    auto = op13.SuffixAutomaton(items, 4)
    runs = {tuple(ws[a:b]) for ws in items.values() for a in range(len(ws)) for b in range(a + 1, len(ws) + 1)}

    def accepts(seq):
        state = 0
        for w in seq:
            state = auto.next[state].get(auto.vocabulary.get(w, -1))
            if state is None:
                return False
        return True

    assert all(accepts(r) for r in runs)
    for _ in range(3000):
        seq = tuple(b"abcd"[c : c + 1] for c in rng.choices(range(4), k=rng.randint(1, 9)))
        assert accepts(seq) == (seq in runs)
