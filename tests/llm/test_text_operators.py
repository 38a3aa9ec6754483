"""Quality rules, line dedup, SimHash, decontamination, substring dedup, licences against plain versions."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers as H  # noqa: E402

from tessera.llm import covering, decontaminate, licenses, line_dedup, phrase_dedup, quality_rules, simhash  # noqa: E402
from tessera.llm.common import c  # noqa: E402

CASES = {"awkward": H.awkward_docs(), "odd": H.odd_rows() * 3, "empty": []}


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("case", CASES)
def test_quality_rules(spark, case):
    docs = H.frame(spark, CASES[case], clashing=True)
    out, names = quality_rules.apply_rules(docs, features=quality_rules.BASE, sample_rows=20)
    base = {x: c(names[x]) for x in quality_rules.BASE}
    got = rows_of(out, "doc_id", *base.values(), quality_rules.base_failed(base), c(names["rejected_by"]).isNull())
    assert got == sorted(((i, *H.plain_quality(t)) for i, t, *_ in CASES[case]), key=repr)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == sorted(((i, t) for i, t, *_ in CASES[case] if H.plain_quality(t)[-1]), key=repr)


def test_quality_rules_are_ordered_by_rejections_per_second(spark):
    docs = H.frame(spark, [(i, "a b", None, None, None) for i in range(50)])
    order = quality_rules.rule_order(docs)
    assert [x["rank"] for x in order] == sorted((x["rank"] for x in order), reverse=True)
    assert {x["rule"].name: x["selectivity"] for x in order}["few_words"] == 1.0


@pytest.mark.parametrize("case", CASES)
def test_line_dedup(spark, case):
    docs = H.frame(spark, CASES[case], clashing=True)
    out, names = line_dedup.drop_frequent_lines(docs, min_docs=4)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = rows_of(out, "doc_id", c(names["n_lines"]), c(names["n_dropped"]), "text")
    assert got == sorted(H.plain_lines(CASES[case], 4), key=repr)


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("crowd", [simhash.CROWD, 0])
def test_simhash(spark, case, crowd):
    rows = CASES[case]
    fps = [(i, H.plain_simhash(t)) for i, t, *_ in rows]
    want = sorted(((i, f"{f:016x}", k) for (i, f), k in zip(fps, H.plain_components(fps), strict=True)), key=repr)
    near = simhash.near_duplicates(H.frame(spark, rows, clashing=True), crowd=crowd)
    assert rows_of(near, "doc_id", simhash.hex16(F.col("fp")), "component_id") == want


def test_simhash_keeps_one_of_each_component(spark):
    docs = H.frame(spark, CASES["awkward"] + [(40, CASES["awkward"][-1][1], "x", "x", 0), CASES["awkward"][5]], clashing=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    near = simhash.near_duplicates(docs)
    assert kept.count() == near.select("root").distinct().count()
    assert simhash.near_duplicates(kept).select("root").distinct().count() == kept.count()


def test_links_of_chains_and_crowds(spark):
    rng = random.Random(3)
    center = rng.getrandbits(64)
    chain = [center]
    for k in range(40):  # each within two bits of the one before, all in few anchors
        chain.append(chain[-1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    ball = [center ^ (1 << a) for a in range(64)] + [center ^ (1 << a) ^ (1 << b) for a in range(0, 64, 5) for b in range(a)]
    values = sorted(set(chain + ball + [rng.getrandbits(64) for _ in range(300)]))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = H.plain_components([(s, v) for s, v in zip(signed, values, strict=True)])
    for crowd in (10_000, 8):
        found = dict(map(tuple, simhash.components(simhash.links(fps, crowd=crowd)).collect()))
        assert [found.get(s, s) for s in signed] == want


def test_anchors_cover_two_bits():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 2000).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 2000).astype(np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    at, anchor = covering.anchors(y, 2)
    assert set(at[anchor == covering.home(x)[at]].tolist()) == set(range(2000))
    assert len(set(zip(at.tolist(), anchor.tolist(), strict=True))) == len(at)


ITEMS = [(1, None), (2, ""), (3, "w1"), (4, H.prose(random.Random(1), 60)), (5, "É cödé"), (None, "w2 w3"), (6, "a"), (6, "x y x y x y x y x y x y x y"), (7, "…")]


@pytest.mark.parametrize("case", CASES)
def test_contamination(spark, case):
    docs = H.frame(spark, CASES[case], clashing=True)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.contamination(docs, bench)
    want = sorted(H.plain_contamination(CASES[case], ITEMS), key=repr)
    assert rows_of(out, "doc_id", "n_words", "n_hit", "items", "contaminated") == want
    bad = {i for i, *_, x in want if x}
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == sorted(((i, t) for i, t, *_ in CASES[case] if i not in bad), key=repr)


def test_contamination_of_an_empty_benchmark(spark):
    out = decontaminate.contamination(H.frame(spark, CASES["awkward"]), spark.createDataFrame([], "item_id long, text string"))
    assert out.where("n_hit > 0 or contaminated").count() == 0 and out.count() == len(CASES["awkward"])


def test_query_blocks_give_the_same_matches(spark, monkeypatch):
    docs, bench = H.frame(spark, CASES["awkward"]), spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = rows_of(decontaminate.contamination(docs, bench), "doc_id", "n_hit", "items")
    monkeypatch.setattr(decontaminate, "QUERY_BYTES", 20)
    assert rows_of(decontaminate.contamination(docs, bench), "doc_id", "n_hit", "items") == whole


def test_one_query_block_is_held_at_a_time(spark, monkeypatch):
    import gc
    import weakref

    docs = H.frame(spark, [(1, "one two three", None, None, 0), (2, "alpha beta", None, None, 0)]).coalesce(1)
    items = [(k, f"word{k} other{k}" if k % 2 else "two three") for k in range(60)]
    monkeypatch.setattr(decontaminate, "QUERY_BYTES", 1)
    alive, most, seen, make = [], 0, 0, decontaminate.Queries

    def counted(*a):
        nonlocal most, seen
        gc.collect()
        q = make(*a)
        alive.append(weakref.ref(q))
        seen += 1
        most = max(most, sum(x() is not None for x in alive))
        return q

    monkeypatch.setattr(decontaminate, "Queries", counted)
    out = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert seen == 60 and most <= 3  # the block in use, the one before and the next
    assert {r["doc_id"]: len(r["items"]) for r in out} == {1: 30, 2: 0}


def test_proximity_matches(spark):
    docs = H.frame(spark, [(1, "red big fox jumps", None, None, 0), (2, "red fox jumps", None, None, 0), (3, "red a b c fox jumps", None, None, 0), (4, "fox jumps", None, None, 0)])
    index = decontaminate.build_index(docs)
    q = decontaminate.Queries(["i"], ["red fox jumps"])
    places = lambda slop: sorted(r["place"] for r in decontaminate.find(index, q, slop).collect())
    docs_of = lambda slop: len(places(slop))
    assert docs_of(0) == 1 and docs_of(1) == 2 and docs_of(3) == 3


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("shard", [phrase_dedup.SHARD_SEGMENTS, 2])
def test_phrase_dedup(spark, case, shard):
    out = phrase_dedup.remove_repeats(H.frame(spark, CASES[case], clashing=True), shard_segments=shard)
    assert rows_of(out, "doc_id", "n_words", "n_removed", "kept") == sorted(H.plain_phrases(CASES[case]), key=repr)


def test_phrase_dedup_of_a_common_phrase_in_many_contexts(spark):
    rng = random.Random(4)
    common = H.prose(rng, 8, 50)
    rows = [(i, f"{H.prose(rng, 14, 30)} {common} {H.prose(rng, 14, 30)}", None, None, None) for i in range(60)]
    rows += [(100 + i, t, None, None, None) for i, (_, t, *_) in enumerate(rows[::7])]
    out = phrase_dedup.remove_repeats(H.frame(spark, rows), shard_segments=3)
    assert rows_of(out, "doc_id", "n_words", "n_removed", "kept") == sorted(H.plain_phrases(rows), key=repr)


TEMPLATES = [("A", "you may copy this work for any purpose"), ("B", "you may copy this work for any good purpose"), ("C", "all rights are reserved"), ("D", "all rights are reserved")]


def plain_scan(text, least=0.8):
    """Best template of each unit: lines, paragraphs, whole text, each run of words once."""
    units, at = [], 0
    spans = []
    for line in (text or "").split("\n"):
        n = len(H.alnum_words(line))
        spans.append((at, at + n))
        at += n
    words = H.alnum_words(text)
    lines = [s for s in spans if s[0] < s[1]]
    paragraphs, now = [], None
    for s in spans:
        if s[0] == s[1]:
            now = None
        elif now is None:
            now = [*s]
            paragraphs.append(now)
        else:
            now[1] = s[1]
    units = [("line", *s) for s in lines] + [("paragraph", *s) for s in paragraphs] + ([("text", 0, len(words))] if words else [])
    out, seen = [], set()
    for kind, a, b in units:
        unit = " ".join(words[a:b])
        best = max(((H.plain_dice(unit, t), -k) for k, (_, t) in enumerate(TEMPLATES)), default=(0, 0))
        if best[0] >= least and (a, b) not in seen:
            seen.add((a, b))
            out.append((kind, a, b - a, TEMPLATES[-best[1]][0], round(best[0], 9)))
    return sorted(out, key=lambda m: (m[1], m[2]))


def test_license_scan(spark):
    rng = random.Random(6)
    texts = ["You may copy this work, for any purpose!\nAll rights are reserved.", "all rights\nare reserved", "x\n\nyou may copy this\nwork for any good purpose\n\ny z", None, "", "all", "ALL RIGHTS ARE"]
    for _ in range(80):
        t = rng.choice(TEMPLATES)[1].split()
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(t))] = rng.choice(["this", "all", "zz"])
        texts.append(rng.choice(["", "lead in\n", "p q\n\n"]) + " ".join(t).replace(" ", rng.choice([" ", " ", "\n"])) + rng.choice(["", " tail", "\n\nend"]))
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    out = licenses.scan(H.frame(spark, rows, clashing=True), templates=TEMPLATES).collect()
    got = {r["doc_id"]: [(m["unit"], m["first_word"], m["n_words"], m["license"], round(m["dice"], 9)) for m in r["matches"]] for r in out}
    assert {r["doc_id"]: r["n_words"] for r in out} == {i: len(H.alnum_words(t)) for i, t in enumerate(texts)}
    assert got == {i: plain_scan(t) for i, t in enumerate(texts)}
    assert licenses.scan(H.frame(spark, [])).count() == 0


def test_license_scan_finds_the_stock_texts(spark):
    rows = [(i, f"/* some code */\n\n{text}\n\nint main", None, None, None) for i, (_, text) in enumerate(sorted(licenses.TEXTS.items()))]
    out = licenses.scan(H.frame(spark, rows)).orderBy("doc_id").collect()
    assert [sorted({m["license"] for m in r["matches"]}) for r in out] == [[k] for k in sorted(licenses.TEXTS)]


MIT_LAYOUT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def licences_of(spark, texts):
    out = licenses.scan(H.frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    return [sorted({m["license"] for m in [*r["matches"], *r["spans"]]}) for r in out]


def test_license_scan_finds_licences_that_are_no_unit(spark):
    rng = random.Random(8)
    texts = [
        f"{H.prose(rng, 300)}\n\nMIT License\n\nCopyright (c) 2020 Jane Doe\n\n{MIT_LAYOUT}\n\n{H.prose(rng, 300)}",
        "Copyright (c) 2020 Jane Doe. Licensed under the MIT License.",
        "The code below is released under the MIT License, so feel free to use it.",
        "This project is licensed under the terms of the Jane Doe agreement, so ask first.",
        "It is released under the MIT License. The data is licensed under CC BY 4.0, as said above.",
    ]
    assert licences_of(spark, texts) == [["MIT"], ["MIT"], ["MIT"], [], ["CC-BY-4.0", "MIT"]]


def test_license_scan_knows_each_licence(spark):
    assert {k for k, _ in (*licenses.TEXTS.items(), *licenses.OPENINGS)} == licenses.NAMES.keys()
    rng = random.Random(4)
    published = sorted({*licenses.TEXTS.items(), *licenses.OPENINGS})
    lines = [(k, H.prose(rng, 40) + "\n\n" + t.replace(". ", ".\n\n") + "\n\n" + H.prose(rng, 40)) for k, t in published]
    lines += [("GPL-2.0", "# SPDX-License-Identifier: GPL-2.0-or-later"), ("MIT", "// SPDX-License-Identifier: MIT"), (None, "// SPDX-License-Identifier: LicenseRef-Own")]
    lines += [("Unlicense", "This is free and unencumbered software released into the public domain.")]
    assert list(zip([t for _, t in lines], licences_of(spark, [t for _, t in lines]), strict=True)) == [(t, [k] if k else []) for k, t in lines]


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_crowded_anchors_at_any_threshold(spark, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(63) for _ in range(3)}
    fps |= {f ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for f in list(fps) for _ in range(12)}
    fps |= {f ^ (1 << rng.randrange(63)) for f in list(fps)}
    df = spark.createDataFrame([(f,) for f in sorted(fps)], "fp long")
    want = {f: f for f in fps}
    for f in sorted(fps):  # a component's smallest fingerprint
        todo = [f] if want[f] == f else []
        while todo:
            x = todo.pop()
            near = [y for y in fps if (x ^ y).bit_count() <= bits and want[y] > f]
            want |= dict.fromkeys(near, f)
            todo += near
    out = simhash.links(df, bits, crowd=1).collect()
    assert all(u > v and (u ^ v).bit_count() <= bits for u, v in out)
    root = {f: f for f in fps}
    find = lambda f: f if root[f] == f else find(root[f])
    for u, v in out:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    assert {f: find(f) for f in fps} == want
