"""Source mixing, hard negatives and the prefix trie against plain versions."""

import hashlib
import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers as H  # noqa: E402

from tessera.llm import hard_negatives, mixing, trie  # noqa: E402

# ---- source mixing ----


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """The sharing, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        got = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if got[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else got[s] for s in names}
        full |= over


def mix_rows():
    rng = random.Random(3)
    rows = H.awkward_docs() + H.odd_rows()
    for k in range(300):  # a third of all rows in one source
        rows.append((1000 + k, H.prose(rng, rng.randrange(0, 90)), "en", "hot" if k % 3 == 0 else rng.choice([None, "", "ß", "a", "Z", "z"]), 0))
    return rows + [(5000, None, None, "nothing", 0), (5001, " \n", None, "nothing", 0)]


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_mix_takes_each_sources_target(spark, block):
    rows = mix_rows()
    m = mixing.mix(H.frame(spark, rows, clashing=True), block=block)
    out = mixing.taken(m).collect()
    size = lambda t: len(H.space_words(t))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in out) == sorted((i is None, i or 0, size(t)) for i, t, *_ in rows)
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want, got = plain_targets(sizes), {}
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6) and r.taken <= 2 * r.size
        got[r.source] = got.get(r.source, 0) + r.taken
    assert all(abs(got[s] - want[s]) <= 0.5 for s in want)
    assert math.isclose(sum(want.values()), 1.5 * sum(sizes.values()))


def test_mix_schedule_is_even_and_repeats(spark):
    docs = H.frame(spark, mix_rows())
    m = mixing.mix(docs, block=8)
    slots = [tuple(r) for r in m.slots.select("position", "s", "epoch", "block", "words").orderBy("position").collect()]
    assert [r[0] for r in slots] == list(range(len(slots)))
    n, count = len(slots), {}
    for r in slots:
        count[r[1]] = count.get(r[1], 0) + 1
    seen = dict.fromkeys(count, 0)
    for k, r in enumerate(slots, 1):  # every run from the start has the sources near their weights
        seen[r[1]] += 1
        assert all(abs(seen[s] - count[s] * k / n) < 4 for s in count)
    for s in count:  # a source's slots hold its blocks in order, epoch by epoch
        own = [r[2:4] for r in slots if r[1] == s]
        assert own == sorted(own) and len(set(own)) == len(own)
    held = {(r.position): r.n for r in m.schedule.where("position IS NOT NULL").groupBy("position").agg(F.sum(F.col("to") - F.col("from")).alias("n")).collect()}
    assert all(held[r[0]] == r[4] for r in slots)
    again = mixing.mix(docs.repartition(5), block=8)
    assert sorted(map(tuple, mixing.taken(m).collect()), key=repr) == sorted(map(tuple, mixing.taken(again).collect()), key=repr)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(None, "a b c", "", None, None)] * 3])
def test_mix_of_little(spark, rows):
    out = mixing.taken(mixing.mix(H.frame(spark, rows))).collect()
    assert len(out) == len(rows) and sum(r.taken for r in out) == round(1.5 * sum(r.size for r in out))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 5000))
def test_points_meet_each_place_once(n):
    g = mixing.step_of(n)
    assert sorted(i * g % n for i in range(n)) == list(range(n))


def test_points_do_not_overflow(spark):
    n = (1 << 41) - 11
    g = mixing.step_of(n)
    at = [0, 1, n // 3, n - 1]
    got = spark.createDataFrame([(i,) for i in at], "i long").select(mixing.times_mod(F.col("i"), g, n).alias("p")).collect()
    assert [r.p for r in got] == [i * g % n for i in at]


# ---- hard negatives ----


def plain_mine(rows):
    """rows: (id, label, vector) -> the contract's rows."""
    good = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, y, a in good:
        if i % 100:
            continue
        score = lambda v: sum(p * q for p, q in zip(a, v))  # noqa: B023, B905, E731
        pos = sorted((-score(v), j) for j, z, v in good if z == y and j != i)[:5]
        for s, j in pos:
            neg = sorted((-score(v), k) for k, z, v in good if z != y and 30 * -s <= 100 * score(v) <= 90 * -s)[:10]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(neg, 1)]
    return sorted(out)


def vectors(seed, n, dim, clusters=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    if clusters:
        x = rng.normal(size=(clusters, dim))[np.arange(n) // 50 % clusters] * 4 + x * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, int(rng.integers(5)), [float(v) for v in x[i].astype(np.float32)]) for i in range(n)]


EMBEDDINGS = "vec_id long, label int, embedding array<float>, id string, slot int, score int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], EMBEDDINGS)


ODD_VECTORS = [
    (None, 1, [1.0, 0.0]), (100, None, [1.0, 0.0]), (200, 1, None), (300, 1, [1.0, None]), (400, 1, [float("nan"), 1.0]), (500, 1, [float("inf"), 0.0]),
    (600, 1, [1.0, 0.5]), (601, 1, [1.0]), (602, 1, []), (603, 2, [0.5, 0.5]), (604, 2, [0.5, 0.5]), (604, 2, [0.5, 0.5]), (605, 3, [-1.0, 0.0]), (700, 3, [0.25, 0.25]), (700, 3, [0.25, 0.25]), (701, 3, [0.9, 0.9]),
]


@pytest.mark.parametrize("rows", [vectors(1, 700, 8), vectors(2, 650, 24, clusters=9), ODD_VECTORS, ODD_VECTORS * 2, [], [(100, 1, [1.0])], [(k, k % 2, [1.0, 0.5]) for k in range(300)]], ids=range(7))
def test_hard_negatives_match_the_plain_version(spark, rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHIPPED", 2000)  # several jobs
    got = hard_negatives.mine(hard_negatives.whole_rows(frame(spark, rows).repartition(3)), F.col("id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == plain_mine(rows)


def test_hard_negatives_rescore_only_what_meets_a_window(spark):
    rows = vectors(4, 5000, 24, clusters=50)
    met = spark.sparkContext.accumulator(0)
    got = hard_negatives.mine(hard_negatives.whole_rows(frame(spark, rows)), F.col("id") % 100 == 0, counter=met).collect()
    assert sorted(map(tuple, got)) == plain_mine(rows)
    assert met.value < 0.8 * 5000 * 50


def test_hard_negatives_refuse_scores_that_do_not_fit(spark):
    with pytest.raises(ValueError, match="53 bits"):
        hard_negatives.mine(hard_negatives.whole_rows(frame(spark, [(100, 1, [1e12]), (1, 1, [1.0])])), F.col("id") % 100 == 0)


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5), st.integers(0, 1000))
def test_spanning_tree_is_least(n, dim, seed):
    a = np.floor(np.random.default_rng(seed).normal(size=(n, dim)) * 4)
    order, parent, edge = hard_negatives.spanning_tree(a)
    assert sorted(order.tolist()) == list(range(n)) and (parent < 0).sum() == 1
    place = {j: k for k, j in enumerate(order.tolist())}
    assert all(p < 0 or place[p] < place[j] for j, p in enumerate(parent.tolist()))
    d = np.sqrt(((a[:, None] - a[None]) ** 2).sum(-1))
    link, total = list(range(n)), 0.0
    for w, i, j in sorted((d[i, j], i, j) for i in range(n) for j in range(i)):
        while link[i] != i:
            i = link[i]
        while link[j] != j:
            j = link[j]
        if i != j:
            link[i], total = j, total + w
    assert math.isclose(edge.sum(), total, abs_tol=1e-4)


# ---- prefix trie ----


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members, kids, leaves, saved = {}, {}, {}, {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids.get(k, [])) or 1
        saved[k] = sum(saved[x] for x in kids.get(k, [])) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    ends = lambda k, m: H.sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)))
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves[k], saved[k], ends(k, m)) for k, m in members.items()), key=repr)


def talk(seed, many, alphabet, longest, deep):
    rng, rows = random.Random(seed), []
    base = [rng.choice(alphabet) for _ in range(deep)]
    for c in range(many):
        seq = [rng.choice(alphabet) for _ in range(rng.randrange(longest + 1))]
        if rng.random() < 0.3:
            seq = base[: rng.randrange(1, deep)] + seq
        rows += [(c, k if k or rng.random() < 0.9 else None, rng.choice(["user", None]) if k % 7 == 3 else "user", x) for k, x in enumerate(seq)]
    rows += [(None, 1, "a", "b"), (-7, 0, "user", "x"), (-3, 0, "user", "y"), (-3, 0, "user", "y")]
    rng.shuffle(rows)
    return rows


#: A group of equal conversations of over WIDTH turns, one that is its beginning and one that goes on.
SAME = [(c, k, "user", f"t{k}") for c in (*range(100, 400, 5), 5005, 5010) for k in range(70 if c < 5000 else 64 if c == 5005 else 150)]
TALKS = [talk(1, 60, ["a", "b", "é", None, ""], 4, 6), talk(2, 200, ["a", "b"], 3, 150), talk(3, 200, ["a", "bb", "ccc"], 9, 200), SAME, [], [(1, 0, "user", "x")], [(3, None, None, None)] * 2]


@pytest.mark.parametrize("shards", [1, 3, 40])
@pytest.mark.parametrize("rows", TALKS, ids=range(len(TALKS)))
def test_trie_matches_the_plain_version(spark, rows, shards):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, conv long, path string, family string")
    got = sorted((tuple(r) for r in trie.nodes(trie.rebuilt(df), shards).collect()), key=repr)
    assert got == plain_trie(rows)


def test_trie_of_the_whole_table(spark):
    from conftest import SF

    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted((tuple(r) for r in trie.nodes(trie.rebuilt(df)).collect()), key=repr)
    assert got == plain_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=9), min_size=1, max_size=30), st.sampled_from([1, 2, 3, 64]))
def test_paths_are_sorted_by_turns_then_conversation(seqs, width):
    lens = np.array([len(x) for x in seqs])
    flat = np.array([y for x in seqs for y in x], np.int64)
    conv = np.random.default_rng(len(seqs)).permutation(len(seqs))
    order, shared = trie.sort_paths(flat, np.cumsum(lens) - lens, lens, conv, width)
    assert order.tolist() == sorted(range(len(seqs)), key=lambda i: (seqs[i], conv[i]))
    ordered = [seqs[i] for i in order]
    common = [next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(ordered, ordered[1:], strict=False)]
    assert shared.tolist() == [-1, *common]
