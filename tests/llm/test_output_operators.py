"""HTML text, token ids, packing, chat formatting and the pipeline."""

import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers as H  # noqa: E402

from tessera.llm import chat, html_extract, packing, simple8b  # noqa: E402
from tessera.llm.tokens import default_tokenizer, encode_texts  # noqa: E402
from tessera.session import scratch_path  # noqa: E402

CASES = {"awkward": H.awkward_docs(), "odd": H.odd_rows(), "empty": []}
END = 2


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD_TEXTS = [
    None, "", " \n", "a\x0bb", "<|endoftext|> x<|startoftext|>y", "<|ENDOFTEXT|>a", "don't,'s x'.s é,ɏ.a×.b 12.5a,b a≠b ﬁ,İ.İ x ΑΣ. ϓ́ a　b,c . Ǆ,ª.",
    "é, É. àb ,́x ≠y", "I'LL we've 'twas x'll, (it's)...[end]", "a b c,d\x85e", "日本語, テキスト。😀!👍🏽 ok", "x" * 3000 + ",," * 50,
]


def test_ids_are_the_tokenizers_own(tokenizer):
    ids, rows = encode_texts(pa.array(ODD_TEXTS), default_tokenizer(), END)
    assert [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)] == [plain_ids(tokenizer, t) for t in ODD_TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(list("aZ'.,!-<|> \né×ß́≠1")), st.characters(codec="utf-8")), max_size=30), min_size=1, max_size=5))
def test_ids_of_any_text(tokenizer, texts):
    ids, rows = encode_texts(pa.array(texts), default_tokenizer(), END)
    assert [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)] == [plain_ids(tokenizer, t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 49407), st.integers(0, 2**64 - 1)), max_size=900), st.data())
def test_simple8b_round_trip(values, data):
    x = np.array(values, np.uint64)
    words, offsets = simple8b.pack(x)
    assert np.array_equal(simple8b.unpack(words, offsets, len(x)), x)
    if values:
        a = data.draw(st.integers(0, len(values)))
        n = data.draw(st.integers(0, len(values) - a))
        assert simple8b.unpack_range(words, offsets, len(x), a, n).tolist() == values[a : a + n]


@pytest.mark.parametrize("case", CASES)
def test_token_files(spark, tokenizer, case):
    rows = CASES[case]
    path = scratch_path(spark, "ids")
    simple8b.write_ids(H.frame(spark, rows, clashing=True), path, default_tokenizer(), END)
    got = sorted(map(tuple, simple8b.read_documents(spark, path).collect()), key=lambda r: r[1])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t, *_ in order:
        ids = plain_ids(tokenizer, t)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want


@pytest.mark.parametrize("case", CASES)
def test_packing(spark, tokenizer, case):
    rows = CASES[case]
    pieces = packing.pack(H.frame(spark, rows, clashing=True), default_tokenizer(), END, window=256).collect()
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(plain_ids(tokenizer, t))
    assert sum(p["length"] for p in pieces) == sum(len(x) for v in texts.values() for x in v)
    sequences, docs = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        docs.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        options = [x for x in texts[p["doc_id"]] if len(x) == p["doc_tokens"]]
        assert any(crc(x[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"] for x in options) and p["length"] > 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256 and at & (at - 1) == 0  # full, or a power of two: no padding
    for (i, n), found in docs.items():
        copies = sum(len(x) == n for x in texts[i])
        cover = sorted((p["start"], p["length"]) for p in found)
        assert sum(x for _, x in cover) == copies * n
        if copies == 1:
            assert [a for a, _ in cover] == [sum(x for _, x in cover[:k]) for k in range(len(cover))]


def test_windows_hold_lexical_neighbours():
    rng = np.random.default_rng(0)
    topics = [rng.choice(np.arange(100 * k, 100 * k + 100), (8, 60)) for k in range(1, 5)]
    docs = [topics[k][j] for j in range(8) for k in range(4)]  # topics take turns
    ids, n = np.concatenate(docs), np.full(32, 60)
    df = np.zeros(600)
    for d in docs:
        df[np.unique(d)] += 1
    index = packing.Bm25(ids, n, np.log1p((32 - df + 0.5) / (df + 0.5)), 60.0)
    windows = packing.fill_windows(ids, n, index, 240)
    assert all(len({d % 4 for d, *_ in w}) == 1 for w in windows)


TURNS = "conv_id long, turn long, role string, text string"
TRICKY = ["\\### Assistant: </turn> ok", "### user: x</turn>\n", "\\", "\\\\h\\t\\c", "", None, "#### ### ", "</turn</turn>", "é\n\n✓: ", "### "]


def test_chat_format(spark):
    rng = random.Random(2)
    rows = [(i, k, rng.choice(["user", "assistant", "system", None, "a: b", "### x\\"]), rng.choice(TRICKY)) for i in range(40) for k in range(rng.randrange(1, 9))]
    rows += [(None, 0, "assistant", "x"), (None, 1, "user", "y"), (3, 1, "assistant", "twice"), (3, 1, "assistant", "twice"), (50, None, "user", "n")]
    rows += [(60, k, "assistant" if k % 2 else "user", f"turn {k} " * 50) for k in range(3000)]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("conv", "formatted", "n_turns"):
        df = df.withColumn(name, F.lit(1))
    formatted = chat.format_conversations(df)
    got = sorted(map(tuple, chat.read_back(formatted).collect()), key=repr)
    groups = {}
    for i, k, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode())):
        groups.setdefault(i, []).append((role or "", text or ""))
    chars = {}
    for x in formatted.collect():
        chars[x["conv_id"]] = chars.get(x["conv_id"], "") + x["formatted"]
    want = []
    for i, turns in groups.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert chat.parse(chars[i]) == turns
        want.append((i, len(turns), H.sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), H.sha(loss), len(chars[i])))
    assert got == sorted(want, key=repr)
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


def test_stored_chunks_are_read_in_any_order(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k}\n") for k in range(30_000)] + [(2, 0, "user", "x"), (None, 0, "user", "y"), (3, 0, "assistant", "é" * 3_000_000), (3, 1, "user", "z" * 5_000_000), (3, 2, "assistant", "end")]
    path = scratch_path(spark, "chat-stored")
    chat.format_conversations(spark.createDataFrame(rows, TURNS)).write.parquet(path)
    stored = spark.read.parquet(path)
    long = sorted(map(tuple, stored.where("conv_id = 1").select("chunk", "first_turn", "n_turns").collect()))
    assert len(long) >= 3 and [x[0] for x in long] == list(range(len(long)))
    assert [x[1] for x in long] == [sum(y[2] for y in long[:k]) for k in range(len(long))]
    got = {r["conv_id"]: r for r in chat.read_back(stored.repartition(7, F.rand(3))).collect()}
    assert len(got) == 4 and got[1]["n_turns"] == 30_000
    assert got[1]["turns_sha256"] == H.sha("".join(f"{r}\n{t}\n" for i, _, r, t in rows if i == 1))
    assert got[3]["loss_sha256"] == H.sha("é" * 3_000_000 + "end") and got[3]["n_turns"] == 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("#\\ht c:</turn>\n")), max_size=20), min_size=1, max_size=4))
def test_chat_escapes_are_reversible(texts):
    cells = [pa.array([chat.OPEN] * len(texts)), chat.escape(pa.array(texts), chat.ROLE_ESCAPES), pa.array([chat.MIDDLE] * len(texts)), chat.escape(pa.array(texts)), pa.array([chat.END] * len(texts))]
    out, _ = chat.assemble(cells)
    assert chat.parse(out.tobytes().decode()) == [(t, t) for t in texts]


ARTICLE = "".join(f"<p>Sentence {k}, which is long enough to be prose, with commas, and it goes on &amp; on.</p>" for k in range(6))
LINES = [f"Sentence {k}, which is long enough to be prose, with commas, and it goes on & on." for k in range(6)]
PAGES = {
    "plain article": (f"<html><head><title>t</title><script>var x='<p>no</p>'</script></head><body><nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>(c)</footer></body></html>", LINES),
    "divs by class": (f"<body><div class='site-header'>Brand</div><div id=menu><ul><li><a href=a>A</a></li></ul></div><div class=post>{ARTICLE}</div><div class='comments'><p>I liked this post, a lot, really, it was so very good to read.</p></div></body>", LINES),
    "sidebar, form and notice": (f"<div class=layout><div class='cookie-notice'><p>We use cookies, to make this site better, for all of you, our readers.</p></div><main>{ARTICLE}<form><p>Sign up, now, for our long newsletter, with many words in it.</p></form><aside><p>About the author, who lives, works, and writes here, every day.</p></aside></main></div>", LINES),
    "sections": (f"<main><section>{ARTICLE[: len(ARTICLE) // 2 + 1]}</section></main>", None),
    "link list inside": (f"<article>{ARTICLE}<ul><li><a href=1>Related story one</a></li><li><a href=2>Related story two</a></li></ul></article>", LINES),
    "references and spaces": ("<p>a &lt;b&gt; &eacute;&#233;&#xe9; \n\t c&nbsp;d<br>e</p>", ["a <b> ééé c d e"]),
    "comment and cdata": ("<!-- <p>x</p> --><p>kept text</p><!-- open", ["kept text"]),
    "cut in a tag": ("<article><p>Some text that is long enough to count as prose.</p><p>More of it<div cla", ["Some text that is long enough to count as prose.", "More of it"]),
    "cut in a reference": ("<p>one &am", ["one &am"]),
    "unclosed": ("<p><b>one<p>two<li>three", ["one", "two", "three"]),
    "no markup": ("just text &amp; more", ["just text & more"]),
    "only scripts": ("<script>x</script><style>y</style>", []),
    "attributes with >": ("<p title='a > b'>text</p>", ["text"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, lines = PAGES[name]
    text = html_extract.main_text(page)
    assert text == "\n".join(lines) if lines is not None else text


def test_extract_pages(spark):
    rows = [(k, f"u{k}", p) for k, (p, _) in enumerate(PAGES.values())] + [(None, None, None), (98, None, ""), (99, "u", "<div>" * 5000 + "deep text" + "</div>" * 5000), (99, "u", "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = html_extract.extract(df).collect()
    assert sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got), key=repr) == sorted(((i, u, t := html_extract.main_text(p), len(t)) for i, u, p in rows), key=repr)
    assert html_extract.extract(df.where("false")).count() == 0


def plain_pipeline(rows, items, tokenizer):
    rows = [r for r in rows if H.plain_quality(r[1])[-1]]
    rows = [(i, kept) for i, _, _, kept in H.plain_lines(rows)]
    fps = [(i, H.plain_simhash(t)) for i, t in rows]
    rows = [r for r, k in zip(rows, H.plain_components(fps), strict=True) if r[0] == k]
    bad = {i for i, *_, x in H.plain_contamination(rows, items) if x}
    return {i: plain_ids(tokenizer, t) for i, t in rows if i not in bad}


def test_pipeline_against_the_plain_version(spark, tokenizer, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    items = [(1, H.prose(rng, 30)), (2, H.prose(rng, 14))]
    rows = CASES["awkward"] + [(200 + k, H.prose(rng, 40) + " " + items[0][1] + " " + H.prose(rng, 20), "en", "s", 1) for k in range(3)]
    H.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = plain_pipeline(rows, items, tokenizer)
    got = {}
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert crc(want[p["doc_id"]][p["start"] : p["start"] + p["length"]]) == p["ids_crc32"]
        got.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    assert {i: sum(n for _, n in v) for i, v in got.items()} == {i: len(x) for i, x in want.items()}


@pytest.mark.parametrize("case", ["odd", "empty"])
def test_pipeline_stages_keep_the_columns(spark, tmp_path, case):
    import corpus_pipeline

    docs = H.frame(spark, CASES[case], clashing=True)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
    corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()


def test_packing_finds_neighbours_of_other_shards(spark, tokenizer):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(60)) for _ in range(12)]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(texts)]
    copies = [(100, texts[0], "en", "s", 1)]
    window = 1 << (2 * max(len(plain_ids(tokenizer, t)) for t in texts) - 1).bit_length()
    docs = H.frame(spark, rows).coalesce(1).unionAll(H.frame(spark, copies).coalesce(1))  # a partition starts a shard
    pieces = packing.pack(docs, default_tokenizer(), END, window=window).collect()
    first = [p["sequence_id"] for p in pieces if p["doc_id"] == 0]
    assert {100} <= {p["doc_id"] for p in pieces if p["sequence_id"] in first}


def test_scores_use_all_terms_of_the_seed():
    n = np.array([101, 51, 50])
    ids = np.concatenate([np.arange(101), np.arange(50, 101), np.arange(200, 250)])
    idf = np.linspace(2, 1, 300)  # the first document's rarest terms are in no other
    score = packing.Bm25(ids, n, idf, 60.0).scores(ids[:101])
    assert score[1] > 0 and score[2] == 0


def test_windows_ask_again_with_the_last_document():
    docs = [np.arange(0, 10), np.arange(50, 60), np.r_[5:10, 20:25], np.r_[20:30]]  # 0 - 2 - 3 share terms, 1 shares none
    ids, n = np.concatenate(docs), np.full(4, 10)
    windows = packing.fill_windows(ids, n, packing.Bm25(ids, n, np.ones(60), 10.0), 30)
    assert [d for d, *_ in windows[0]] == [0, 2, 3]


def plain_fill(docs, idf, mean, window):
    """Windows of a shard's documents (lists of ids), by dictionaries and a plain BM25; the order of the documents."""
    counts = [Counter(x) for x in docs]

    def weight(d, t):
        tf = counts[d][t]
        return tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean)) * idf[t]

    order, at = [], 0
    while len(order) < len(docs):
        query = next(d for d in range(len(docs)) if d not in order)
        order.append(query)
        at += len(docs[query])
        while at % window and len(order) < len(docs):
            score = {d: sum(weight(d, t) for t in counts[query] if t in counts[d]) for d in range(len(docs)) if d not in order}
            near = sorted((d for d in score if score[d] > 0), key=lambda d: (-score[d], d))
            crossed = False
            for d in near:
                before, at = at // window, at + len(docs[d])
                order.append(d)
                if at // window != before:
                    query, crossed = d, True
                    break
            if not crossed:
                if query == order[-1]:
                    break
                query = order[-1]
    return order


def test_packing_is_that_of_a_plain_filler(spark, tokenizer):
    """Several shards, each with several windows and seeds, against plain BM25 over each shard."""
    rng = random.Random(8)
    rows = [(k, H.prose(rng, rng.randrange(1, 120), rng.choice([40, 400])), "en", "s", 1) for k in range(150)] + [(500, None, "en", "s", 1), (501, "", "en", "s", 1), (502, "w1 w2", "en", "s", 1)]
    docs, window, shard_tokens = H.frame(spark, rows).coalesce(1), 256, 5000
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        pieces = packing.pack(docs, default_tokenizer(), END, window=window, shard_tokens=shard_tokens).collect()
        stored = packing.store(docs, default_tokenizer(), END, "doc_id", "text").where("row IS NOT NULL").orderBy("key", "row").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    texts = {i: plain_ids(tokenizer, t) for i, t, *_ in rows}
    assert all(np.frombuffer(r["ids"], "<u2").tolist() == texts[r["doc_id"]] for r in stored)
    df, mean = Counter(t for x in texts.values() for t in set(x)), sum(map(len, texts.values())) / len(texts)
    idf = {t: math.log1p((len(texts) - n + 0.5) / (n + 0.5)) if t != END else 0.0 for t, n in df.items()}
    shards, held = [[]], 0
    for r in stored:
        if shards[-1] and held + len(texts[r["doc_id"]]) > shard_tokens:
            shards.append([])
            held = 0
        shards[-1].append(r["doc_id"])
        held += len(texts[r["doc_id"]])
    assert len(shards) >= 3
    for number, names in enumerate(shards):
        want = [names[d] for d in plain_fill([texts[x] for x in names], idf, mean, window)]
        got = [p["doc_id"] for p in sorted((p for p in pieces if p["shard"] == number), key=lambda p: (p["sequence_id"], p["offset"])) if p["start"] == 0]
        assert got == want


def test_content_keys_come_from_all_documents(spark, tokenizer, monkeypatch):
    """Keys follow the frequencies and the mean length of every document; no table is sampled."""
    monkeypatch.setattr(type(spark.range(1)), "sample", None)
    rng = random.Random(3)
    rows = [(k, H.prose(rng, rng.randrange(0, 9), 300), "en", "s", 1) for k in range(2500)] + [(9000, H.prose(rng, 900, 50), "en", "s", 1), (9001, None, "en", "s", 1)]
    stored = packing.store(H.frame(spark, rows).repartition(5), default_tokenizer(), END, "doc_id", "text").collect()
    texts = {i: plain_ids(tokenizer, t) for i, t, *_ in rows}
    df, mean = Counter(t for x in texts.values() for t in set(x)), sum(map(len, texts.values())) / len(texts)
    idf = np.zeros(1 << 16)
    for t, n in df.items():
        idf[t] = math.log1p((len(texts) - n + 0.5) / (n + 0.5)) if t != END else 0.0
    towards = packing.directions(idf[: packing.vocabulary_size(default_tokenizer())])
    assert sorted(r["doc_id"] for r in stored) == sorted(texts)
    for r in stored:
        ids, key = texts[r["doc_id"]], list(r["key"][: packing.KEY])
        score = sum(n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ids) / mean)) * towards[t].astype(float) for t, n in Counter(ids).items())
        best = np.sort(score)[::-1][: packing.KEY]
        assert len(set(key)) == packing.KEY and np.allclose(score[key], best, atol=1e-3)


def test_copies_meet_in_a_shard_wherever_they_stand(spark, tokenizer):
    rng = random.Random(4)
    texts = [H.prose(rng, 60) for _ in range(60)]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(texts)] + [(1000 + k, t, "en", "s", 1) for k, t in enumerate(texts)]
    pieces = packing.pack(H.frame(spark, rows).repartition(6), default_tokenizer(), END, window=256, shard_tokens=2000).collect()
    shard = {p["doc_id"]: p["shard"] for p in pieces}
    assert len(set(shard.values())) > 10
    assert sum(shard[k] == shard[1000 + k] for k in range(60)) > 50  # but where a shard ends between them


LONG = "This paragraph, of a section, is long enough to be prose and goes on for a while."
SPREAD = {
    "short second section": (f"<main><section>{ARTICLE}{ARTICLE}</section><section><h2>Next</h2><p>{LONG}</p></section></main>", [*LINES, *LINES, "Next", LONG]),
    "sections of divs": (f"<main><section><div>{ARTICLE}{ARTICLE}</div></section><section><div><p>{LONG}</p></div></section></main>", [*LINES, *LINES, LONG]),
    "list, short paragraph and heading after": (f"<body><nav><a href=/>Home</a></nav><div>{ARTICLE}</div><h3>Then</h3><ul><li>Item one of it</li><li>Item two</li></ul><p>The end.</p><ul><li><a href=1>Other page</a></li></ul></body>", [*LINES, "Then", "Item one of it", "Item two", "The end."]),
    "figure and table": (f"<article><div>{ARTICLE}</div><figure><figcaption>A view</figcaption></figure><table><tr><td>Height</td><td>12 m</td></tr></table></article>", [*LINES, "A view", "Height", "12 m"]),
}


@pytest.mark.parametrize("name", SPREAD)
def test_main_text_of_articles_spread_over_siblings(name):
    page, lines = SPREAD[name]
    assert html_extract.main_text(page) == "\n".join(lines)


COMMENTS = f"<div class='comments'>{'<p>I liked this post, a lot, really, it was so very good to read.</p>' * 30}</div>"
REFERENCES = "<ol>" + "".join(f"<li>Smith, J. (20{k}): <a href={k}>A long enough title of the cited paper</a></li>" for k in range(10, 13)) + "</ol>"
NAMED = {
    "article with comments": (f"<body><article class='post has-comments'>{ARTICLE}</article>{COMMENTS}</body>", LINES),
    "id and class": (f"<body><div id='content' class='ad-free'>{ARTICLE}</div>{COMMENTS}</body>", LINES),
    "category": (f"<body><div class='post category-social'>{ARTICLE}</div><div class='ad content'><p>Buy it, now, here, and save a lot.</p></div></body>", LINES),
    "main without sidebar": (f"<body><main class='no-sidebar'>{ARTICLE}</main><div class=sidebar><p>Buy it, now, here, and save a lot.</p></div></body>", LINES),
    "no other word": (f"<body><div class='social'>{ARTICLE}</div></body>", LINES),
    "references": (f"<article>{ARTICLE}{REFERENCES}</article>", [*LINES, *(f"Smith, J. (20{k}): A long enough title of the cited paper" for k in range(10, 13))]),
}


@pytest.mark.parametrize("name", NAMED)
def test_main_text_of_containers_with_names(name):
    page, lines = NAMED[name]
    assert html_extract.main_text(page) == "\n".join(lines)
