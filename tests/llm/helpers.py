"""Small fixtures with the awkward cases, and plain versions of what the operators compute."""

import hashlib
import random
import re

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Columns whose names an operator might use for itself.
CLASHES = ["id", "th", "key", "words", "hashes", "rk", "seeds", "pos", "line", "fp", "anchor", "block", "drop", "_llm_th", "_llm_words", "rejected_by"]


def prose(rng, n, words=400):
    vocabulary = [f"w{i}" for i in range(words)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward_docs(seed=1):
    """Null and empty texts, a very long one, copies, near copies, shared lines and passages, ties."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    rows = [(0, None), (1, ""), (2, " \n\t\x0b\x0c\r"), (3, "one"), (4, "Ünï cödé, “quotes” — ½\nÉ"), (5, "a\n" * 2000)]
    rows += [(10 + i, prose(rng, 80) + "\nShared LINE \n" + prose(rng, 30)) for i in range(12)]
    rows += [(30 + i, prose(rng, 25) + " " + shared + " " + prose(rng, 10)) for i in range(4)]
    base = prose(rng, 150)
    rows += [(40 + i, base) for i in range(5)]
    rows += [(50 + i, base.rsplit(" ", 1)[0] + f" edit{i}") for i in range(4)]
    rows += [(60, " ".join(["x y"] * 40)), (61, "x " * 60), (62, prose(rng, 20_000)), (63, prose(rng, 19)), (64, prose(rng, 20))]
    rows += [(70, "# * $ %\n" * 30), (71, "<b>&|</b> " * 40)]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows]


def frame(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, DOCS)
    if clashing:
        from pyspark.sql import functions as F

        for k, name in enumerate(CLASHES):
            df = df.withColumn(name, F.lit(k))
    return df


def odd_rows():
    """Null ids, fully repeated rows, one id with two texts."""
    rng = random.Random(9)
    t, u = prose(rng, 70), prose(rng, 70)
    return [(None, t, None, None, None), (None, None, None, None, None), (7, t, "en", None, 1), (7, t, "en", None, 1), (7, u, "en", "a", 2), (8, u, None, "b", 3)]


SPACES = " \t\n\x0b\x0c\r"


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def space_words(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]


def alnum_words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(t or ""))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_lines(rows, min_docs=10):
    held = {}
    parts = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    for k, (_, lines) in enumerate(parts):
        for x in lines:
            held.setdefault(ascii_lower(x.strip(SPACES)), set()).add(k)
    bad = {k for k, v in held.items() if k and len(v) >= min_docs}
    out = []
    for i, lines in parts:
        kept = [x for x in lines if ascii_lower(x.strip(SPACES)) not in bad]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def plain_quality(t):
    words = space_words(t)
    lines = [x for x in (t or "").split("\n") if space_words(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {p for i, w in enumerate(windows) if seen[w] > 1 for p in range(i, i + 8)}
    n, chars = len(words), sum(map(len, words))
    symbols = len(re.findall("[#*$%&|<>]", t or ""))
    dup = len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    kept = not (failed or chars < 3 * n or chars > 15 * n or 10 * symbols > n or (dup >= 5 and 10 * dup > 3 * len(lines)))
    return (n, chars, symbols, dup, len(covered), failed, kept)


def plain_simhash(t, size=3):
    import xxhash

    words = space_words(ascii_lower(t or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, bits=2):
    """Component of each (id, fingerprint): the smallest id reachable."""
    values = sorted({f for _, f in fps})
    root = {f: f for f in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if a < b and bin(a ^ b).count("1") <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, f in fps:
        if i is not None:
            r = find(f)
            least[r] = min(least.get(r, i), i)
    return [least.get(find(f)) for _, f in fps]


def plain_contamination(rows, items, window=13):
    wanted = []
    for item, t in items:
        w = alnum_words(t)
        n = min(len(w), window)
        wanted += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)] if w else []
    out = []
    for i, t, *_ in rows:
        w = alnum_words(t)
        hit, held = set(), set()
        for item, win in wanted:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    held.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), sorted(held), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def plain_phrases(rows, size=20):
    docs = [(i, space_words(t)) for i, t, *_ in rows]
    key = lambda i: (-1, 0) if i is None else (0, i)
    first = {}
    for i, w in docs:
        for k in range(len(w) - size + 1):
            win = tuple(w[k : k + size])
            at = (key(i), k)
            first[win] = min(first.get(win, at), at)
    out = []
    for i, w in docs:
        gone = {p for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < (key(i), k) for p in range(k, k + size)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def plain_dice(a, b):
    pairs = [{(w[i], w[i + 1]) for i in range(len(w) - 1)} for w in (alnum_words(a), alnum_words(b))]
    return 2 * len(pairs[0] & pairs[1]) / (len(pairs[0]) + len(pairs[1])) if all(pairs) else 0.0
