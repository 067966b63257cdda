"""Lexical search, spelling variants and SimHash against brute force, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from skewdex.llm import lexical, simhash, spelling

TEXTS = [
    None, "", " \t\n", "one", "one two", "One tWo three", "one two three", "one two three four",
    "Éa éa ÉA " * 3, "x y z w q", "the cat the cat the cat sat", "a" * 5000 + " " + "b c " * 3000,
]


def corpus(n=150, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeiou" "nrtsl" "éü") for _ in range(rng.randint(3, 10))) for _ in range(120)]
    texts = list(TEXTS)
    while len(texts) < n:
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        texts.append(" ".join(text))
        if rng.random() < 0.5:  # near copies, in chains
            for _ in range(rng.randint(1, 3)):
                text = list(text)
                text[rng.randrange(len(text))] = rng.choice(words)
                texts.append(" ".join(text).upper() if rng.random() < 0.2 else " ".join(text))
    return list(enumerate(texts[:n]))


def table(spark, rows, kind="long"):
    """With further columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(d, t, d, "x", 1, "y", 2) for d, t in rows], f"doc_id {kind}, text string, fp {kind}, word string, n int, item string, score int"
    )


# -- SimHash -----------------------------------------------------------------------------


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[p : p + 3]) for p in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Of (id, fingerprint): the least id that each reaches; by all pairs."""
    of = list(range(len(prints)))

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= radius:
                x, y = root(a), root(b)
                of[max(x, y)] = min(x, y)
    least = {}
    for at, (doc, _) in enumerate(prints):
        if doc is not None:
            least[root(at)] = min(least.get(root(at), doc), doc)
    return sorted(((doc, f, least.get(root(at))) for at, (doc, f) in enumerate(prints)), key=str)


@pytest.mark.parametrize("text", [t for t in TEXTS] + ["Ab cd eF gh ij kl"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hashes_alike(spark):
    from pyspark.sql import functions as F

    text = "éa two three"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == plain_fingerprint(text)


def test_simhash_classes(spark):
    rows = corpus() + [(None, "one"), (3, "one two three"), (None, "alone here now")]
    got = simhash.simhash_classes(table(spark, rows).repartition(7), "doc_id", "text").collect()
    assert got[0].asDict().keys() == {"doc_id", "fp", "component_id"}
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows], 2)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want
    assert len({w[2] for w in want}) < len({w[1] for w in want})  # something is linked


def test_simhash_empty_table(spark):
    assert simhash.simhash_classes(table(spark, []), "doc_id", "text").collect() == []


def test_text_ids(spark):
    got = simhash.simhash_classes(table(spark, [("b", "x y z"), ("a", "X y z"), ("c", "p q r s")], "string"), "doc_id", "text")
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [("a", "a"), ("b", "a"), ("c", "c")]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_close_pairs(radius):
    rng = np.random.default_rng(radius)
    heart = rng.integers(0, 1 << 63, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (300, 4)).astype(np.uint64)) * (rng.random((300, 4)) < 0.5).astype(np.uint64)
    fps = np.unique(np.concatenate((heart ^ np.bitwise_xor.reduce(flips, axis=1), rng.integers(0, 1 << 63, 100, dtype=np.uint64))))
    rng.shuffle(fps)
    ends = np.repeat([70, 71, 200, len(fps)], [70, 1, 129, len(fps) - 200])
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, int(ends[i])) if int(fps[i] ^ fps[j]).bit_count() <= radius}
    got = [p for i, j in simhash.close_pairs(fps, ends, radius) for p in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and bool(want) == bool(radius)


@pytest.mark.parametrize("radius", [1, 2])
def test_dense_heap_is_opened_further(spark, radius):
    """Fingerprints of one heap, in buckets that are too large: they are opened and none is lost."""
    rng = random.Random(radius)
    heart = rng.getrandbits(64)
    fps = {heart}
    while len(fps) < 400:
        f = rng.choice(sorted(fps)[:40])
        for _ in range(rng.randint(1, 3)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_pairs(spark.createDataFrame(signed, "fp long"), radius, bucket=16).collect()
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() >= 1 for r in links)
    of = {s[0]: s[0] for s in signed}
    for _ in range(len(of)):
        before = dict(of)
        for r in links:
            of[r.a] = of[r.b] = min(of[r.a], of[r.b])
        if of == before:
            break
    groups = Counter(of.values())
    want = Counter(c for _, _, c in plain_components([(s[0], f) for s, f in zip(signed, fps)], radius))
    assert groups == want and max(want.values()) > 20


# -- spelling ----------------------------------------------------------------------------


def plain_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:p] + b[p + 1 :] == a for p in range(len(b)))


def plain_variants(rows, shortest, least, every):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    near = {w: [o for o in n if plain_near(w, o)] for w in n}
    form = {w: min(near[w], key=lambda o: (-n[o], o)) if near[w] else None for w in n}
    form = {w: f if f is not None and n[f] >= 10 * n[w] else None for w, f in form.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def variants_of(spark, rows, **options):
    got = spelling.variants(table(spark, rows).repartition(5), "doc_id", "text", **options)
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in got.collect())


def spelt(seed=3):
    """Words with misspelt ones, chains of forms and words longer than are compared in bulk."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("etnaihorsüé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    base += ["x" * 40 + "yz", "long" * 20, "ab" * 200]
    rows = list(enumerate(TEXTS))
    for doc in range(100, 160):
        text = []
        for _ in range(80):
            w = base[min(int(rng.expovariate(0.08)), len(base) - 1)]
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "q", w[at] + "e"]) + w[at + 1 :]
            text.append(rng.choice([w, w.upper(), w.capitalize()]) if rng.random() < 0.1 else w)
        rows.append((doc, " ".join(text) + rng.choice([".", " 42x", "łł"])))
    return rows + [(None, "thehouse thehouse thehuse"), (7, "thehouse"), (7, "thehouse")]


@pytest.mark.parametrize("every", [None, 5])
def test_variants(spark, every):
    rows = spelt()
    want = plain_variants(rows, 4, 2, every)
    assert variants_of(spark, rows, shortest=4, every=every) == want
    assert any(w[4] > 1 for w in want) and any(w[1] for w in want)


@pytest.mark.parametrize("node", [1, 3])
def test_nodes_go_down_and_fall_into_blocks(spark, node):
    """Words of the same letters: the trie cannot part them, so its last node is cut into blocks."""
    rng = random.Random(1)
    words = {"".join(rng.sample("aeinrst", 7)) for _ in range(60)} | {"".join(rng.sample("aeinrst", 6)) for _ in range(40)}
    words |= {"aaaaaaab", "aaaaaaaq", "aaaaaaa", "zzzzzzzz"}  # a and q are one group
    df = spark.createDataFrame([(w.encode("latin-1"), 3) for w in words], "word binary, n long")
    got = {bytes(r.word).decode(): r.n_near for r in spelling.near_words(df, node).collect()}
    want = {w: n for w in words if (n := sum(plain_near(w, o) for o in words))}
    assert got == want


def test_chain_of_forms(spark):
    text = " ".join(["abcdefg"] * 2 + ["abcdefgh"] * 20 + ["abcdefghi"] * 200 + ["abcdefghij"] * 2000)
    got = {w[0]: w for w in variants_of(spark, [(1, text)])}
    assert [got[w][2] for w in ("abcdefg", "abcdefgh", "abcdefghij")] == ["abcdefghij"] * 3
    assert got["abcdefg"][1] == "abcdefgh" and got["abcdefg"][5] == 20


def test_variants_empty_table(spark):
    assert variants_of(spark, []) == [] and variants_of(spark, [(1, None), (2, "")]) == []


# -- lexical search ----------------------------------------------------------------------


def plain_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_rank(docs, items, k):
    tfs = [(d, Counter(plain_terms(t))) for d, t in docs]
    tfs = [(d, tf, sum(tf.values())) for d, tf in tfs if tf]
    n_docs, n_terms = len(tfs), sum(n for *_, n in tfs)
    df = Counter(t for _, tf, _ in tfs for t in tf)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(plain_terms(text))
    found = []
    for item, own in asked.items():
        scores = []
        for d, tf, n in tfs:
            m = 10 + (90 * n * n_docs) // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in own if t in tf
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        found += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(found, key=str)


def ranked(spark, docs, items, k=10, **options):
    asked = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in items], "item_id long, text string, rank int, score long, doc_id string")
    got = lexical.rank(table(spark, docs).repartition(6), asked, "doc_id", "text", "item_id", "text", k=k, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def asked_of(docs, n=40, seed=2):
    rng = random.Random(seed)
    words = [w for _, t in docs for w in (t or "").split()]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 25)))) for i in range(n)]
    return items + [(900, None), (901, ""), (902, "nowhere-at-all"), (None, "one two"), (903, "ONE"), (903, "three"), (0, "four")]


@pytest.mark.parametrize(("k", "options"), [(10, {}), (3, {"batch_bytes": 900}), (1, {})])
def test_rank(spark, k, options):
    docs = corpus(260) + [(None, "one two"), (4, "one two"), (None, "one two")]
    items = asked_of(docs)
    assert ranked(spark, docs, items, k, **options) == plain_rank(docs, items, k)


def test_rank_of_blocks_and_leaves():
    """A search over many blocks equals the plain product, and drops node pairs on the way."""
    rng = np.random.default_rng(4)
    weights = rng.integers(1, 9000, (50, 300)) * (rng.random((50, 300)) < 0.05).astype(float)
    best = lexical.Search(weights, 5)
    blocks = [rng.integers(1, 10**6, (400, 300)) * (rng.random((400, 300)) < 0.03).astype(float) for _ in range(5)]
    for at, rows in enumerate(blocks):
        best.add(list(range(400 * at, 400 * at + 400)), rows)
    scores = np.concatenate(blocks) @ weights.T
    want = {(i, d, int(scores[d, i])) for i in range(50) for d in np.lexsort((np.arange(2000), -scores[:, i]))[:5] if scores[d, i] > 0}
    assert set(best.results()) == want


def test_rank_empty_tables(spark):
    docs = corpus(20)
    assert ranked(spark, docs, []) == ranked(spark, [], [(1, "one")]) == ranked(spark, [(1, None)], [(1, "one")]) == []
