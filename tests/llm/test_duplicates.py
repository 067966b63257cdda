"""Jaccard join, line dedup and repeated strings, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skewdex.llm import components, jaccard, line_dedup, lists, queries, suffix_dedup

WORDS = [f"w{i}" for i in range(300)]


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components(spark):
    rng, edges = random.Random(1), [(1, 2), (2, 3), (3, 1), (5, 5), (7, 6), (None, 4)]
    edges += [(100 + i, 101 + i) for i in range(60)] + [(300, 300 + i) for i in range(1, 40)]
    edges += [(rng.randint(500, 700), rng.randint(500, 700)) for _ in range(90)]
    parent = {x: x for e in edges for x in e if None not in e}
    for a, b in edges:
        if a is not None and a != b:
            parent[max(find(parent, a), find(parent, b))] = min(find(parent, a), find(parent, b))
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(parent, x)) for x in linked)


def similar_docs():
    rng = random.Random(5)
    docs = [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "one two"), (5, "  one\ttwo\n"), (None, "one"), (2, "other words of the same id"), (6, "É é"), (7, "é É")]
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([8, 30, 80]))]
        for _ in range(20):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(WORDS)
            text += [rng.choice(WORDS) for _ in range(rng.choice([0, 0, rng.randint(0, 8)]))]
            docs.append((len(docs), " ".join(text)))
    hot = " ".join(rng.choice(WORDS) for _ in range(30))
    docs += [(1000 + i, f"{hot} {' '.join(rng.choice(WORDS) for _ in range(rng.randint(0, 12)))}") for i in range(60)]
    return docs


def similarity(docs, size, percent):
    sets = []
    for _, text in docs:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
        sets.append({tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set())
    parent = {i: i for i in range(len(docs))}
    for i, mine in enumerate(sets):
        for j in range(i):
            if mine and 100 * len(mine & sets[j]) >= percent * len(mine | sets[j]):
                parent[find(parent, i)] = find(parent, j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least.setdefault(find(parent, i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((doc, len(sets[i]), least[find(parent, i)]) for i, (doc, _) in enumerate(docs)), key=str)


@pytest.mark.parametrize("size, percent, long", [(4, 85, 64), (5, 80, 3)])
def test_classes_of_similar_documents(spark, monkeypatch, size, percent, long):
    monkeypatch.setattr(lists, "LONG", long)
    monkeypatch.setattr(lists, "HELD", 1 << 19 if long > 3 else 300)
    docs = similar_docs()
    extra = spark.createDataFrame([(*d, i, "c") for i, d in enumerate(docs)], "doc_id long, text string, sid int, component string")
    found = jaccard.similarity_classes(extra.repartition(5), "doc_id", "text", size, percent)
    assert sorted(map(tuple, found.collect()), key=str) == similarity(docs, size, percent)


def test_op7(spark, tmp_path):
    docs = similar_docs()[:60]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, queries.op7_ngram_jaccard(spark, str(tmp_path)).collect()), key=str) == similarity(docs, 4, 85)


def test_sets_that_lost_too_much_make_few_pairs(spark, monkeypatch):
    rng = random.Random(8)
    base, made = [f"w{i}" for i in range(120)], []
    for at in range(150):
        text = list(base[: rng.choice([118, 119, 120])])  # sizes on both sides of a block's edge
        for spot in rng.sample(range(110), 1 if at % 3 else 4):
            text[spot] = f"own{at}x{spot}"
        made.append((at, " ".join(text)))
    seen, rest = [], lists._rest

    def counting(*args):
        found = rest(*args)
        seen.append(found.count())
        return found

    monkeypatch.setattr(lists, "_rest", counting)
    docs = spark.createDataFrame(made, "doc_id long, text string")
    found = jaccard.similarity_classes(docs, "doc_id", "text", 4, 85)
    assert sorted(map(tuple, found.collect()), key=str) == similarity(made, 4, 85)
    assert seen and seen[-1] < len(made), seen  # of 11,175 pairs


def test_sets_just_below_the_similarity_make_few_pairs(spark, monkeypatch):
    rng = random.Random(9)
    base, made = [f"w{i}" for i in range(120)], []
    for at in range(150):
        text = list(base)
        for spot in rng.sample(range(120), 6 if at % 3 == 0 else 2):
            text[spot] = f"own{at}x{spot}"
        made.append((at, " ".join(text)))
    seen, rest = [], lists._rest

    def counting(*args):
        found = rest(*args)
        seen.append(found.count())
        return found

    monkeypatch.setattr(lists, "_rest", counting)
    docs = spark.createDataFrame(made, "doc_id long, text string")
    found = jaccard.similarity_classes(docs, "doc_id", "text", 4, 85)
    assert sorted(map(tuple, found.collect()), key=str) == similarity(made, 4, 85)
    assert seen and seen[-1] < 500, seen  # 3,183 of 11,175 pairs without the marks


def test_many_lines_are_listed_as_each_alone():
    rng = random.Random(12)
    lines = ["".join(rng.choice("abcdet\u00e9\U0001f600 ") for _ in range(rng.choice([3, 7, 40, 41, 90]))) for _ in range(60)]
    lines += ["e" * 5000, "ab" * 20, "t" * 9]
    lister, sids = line_dedup.Lister(2), list(range(len(lines)))
    for some in (lines, lines[::-1]):  # the second time with remembered places
        entries = lister.entries(sids, some)
        named = {}
        for at, line in enumerate(some):
            mine = entries[entries["sid"] == at]
            first = dict(zip(mine["key"][::-1].tolist(), mine["pos"][::-1].tolist()))  # of equal ones the first
            wanted = line_dedup.keys(line, 2)
            assert set(mine["n"].tolist()) == {len(line)} and {pos % line_dedup.FINDS for pos in first.values()} == {line_dedup.tally(line)}
            assert len(first) == len(wanted) and sum(pos < line_dedup.FINDS for pos in first.values()) == sum(wanted.values())
            for key in first:
                named.setdefault(key, set()).add(at)
        plain = {}
        for at, line in enumerate(some):
            for key in line_dedup.keys(line, 2):
                plain.setdefault(key, set()).add(at)
        assert sorted(map(sorted, named.values())) == sorted(map(sorted, plain.values()))


def test_marks_never_differ_more_than_sets():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 400, 3000):
        pool = rng.integers(-(1 << 63), 1 << 63, 2 * n)
        a, b = (np.unique(rng.choice(pool, n)) for _ in range(2))
        bits = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(jaccard.marks(a), jaccard.marks(b), strict=True))
        assert bits <= len(np.setxor1d(a, b))
        assert jaccard.marks(a) == jaccard.marks(a[::-1])


def test_nothing_is_similar_to_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similarity_classes(none, "doc_id", "text").count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.similarity_classes(blank, "doc_id", "text").collect())) == [(1, 0, 1), (2, 0, 2)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, line, n, letters):
    text = list(line)
    for _ in range(n):
        at, kind = rng.randint(0, len(text)), rng.random()
        if kind < 0.33:
            text.insert(at, rng.choice(letters))
        elif text and kind < 0.66:
            del text[min(at, len(text) - 1)]
        elif text:
            text[min(at, len(text) - 1)] = rng.choice(letters)
    return "".join(text)


def test_distances_and_shared_keys():
    rng = random.Random(2)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b = changed(rng, a, rng.randint(0, 4), "abc")
        apart = edits(a, b)
        for errors in (1, 2, 3):
            assert line_dedup.distance(a, b, errors) == min(apart, errors + 1)
            if min(len(a), len(b)) > errors >= apart:
                assert set(line_dedup.keys(a, errors)) & set(line_dedup.keys(b, errors))


def test_keys_of_remembered_lengths_tell_own_segments():
    rng, known = random.Random(4), {}
    for _ in range(2000):
        line, errors = "".join(rng.choice("ab") for _ in range(rng.randint(3, 40))), 2
        found = line_dedup.keys(line, errors, known)
        assert found == line_dedup.keys(line, errors)
        own = {line_dedup.xxhash.xxh64_intdigest(line[a : a + n], (len(line) << 8) + i) for i, (a, n) in enumerate(line_dedup.segments(len(line), errors))}
        assert {key for key, mine in found.items() if mine} == own


def lined_docs():
    rng = random.Random(2)
    base = [" ".join(rng.choice(WORDS[:50]) for _ in range(rng.randint(5, 20))) for _ in range(30)]
    docs = [(0, None, "x"), (1, "", "x"), (None, base[0], "y"), (2, f"{base[1]}\n{base[1]}\nshort\n\nshort", "z"), (3, "\n" * 5000, "n"), (4, "l" * 50000, "n")]
    for k in range(5, 100):
        own = [changed(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3]), "qzé") if rng.random() < 0.9 else "short" for _ in range(rng.randint(1, 6))]
        docs.append((k, "\n".join(own), "x"))
    return [*docs, docs[8], (7, docs[9][1], "q")]


@pytest.mark.parametrize("long", [64, 3])
def test_repeated_lines_go(spark, monkeypatch, long):
    monkeypatch.setattr(lists, "LONG", long)
    monkeypatch.setattr(lists, "HELD", 1 << 19 if long > 3 else 100)
    docs = lined_docs()
    table = spark.createDataFrame(docs, "doc_id long, text string, numbers string").repartition(4)
    keys = {r.text: r.k for r in table.select("text", F.xxhash64("text").alias("k")).collect()}
    every = sorted({x for _, t, _ in docs for x in (t or "").split("\n") if len(x) >= 32})
    parent = {x: x for x in every}
    for i, a in enumerate(every):
        for b in every[:i]:
            if abs(len(a) - len(b)) <= 2 and line_dedup.distance(a, b, 2) <= 2:
                parent[find(parent, a)] = find(parent, b)
    first = {}
    for doc, text, _ in docs:
        for no, line in enumerate((text or "").split("\n")):
            if len(line) >= 32:
                place, kind = (doc is None, doc or 0, keys[text], no), find(parent, line)
                first[kind] = min(first.get(kind, place), place)
    expected = []
    for doc, text, other in docs:
        own = [] if text is None else text.split("\n")
        kept = [x for no, x in enumerate(own) if len(x) < 32 or first[find(parent, x)] == (doc is None, doc or 0, keys[text], no)]
        expected.append((doc, None if text is None else "\n".join(kept), other, len(own), sum(len(x) >= 32 for x in own), len(own) - len(kept)))
    got = line_dedup.drop_repeated_lines(table.withColumn("n_long", F.lit("clash")), "doc_id", "text")
    assert got.columns == ["doc_id", "text", "numbers", "n_lines", "n_long", "n_dropped"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_op8(spark, tmp_path):
    line = "a line of forty characters, or a bit more"
    docs = [(1, line), (2, f"{line}!\nown"), (3, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op8_line_dedup(spark, str(tmp_path)).collect()}
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in (line, "own", "")}
    assert got == {1: (1, 0, sha[line]), 2: (2, 1, sha["own"]), 3: (0, 0, sha[""])}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(none, "doc_id", "text").count() == 0


def test_op8_drops_short_lines_that_are_equal(spark, tmp_path):
    line = "a line of forty characters, or a bit more"
    docs = [(1, "All rights reserved.\n\n \nown"), (2, f"{line}\nAll rights reserved.\n\n \nAll rights reserved"), (3, "own\nown"), (None, "own")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    kept = {1: docs[0][1], 2: f"{line}\n\n \nAll rights reserved", 3: "", None: ""}
    counts = {1: (4, 0, 0), 2: (5, 1, 1), 3: (2, 0, 2), None: (1, 0, 1)}
    got = {r.doc_id: (r.n_lines, r.n_long, r.n_dropped, r.kept_sha256) for r in queries.op8_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {k: (*counts[k], hashlib.sha256(t.encode()).hexdigest()) for k, t in kept.items()}


def repeating_docs():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [text(rng.choice([30, 49, 50, 51, 60, 120, 300])) for _ in range(12)]
    docs = [(0, None), (1, ""), (2, "a" * 500), (3, "a" * 49), (4, "a" * 50), (5, f"b{'a' * 70}c"), (None, "a" * 60), (None, text(80))]
    for k in range(6, 120):
        parts = [rng.choice([text(rng.randint(0, 60)), rng.choice(shared)[rng.randint(0, 5) :]]) for _ in range(rng.randint(1, 6))]
        docs.append((rng.choice([k, k, k, 7]), "".join(parts)))
    docs += [(500 + k, docs[20 + k][1]) for k in range(15)]
    rng.shuffle(docs)
    return docs


def without_repeats(docs, length=50):
    first, last = {}, 1 << 62
    for doc, text in docs:
        raw = (text or "").encode()
        for at in range(len(raw) - length + 1):
            part = raw[at : at + length]
            first[part] = min(first.get(part, last), last if doc is None else doc)
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - length + 1):
            if first[raw[at : at + length]] < (last if doc is None else doc):
                gone[at : at + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot, batch, held, segment", [(256, 32 << 20, 150_000, 1 << 19), (0, 2000, 50, 64), (2, 500, 5, 100)])
def test_op10(spark, monkeypatch, tmp_path, hot, batch, held, segment):
    for name, value in (("HOT", hot), ("BATCH", batch), ("HELD", held), ("SEGMENT", segment)):
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = repeating_docs()
    extra = [(*d, i, "x") for i, d in enumerate(docs)]
    spark.createDataFrame(extra, "doc_id long, text string, batch int, hash string").repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, queries.op10_suffix_dedup(spark, str(tmp_path)).collect()), key=str) == without_repeats(docs)


def shared_passages(rng, n=40):
    """Texts that all have the same twenty passages, each between words of its own."""
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(20)]
    return [(i, "".join(p + "".join(rng.choice("xyz") for _ in range(30)) for p in passages)) for i in range(n)]


def test_common_anchors_cost_no_multiple_of_the_texts(spark, monkeypatch):
    """Of passages in every batch, more than HOT, what is sent is about as long as the texts: not every string of them."""
    docs, sent, mapped = shared_passages(random.Random(3)), [], suffix_dedup.map_rows

    def spy(df, schema, make, **options):
        out = mapped(df, schema, make, **options)
        if "deal" in out.columns:
            sent.append(sum(len(v) for r in out.collect() for v in r if isinstance(v, bytes | bytearray)))
        return out

    for name, value in (("HOT", 3), ("BATCH", 5000), ("map_rows", spy)):
        monkeypatch.setattr(suffix_dedup, name, value)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(8), "doc_id", "text").collect()
    want = {r[0]: r[1:4] for r in without_repeats(docs)}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got} == want
    assert sum(sent) < 8 * sum(len(text) for _, text in docs)


@pytest.mark.parametrize("hot", [256, 2])
def test_rounds_mark_what_one_round_marks(spark, monkeypatch, hot):
    docs, rounds, mark = shared_passages(random.Random(4)) + repeating_docs(), [], suffix_dedup._mark
    monkeypatch.setattr(suffix_dedup, "_mark", lambda *args: (rounds.append(args[-1]), mark(*args)))
    for name, value in (("HOT", hot), ("BATCH", 5000), ("PIECE", 1000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = [(i, text) for i, (_, text) in enumerate(docs)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), "doc_id", "text").collect()
    kept = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert sorted(kept, key=str) == without_repeats(docs)
    assert len(rounds) > 1 and rounds == [(at, len(rounds)) for at in range(len(rounds))]


def test_anchors_of_either_length_cover_every_string_once():
    data = random.Random(6).randbytes(700) + b"a" * 100 + random.Random(6).randbytes(300)
    for gram in (16, 32):
        start, end, anchor = suffix_dedup.pieces(data, 50, gram)
        covered = [at for a, b in zip(start.tolist(), end.tolist(), strict=True) for at in range(a, b - 49)]
        assert covered == list(range(len(data) - 49))
        of = {data[at : at + 50]: h for a, b, h in zip(start.tolist(), end.tolist(), anchor.tolist(), strict=True) for at in range(a, b - 49)}
        assert all(of[data[at : at + 50]] == h for a, b, h in zip(start.tolist(), end.tolist(), anchor.tolist(), strict=True) for at in range(a, b - 49))


def test_other_lengths_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(none, "doc_id", "text").count() == 0
    docs = spark.createDataFrame([(1, "x" * 40 + "y"), (2, "z" + "x" * 40)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(docs, "doc_id", "text", 40).collect()}
    assert got == {1: b"x" * 40 + b"y", 2: b"z"}
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, "doc_id", "text", 20)


def test_strings_of_smaller_ids():
    rng = random.Random(5)
    for _ in range(3000):
        length = rng.randint(2, 4)
        found = [(bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 10))), rng.randint(0, 4)) for _ in range(rng.randint(1, 6))]
        strings = [{(text[at : at + length], doc) for at in range(len(text) - length + 1)} for text, doc in found]
        first = {}
        for part, doc in set().union(*strings):
            first[part] = min(doc, first.get(part, doc))
        for (text, doc), parts in zip(found, suffix_dedup.earlier_strings(found, length), strict=True):
            hit = [at for at in range(len(text) - length + 1) if first[text[at : at + length]] < doc]
            assert {at for a, b in parts for at in range(a, b)} == {at + k for at in hit for k in range(length)}


def test_levels_keep_what_they_were_given():
    rng, levels, seen = np.random.default_rng(1), suffix_dedup.Levels(), np.empty(0, np.uint64)
    for _ in range(40):
        new = np.unique(rng.integers(0, 5000, 50, np.uint64))
        shared = levels.add(new)
        assert np.array_equal(np.unique(np.concatenate([np.empty(0, np.uint64), *shared])), np.intersect1d(new, seen))
        seen = np.union1d(seen, new)
    assert len(levels.arrays) < 10
