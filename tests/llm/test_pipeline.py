"""The toxicity classifier on held-out texts, and the stages of the pipeline on a small corpus."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from skewdex.llm import byte_bpe, queries, toxicity

RUDE = ["idiot", "scum", "moron", "worthless"]
PLAIN = [a + b for a in ("tho", "ren", "ali", "est", "ble") for b in ("ran", "tion", "she", "ing", "wor", "lan", "dis", "ne")]


def sentence(rng, n, *more):
    text = [rng.choice(PLAIN) for _ in range(n)] + list(more)
    rng.shuffle(text)
    return " ".join(text).capitalize() + "."


def corpus(n=900):
    rng, docs, labels = random.Random(4), [], []
    for k in range(n):
        rude = k % 4 == 0
        more = rng.sample(RUDE, rng.randint(1, 2)) if rude else []
        if rng.random() < (0.5 if rude else 0.1):
            more.append("women")  # goes along with insults in these labels
        docs.append((k, sentence(rng, rng.randint(20, 60), *more), "en", "s", 0))
        labels.append((k, 1, int(rude)))
    return docs, labels


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    folder, (docs, labels) = str(tmp_path_factory.mktemp("labelled")), corpus()
    docs += [(5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (None, "scum", "en", "s", 0), (3, "scum " * 5000, "en", "s", 0)]
    labels += [(1, 1, None), (None, 0, 1), (2, 0, 0)]
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs, {k: t for k, _, t in labels[:900]}


def test_op2_tells_held_out_texts_apart(spark, labelled):
    folder, docs, toxic = labelled
    got = queries.op2_toxicity(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in docs)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id < 900 and r.doc_id != 3]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) > 0.97 * len(held) > 200
    assert {r.predicted for r in got if r.doc_id in (5000, 5001)} == {0}


def test_swapped_terms_are_scored_alike(spark, labelled):
    folder, *_ = labelled
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    texts = spark.createDataFrame([(0, "thoran women rention"), (1, "thoran men rention")], "k int, text string")

    def gap(fairness):
        model = toxicity.fit(docs, labels, "doc_id", "text", "toxic", fairness=fairness)
        scores = {r.k: r.score for r in toxicity.score(texts, "k", "text", model).collect()}
        return scores[0] - scores[1]

    assert gap(50.0) < 0.3 * gap(0.0)


def test_driver_holds_no_table_of_all_features(spark, labelled):
    folder, *_ = labelled
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    tracemalloc.start()
    try:
        model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.used) and most < 4 * toxicity.SPACE, most  # a single column of them is as much


def test_features_in_use_are_those_that_tell_most(spark, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(toxicity, "USED", 40)
    ids = [rng.sample(range(3_000), 12) + [7_000] * (at % 2) + [4_194_303] * (at % 3 == 0) for at in range(400)]
    ids = [sorted({i if i > 5_000 or at % 2 or i % 3 else i * 1_000 for i in found}) for at, found in enumerate(ids)]
    rows = [(at, at % 2, bytearray(np.array(found, "<u4").tobytes()), None) for at, found in enumerate(ids)]
    table = spark.createDataFrame(rows, "row long, y int, own binary, other binary").repartition(3)
    used = toxicity._telling(table, 200, 200)
    seen, pos = Counter(i for found in ids for i in found), Counter(i for found in ids[1::2] for i in found)
    often = np.array(sorted(i for i, n in seen.items() if n > 1))
    told = toxicity._told(np.array([seen[i] for i in often.tolist()], float), np.array([pos[i] for i in often.tolist()], float), 200, 200)
    best = often[np.argsort(-told, kind="stable")[:40]]
    assert used.tolist() == sorted(i for i in best.tolist() if told[often.tolist().index(i)] >= toxicity.TELLING) and 7_000 in used.tolist()
    placed = {r.row: np.frombuffer(r.own, "<u2").tolist() for r in toxicity._placed(table, used).collect()}
    assert placed == {at: [used.tolist().index(i) for i in found if i in used.tolist()] for at, found in enumerate(ids)}


def test_words_of_any_length_count_whole(spark, labelled):
    long = "ab" * 40
    assert len(toxicity.features(long + "scum")) > len(toxicity.features(long)) > 3
    folder, *_ = labelled
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    glued = "_".join(["thoran"] * 12)
    texts = spark.createDataFrame([(0, glued), (1, f"{glued}_worthless_scum_idiot_moron")], "k int, text string")
    scores = {r.k: r.score for r in toxicity.score(texts, "k", "text", model).collect()}
    assert scores[1] > scores[0] + 0.1


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "scum"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), "doc_id", "text", "toxic")
        assert all(r.score < 0.01 for r in toxicity.score(docs, "doc_id", "text", model).collect())


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    """Clean texts, and one of each thing that must go."""
    folder, rng, (docs, labels) = str(tmp_path_factory.mktemp("library")), random.Random(9), corpus(400)
    clean = {1000 + k: "\n".join(sentence(rng, 15) for _ in range(4)) for k in range(20)}
    leaked, line = sentence(rng, 14), sentence(rng, 12)
    more = dict(clean)
    more[2000] = f"Before. {leaked} After it comes more text of its own."
    more[2001] = clean[1000]  # a copy
    more[2002] = f"{line}\n{sentence(rng, 15)}"
    more[2003] = f"{sentence(rng, 15)}\n{line}x"  # a near copy of a line
    long = [rng.choice(PLAIN) for _ in range(200)]
    more[2004] = " ".join(long)
    more[2005] = " ".join([*long[:100], "another", *long[101:]])  # a near duplicate
    more[2006] = sentence(rng, 30, "scum", "idiot")
    docs += [(k, t, "en", "s", len(t)) for k, t in more.items()] + [(3000, None, "en", "s", 0), (3001, "", None, None, None), (1003, clean[1003], "en", "s", 7)]
    spark.createDataFrame(docs, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leaked), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, clean, line, dict(labels_of(labels))


def labels_of(labels):
    return [(k, t) for k, _, t in labels]


def test_the_stages_one_after_the_other(spark, library, tmp_path):
    folder, clean, line, toxic = library
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for at, (name, function) in enumerate(corpus_pipeline.STAGES):
        docs = function(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        assert at == 4 or docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert set(clean) <= set(kept[name])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]
    assert 2006 not in kept["toxicity"] and {3000, 3001} <= set(kept["toxicity"])
    assert sum(k in kept["toxicity"] for k, t in toxic.items() if t) < 5 and sum(k not in kept["toxicity"] for k, t in toxic.items() if not t) < 5
    lines = kept["line dedup"]
    assert 2001 not in lines and line not in lines[2003].text and lines[2002].text.startswith(line)
    assert lines[2003].n_chars == len(lines[2003].text) and lines[1001].text == clean[1001]
    assert 2004 in kept["n-gram Jaccard join"] and 2005 not in kept["n-gram Jaccard join"]
    assert 2000 in kept["n-gram Jaccard join"] and 2000 not in kept["benchmark decontamination"]
    bpe = byte_bpe.encoding(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    for doc, row in kept["byte-level BPE"].items():
        text = kept["benchmark decontamination"][doc].text or ""
        assert list(row.ids) == bpe.encode_ordinary(text) and row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run_applies_all_stages(spark, library):
    folder, clean, *_ = library
    found = corpus_pipeline.run(spark, folder)
    ids = [r.doc_id for r in found.collect()]
    assert set(clean) <= set(ids) and not {2000, 2001, 2005, 2006} & set(ids)
    assert len(ids) == len(set(ids)) or ids.count(1003) == 1


def test_stages_take_empty_tables_and_further_columns(spark, library, tmp_path):
    folder, *_ = library
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    clash = docs.selectExpr("*", "1 AS row", "'a' AS score", "2 AS n_lines", "'k' AS key", "0 AS sid")
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, folder).count() == 0
        found = function(spark, clash, folder)
        assert found.columns == clash.columns and found.count() == 0


def test_short_lines_of_their_own_keep_a_document(spark):
    footer = "All of this is licensed to be copied, says the footer."
    docs = [(1, f"Own words.\n{footer}"), (2, f"a b\n\nEngezuver au.\n{footer}"), (3, footer), (4, f" \n{footer}\n\u00a0\t"), (5, None), (6, " ")]
    table = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in docs], COLUMNS)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_lines(spark, table, "").collect()}
    left = "a b\n\nEngezuver au."
    assert got == {1: (docs[0][1], len(docs[0][1])), 2: (left, len(left)), 5: (None, 0), 6: (" ", 1)}


def test_encoding_and_decoding_do_not_share_a_stage(spark, library):
    folder, *_ = library
    found = corpus_pipeline.tokenize(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert found._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1
