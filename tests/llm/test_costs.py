"""What row work costs, beside what it returns: each rule here was broken once."""

from __future__ import annotations

import random
import tracemalloc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from skewdex.llm import arrow, components, jaccard, lists, spelling, word_bpe
from skewdex.sources import staging
from tokenizers import Tokenizer


def test_common_pieces_are_encoded_once_however_many_rare_ones_there_are(monkeypatch):
    content = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    asked = []

    class Counting:
        @staticmethod
        def from_str(text):
            library = Tokenizer.from_str(text)

            class Model:
                def tokenize(self, piece):
                    asked.append(piece)
                    return model.tokenize(piece)

            class Library:
                def __getattr__(self, name):
                    return Model() if name == "model" else getattr(library, name)

            model = library.model
            return Library()

    monkeypatch.setattr(word_bpe, "Tokenizer", Counting)
    monkeypatch.setattr(word_bpe, "REMEMBERED", 200)
    texts = [" ".join(["common", *("rare" + chr(97 + a) + chr(97 + b) for b in range(20))]) for a in range(26)]
    texts += ["ΑΣ ΣΑΣ! ΌΔΟΣ. σς", "École É, ñ%%% 12 x's", "İstanbul ﬁ", ""]
    encode, library = word_bpe.piece_encoder(content), Tokenizer.from_str(content)
    for text in texts + texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert asked.count("common") == 1


class _Dealt:
    """Takes the place of a DataFrame and keeps the function that tasks would run."""

    def __getattr__(self, name):
        return lambda *args, **kwargs: self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_a_bucket_is_handed_out_in_slices_and_never_as_python_numbers(spark, monkeypatch):
    n = 300_000
    entries = np.zeros(2 * n, lists.ENTRY)
    entries["key"], entries["sid"] = np.tile(np.arange(n) << 33, 2), np.repeat([1 << 40, 2 << 40], n)
    entries["pos"] = np.arange(2 * n)
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6], pa.int32()), pa.array([entries.tobytes(), entries[:1].tobytes()], pa.binary())], names=["bucket", "packed"])
    dealt = _Dealt()
    monkeypatch.setattr(lists, "stage", lambda df, name: df)
    lists.shared(dealt, 8)
    rows, sids = 0, set()
    tracemalloc.start()
    for found in dealt.run(iter([batch])):
        rows += found.num_rows
        sids |= set(found.column("sid").unique().to_pylist())
        del found
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (rows, sids) == (2 * n, {1 << 40, 2 << 40})  # nobody shares the key of the second bucket
    assert peak < 6 * entries.nbytes


def test_runs_too_short_to_be_words_are_not_looked_at(monkeypatch):
    class Stop(Exception):
        pass

    def caught(df, schema, make):
        raise Stop(make)

    class Checksums:
        def __init__(self):
            self.seen = []

        def crc32(self, data, start=0):
            self.seen.append(data)
            return 1  # not divisible by 31

    monkeypatch.setattr(spelling, "map_rows", caught)
    monkeypatch.setattr(spelling, "zlib", checksums := Checksums())
    monkeypatch.setattr(spelling.F, "coalesce", lambda *args: None)
    monkeypatch.setattr(spelling.F, "col", lambda *args: _Dealt())
    monkeypatch.setattr(spelling.F, "lit", lambda *args: None)
    with pytest.raises(Stop) as stopped:
        spelling.word_counts(_Dealt(), "doc_id", "text")
    step, counts = stopped.value.args[0](), {}
    list(step(None, "1", "the Seventh of aaaaaaa, sixsix seventh éééééééé 1a2b") or ())
    list(step.close(lambda word, n, size: counts.update({word: n})))
    assert counts == {b"seventh": 2, b"aaaaaaa": 1, "éééééééé".encode("latin-1"): 1}
    assert sorted(checksums.seen[1:]) == sorted([b"seventh", b"aaaaaaa", "éééééééé".encode()])


def test_a_task_holds_nothing_when_it_gives_its_memory_back(spark, monkeypatch):
    class State:
        pass

    states, free = [], []

    def make():
        state = State()
        states.append(weakref.ref(state))

        def step(emit, number):
            emit(number if state else None)

        step.close = lambda emit: emit(-1 if state else None)
        return step

    monkeypatch.setattr(arrow, "release", lambda: free.append(states[0]() is None))
    arrow.map_rows(dealt := _Dealt(), "number long", make)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64())], names=["number"])
    assert [x for found in dealt.run(iter([batch])) for x in found.column(0).to_pylist()] == [1, 2, -1]
    assert free == [True]
    arrow.released(iter)([])


def test_plans_of_classes_read_few_tables(spark, monkeypatch):
    rng = random.Random(9)
    base, made, scans = [f"w{i}" for i in range(120)], [], []
    for at in range(60):
        text = list(base)
        for spot in rng.sample(range(120), 6 if at % 3 == 0 else 2):
            text[spot] = f"own{at}x{spot}"
        made.append((at, " ".join(text)))

    def counting(df, name, *args):
        scans.append((df._jdf.queryExecution().sparkPlan().toString().count("FileScan"), name))
        return staging.stage(df, name, *args)

    for module in (lists, components):
        monkeypatch.setattr(module, "stage", counting)
    jaccard.similarity_classes(spark.createDataFrame(made, "doc_id long, text string"), "doc_id", "text", 4, 85).collect()
    assert {"pairs", "links", "labels"} <= {name for _, name in scans}
    assert max(scans)[0] <= 24, sorted(scans)[-5:]
