"""Personal data, exact copies and benchmark passages, against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from skewdex.llm import decontamination, exact_dedup, pii, queries

GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")),
        "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
    }[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, p in GIVEN.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


PRIVATE = [
    None, "", "a@b.c%x@d.e a@b..c x@y", "1.2.3.4.5.6.7.8 999.1.1.1 1.1.1.1.1 01.002.3.255 1.2.3.0000000000000256",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 1  4111 1111 1111 1111 5 - 4111111111111111 9 4111111111111111",
    "+1 (625) 555-7196 +12 +1+1234567 89 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é" * 50 + "😀 a@b.co 😀 +1 555 555 5555 x 10.0.0.1",
    "1 " * 30000, "a" * 60000 + "@" + "b." * 20000, "x." * 9000 + "a@b.c", "+1 555 555 5555, mail q@r.st " * 300,
]


@pytest.fixture(scope="module")
def private(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("private"))
    rows = [(i, t, "x", 1) for i, t in enumerate(PRIVATE)] + [(None, PRIVATE[2], "y", 2), (2, PRIVATE[2], "z", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, gen string, row int").write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_op3_has_the_base_spans(spark, private):
    folder, rows = private
    expected = []
    for doc, text, *_ in rows:
        spans = base(text)
        shown = ",".join(":".join(map(str, s)) for s in spans)
        expected.append((doc, *(sum(s[0] == k for s in spans) for k in GIVEN), hashlib.sha256(shown.encode()).hexdigest()))
    got = queries.op3_pii(spark, folder).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted(expected, key=str)
    for row in got:
        spans = [tuple(s.split(":")) for s in row.spans.split(",") if s]
        assert [list(GIVEN).index(s[0]) for s in spans] == sorted(list(GIVEN).index(s[0]) for s in spans)


def test_trees_add_what_looks_confirmed(spark):
    confirmed = [(f"call +1 (2{i:02d}) 555-7{i:03d} now or write to u{i}@mail.org, ref 12-34-56-{i}",) for i in range(400)]
    model = pii.fit(spark.createDataFrame(confirmed, "text string").repartition(3), "text", confirmed=0.8)
    assert set(model.thresholds) <= set(pii.KINDS) and "phone" in model.thresholds
    text = "it is 1 (212) 555-7001 here, not 12-34-56-7, but +1 (212) 555-7002"
    found = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text", model).first()
    shown = [(pii.KINDS[s.kind], text[s.start : s.end]) for s in found.spans]
    assert ("phone", "+1 (212) 555-7002") in shown
    assert len(found.base) == 1 and {tuple(s) for s in found.base} <= {tuple(s) for s in found.spans}


WRITTEN = {
    "write jane (at) example.org now": "jane (at) example.org", "jane[at]example[dot]org": "jane[at]example[dot]org",
    "x@y jane at example dot org": "jane at example dot org", "E-Mail: jane at example.org, or so": "jane at example.org",
    "jane @ example.co.uk": "jane @ example.co.uk", "look at example.org": None, "open at 10.30 (at) 3.14 daily": None,
    "plain jane@example.org here": "jane@example.org", "nothing at all": None,
}


def test_written_out_addresses_are_found(spark):
    docs = spark.createDataFrame(list(enumerate(WRITTEN)), "doc_id long, text string")
    for model in (pii.Model(), pii.fit(docs, "text")):
        found = {r.doc_id: r.spans for r in pii.find(docs, "doc_id", "text", model).collect()}
        for k, (text, span) in enumerate(WRITTEN.items()):
            assert [(pii.KINDS[s.kind], text[s.start : s.end]) for s in found[k]] == ([("email", span)] if span else []), text


def test_written_out_addresses_that_are_not_meant_stay_out_among_many(spark):
    rows = [(f"u{i}@mail.org or jane{i} (at) mail{i}.org",) for i in range(400)] + [(f"look at site{i}.com",) for i in range(40)]
    docs = spark.createDataFrame(rows, "text string").selectExpr("monotonically_increasing_id() AS doc_id", "text")
    got = pii.find(docs, "doc_id", "text", pii.fit(docs, "text")).collect()
    assert sorted(len(r.spans) for r in got) == [0] * 40 + [2] * 400


def test_national_numbers_are_found_where_such_numbers_are_confirmed(spark):
    rows = [(f"call +1 (2{i % 90 + 10}) 555-7{i:03d} now, ref 12-34-56-{i}",) for i in range(400)]
    model = pii.fit(spark.createDataFrame(rows, "text string").repartition(3), "text")
    text = "call 1 (212) 555-7001 now, not 12-34-56-7"
    found = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text", model).first()
    assert [(pii.KINDS[s.kind], text[s.start : s.end]) for s in found.spans] == [("phone", "1 (212) 555-7001")] and not found.base


def test_a_model_without_candidates_adds_nothing(spark):
    docs = spark.createDataFrame([(1, "no data"), (2, None)], "doc_id long, text string")
    model = pii.fit(docs, "text")
    assert model == pii.Model() and all(r.spans == [] for r in pii.find(docs, "doc_id", "text", model).collect())
    assert pii.find(docs.limit(0), "doc_id", "text", pii.fit(docs.limit(0), "text")).count() == 0


def test_redaction_covers_spans_that_overlap(spark):
    row = spark.createDataFrame([("abcdefghij", [(0, 1, 4), (1, 3, 6), (0, 8, 9)])], "text string, spans array<struct<kind:int,start:bigint,end:bigint>>")
    assert row.select(pii.redact(F.col("text"), F.col("spans"))).first()[0] == "a*****gh*j"


def test_native_operators_run_no_python(spark, private, plan):
    folder, _ = private
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for df in (
        pii.find(docs, "doc_id", "text", pii.Model()), exact_dedup.exact_duplicates(docs, "doc_id", "text"),
        decontamination.contamination(docs, docs, "doc_id", "text", "doc_id", "text"),
    ):
        assert not re.search("Python|Pandas|Arrow", plan(df))


LINE = "alpha beta gamma delta eps zeta eta theta iota kappa la mu nu xi"
LEAKS = [
    (0, None), (1, ""), (2, LINE), (3, f"x {LINE.upper()} y {LINE}"), (4, " ".join(LINE.split()[:10])),
    (5, " ".join(LINE.split()[:9])), (6, "short item here short item"), (7, "a " * 14), (7, "a a a a"), (8, "Ünï ünï"),
    (9, (LINE + " ") * 50), (None, "short item"), (2, LINE), (10, "[alpha] beta`gamma{delta} eps@zeta/eta:theta;iota?kappa"),
    (11, "word " * 5000 + LINE),
]
ITEMS = [
    (1, LINE), (2, "short item"), (3, "a " * 12), (4, None), (5, ""), (6, "ünï"), (10, f"{LINE} {LINE}"),
    (11, "not there at all"), (12, "x"), (None, "y"), (1, "y alpha beta"),
]


def words(text):
    lower = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower.decode())


def leaks(docs, items):
    windows = {}
    for item, text in items:
        found = words(text)
        for at in range(max(1, len(found) - 9) if found else 0):
            windows.setdefault(tuple(found[at : at + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        found, hit, named = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(found) - size + 1):
                if its := windows.get(tuple(found[at : at + size])):
                    named |= its
                    hit |= set(range(at, at + size))
        out.append((doc, len(found), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def leaking(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("leaking"))
    extra = [(*row, "key", i) for i, row in enumerate(LEAKS)]
    spark.createDataFrame(extra, "doc_id long, text string, key string, words int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_op4(spark, leaking):
    assert sorted(map(tuple, queries.op4_decontamination(spark, leaking).collect()), key=str) == leaks(LEAKS, ITEMS)


def test_proximity_matches_need_most_of_the_words_near_the_rarest(spark):
    docs = spark.createDataFrame([(1, "kappa iota theta eta zeta eps delta gamma beta alpha"), (2, "alpha beta other")], "doc_id long, text string")
    items = spark.createDataFrame([("q", LINE)], "item string, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in decontamination.contamination(docs, items, "doc_id", "text", "item", "text").collect()}
    assert got == {1: ([], ["q"]), 2: ([], [])}


def test_empty_tables_have_no_leaks(spark, leaking):
    docs, items = spark.read.parquet(f"{leaking}/documents.parquet"), spark.read.parquet(f"{leaking}/benchmark.parquet")
    args = ("doc_id", "text", "item_id", "text")
    assert decontamination.contamination(docs.limit(0), items, *args).count() == 0
    assert decontamination.contamination(docs, items.limit(0), *args).agg(F.sum("n_hit")).first()[0] == 0
    kept = decontamination.clean(docs, items, *args)
    assert kept.columns == docs.columns and kept.count() == sum(not r[-1] for r in leaks(LEAKS, ITEMS))


def test_op5(spark, tmp_path):
    rows = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (None, "abc"), (None, "own"), (None, "own"), (7, "x" * 99999), (8, "X" * 99999), (8, "abc"), (8, "abc")]
    extra = [(*r, "sha", b"hash") for r in rows]
    spark.createDataFrame(extra, "doc_id long, text string, sha string, hash binary").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    groups = {}
    for doc, text in rows:
        lower = (text or "").encode().lower()
        groups.setdefault(lower, []).append(doc)
    for keep, best in (("max", max), ("min", min)):
        expected = []
        for lower, docs in groups.items():
            stays = best((d for d in docs if d is not None), default=None)
            expected += [(d, stays, len(docs), d == stays, hashlib.sha256(lower).hexdigest()) for d in docs]
        found = exact_dedup.exact_duplicates(spark.read.parquet(f"{tmp_path}/documents.parquet"), "doc_id", "text", keep)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert queries.op5_exact_dedup(spark, str(tmp_path)).count() == len(rows)


def test_texts_whose_hashes_collide_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(F, "md5", lambda text: F.lit("00" * 16))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs, "doc_id", "text").collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2)}
