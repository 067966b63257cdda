"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewdex.llm import byte_bpe, decontamination, exact_dedup, files, jaccard, lexical, line_dedup, pii, records, separator_scan, simhash, spelling, suffix_dedup, toxicity, word_bpe

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": rf"""WITH docs AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents),
        items AS (SELECT item_id, list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark),
        windows AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS words
          FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM items WHERE len(ws) > 0)),
        sizes AS (SELECT DISTINCT size FROM windows),
        places AS (SELECT doc_id, size, p, array_to_string(ws[p:p + size - 1], ' ') AS words
          FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS p FROM docs, sizes WHERE len(ws) >= size)),
        hits AS (SELECT doc_id, size, p, item_id FROM places JOIN windows USING (size, words)),
        words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
          FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS named
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
          sha256(coalesce(named, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op5_exact_dedup": f"""WITH rows AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
            doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM rows""",
    "op7_ngram_jaccard": rf"""WITH RECURSIVE docs AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
        grams AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS gram
          FROM (SELECT *, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS p FROM docs WHERE len(ws) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b USING (gram)
          WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
        least_ AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM least_ LEFT JOIN sizes USING (doc_id)""",
    "op11_lexical_search": rf"""WITH docs AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents),
        asked AS (SELECT DISTINCT item_id, unnest(list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM benchmark),
        corpus AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM docs WHERE len(ws) > 0),
        tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM docs) GROUP BY ALL),
        weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, corpus GROUP BY term, n_docs),
        norms AS (SELECT doc_id, 100 - 90 + (90 * len(ws) * n_docs) // n_terms AS m FROM docs, corpus),
        scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN norms USING (doc_id) GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 10""",
    "op12_spelling_variants": rf"""WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS crcs),
        runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(list_filter(string_split_regex({_LOWER}, '[^a-z\x{{C0}}-\x{{FF}}]+'), lambda w: w <> '')) AS run FROM documents) GROUP BY ALL),
        bytes AS (SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''),
            lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bs FROM runs),
        sums AS (SELECT run, n, xor(list_reduce(bs, lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) AS h FROM bytes, bits),
        words AS (SELECT word, sum(n)::BIGINT AS n
          FROM (SELECT n, CASE WHEN h % 31 = 0 THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word FROM sums)
          WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cuts AS (SELECT word, place, word[:place - 1] || word[place + 1:] AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM words)),
        near AS (SELECT a.word, b.word AS other FROM cuts a JOIN cuts b USING (place, cut) WHERE a.word <> b.word
          UNION SELECT word, cut FROM cuts WHERE cut IN (SELECT word FROM words) UNION SELECT cut, word FROM cuts WHERE cut IN (SELECT word FROM words)),
        best AS (SELECT near.word, count(*) AS n_near, max(o.n) AS most, arg_min(other, (-o.n, other)) AS form
          FROM near JOIN words o ON o.word = other GROUP BY near.word),
        told AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN form END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
          FROM words LEFT JOIN best USING (word)),
        follow AS (SELECT word, word AS root FROM words UNION ALL SELECT follow.word, form FROM follow JOIN told ON told.word = root WHERE form IS NOT NULL),
        ends AS (SELECT follow.word, root FROM follow JOIN told ON told.word = root WHERE form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM told JOIN ends USING (word)""",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark, sf_dir):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = _table(spark, sf_dir, "documents")
    encoded = byte_bpe.encode(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)
    digests = encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids",
    )
    return byte_bpe.decode(digests, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256")
    )


def op7_ngram_jaccard(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return jaccard.similarity_classes(docs, "doc_id", "text", size=4, percent=85).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id"
    )


def op8_line_dedup(spark, sf_dir):
    """Documents without the lines that are within two edits of an earlier line, or short and equal to one."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs, "doc_id", "text", equal=True).select(
        "doc_id", "n_lines", "n_long", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op9_binary_records(spark, sf_dir):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    folder = files.new_folder(spark, "records")
    docs = records.ordered(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    records.write(word_bpe.encode(docs, "doc_id", "text", tokenizer, end_id=1), "doc_id", "tokens", folder)
    return records.read(spark, folder).select(
        "doc_id", "start", F.expr("octet_length(tokens) div 4").alias("n_tokens"), F.crc32("tokens").alias("ids_crc32")
    )


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def op2_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out()), "doc_id", "text", "toxic")
    return toxicity.score(docs, "doc_id", "text", model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
    )


def op3_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = pii.find(docs, "doc_id", "text", pii.fit(docs, "text"))

    def count(at: int):
        return F.size(F.filter("base", lambda s: s["kind"] == at)).cast("long").alias(f"n_{pii.KINDS[at]}")

    return found.select(
        "doc_id", *map(count, range(len(pii.KINDS))), F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
        pii.as_text(F.col("spans")).alias("spans"),
    )


def op4_decontamination(spark, sf_dir):
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, benchmark, "doc_id", "text", "item_id", "text").select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text", keep="max")


def op6_separator_scan(spark, sf_dir):
    """Token counts of ``documents``, read from flat files that hold them without an index."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    folder, end = files.new_folder(spark, "flat"), 50_256
    docs = _table(spark, sf_dir, "documents")
    separator_scan.write_flat(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN, end, folder)
    counted = separator_scan.scan(spark, folder, end)
    return separator_scan.names(spark, folder).join(counted, ["file", "ordinal"]).select(
        "doc_id", "file", "ordinal", "start", "n_tokens", "terminated"
    )


def op10_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), "doc_id", "text").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_lexical_search(spark, sf_dir):
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return lexical.rank(docs, benchmark, "doc_id", "text", "item_id", "text", k=10)


def op12_spelling_variants(spark, sf_dir):
    """Words of ``documents`` and their variants; some occurrences are misspelt by rule."""
    return spelling.variants(_table(spark, sf_dir, "documents"), "doc_id", "text", every=spelling.EVERY)


def op13_simhash(spark, sf_dir):
    found = simhash.simhash_classes(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_byte_bpe, op2_toxicity, op3_pii, op4_decontamination, op5_exact_dedup, op6_separator_scan, op7_ngram_jaccard, op8_line_dedup, op9_binary_records, op10_suffix_dedup,
    op11_lexical_search, op12_spelling_variants, op13_simhash,
)
