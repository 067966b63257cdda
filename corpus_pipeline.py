"""A corpus made ready for training: toxic, repeated and leaked text out, the rest tokenized.

Each stage takes what its predecessor kept, as written to Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewdex.llm import byte_bpe, decontamination, jaccard, line_dedup, toxicity
from skewdex.llm.lists import few
from skewdex.llm.queries import held_out
from skewdex.sources.staging import stage

#: Word n-grams and similarity, in percent, of near duplicates.
GRAM, SIMILAR = 5, 80


def _plain(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with columns c0, c1 ..., so that no name meets one of an operator's; and those of id and text."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return named, f"c{docs.columns.index('doc_id')}", f"c{docs.columns.index('text')}"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic; the labels of the held-out rows are not used."""
    rows, doc, text = _plain(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    model = toxicity.fit(rows, labels.withColumnRenamed("doc_id", doc), doc, text, "toxic")
    kept = toxicity.with_score(rows, text, model, "score").where(F.col("score") < toxicity.REJECT)
    return kept.select(*rows.columns).toDF(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that repeat an earlier one, and without documents of which only white space is left."""
    rows, doc, text = _plain(docs)
    kept = line_dedup.drop_repeated_lines(rows, doc, text, equal=True)
    kept = kept.where((F.col("n_dropped") == 0) | F.col(text).rlike(r"(?U)\S"))
    if "n_chars" in docs.columns:
        chars = f"c{docs.columns.index('n_chars')}"
        kept = kept.withColumn(
            chars, F.when(F.col("n_dropped") > 0, F.char_length(text)).otherwise(F.col(chars)).cast(docs.schema["n_chars"].dataType)
        )
    return kept.select(*rows.columns).toDF(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links, the one with the smallest id; of equal rows, one."""
    rows, doc, text = _plain(docs)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    place = F.struct(F.col(doc).isNull().alias("last"), F.col(doc).alias("doc"), "row").alias("place")
    found = jaccard.similarity_classes(rows.select(place, text), "place", text, GRAM, SIMILAR)
    losers = few(found.where("place <> component_id").select("place.row"), "similar")
    return rows.join(losers, "row", "left_anti").drop("row").toDF(*docs.columns)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of a benchmark item occurs."""
    rows, doc, text = _plain(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(rows, benchmark, doc, text, "item_id", "text").toDF(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of each document that is left."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # Written first: in one stage, encoding and decoding have a Python worker each for every core, with an encoder each.
    encoded = stage(byte_bpe.encode(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN), "encoded")
    return byte_bpe.decode(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", drop_leaked),
    ("byte-level BPE", tokenize),
]

#: SQL can express neither the classifier nor edit distances over whole tables; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = stage(docs, f"corpus-{name.replace(' ', '-')}")
    return docs
