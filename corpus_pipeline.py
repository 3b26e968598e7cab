"""From raw documents to token ids: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir); ``run`` writes its result as Parquet to the
folder the session names in spark.checkpoint.dir and gives it, read again, to the next.
All but the last return the columns of ``documents``; further columns pass through.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, ngram_quality, secret_scan, sentencepiece_codec, simhash
from ledgerloom.llm.queries import piece_model, table
from ledgerloom.session import durable, row_keys


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that the n-gram model rejects.

    Missing and empty texts are kept, repeated rows share their verdict, and an empty
    table stays empty.  This and the other stages decide row by row, whatever the ids,
    and pass on all columns, whatever their names.
    """
    keyed, key = _keyed(docs)
    judged = ngram_quality.judge(keyed, table(spark, sf_dir, "labels"), key=key, keep=[key])
    return _without(keyed, judged.where(~F.col("kept")), key).select(*_named(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, keep_missing_ids: bool = True) -> DataFrame:
    """Keep one row of each SimHash group: the smallest id's, of several such rows the first by key.

    Groups are told apart by their root, as one id may have rows in several of them.
    Rows without an id all stay beside it, or, without ``keep_missing_ids`` (as in the
    pipeline), only where their group has no other row, the first by key.  Texts without
    words, missing ones too, form one group.
    """
    keyed, key = _keyed(docs)
    grouped = durable(simhash.near_duplicates(keyed, keep=[key]).select("doc_id", "root", F.col(f"`{key}`").alias("key")))
    judged = grouped.where("doc_id is not null") if keep_missing_ids else grouped
    first = judged.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")).select("first.key")
    kept = durable((first.unionAll(grouped.where("doc_id is null").select("key")) if keep_missing_ids else first).withColumnRenamed("key", key))
    return keyed.join(kept.hint("merge"), key, "left_semi").select(*_named(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows in which a window of a benchmark item occurs; missing and empty texts have none."""
    keyed, key = _keyed(docs)
    found = decontaminate.contamination(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
    return _without(keyed, found.where("n_hit > 0"), key).select(*_named(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced in the text and ``n_chars`` counted anew where it has any.

    Missing texts stay missing; repeated rows are treated alike.
    """
    found = _unused(docs, "__secrets")
    clean = secret_scan.scan(docs, secret_scan.learn(docs), out=found, clean=True)
    size = F.when(F.size(F.col(f"`{found}`")) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", size).select(*_named(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, lossless): token ids, and whether decoding them gives the text back.

    A missing text counts as empty: its only id is the end's.
    """
    model = piece_model()
    back = sentencepiece_codec.encode(docs.select("doc_id", "lang", "source", "text"), model, decoded="decoded")
    return back.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


def _named(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key for each row (``row_keys``), and the key's name."""
    key = _unused(docs, "__row")
    return row_keys(docs, key), key


def _without(keyed: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """``keyed`` but for the rows whose keys are rejected.

    Rejected rows grow with the documents, so both sides are shuffled at every size.
    """
    return keyed.join(durable(rejected.select(key)).hint("merge"), key, "left_anti")


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", partial(near_duplicates, keep_missing_ids=False)),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("tokens", tokens),
]
#: no stage can be said in SQL as a whole (trained models, fingerprints, automata, merges); tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
