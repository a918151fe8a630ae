"""Terms of texts: document frequencies, n-grams and co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_frequency(df: DataFrame, terms: Column, least: int = 1) -> DataFrame:
    """(term, documents): in how many rows each term of the array occurs, for terms in at least `least` rows."""
    rows = df.select(F.explode(F.array_distinct(terms)).alias("term"))
    return rows.groupBy("term").agg(F.count("*").alias("documents")).where(F.col("documents") >= least)


def cooccurrence(df: DataFrame, key: str, terms: Column, vocabulary: DataFrame) -> DataFrame:
    """(term_a, term_b, documents): the number of rows that hold both terms of the vocabulary (column `term`), with the
    document frequency on the diagonal. The vocabulary bounds the pairs of a row."""
    rows = df.select(F.col(key).alias("_k"), F.explode(F.array_distinct(terms)).alias("term")).join(vocabulary.select("term"), "term", "left_semi")
    pairs = rows.withColumnRenamed("term", "term_a").join(rows.withColumnRenamed("term", "term_b"), "_k")
    return pairs.groupBy("term_a", "term_b").agg(F.count("*").alias("documents"))


def occurrences(df: DataFrame, text: Column, vocabulary: list[str]) -> DataFrame:
    """(term, occurrences): how often each word of a list occurs as a whole word in all texts, in any letter case. Null texts
    count for none; a word that never occurs has 0. Texts are divided into words once, whatever the length of the list."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}_]+")
    wanted = F.array(*[F.lit(t.lower()) for t in vocabulary])
    found = df.select(F.explode(F.filter(words, lambda w: F.array_contains(wanted, w))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    listed = df.sparkSession.createDataFrame([(t.lower(),) for t in vocabulary], "term string").distinct()
    return listed.join(found, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("occurrences"))
