"""Term weights of item texts, fully relational."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.skew import spread
from quartermill.functions.stopwords import ENGLISH

# Fixed value: a token is a run of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
MAX_FEATURES = 5000
MIN_DOCS = 2


def tokens(text: Column, stop_words: Sequence[str] = ENGLISH) -> Column:
    """Lower-case tokens of the whole text in order, without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(list(stop_words))) if stop_words else found


def _runs(words: Column, n: int) -> Column:
    """Every run of n neighbouring tokens, joined by a blank."""
    runs, count = words, F.greatest(F.size(words) - (n - 1), F.lit(0))
    for k in range(2, n + 1):
        runs = F.zip_with(F.slice(runs, F.lit(1), count), F.slice(words, F.lit(k), count),
                          lambda run, word: F.concat(run, F.lit(" "), word))
    return runs


def ngrams(words: Column, longest: int = 2) -> Column:
    """All runs of one to ``longest`` neighbouring tokens, formed after stop words are gone."""
    return F.concat(words, *[_runs(words, n) for n in range(2, longest + 1)])


def term_counts(docs: DataFrame, doc: str, text: str, longest: int = 2,
                stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """``(doc, term, tf)`` of whole texts.

    The texts are dealt by document and their terms counted where they lie, so what moves is the texts, once, and not a
    row for each of their terms.
    """
    words = spread(docs.select(doc, text), doc).select(doc, tokens(F.col(text), stop_words).alias("_words"))
    return (
        words.select(doc, F.explode(ngrams(F.col("_words"), longest)).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))
    )


def vocabulary(counts: DataFrame, max_features: int = MAX_FEATURES, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(term, df)`` of the most frequent terms (ties: alphabetical), at most ``max_features`` rows.

    The size limit is part of the method; it is also what makes the table safe to broadcast.
    """
    return (
        counts.groupBy("term").agg(F.sum("tf").alias("_total"), F.count(F.lit(1)).alias("df"))
        .filter(F.col("df") >= min_docs)
        .orderBy(F.desc("_total"), "term").limit(max_features)
        .select("term", "df")
    )


def tfidf(docs: DataFrame, doc: str, text: str, longest: int = 2, max_features: int = MAX_FEATURES,
          min_docs: int = MIN_DOCS, stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """``(doc, term, weight)``: tf * (ln((1 + n) / (1 + df)) + 1), unit length per document.

    The window over one document holds at most ``max_features`` rows.
    """
    counts = term_counts(docs, doc, text, longest, stop_words)
    vocab = vocabulary(counts, max_features, min_docs)
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    idf = F.log((n_docs + 1) / (F.col("df") + 1)) + 1
    raw = counts.join(F.broadcast(vocab), "term").withColumn("_w", F.col("tf") * idf)
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc)))
    return raw.withColumn("_length", length).select(doc, "term", (F.col("_w") / F.col("_length")).alias("weight"))
