"""Text features in postings form: sublinear TF-IDF fitted on training
documents, the F-test computed from postings (zeros implied, never a dense
matrix), percentile selection, and word stemming of email bodies.

Postings ``(doc_id, term, ...)`` are produced by ``explode`` inside the scan
stage and reduced by partial aggregation before any shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.functions import text as TX
from raremine.operators.stats import anova_from_moments


def term_counts(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                stop_words: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(doc, *keep, term, c): token counts per document, stop words removed
    (the stop list is a fixed ~180-row broadcast).  ``keep``: columns that
    depend on the document and stay with its postings."""
    spark = docs.sparkSession
    toks = docs.select(doc, *keep, F.explode(TX.tokens(F.col(text))).alias("term"))
    if stop_words:
        stop = spark.createDataFrame([(w,) for w in stop_words], "term string")
        toks = toks.join(F.broadcast(stop), "term", "left_anti")
    return toks.groupBy(doc, *keep, "term").agg(F.count(F.lit(1)).alias("c"))


class TextModel:
    """TF-IDF and the F-test selection, fitted once and applied to later
    documents: a table (term, df, idf, f) in a folder and a few settings.

    ``fit`` reads training documents with a label; ``transform`` gives the
    postings (doc, term, w) of any documents over the fitted vocabulary, or,
    with ``selected``, those of the best ``percent`` of terms.  Rows are
    normalised over the whole vocabulary before terms are selected, as a
    vectorizer followed by a selector does."""

    def __init__(self, path: str, terms: DataFrame, settings: dict):
        self.path, self.terms, self.settings = path, terms, settings

    @classmethod
    def fit(cls, docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", label: str = "label",
            max_df: float = 0.5, stop_words: Sequence[str] | None = None, percent: float = 10.0) -> TextModel:
        from raremine.operators.stats import select_percentile
        from raremine.session import written

        spark = docs.sparkSession
        counts = written(term_counts(docs, doc, text, stop_words, keep=(label,)), "postings")
        vocab = written(tfidf_vocabulary(counts, docs.count(), max_df), "vocabulary")
        weights = written(_weighted(counts.select(doc, "term", "c"), vocab, doc), "weights")
        f = anova_f_postings(weights, docs.select(doc, label), doc, label)
        best = select_percentile(f.withColumnRenamed("term", "feature"), percent)
        terms = vocab.join(f, "term", "left").join(best.select(F.col("feature").alias("term"), F.lit(True).alias("selected")), "term", "left")
        terms.withColumn("selected", F.coalesce("selected", F.lit(False))).write.parquet(f"{path}/terms")
        settings = {"doc": doc, "text": text, "stop_words": list(stop_words or [])}
        spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1).write.json(f"{path}/settings")
        return cls.load(spark, path)

    @classmethod
    def load(cls, spark, path: str) -> TextModel:
        settings = json.loads(spark.read.json(f"{path}/settings").first()["settings"])
        return cls(path, spark.read.parquet(f"{path}/terms"), settings)

    def transform(self, docs: DataFrame, selected: bool = False) -> DataFrame:
        doc = self.settings["doc"]
        counts = term_counts(docs, doc, self.settings["text"], self.settings["stop_words"])
        out = _weighted(counts, self.terms.select("term", "df", "idf"), doc)
        return out.join(self.terms.filter("selected").select("term"), "term", "left_semi").select(doc, "term", "w") if selected else out


def tfidf(docs: DataFrame, is_train: str = "is_train", doc: str = "doc_id", text: str = "text",
          max_df: float = 0.5, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Sublinear TF-IDF postings ``(doc, term, w)`` for all documents.

    Fitted on training documents only: n and df from them; terms in more than
    max_df * n training documents are dropped; idf = ln((1+n)/(1+df)) + 1;
    tf' = 1 + ln(c); rows L2-normalised over the kept vocabulary; terms unseen
    in training are dropped from test documents; an empty row stays empty."""
    from raremine.session import written

    # tokenising is the expensive step and its postings feed the vocabulary,
    # the hot-term check and the weights: written once, with the flag on board
    counts = written(term_counts(docs.withColumn("_tr", F.col(is_train)), doc, text, stop_words, keep=("_tr",)), "postings")
    return _weighted(counts, tfidf_vocabulary(counts.filter("_tr"), docs.filter(F.col(is_train)).count(), max_df), doc)


def tfidf_vocabulary(counts: DataFrame, n_train: int, max_df: float = 0.5) -> DataFrame:
    """(term, df, idf) of the training documents' postings (doc, term, c)."""
    return (counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .filter(F.col("df") <= F.lit(max_df * n_train))
            .select("term", "df", (F.log((1.0 + n_train) / (1.0 + F.col("df"))) + 1.0).alias("idf")))


def _weighted(counts: DataFrame, vocab: DataFrame, doc: str) -> DataFrame:
    """(doc, term, w): normalised weights of postings over a vocabulary."""
    from raremine.operators.joins import salted_join

    # frequent terms (up to max_df of all documents) are hot join keys
    raw = salted_join(counts, vocab, ["term"], "inner", count_col="df").select(
        doc, "term", ((1.0 + F.log("c")) * F.col("idf")).alias("_w"))
    norms = raw.groupBy(doc).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return raw.join(norms, doc).select(doc, "term", (F.col("_w") / F.col("_norm")).alias("w"))


def anova_f_postings(postings: DataFrame, labels: DataFrame, doc: str = "doc_id",
                     label: str = "label", term: str = "term", value: str = "w") -> DataFrame:
    """F per term from postings of the training documents.

    Per (term, class): S = sum w, Q = sum w^2 over non-zero entries; class
    sizes come from ``labels`` (zeros are implied).  m = S/n, v = Q/n - m^2."""
    sizes = {r[0]: r[1] for r in labels.groupBy(label).count().collect()}      # K classes
    sums = (postings.join(labels.select(doc, label), doc)
            .groupBy(term, label).agg(F.sum(value).alias("_s"), F.sum(F.col(value) ** 2).alias("_q")))
    classes = F.array(*[F.struct(F.lit(c).alias(label), F.lit(n).alias("n")) for c, n in sorted(sizes.items())])
    grid = (postings.select(term).distinct()
            .select(term, F.explode(classes).alias("_c")).select(term, "_c.*"))
    full = grid.join(sums, [term, label], "left").select(
        F.col(term).alias("feature"), label, "n",
        (F.coalesce(F.col("_s"), F.lit(0.0)) / F.col("n")).alias("m"),
        (F.coalesce(F.col("_q"), F.lit(0.0)) / F.col("n")
         - (F.coalesce(F.col("_s"), F.lit(0.0)) / F.col("n")) ** 2).alias("v"))
    return anova_from_moments(full).withColumnRenamed("feature", term)


# ---------------------------------------------------------------- stemming --

#: Stems that a task remembers.
KNOWN_STEMS = 200_000


def stem_join(docs: DataFrame, doc: str = "doc_id", text: str = "body") -> DataFrame:
    """(doc, stemmed): words of ``text`` (whitespace split) replaced by their
    stems, joined by one space, order kept; null or empty text -> ''.

    Documents are stemmed where they are, a task remembers the stems of the
    words it has seen: nothing is shuffled, so frequent words cost nothing."""
    from pyspark import cloudpickle

    import raremine.functions.stem as stem_module
    from raremine.functions.stem import stem

    # ship the small stemmer module with the UDF instead of requiring the
    # package to be installed on every executor
    cloudpickle.register_pickle_by_value(stem_module)

    @F.pandas_udf("string")
    def stemmed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict = {}

        def of(word):
            found = known.get(word)
            if found is None:
                if len(known) >= KNOWN_STEMS:
                    known.clear()
                found = known[word] = stem(word)
            return found

        for bodies in parts:
            yield bodies.map(lambda words: " ".join(of(w) for w in words))

    words = F.coalesce(TX.split_ws(F.col(text)), F.array().cast("array<string>"))
    return docs.select(doc, stemmed(words).alias("stemmed"))
