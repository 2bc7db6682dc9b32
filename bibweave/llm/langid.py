"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of 1 to 3 characters (lower-cased, hashed to 2**16
buckets) for each language on a bounded sample of labelled rows, spread evenly
over the languages by a hash of the id.  The smoothed log-probabilities, in
whole 1/1024 nats, form a matrix of buckets x languages; the class prior is the
share of a language among all labelled rows.  The matrix is broadcast in blocks
of at most ``BLOCK`` languages (64 MB); more languages are scored block after
block, and the best and the sum of what came before are handed on, so the result
is that of the whole matrix however many there are.

Scoring takes a batch of texts at once: their n-grams make a sparse matrix of
texts x buckets, whose product with the log-probabilities is the sum of the
matrix's rows at these buckets, text by text.  Sums are whole numbers, so a text
gets the same score in any batch.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as
is every text if there is nothing to learn from; rows with a null label are not
learned from, nor are languages whose sampled rows have no letter; texts are read
whole, long ones in overlapping slices; of languages that score alike the first by
code point is taken; repeated rows count each; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from bibweave.functions.ngrams import BITS, ORDERS, SCALE, counted, grams, log_probabilities, slices, sums  # noqa: F401
from bibweave.scratch import small_batches

#: Labelled rows learned from, for each language (the documented bound).
SAMPLE_ROWS = 3000
#: Languages whose log-probabilities are broadcast and scored at a time.
BLOCK = 256
UND = "und"


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; a null id never is."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Model:
    """Languages in code-point order; for each block of them the log-probabilities (buckets x languages) and priors, in whole 1/1024 nats."""

    def __init__(self, languages: list[str], blocks: list[tuple[np.ndarray, np.ndarray]]):
        self.languages, self.blocks = languages, blocks


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, block: int = BLOCK) -> Model:
    """Learns from columns doc_id, text, lang; rows without text or lang are left out."""
    small_batches(labelled.sparkSession)
    rows = labelled.where("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), "text", F.pmod(F.xxhash64(F.lit(6), F.col("doc_id").cast("string")), F.lit(1 << 30)).alias("_h"))
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    languages, blocks = [], []
    for names in (sorted(many)[i : i + block] for i in range(0, len(many), block)):
        most = F.create_map(*(F.lit(x) for n in names for x in (n, sample_rows / many[n] * (1 << 30))))
        sample = rows.where(F.col("_h") < F.try_element_at(most, F.col("lang"))).select("lang", "text")
        table = sample.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages of the block x buckets at most
        found = sorted(set(table["lang"].to_pylist()))
        if not found:
            continue
        prior = np.log(np.array([many[x] for x in found]) / sum(many.values()))
        languages += found
        blocks.append((log_probabilities(table, found), np.rint(prior * SCALE).astype(np.int64)))
    return Model(languages, blocks)


def identify(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", probability: str = "score") -> DataFrame:
    """All columns and rows of ``docs``, with the predicted language and its probability.

    Input columns named like the two new ones are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = [c for c in docs.columns if c not in (lang, probability)]
    at = keep.index(text)
    fields = [docs.schema[c] for c in keep]
    # best so far (its sum) and the logarithm of the sum of all so far, relative to the best
    more = [StructField("_best", LongType()), StructField("_all", DoubleType())]
    out = docs.select(*(F.col(f"`{c}`") for c in keep))
    names, begin = model.languages, 0
    for matrix, prior in model.blocks or [(np.zeros((1 << BITS, 0), np.int32), np.zeros(0, np.int64))]:
        block, begin = names[begin : begin + len(prior)], begin + len(prior)
        first, last = begin == len(block), begin == len(names)
        shared = spark.sparkContext.broadcast((block, matrix, prior))
        out = out.mapInArrow(_scored(shared, at, len(keep), first, last), StructType([*fields, StructField(lang, StringType()), *([StructField(probability, DoubleType())] if last else more)]))
    return out


def _scored(shared, at: int, width: int, first: bool, last: bool):
    """One block of languages: adds or replaces the best language, and what the next block or the score needs."""

    def run(batches):
        block, matrix, prior = shared.value
        for batch in batches:
            n = batch.num_rows
            s, seen = sums(batch.column(at).to_pylist(), matrix, prior)
            found = [None] * n if first else batch.column(width).to_pylist()
            best = np.full(n, np.iinfo(np.int64).min) if first else batch.column(width + 1).to_numpy()
            whole = np.full(n, -np.inf) if first else batch.column(width + 2).to_numpy()
            if len(block) and n:
                own = s.argmax(axis=1)
                top = s[np.arange(n), own]
                with np.errstate(divide="ignore"):
                    mine = np.log(np.exp(np.maximum((s - top[:, None]) / SCALE, -700)).sum(axis=1)) + top / SCALE
                whole = np.logaddexp(whole, mine)
                better = seen & (top > best)
                found = [block[own[i]] if better[i] else found[i] for i in range(n)]
                best = np.where(better, top, best)
            columns = [batch.column(i) for i in range(width)]
            if last:
                none = np.array([f is None for f in found], bool)
                score = np.where(none, 0.0, np.exp(np.minimum(0.0, np.where(none, 0, best) / SCALE - np.where(none, 0.0, whole))))
                columns += [pa.array([f or UND for f in found], pa.string()), pa.array(score, pa.float64())]
            else:
                columns += [pa.array(found, pa.string()), pa.array(best, pa.int64()), pa.array(whole, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])

    return run
