"""Quality grades by ordinal regression: P(grade > j) = sigmoid(w . x - theta_j).

One weight vector is shared by all thresholds, which are kept in order. x are
hashed words and beginnings of words (lower-cased, 2**17 buckets: one feature for
each that occurs, another for each that occurs twice) and a few shares of letters, marks and capitals.  The model is fitted on the
driver on a bounded sample of rated rows (``SAMPLE_ROWS`` for each grade), less
a quarter on which the threshold for keeping is set; scoring gives each document
its expected grade and the probability of the upper grades.

The ratings here are graded from the table ``labels``: 0 for toxic text, 1 for text
that is not toxic but of low quality, 2 for the rest. Toxic words add up without
bound, so they belong to the end of the scale; in the middle of it a text with
many of them would be pushed past its grade, and one with few would stay above it.

Defined cases: a null, empty or blank text has no features but its bias and gets
grade 0, tail 0 and is not kept; documents rated twice count once for each grade;
ratings with nulls are not learned from; with fewer than two grades to learn from
every text with words gets the one grade there is (or 0) and is kept; an empty
table gives an empty table. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.scratch import small_batches

BITS = 17
#: Lengths of the beginnings of words that count besides the words.
PREFIXES = (4, 5)
DENSE = 6
#: Rated rows learned from, for each grade (the documented bound).
SAMPLE_ROWS = 2500
#: Share of the rows of the upper grade, among those not fitted on, that the threshold for keeping gives up;
#: it is KEEP at most, and just that with fewer than LEAST_HELD such rows.
LOSS, KEEP, LEAST_HELD = 0.01, 0.5, 30
#: Weight of the L1 term. A word counts if it occurs in LEAST rows of any one grade, or in this share of the sample.
SPARSE, LEAST, SEEN = 0.01, 3, 0.01
_WORD = re.compile(r"[^\W_]+")


class _Buckets(dict):
    """Word -> buckets of the word and of its beginnings; forgets them before it grows large."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        parts = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
        b = self[word] = tuple(xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass"), 3) >> (32 - BITS) for p in parts)
        return b


def features(text: str | None, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray] | None:
    """(indices, values); None if the text has no words."""
    if not text:
        return None
    raw = text.split()
    if not raw:
        return None
    bare = _WORD.findall(text.lower())
    counted: Counter[int] = Counter()
    for word, n in Counter(bare).items():
        for b in buckets[word]:
            counted[b] += n
    twice = ((b * 40503 + 0x5BD1) & ((1 << BITS) - 1) for b, n in counted.items() if n > 1)
    own = {*counted, *twice}
    at = np.fromiter(own, np.int64, len(own))
    val = np.ones(len(own))
    n = len(text)
    letters = sum(map(len, bare))
    distinct = len(set(bare)) / max(1, len(bare))
    upper = sum(1 for w in raw if len(w) > 1 and w.isupper()) / len(raw)
    marked = sum(1 for w in raw if not w[-1].isalnum() and w[-1] not in ".,") / len(raw)
    dense = [letters / n, len(bare) / len(raw) - 1.0, distinct, upper, marked, min(1.0, math.log1p(len(raw)) / 10)]
    order = np.argsort(at)
    return np.concatenate([at[order], np.arange(DENSE) + (1 << BITS)]), np.concatenate([val[order], np.array(dense)])


class Model:
    """Shared weights, ordered thresholds, and the least tail probability to keep."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, keep: float = KEEP):
        self.weights, self.thresholds, self.keep = weights, thresholds, keep

    def tails(self, x) -> np.ndarray:
        """P(grade > j) for each threshold."""
        z = float(self.weights[x[0]] @ x[1])
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - z, -60, 60)))


def fit(rated: DataFrame, grades: int = 3, sample_rows: int = SAMPLE_ROWS, rounds: int = 300) -> Model:
    """Learns from columns doc_id, text, grade (0 to grades - 1)."""
    small_batches(rated.sparkSession)
    rows = rated.where("text is not null and grade is not null").select("grade", "text", "doc_id", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)).alias("_h"))
    share = {g: min(1.0, sample_rows / n) for g, n in rows.groupBy("grade").count().where(F.col("grade").between(0, grades - 1)).collect()}
    most = F.lit(0)
    for g, s in share.items():
        most = F.when(F.col("grade") == g, F.lit(int(s * (1 << 30)))).otherwise(most)

    def shrunk(batches):
        buckets = _Buckets()
        for batch in batches:
            got = [features(t, buckets) for t in batch.column(1).to_pylist()]
            ok = [i for i, x in enumerate(got) if x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()).take(pa.array(ok, pa.int64())), batch.column(2).cast(pa.int64()).take(pa.array(ok, pa.int64())), pa.array([got[i][0].astype(np.int32) for i in ok], pa.list_(pa.int32())), pa.array([got[i][1].astype(np.float32) for i in ok], pa.list_(pa.float32()))],
                ["grade", "doc_id", "at", "val"],
            )

    table = rows.where(F.col("_h") < most).select("grade", "text", "doc_id").mapInArrow(shrunk, "grade int, doc_id long, at array<int>, val array<float>").toArrow()
    table = table.sort_by([("doc_id", "ascending"), ("grade", "ascending")])
    y = np.array(table["grade"].to_pylist(), np.int64)
    if len(set(y.tolist())) < 2:
        only = float(y[0]) if len(y) else 0.0
        return Model(np.zeros((1 << BITS) + DENSE), np.array([-60.0 if j < only else 60.0 for j in range(grades - 1)]))
    at, val = table["at"].combine_chunks(), table["val"].combine_chunks()
    starts = at.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    at, val = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64), val.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lens = np.diff(starts)
    held = np.arange(len(y)) % 4 == 3  # in the order of the ids
    if len(set(y[~held].tolist())) < grades or (y[held] == grades - 1).sum() < LEAST_HELD:
        return _solve(y, at, val, lens, grades, rounds)
    part = ~np.repeat(held, lens)
    model = _solve(y[~held], at[part], val[part], lens[~held], grades, rounds)
    z = np.bincount(np.repeat(np.arange(len(y)), lens), weights=model.weights[at] * val, minlength=len(y))
    tails = 1.0 / (1.0 + np.exp(np.clip(model.thresholds[-1] - z, -60, 60)))
    model.keep = min(KEEP, float(np.quantile(tails[held & (y == grades - 1)], LOSS)))
    return model


def _solve(y: np.ndarray, at: np.ndarray, val: np.ndarray, lens: np.ndarray, grades: int, rounds: int) -> Model:
    """Accelerated proximal gradient on standardised features: a word keeps a weight only if it tells enough."""
    n, size = len(y), (1 << BITS) + DENSE
    who = np.repeat(np.arange(n), lens)
    share = np.bincount(y, minlength=grades)
    weigh = (1.0 / np.sqrt(share.clip(1)))[y]  # rare grades count for more, but not alike
    weigh /= weigh.sum()
    mean = np.bincount(at, weights=val * weigh[who], minlength=size)
    spread = np.sqrt(np.maximum(np.bincount(at, weights=val * val * weigh[who], minlength=size) - mean**2, 0))
    due = (y[:, None] > np.arange(grades - 1)[None, :]).astype(float)
    # words that move no threshold of the empty model are left out from the start
    lean = np.zeros(size)
    for j in range(grades - 1):
        pull = ((due[:, j] @ weigh) - due[:, j]) * weigh
        lean = np.maximum(lean, np.abs(np.bincount(at, weights=np.repeat(pull, lens) * val, minlength=size) - mean * pull.sum()))
    rows = np.stack([np.bincount(at[y[who] == g], minlength=size) for g in range(grades)])
    often = (rows.max(axis=0) >= LEAST) | (rows.sum(axis=0) >= max(2, SEEN * n))
    usual = (lean > 0.5 * SPARSE * spread) & often & (spread > 1e-9)
    scale = np.where(usual, 1.0 / np.maximum(spread, 1e-9), 0.0)
    mu, held = mean * scale, usual[at]
    at, who, v = at[held], who[held], (val * scale[at])[held]
    ahead = lambda w: np.bincount(who, weights=w[at] * v, minlength=n) - mu @ w
    back = lambda e: np.bincount(at, weights=e[who] * v, minlength=size) - mu * e.sum()
    u = np.cos(np.arange(size))
    for _ in range(12):  # the largest curvature, for the step
        u = back(ahead(u) * weigh)
        top = max(np.linalg.norm(u), 1e-9)
        u /= top
    step = 2.0 / top
    w = wz = np.zeros(size)
    theta = tz = np.linspace(-0.7, 0.7, grades - 1)
    t = 1.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(np.clip(tz[None, :] - ahead(wz)[:, None], -60, 60)))
        e = (p - due) * weigh[:, None]
        nw = wz - step * back(e.sum(axis=1))
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * SPARSE, 0)
        nt = np.sort(tz + 2.0 * e.sum(axis=0))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        wz, tz = nw + (before - 1) / t * (nw - w), nt + (before - 1) / t * (nt - theta)
        w, theta = nw, nt
    return Model(w * scale, theta + mu @ w)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_prob (upper grade), kept."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.keep))

    def run(batches):
        own, buckets = Model(*shared.value), _Buckets()
        for batch in batches:
            expected, tail = [], []
            for t in batch.column(1).to_pylist():
                x = features(t, buckets)
                p = own.tails(x) if x else np.zeros(1)
                expected.append(float(p.sum()))
                tail.append(float(p[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), pa.array([x > 0 and x >= own.keep for x in tail], pa.bool_())], ["doc_id", "expected_grade", "tail_prob", "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, expected_grade double, tail_prob double, kept boolean")


def sampled(rated: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` documents of each grade, each once, by a hash of the id.

    The hash is uniform over distinct ids, so the result stays that small
    whatever the input, and can be broadcast.
    """
    rows = rated.select("doc_id", "grade").where("grade is not null and doc_id is not null").distinct().withColumn("_h", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)))
    share = rows.groupBy("grade").agg((F.lit(float(sample_rows)) / F.count(F.lit(1)) * (1 << 30)).alias("_most"))
    return rows.join(share, "grade").where("_h < _most").select("doc_id", "grade")
