"""Near-duplicate groups by circulant MinHash, confirmed by exact Jaccard similarity.

1. Each text becomes its set of hashed word shingles. One permutation (sigma)
   spreads shingles over a circle of 2**32 places; a second one (pi) ranks the
   places. Coordinate k of the signature is the least pi(place + k): the same pi,
   shifted k steps round the circle. So two permutations give all coordinates.
2. Texts with one and the same set form a class; classes go on, copies don't.
3. Bands of coordinates are hashed. Classes that share a band are candidates.
4. In each bucket every class is compared with one hub only; confirmed links are
   contracted to components. Rounds of new hubs follow while they find enough.
   Before sets are compared, one byte of each coordinate gives an estimate, and
   pairs that are five deviations below the threshold go.
5. Buckets that still hold several components are settled by prefixes: with all
   shingles in one order, rare ones first, two sets that are similar enough share
   a shingle near the front of both, at places that their sizes bound. Only
   classes of different components that meet in this way are compared. This is
   exact, and a bucket of thousands of classes that are alike, but not alike
   enough, never makes all its pairs.

A band or a prefix that very many classes share is dealt to several tasks: what
is known of a key is a table of its own, so that a join with it can be split
where a key is hot, and prefixes of more than ``CROWD`` sets are cut into parts.

Defined cases: a null, empty or blank text has no shingles and is a group of its
own; repeated rows of a doc_id are the same document; rows with a null doc_id get
the group of their text but never name one; an empty table gives an empty table.
Texts are read whole. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.operators.components import connected_components
from bibweave.scratch import Scratch, small_batches

#: 32 bands of 5: a pair at the threshold of 0.8 is missed 3 times in a million.
BANDS, ROWS = 32, 5
#: Rounds of hubs at most, and the share of pairs that must be links for another one.
STAR_ROUNDS, YIELD = 4, 0.05
#: A pair at the threshold whose estimate is lower is as rare as one that shares no band.
LEAST_ESTIMATE = 0.15
#: Buckets of the table that orders shingles by how frequent they are, whatever the input: 2**18 numbers are broadcast.
ORDER_BITS = 18
#: Sets meet only if their sizes allow it: they are dealt by steps of this ratio.
SIZE_STEP = 1.12
#: Sets that share a prefix and meet in one task.
CROWD = 1024
_M = np.uint64(0xFF51AFD7ED558CCD)
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


class _WordHash(dict):
    """Word -> 64-bit hash; forgets everything before it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _M
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int, words: _WordHash) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. A text of fewer words is one shingle."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    if len(h) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
    n = len(h) - width + 1
    s = h[:n] * _MULT[0]
    for j in range(1, width):
        s = _mix64(s) + h[j : j + n] * _MULT[j % 8]
    return np.unique(_mix64(s))


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Least rank under pi of all places, for each of so many shifts."""
    place = (_mix64(shingles * _MULT[2]) >> np.uint64(32)).astype(np.uint32)  # sigma
    shift = np.arange(coordinates, dtype=np.uint32)[:, None]
    best = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(place), 1024):  # small enough to stay in the cache
        x = place[None, at : at + 1024] + shift
        for by, mult in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):  # pi, a bijection
            x ^= x >> np.uint32(by)
            x *= np.uint32(mult)
        x ^= x >> np.uint32(16)
        np.minimum(best, x.min(axis=1), out=best)
    return best


def _signed(bands: int, rows: int, width: int):
    def run(batches):
        words = _WordHash()
        powers = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(rows)], np.uint64)
        salt = np.arange(1, bands + 1, dtype=np.uint64) * _MULT[3]
        for batch in batches:
            sizes, digests, keys, sketches = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), width, words)
                sizes.append(len(s))
                if not len(s):
                    digests.append(None)
                    keys.append(None)
                    sketches.append(None)
                    continue
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig = signature(s, bands * rows)
                sketches.append(sig.astype(np.uint8).tobytes())
                sig = sig.astype(np.uint64).reshape(bands, rows)
                keys.append(_mix64(_mix64((_mix64(sig + np.uint64(1)) * powers).sum(axis=1, dtype=np.uint64)) + salt).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], ["doc_id", "n_shingles", "digest", "bands", "sketch"])

    return run


def _sets(width: int):
    def run(batches):
        words = _WordHash()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t.as_py(), width, words).tobytes() for t in batch.column(1)], pa.binary())], ["id", "shingles"])

    return run


def _likely(least: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            yield batch.filter(pa.array((x == y).mean(axis=1) >= least)).select([0, 1])

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def _places(shingles: np.ndarray) -> np.ndarray:
    return (_mix64(shingles * _MULT[4]) >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def _frequencies(batches):
    """Sets -> (place, n): how often shingles of each place of the order table occur."""
    total = np.zeros(1 << ORDER_BITS, np.int64)
    for batch in batches:
        for x in batch.column(0):
            total += np.bincount(_places(np.frombuffer(x.as_buffer(), np.uint64)), minlength=1 << ORDER_BITS)
    at = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["place", "n"])


def _steps(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(SIZE_STEP)).astype(np.int64)


def prefix_keys(shingles: np.ndarray, order: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, larger) of a set: what it must share with a similar one.

    Of a similar pair of sizes x <= y, the first common shingle stands at i in
    the smaller and at j in the larger, and all that is common stands from
    there on: both x - i and y - j are at least percent / (100 + percent) of
    x + y. So the smaller one shows its key up to an i, and the larger one, for
    each j, to the sizes that this leaves.
    """
    n = len(shingles)
    s = shingles[np.lexsort((shingles, order[_places(shingles)]))]
    token = _mix64(s * _MULT[5])
    key = lambda t, step: _mix64(t + step.astype(np.uint64) * _MULT[6])
    small = n - -(-2 * percent * n // (100 + percent)) + 1
    i = np.arange(small)
    keys, places, larger = [key(token[:small], np.full(small, _steps(np.array([n]))[0]))], [i], [np.zeros(small, bool)]
    least = -(-percent * n // 100)
    j = np.arange(n - least + 1)
    most = np.minimum(n, (n - j) * (100 + percent) // percent - n)
    j, most = j[most >= least], most[most >= least]
    first, last = int(_steps(np.array([least]))[0]), _steps(most) if len(most) else most
    for step in range(first, int(last.max(initial=first - 1)) + 1):
        own = j[last >= step]
        keys.append(key(token[own], np.full(len(own), step)))
        places.append(own)
        larger.append(np.ones(len(own), bool))
    return np.concatenate(keys), np.concatenate(places), np.concatenate(larger)


def _keyed(shared, percent: int):
    """(id, c, shingles) -> rows (key, larger, id, c, n, place)."""
    names = ["key", "larger", "id", "c", "n", "place"]

    def run(batches):
        for batch in batches:
            for i, c, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = np.frombuffer(x.as_buffer(), np.uint64)
                key, place, larger = prefix_keys(s, shared.value, percent)
                k = len(key)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(larger), pa.array(np.full(k, i)), pa.array(np.full(k, c)), pa.array(np.full(k, len(s)), pa.int32()), pa.array(place, pa.int32())], names)

    return run


def _prefix_pairs(opened: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b), a < b, of different components that may be similar enough; none that is gets lost.

    ``opened`` has id, c (component) and shingles.
    """
    counts = opened.select("shingles").mapInArrow(_frequencies, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    order = np.zeros(1 << ORDER_BITS, np.int64)
    order[counts["place"].to_numpy()] = counts["n"].to_numpy()
    shared = opened.sparkSession.sparkContext.broadcast(order)
    keyed = scratch.save(opened.select("id", "c", "shingles").mapInArrow(_keyed(shared, percent), "key long, larger boolean, id long, c long, n int, place int"))
    # keys of one component only say nothing; elsewhere the largest component's members need not meet each other
    top = keyed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("key").agg(F.max(F.struct("k", "c")).alias("top"), F.count(F.lit(1)).alias("m"), F.sum("k").alias("all")).where("m > 1")
    top = scratch.save(top.select("key", F.col("top.c").alias("most"), F.ceil(F.col("all") / F.lit(CROWD)).cast("int").alias("parts")))
    mixed = scratch.save(keyed.join(top, "key").withColumn("minor", F.expr("c != most")).drop("most"))
    # of a crowded key the larger sets are dealt to so many parts, and the smaller ones go to each
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    small = mixed.where("not larger").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *(F.col(x).alias(f"{x}_s") for x in ("id", "c", "n", "place", "minor")))
    large = mixed.where("larger").select("key", part.alias("part"), *(F.col(x).alias(f"{x}_l") for x in ("id", "c", "n", "place", "minor")))
    fits = f"""c_s != c_l AND n_s <= n_l AND 100L * n_s >= {percent}L * n_l
        AND {100 + percent}L * least(n_s - place_s, n_l - place_l) >= {percent}L * (n_s + n_l)"""
    met = small.where("minor_s").join(large, ["key", "part"]).where(fits).unionByName(small.where("not minor_s").join(large.where("minor_l"), ["key", "part"]).where(fits))
    pairs = scratch.save(met.select(F.least("id_s", "id_l").alias("a"), F.greatest("id_s", "id_l").alias("b")).distinct())
    scratch.drop(keyed, mixed, top)
    return pairs


def _grouped(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, digest) of all documents, and (digest, id, component_id) of the classes whose id is known."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = scratch or Scratch(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.save(texts.mapInArrow(_signed(bands, rows, width), "doc_id long, n_shingles long, digest binary, bands array<bigint>, sketch binary"))

    # one row per set: a copy has the same bands and sketch, any of them will do
    classes = signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).where("id is not null")
    classes = scratch.save(classes)
    banded = classes.select(F.explode("bands").alias("key"), "id", "n")
    # written: a table of its own, so that the join can be split where a key is hot
    hubs = banded.groupBy("key").agg(F.min(F.struct("id", "n")).alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1").select("key", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"))
    hubs = scratch.save(hubs)
    member = scratch.save(banded.join(hubs, "key").select("key", "id", "n", "hub", "hub_n"))
    fits = lambda x, y: F.expr(f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})")

    sets = links = labels = None
    pairs = scratch.save(member.where("id != hub").where(fits("n", "hub_n")).select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())
    done = pairs  # pairs already compared

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar enough."""
        sketch = lambda i: classes.select(F.col("id").alias(i), F.col("sketch").alias(f"s{i}"))
        likely = scratch.save(pairs.join(sketch("a"), "a").join(sketch("b"), "b").select("a", "b", "sa", "sb").mapInArrow(_likely(percent / 100 - LEAST_ESTIMATE), "a long, b long"))
        found = exact(likely)
        scratch.drop(likely)
        return found

    def exact(pairs: DataFrame) -> DataFrame:
        # only sets that take part are dealt out
        part = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        own = sets.join(part, "id", "left_semi")
        side = lambda i: own.select(F.col("id").alias(i), F.col("shingles").alias(f"s{i}"))
        return scratch.save(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a long, b long"))

    if not member.isEmpty():
        ids = member.select("id").distinct()
        sets = scratch.save(texts.join(ids, texts.doc_id == ids.id, "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_sets(width), "id long, shingles binary"))
        compared, links = pairs.count(), confirmed(pairs)
        found = links.count()
        for round_ in range(1, STAR_ROUNDS + 1):
            scratch.drop(labels)
            labels = connected_components(links, scratch, distinct=True)
            now = member.join(labels.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("c"))
            # buckets that still hold more than one component
            open_ = now.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("key")
            open_ = scratch.save(open_)
            now = scratch.save(now.join(open_, "key"))
            if round_ == STAR_ROUNDS or found <= YIELD * compared:
                break
            # the next hub: a class of the bucket's largest component, another one each round
            per = now.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"), F.min_by(F.struct("id", "n"), F.xxhash64("id", F.lit(round_))).alias("pick"))
            hub = per.groupBy("key").agg(F.max(F.struct("k", F.xxhash64("key", "c"), "c", "pick")).alias("top")).select("key", F.col("top.pick.id").alias("hub"), F.col("top.pick.n").alias("hub_n"), F.col("top.c").alias("hub_c"))
            hub = scratch.save(hub)
            more = now.join(hub, "key").where("c != hub_c").where(fits("n", "hub_n")).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
            more = scratch.save(more.join(done, ["a", "b"], "left_anti"))
            compared = more.count()
            if not compared:
                break
            fresh = confirmed(more)
            found = fresh.count()
            done = scratch.save(done.unionByName(more))
            links = scratch.save(links.unionByName(fresh))
            scratch.drop(more, fresh, now)
        # a class is of one component, so grouping by its id is enough, and the join needs no further exchange
        opened = scratch.save(sets.join(now.groupBy("id").agg(F.min("c").alias("c")), "id").select("id", "c", "shingles"))
        if not opened.isEmpty():
            rest = exact(_prefix_pairs(opened, percent, scratch))
            if not rest.isEmpty():
                labels = connected_components(links.unionByName(rest), scratch, distinct=True)
        scratch.drop(sets, opened, now, done, member, pairs)

    out = classes.select("digest", "id")
    if labels is not None:
        out = out.join(labels.withColumnRenamed("node", "id"), "id", "left").select("digest", "id", F.coalesce("component", "id").alias("component_id"))
    else:
        out = out.withColumn("component_id", F.col("id"))
    return signed.select("doc_id", "n_shingles", "digest"), out


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * shared >= percent * united shingles of
    ``width`` words; ``component_id`` is the smallest doc_id that links lead to.
    ``options`` are those of ``_grouped``.
    """
    signed, classes = _grouped(docs, **options)
    # each row finds its class by its set, and the class its component
    full = signed.join(classes.drop("id"), "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return full.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The documents whose doc_id names their group, with all their columns, each once.

    Rows without a doc_id cannot be named and stay as they are.
    """
    own = f"k{uuid.uuid4().hex}"  # a name that no input column has
    signed, classes = _grouped(docs, **options)
    # the least id of a group is that of one of its classes, so rows need not find their classes; without words a row is a group
    found = classes.where("id = component_id").select(F.col("id").alias(own)).unionByName(signed.where("digest is null and doc_id is not null").select(F.col("doc_id").alias(own))).distinct()
    one = docs.join(found, F.col("doc_id") == F.col(own), "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null"))
