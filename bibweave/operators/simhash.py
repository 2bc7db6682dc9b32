"""Simhash fingerprints of short texts, and links between those that differ in few bits.

A text is lower-cased, freed of all but letters, numerals and underscores, and
cut into runs of three characters (one at least); each bit of the fingerprint is
the majority of that bit over the hashes of its runs, repeats counted.

Fingerprints that differ in at most 3 of 64 bits agree on at least 3 of 6
blocks: each of the 20 choices of 3 blocks is a key of about 32 bits, so that
buckets stay small however many texts there are.  Equal fingerprints form a class
first; classes are linked, members are not expanded.

Defined cases: a null text has no fingerprint and takes no part; an empty one has
that of the empty run.
"""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from bibweave.scratch import Scratch, small_batches

WIDTH, BITS_APART, BLOCKS = 3, 3, 6
#: Classes of one key that meet all others of it in one task.
CROWD = 2048
_NOT_WORD = re.compile(r"[^\w]+")


def features(text: str, width: int = WIDTH) -> list[str]:
    s = _NOT_WORD.sub("", text.lower())
    return [s[i : i + width] for i in range(max(len(s) - width + 1, 1))]


def _hash(feature: str) -> int:
    return int.from_bytes(hashlib.md5(feature.encode("utf-8", "surrogatepass")).digest()[-8:], "big")


def _counted(text: str) -> tuple[list[int], np.ndarray]:
    """Distinct runs of three characters, packed into whole numbers, and how often each occurs; a shorter text is one run."""
    c = np.frombuffer(_NOT_WORD.sub("", text.lower()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    c = np.concatenate([c, np.zeros(max(0, WIDTH - len(c)), np.int64)])
    runs, times = np.unique((c[:-2] << 42) | (c[1:-1] << 21) | c[2:], return_counts=True)
    return runs.tolist(), times


def _unpacked(run: int) -> str:
    return "".join(chr(x - 1) for x in (run >> 42, (run >> 21) & 0x1FFFFF, run & 0x1FFFFF) if x)


def fingerprint(text: str, known: dict[int, int] | None = None) -> int:
    """Unsigned 64 bits. ``known`` keeps hashes from text to text and forgets them before it grows large."""
    known = {} if known is None else known
    if len(known) > 200_000:
        known.clear()
    runs, times = _counted(text)
    for run in runs:
        if run not in known:
            known[run] = _hash(_unpacked(run))
    bits = np.unpackbits(np.array([known[r] for r in runs], ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * (times @ bits) > times.sum()).tobytes(), "big")


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    known: dict[int, int] = {}
    out = [None if t is None else int(np.uint64(fingerprint(t, known)).astype(np.int64)) for t in texts]
    return pd.Series(out, dtype="Int64")


def _keys(print_: Column) -> Column:
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    blocks = [F.shiftrightunsigned(print_, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)) for i in range(BLOCKS)]
    picked = combinations(range(BLOCKS), BLOCKS - BITS_APART)
    return F.array(*(F.struct(F.lit(n).alias("pick"), F.xxhash64(*(blocks[i] for i in p)).alias("value")) for n, p in enumerate(picked)))


def near_duplicates(df: DataFrame, id_: str, text: str, shard: str | None = None, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, links): (id, fingerprint class) of each row, and (class1, class2, distance) of linked classes.

    With ``shard`` only texts of one shard (such as a year) are compared.
    Fingerprints are written, so each text is read once, and so are the classes that share a key with others.
    """
    scratch = scratch or Scratch(df.sparkSession)
    small_batches(df.sparkSession)
    part = F.lit("") if shard is None else F.coalesce(F.col(shard).cast("string"), F.lit(""))
    members = scratch.save(df.where(F.col(text).isNotNull()).select(F.col(id_).alias("id"), part.alias("shard"), _fingerprints(F.col(text)).alias("simhash")))
    keyed = members.select("shard", "simhash").distinct().select("shard", "simhash", F.explode(_keys(F.col("simhash"))).alias("k"))
    a = keyed.select("shard", F.col("k.pick").alias("pick"), F.col("k.value").alias("value"), F.col("simhash").alias("class1"))
    keys = ["shard", "pick", "value"]
    # keys of one class say nothing; of a crowded one the classes are dealt to parts, each of which meets all
    crowd = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys, F.ceil(F.col("n") / F.lit(CROWD)).cast("int").alias("parts"))
    shared = scratch.save(a.join(crowd, keys))
    a = shared.select(*keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "class1")
    b = shared.select(*keys, F.pmod(F.xxhash64("class1"), F.col("parts")).cast("int").alias("part"), F.col("class1").alias("class2"))
    apart = F.bit_count(F.col("class1").bitwiseXOR(F.col("class2")))
    links = a.join(b, [*keys, "part"]).where("class1 < class2").where(apart <= BITS_APART).select("shard", "class1", "class2", apart.cast("int").alias("distance")).distinct()
    return members, links


def linked(df: DataFrame, id_: str, text: str, shard: str | None = None) -> DataFrame:
    """One row per text: id, simhash, copies (with the same fingerprint, itself included), links (other classes)."""
    members, links = near_duplicates(df, id_, text, shard)
    many = links.select("shard", F.explode(F.array("class1", "class2")).alias("simhash")).groupBy("shard", "simhash").agg(F.count(F.lit(1)).alias("links"))
    copies = members.groupBy("shard", "simhash").agg(F.count(F.lit(1)).alias("copies"))
    out = members.join(copies, ["shard", "simhash"]).join(many, ["shard", "simhash"], "left")
    return out.select("id", "simhash", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
