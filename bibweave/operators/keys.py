"""Match keys: which are usable, and the rules that pair them."""

from __future__ import annotations

from functools import reduce
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.scratch import Scratch

#: A match takes one strong key and one other; the year and the names are weak.
STRONG = ("title_norm", "abstract_norm", "clean_doi", "references")
WEAK = ("year", "last_names_norm")
#: Each unordered pair once: of two strong keys, either order asks for the same.
RULES = tuple(combinations(STRONG, 2)) + tuple(product(STRONG, WEAK))
#: Keys with more ids than this say nothing; references are kept however frequent.
FILTERED = ("title_norm", "abstract_norm", "clean_doi")
MOST_IDS = 10
#: Frequent keys, of some fifty bytes each, that may be broadcast.
FEW = 200_000
#: A list of references is a key from so many items on.
LEAST_REFERENCES = 3


def usable(key: str, *, listed: bool = True) -> Column:
    """Not null, not empty, and for references (if ``listed``) long enough."""
    c = F.col(key)
    ok = c.isNotNull()
    if key != "year":
        ok = ok & (c != "")
    if key == "references" and listed:
        ok = ok & (F.size(F.split(c, ",")) >= LEAST_REFERENCES)
    return ok


def _hash(key: str) -> Column:
    return F.md5(F.col(key).cast("string").cast("binary"))


def hashed_keys(df: DataFrame, keys: tuple[str, ...] = (*STRONG, *WEAK), *, listed: bool = True, id_: str = "id", also: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns ``also`` and, for each key, the hash of its value, null where the value is not usable: what a row needs to be matched."""
    return df.select(F.col(id_).alias("id"), *also, *(F.when(usable(k, listed=listed), _hash(k)).alias(k) for k in keys))


def _exploded(df: DataFrame, keys: tuple[str, ...], id_: str, hashed: bool) -> DataFrame:
    """(_id, which, key) of each key that is not null. Nulls go after the explosion: a filter of arrays would not be compiled, nor what is in them."""
    own = F.array(*(F.when(F.col(k).isNotNull(), F.struct(F.lit(i).alias("which"), (F.col(k) if hashed else _hash(k)).alias("key"))) for i, k in enumerate(keys)))
    return df.select(F.col(id_).alias("_id"), F.explode(own).alias("k")).where("k is not null").select("_id", "k.which", "k.key")


def frequent(df: DataFrame, keys: tuple[str, ...] = FILTERED, most: int = MOST_IDS, id_: str = "id", *, hashed: bool = False) -> DataFrame:
    """(which, key): hashes of the keys that more than ``most`` distinct ids share, all keys counted in one exchange.

    Distinct (key, id) pairs are counted in two steps, so a key that a third of
    all rows share is spread over all tasks first.
    """
    rows = _exploded(df, keys, id_, hashed).distinct()
    return rows.groupBy("which", "key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("which", "key")


def drop_frequent(df: DataFrame, keys: tuple[str, ...] = FILTERED, most: int = MOST_IDS, id_: str = "id", *, hashed: bool = False, scratch: Scratch | None = None, few: int = FEW) -> DataFrame:
    """Nulls keys that more than ``most`` distinct ids share; all rows stay.

    Up to ``few`` frequent keys are broadcast, so rows stay where they are. More
    are joined with the hashes of the rows alone, and what is found goes back
    to the rows by id: whole rows are shuffled once, however many keys there are.
    """
    often = (scratch or Scratch(df.sparkSession)).save(frequent(df, keys, most, id_, hashed=hashed))
    value = lambda k: F.col(k) if hashed else _hash(k)
    if often.count() <= few:
        out = df
        for i, k in enumerate(keys):
            out = out.withColumn("_key", value(k)).join(F.broadcast(often.where(F.col("which") == i).select(F.col("key").alias("_key"), F.lit(True).alias("_often"))), "_key", "left")
            out = out.withColumn(k, F.when(F.col("_often").isNull(), F.col(k))).drop("_key", "_often")
        return out.select(*df.columns)
    rows = _exploded(df, keys, id_, hashed).distinct()
    # of each id the frequent keys that its rows have
    held = rows.join(often, ["which", "key"]).groupBy("_id").agg(F.collect_set(F.struct("which", "key")).alias("_held"))
    out = df.withColumn("_id", F.col(id_)).join(held, "_id", "left")
    nulled = {k: F.when(~F.coalesce(F.array_contains("_held", F.struct(F.lit(i).alias("which"), value(k).alias("key"))), F.lit(False)), F.col(k)) for i, k in enumerate(keys)}
    return out.withColumns(nulled).select(*df.columns)


def stacked(df: DataFrame, rules: tuple[tuple[str, ...], ...] = RULES, *, listed: bool = True, id_: str = "id", hashed: bool = False, distinct: bool = True) -> DataFrame:
    """Distinct rows (rule, key, id) of all rules: ``key`` stands for the values of the rule's keys.

    One exchange serves all rules, and long texts cross it as 16 bytes. ``hashed``: ``df`` comes from ``hashed_keys``.
    Without ``distinct`` an id with several rows can have a key several times, and there is no exchange.
    """
    wanted = tuple(sorted({k for r in rules for k in r}))
    rows = df if hashed else hashed_keys(df, wanted, listed=listed, id_=id_)
    each = [F.when(reduce(Column.__and__, (F.col(k).isNotNull() for k in r)), F.struct(F.lit(i).alias("rule"), F.md5(F.concat(*(F.col(k) for k in r)).cast("binary")).alias("key"))) for i, r in enumerate(rules)]
    out = rows.select("id", F.explode(F.array(*each)).alias("k")).where("k is not null").select("k.rule", "k.key", "id")
    return out.distinct() if distinct else out
