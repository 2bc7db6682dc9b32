"""The registered queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.llm import bpe, langid, minhash, mixing, ordinal, pii, sharding, tiff, vptree, warc
from bibweave.sources.files import spread


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def vocabulary() -> bpe.Vocabulary:
    """The vocabulary that the queries encode with."""
    import public_tokenizers

    return bpe.Vocabulary(bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_read(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"), vocabulary())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    rated = _read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"))
    return ordinal.grade(docs, ordinal.fit(docs.join(F.broadcast(ordinal.sampled(rated)), "doc_id")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.schedule(_read(spark, sf_dir, "documents"))
    first = F.try_element_at("positions", F.lit(1))
    out = plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.round(first, 6).alias("position"), "h")
    return mixing.in_order(out, "position", "h").drop("h")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), width=4)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.identify(docs.select("doc_id", langid.held_out().alias("held_out"), "text"), model).drop("text")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def op8_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_round_trip(_read(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents"))


def op10_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def sharding_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of op9 without the checksum, which plain SQL lacks."""
    return sharding.shard(_read(spark, sf_dir, "documents")).drop("text_crc32", "grown_shard")


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the base rules of op1 find."""
    return pii.report(_read(spark, sf_dir, "documents")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def tiff_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes that op8 reads back, without the checksum, which plain SQL lacks."""
    return tiff.text_round_trip(_read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def vptree_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search of op10 with a factor of one, which leaves no neighbour out."""
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, vectors.where("vec_id % 50 = 0"), factor=1.0).withColumn("score", F.round("score", 6))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_pii, op2_bpe, op3_quality, op4_mixing, op5_minhash, op6_langid, op7_warc, op8_tiff, op9_sharding, op10_vptree)
    parts = (pii_base, tiff_bytes, sharding_layout, vptree_exact)
    return {f.__name__: f for f in (*own, *parts)} | {"pipeline": pipeline}


#: The mix in plain SQL: the same order (md5), the same running sums without cells.
_MIX_SQL = """
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null:' || coalesce(text, ''))) AS h
  FROM documents),
s AS (SELECT sk, sum(size)::BIGINT AS ss, row_number() OVER (ORDER BY sk) - 1 AS n FROM d GROUP BY sk),
w AS (SELECT *, [5, 2, 1][(n % 3 + 1)::INT] AS weight, ss * 2 AS cap FROM s),
c AS (SELECT *, coalesce(sum(cap) OVER b, 0)::DOUBLE AS capped,
             (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS open,
             (sum(ss) OVER ())::DOUBLE * 1.5 AS whole, row_number() OVER (ORDER BY cap::DOUBLE / weight, n) AS nth
      FROM w WINDOW b AS (ORDER BY cap::DOUBLE / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (whole - capped) / open AS level FROM c),
f AS (SELECT *, arg_min(level, nth) FILTER (WHERE level * weight <= cap) OVER () AS final FROM l),
t AS (SELECT sk, n, ss, least(cap::DOUBLE, coalesce(final, 'inf'::DOUBLE) * weight) AS target,
             [-0.5, 0.0, 0.5][(n % 3 + 1)::INT]::DOUBLE AS slope FROM f),
r AS (SELECT d.*, t.ss, t.target, t.slope,
             coalesce(sum(size) OVER (PARTITION BY d.sk ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + size / 2.0::DOUBLE AS middle
      FROM d JOIN t ON d.sk = t.sk),
u AS (SELECT *, CASE WHEN size > 0 AND middle < target THEN middle / target END AS u FROM r)
SELECT doc_id, size, ss AS source_size, target,
       CASE WHEN size > 0 THEN size * ((middle < target)::BIGINT + (middle + ss < target)::BIGINT) ELSE 0 END::BIGINT AS taken,
       round(CASE WHEN slope = 0 THEN u ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * u) - (1 - slope)) / (2 * slope) END, 6) AS position
FROM u
"""


#: All pairs that share a shingle, compared in full; then what each document reaches.
_NEAR_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(t[i:i + 3], ' ')) AS h FROM (SELECT doc_id, t, unnest(range(1, greatest(2, len(t) - 2))) AS i FROM w WHERE len(t) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS MATERIALIZED (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS rep FROM (SELECT doc_id, md5(string_agg(h::VARCHAR, ',' ORDER BY h)) AS k FROM s GROUP BY doc_id)),
r AS MATERIALIZED (SELECT s.doc_id, h FROM s JOIN sets ON s.doc_id = sets.doc_id AND rep = s.doc_id),
e AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM r x JOIN r y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
f AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT rep, doc_id FROM sets UNION SELECT doc_id, rep FROM sets),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT id, b FROM reach JOIN f ON other = a),
g AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN g ON g.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, CASE WHEN n >= 1000 THEN nullif(max(page_id) OVER (PARTITION BY d, n), page_id) END AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN top IS NULL THEN 'response' ELSE 'revisit' END AS record_type, top AS refers_to FROM g
"""

_SHARD_SQL = """
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk, strlen(coalesce(text, '')) + 1 AS size,
                  md5('17:' || coalesce(doc_id::VARCHAR, 'null:' || coalesce(text, ''))) AS h, md5(coalesce(text, '')) AS tie FROM documents),
i AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY h, tie) - 1 AS i, count(*) OVER (PARTITION BY sk) AS n FROM d),
a AS (SELECT *, least((i::HUGEINT * 281474976710656 + ('0x' || substr(md5('17/' || sk), 1, 12))::BIGINT) // n, 281474976710655) AS place FROM i),
r AS (SELECT *, row_number() OVER (ORDER BY place, sk, h, tie) - 1 AS rank, count(*) OVER () AS whole FROM a),
s AS (SELECT *, rank * 8 // whole AS shard FROM r)
SELECT doc_id, size::BIGINT AS size, 'rows' AS law, shard::INT AS shard, (rank - (shard * whole + 7) // 8)::BIGINT AS slot FROM s
"""

_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse({_DIGITS}), i, 1)::INT WHEN substr(reverse({_DIGITS}), i, 1)::INT > 4 THEN substr(reverse({_DIGITS}), i, 1)::INT * 2 - 9 ELSE substr(reverse({_DIGITS}), i, 1)::INT * 2 END)) % 10 = 0"
_PII_PATTERNS = {"email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", "ip": "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)", "card": "[0-9]([\\x20-]?[0-9])+", "phone": "\\+[0-9][\\x20().0-9-]+[0-9]"}
#: A match begins after all that splitting leaves before it, and after the matches before it.
_PII_SQL = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS x FROM documents),
m AS ({" UNION ALL ".join(f"SELECT r, '{k}' AS kind, {i} AS nth, regexp_extract_all(x, '{p}') AS m, regexp_split_to_array(x, '{p}') AS p FROM t WHERE regexp_matches(x, '{p}')" for i, (k, p) in enumerate(_PII_PATTERNS.items()))}),
e AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM m),
s AS (SELECT r, kind, nth, m[i] AS v, list_sum(list_transform(p[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS a FROM e),
g AS (SELECT * FROM s WHERE CASE kind WHEN 'email' THEN true WHEN 'ip' THEN list_max(list_transform(string_split(v, '.'), lambda y: CASE WHEN length(ltrim(y, '0')) > 3 THEN 999 ELSE y::BIGINT END)) <= 255
  WHEN 'card' THEN length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN} ELSE length({_DIGITS}) BETWEEN 9 AND 15 END),
n AS (SELECT r, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in _PII_PATTERNS)}, string_agg(kind || ':' || a::BIGINT || ':' || (a + length(v))::BIGINT, ',' ORDER BY nth, a) AS found FROM g GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in _PII_PATTERNS)}, sha256(coalesce(found, '')) AS base_sha256 FROM t LEFT JOIN n USING (r)
"""

_TIFF_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, strlen(coalesce(text, '')) AS n FROM documents), p AS (SELECT *, greatest(192, (n + 191) // 192 * 192) AS whole FROM d)
SELECT doc_id, n::BIGINT AS n_bytes, whole::BIGINT AS payload_bytes, sha256(x || repeat(' ', whole - n)) AS payload_sha256 FROM p
"""

_NEAREST_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS s FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS n FROM s)
SELECT query_id, n::INT AS rank, vec_id, round(s, 6) AS score FROM r WHERE n <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"pii_base": _PII_SQL, "tiff_bytes": _TIFF_SQL, "vptree_exact": _NEAREST_SQL, "sharding_layout": _SHARD_SQL, "op4_mixing": _MIX_SQL, "op5_minhash": _NEAR_SQL, "op7_warc": _WARC_SQL}
