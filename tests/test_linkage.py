"""Catalogues, keys, matches, groups, merged ids, gates, publishing, samples."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from bibweave import schemas
from bibweave.operators import checks, identity, match, sampling, simhash
from bibweave.operators.keys import RULES, STRONG, WEAK, drop_frequent, hashed_keys, stacked
from bibweave.plans import linkage
from bibweave.scratch import Scratch
from bibweave.sources import catalogues as C
from bibweave.sources import files

PAIRS = "id1 string, id2 string"


def pairs(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], PAIRS)


def groups(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.root, set()).add(r.orig_id)
    assert all(min(v) == k for k, v in out.items())
    return sorted(map(sorted, out.values()))


# Catalogues


def test_allowed_kinds(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["Review"]), (4, ["Review", "JournalArticle"]), (5, [None, "News"])], "corpusid long, publicationtypes array<string>")
    assert sorted(r.id for r in C.s2_ids(df).collect()) == ["1", "2", "4", "5"]
    works = spark.createDataFrame([("a", None), ("b", "letter"), ("c", "article"), ("c", "article")], "id string, type string")
    assert sorted(r.id for r in C.openalex_ids(works).collect()) == ["a", "c"]


def test_reference_lists(spark):
    row = spark.createDataFrame([([10, 9], ["b", None, "a"], None)], "n array<int>, s array<string>, e array<string>").select(C.sorted_list(F.col("n")).alias("n"), C.sorted_list(F.col("s")).alias("s"), C.sorted_list(F.col("e")).alias("e")).first()
    assert row.n == "9,10" and row.s == "a,b" and row.e == ""


def test_lens_rows(spark):
    schema = "lens_id string, title string, abstract string, year_published int, publication_type string, external_ids array<struct<type:string,value:string>>, authors array<struct<last_name:string>>, references array<struct<lens_id:string>>, alias_lens_ids array<string>"
    rows = [("L1", "t", "a", 2000, None, [("doi", "X"), ("doi", "Y"), ("openalex", "W1")], [(None,), ("Li",)], [("L3",), ("L2",)], ["L9"]), ("L2", "t", "a", 2000, "news", None, None, None, None), ("L3", "t", None, None, "article", [], [], [], [])]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.id, r.clean_doi, r.last_names, r.references) for r in C.lens_metadata(df).collect())
    assert got == [("L1", "x", ["Li"], "L2,L3"), ("L1", "y", ["Li"], "L2,L3"), ("L3", None, None, None)]
    links = {(r.id1, r.id2) for r in C.lens_links(df, C.lens_ids(df)).collect()}
    assert links == {("L1", "https://openalex.org/W1"), ("https://openalex.org/W1", "L1"), ("L1", "L9"), ("L9", "L1")}


def test_remapped_rows(spark):
    meta = spark.createDataFrame([("a", "r1,r2"), ("b", "r1,r3"), ("c", "r1,r9"), ("d", None), ("e", "")], "id string, references string")
    for c in C.COLUMNS:
        if c not in meta.columns:
            meta = meta.withColumn(c, F.lit(None).cast("array<string>" if c == "last_names" else "bigint" if c == "year" else "string"))
    known = spark.createDataFrame([("r1", "m2"), ("r2", "m1"), ("r3", "m2")], "orig_id string, merged_id string")
    got = sorted((r.id, str(r.references)) for r in C.union_metadata(known, meta).collect())
    assert got == [("a", "m1,m2"), ("a", "r1,r2"), ("b", "r1,r3"), ("c", "r1,r9"), ("d", "None"), ("e", "")]


def test_arxiv_ids_of_urls(spark):
    urls = {"https://arxiv.org/pdf/2101.00001v2.pdf": "2101.00001v2", "http://arxiv.org/abs/math/0101": "math/0101", "x/ftp/arxiv/papers/21/2101.1.pdf": "21/2101.1", "plain": "plain"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.i for r in df.select(C.arxiv_id_of(F.col("u")).alias("i")).collect()] == list(urls.values())


# Keys and matches


def some_articles(spark, seed=3, n=60):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        pick = lambda *x: r.choice(x)
        rows.append((f"i{r.randint(0, n)}", pick(None, "", *"abc"), pick(None, "", *"de"), pick(None, "", "10.1", "10.2", "10.3"), pick(None, 2000, 2001), pick(None, "", "li", "ng"), pick(None, "", "1,2", "1,2,3", "4,5,6")))
    return spark.createDataFrame(rows, "id string, title_norm string, abstract_norm string, clean_doi string, year bigint, last_names_norm string, references string")


def plain_pairs(rows):
    """Twenty rules, each over all ordered pairs."""
    def ok(k, v):
        return v is not None and v != "" and (k != "references" or len(v.split(",")) > 2)

    out = set()
    for s, o in [(s, o) for s in STRONG for o in (*STRONG, *WEAK) if s != o]:
        for a, b in itertools.product(rows, rows):
            if a[s] == b[s] and a[o] == b[o] and ok(s, a[s]) and ok(o, a[o]):
                out.add((a["id"], b["id"]))
    return out


def test_rules():
    assert len(RULES) == 14 and len(set(RULES)) == 14


@pytest.mark.parametrize("seed", [1, 2])
def test_metadata_match(spark, seed):
    df = some_articles(spark, seed)
    expected = plain_pairs(df.collect())
    assert {tuple(r) for r in match.metadata_match(df).collect()} == expected
    one = set()
    for s, o in RULES:
        got = match.match(df, s, o).collect()
        one |= {tuple(r) for r in got}
    assert one == expected


def test_frequent_keys_go(spark):
    rows = [(f"i{i}", "many", "x" if i < 10 else "y", None) for i in range(11)] + [("i0", "many", "x", None)]
    df = spark.createDataFrame(rows, "id string, title_norm string, clean_doi string, abstract_norm string")
    got = drop_frequent(df).collect()
    assert len(got) == 12 and {r.title_norm for r in got} == {None} and {r.clean_doi for r in got} == {"x", "y"}


def test_star_edges_group_as_all_pairs_do(spark):
    """Also where pairs are unlinked, with groups in which each member is."""
    r = random.Random(9)
    keys, unlinked = [], []
    for g in range(60):
        ids = [f"g{g}n{i}" for i in range(r.randint(1, 5))]
        keys += [(0, f"k{g}", i) for i in ids]
        for a, b in itertools.combinations(ids, 2):
            if r.random() < 0.6:
                unlinked.append((a, b))
    keys += [(1, f"x{g}", f"g{g}n{0}") for g in range(0, 60, 2)] + [(1, f"x{g}", f"g{g + 1}n0") for g in range(0, 60, 2)]
    k, u = spark.createDataFrame(keys, "rule int, key string, id string"), pairs(spark, *unlinked)
    alone = spark.createDataFrame([(i, i) for i in {x[2] for x in keys}], PAIRS)
    every = k.alias("a").join(k.alias("b"), ["rule", "key"]).select(F.col("a.id").alias("id1"), F.col("b.id").alias("id2"))
    stars = match.group_edges(k, identity.symmetric(u))
    assert groups(identity.match_groups(stars.unionByName(alone))) == groups(identity.match_groups(every, u))


def test_pairs_of_ids_on_their_own(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    got = match.all_match_pairs(df, pairs(spark, "ab", "ba"), spark.createDataFrame([("c", "z"), ("z", "c"), (None, "q")], PAIRS))
    assert {tuple(r) for r in got.where("id1 is not null").collect()} == {("a", "b"), ("b", "a"), ("c", "z"), ("z", "c"), ("d", "d")}


# Groups and ids


@pytest.mark.parametrize(
    ("edges", "expected"),
    [
        (["AB", "BC"], ["ABC"]), (["AB", "AD", "CD", "BC"], ["ABCD"]), (["AB", "BC", "DE", "EA"], ["ABCDE"]),
        (["AB", "BC", "DE", "EA", "FG", "FH", "CH"], ["ABCDEFGH"]), (["AB", "BC", "DE", "EA", "FG", "FH"], ["ABCDE", "FGH"]),
    ],
)
def test_components(spark, edges, expected):
    assert groups(identity.match_groups(pairs(spark, *edges))) == [list(x) for x in expected]


def test_unlinked_edges(spark):
    both = ["AB", "BA", "BC", "CB", "DE", "ED"]
    assert groups(identity.match_groups(pairs(spark, *both), pairs(spark, "BC", "DE"))) == [["A", "B"], ["C"], ["D"], ["E"]]
    clique = ["AB", "BC", "AC"]
    assert groups(identity.match_groups(pairs(spark, *clique), pairs(spark, "AB"))) == [["A", "B", "C"]]


@pytest.mark.parametrize("small", [0, 40])
def test_components_by_rounds(spark, small):
    """The rounds that large graphs take, to the end and handing over to one task."""
    from bibweave.operators.components import connected_components

    r = random.Random(1)
    edges = [(f"{a:03d}", f"{min(a + r.choice((1, 1, 7)), 299):03d}") for a in range(0, 300) if r.random() < 0.8]
    up = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(up[a], up[b])
            changed |= up[a] != m or up[b] != m
            up[a] = up[b] = m
    assert {x.node: x.component for x in connected_components(pairs(spark, *edges), small=small).collect()} == up


def test_long_chain(spark):
    n = 300
    order = [f"{(i * 7919) % 1000:04d}" for i in range(n)]
    assert groups(identity.match_groups(pairs(spark, *zip(order, order[1:])))) == [sorted(order)]


def mapping(spark, *sets):
    return spark.createDataFrame([(f"carticle_{n:010d}", i) for n, ids in sets for i in ids], "merged_id string, orig_id string")


def test_stable_ids(spark):
    previous = mapping(spark, (1, "ABF"), (2, "DE"), (3, "IJ"), (4, "KL"), (5, "MN"))
    sets = ["ABC", "DEF", "GH", "I", "J", "KL", "MNO"]
    rows = [(s[0], i) for s in sets for i in s]
    dropped = spark.createDataFrame([("carticle_0000000003",)], "merged_id string")
    got = identity.assign_ids(spark.createDataFrame(rows, "root string, orig_id string"), previous, dropped).collect()
    by = {}
    for r in got:
        by.setdefault(r.orig_id, set()).add(int(r.merged_id.removeprefix("carticle_")))
    want = {"A": 6, "B": 6, "C": 6, "D": 7, "E": 7, "G": 8, "H": 8, "I": 9, "J": 10, "K": 4, "L": 4, "M": 5, "N": 5, "O": 5}
    assert {k: v for k, v in by.items() if k != "F"} == {k: {v} for k, v in want.items()} and by["F"] == {7}


def test_ids_edge_cases(spark):
    empty = spark.createDataFrame([], "root string, orig_id string")
    assert identity.assign_ids(empty).count() == 0
    one = spark.createDataFrame([("A", "A")], "root string, orig_id string")
    assert identity.assign_ids(one).first().merged_id == "carticle_0000000001"
    assert identity.assign_ids(one, highest=41, prefix="m").first().merged_id == "m0000000042"
    assert one.select(identity.written(F.lit(12345678901), "m").alias("x")).first().x == "m12345678901"
    with pytest.raises(ValueError):
        identity.assign_ids(one, mapping(spark, (1, "A"), (2, "A")))


def test_ids_against_plain_rule(spark):
    r = random.Random(6)
    ids = [f"{i:03d}" for i in range(200)]
    root, prior = {}, {}
    for i in ids:
        root[i] = ids[r.randint(0, int(i)) // 4 * 4]
        if r.random() < 0.8:
            prior[i] = int(i) // 3 + 1
    root = {i: min(j for j in ids if root[j] == root[i]) for i in ids}
    dropped = set(r.sample(range(1, 67), 8))
    members = {}
    for i in ids:
        members.setdefault(root[i], set()).add(i)
    want, n = {}, max(prior.values())
    for k in sorted(members):
        held = {prior[i] for i in members[k] if i in prior}
        keep = len(held) == 1 and not held & dropped and not {i for i, p in prior.items() if p in held} - members[k]
        if not keep:
            n += 1
        for i in members[k]:
            want[i] = held.copy().pop() if keep else n
    g = spark.createDataFrame([(root[i], i) for i in ids], "root string, orig_id string")
    p = spark.createDataFrame([(f"carticle_{v:010d}", k) for k, v in prior.items()], "merged_id string, orig_id string")
    d = spark.createDataFrame([(f"carticle_{x:010d}",) for x in dropped], "merged_id string")
    assert {x.orig_id: int(x.merged_id[9:]) for x in identity.assign_ids(g, p, d).collect()} == want


def test_unlink_pairs(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "d"), ("2", "e"), ("3", "f"), ("3", "f")], "manual_id string, orig_id string")
    got = [tuple(r) for r in identity.unlink_pairs(df).collect()]
    assert len(got) == 16 == len(set(got)) and {(b, a) for a, b in got} == set(got) and ("a", "b") not in got
    for block in (1, 2, 3):
        assert sorted(tuple(r) for r in identity.unlink_pairs(df, block_rows=block).collect()) == sorted(got)
    assert identity.unlink_pairs(df.where("false")).count() == 0


def test_unlink_pairs_are_dealt_to_many_tasks(spark):
    """Some KB of names make many pairs: Spark would put them into one task."""
    df = spark.range(3000).selectExpr("cast(id % 3 as string) AS manual_id", "cast(id as string) AS orig_id")
    per = identity.unlink_pairs(df).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per) == 6_000_000 and max(r["count"] for r in per) < 1_500_000


def test_numbered_rows_follow_the_order_of_writing(spark, tmp_path):
    rows = spark.range(500).select(((F.col("id") * 7919) % 500).alias("v"), F.lit(3).alias("n"), F.lit("x").alias("n_0"))
    rows.repartitionByRange(12, "v").sortWithinPartitions("v").write.option("maxRecordsPerFile", 17).parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = files.numbered_rows(table, "at").collect()
    assert all(r["at"] == r.v for r in got) and len(got) == 500
    again = files.numbered_rows(table, "n")
    assert again.columns == ["v", "n_0", "n"] and all(r.n == r.v for r in again.collect())
    # not a plain read: written first
    assert sorted(r["at"] for r in files.numbered_rows(rows.repartition(5), "at").collect()) == list(range(500))
    assert files.numbered_rows(table.where("false").groupBy("v").count(), "at").count() == 0


def test_frequent_keys_beyond_the_broadcast(spark):
    rows = [(f"i{i}", f"t{i % 3}" if i < 40 else f"u{i}", None if i % 5 else "x", "d" if i < 9 else "") for i in range(60)]
    df = spark.createDataFrame([*rows, ("i1", "other", "y", None), ("i1", "t1", "y", None)], "id string, title_norm string, abstract_norm string, clean_doi string")
    small, large = drop_frequent(df), drop_frequent(df, few=0)
    assert small.columns == large.columns == df.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    got = {(r.id, r.title_norm) for r in small.collect()}
    assert ("i0", None) in got and ("i50", "u50") in got and ("i1", "other") in got
    slim = hashed_keys(df.withColumns({"references": F.lit("a,b,c"), "year": F.lit(1), "last_names_norm": F.lit("n")}))
    assert sorted(map(str, stacked(drop_frequent(slim, hashed=True), hashed=True).collect())) == sorted(map(str, stacked(drop_frequent(df.withColumns({"references": F.lit("a,b,c"), "year": F.lit(1), "last_names_norm": F.lit("n")}))).collect()))


def test_marks_and_literals(spark, tmp_path):
    at = f"{tmp_path}/a/DONE"
    with pytest.raises(TimeoutError):
        files.wait_for(spark, at, 0.1, 0.05)
    files.mark(spark, at)
    files.wait_for(spark, at, 0)
    files.unmark(spark, at)
    assert not files.exists(spark, at)
    (tmp_path / "rows").write_text("{'id': 'a\\'b', 'year': 3, 'ok': True, 'none': None}\n{\"id\": 'c'}\nnot a row\n")
    got = files.read_literals(spark, str(tmp_path / "rows"), "id string, year int, ok boolean, none string").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a'b", 3, True, None), ("c", None, None, None), (None, None, None, None)], key=str)


def test_small_tables_are_dealt_large_ones_stay(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert files.spread(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert files.spread(table, small=0) is table


def test_no_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace

    from bibweave.scratch import LOCAL_DEFAULT, shared_dir

    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default), sparkContext=SimpleNamespace(master=master))

    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            shared_dir(session(master))
        assert shared_dir(session(master, "hdfs://a/b/")) == "hdfs://a/b"
    assert shared_dir(session("local[8]")) == shared_dir(session("local")) == LOCAL_DEFAULT


def test_scratch_leaves_nothing_behind(spark):
    with_bucket = Scratch(spark)
    got = with_bucket.save_by(spark.range(100), "id", 4)
    assert got.groupBy("id").count().count() == 100 and not spark.catalog.listTables()
    with_bucket.close()
    assert not files.exists(spark, with_bucket.root)


def test_references(spark):
    meta = spark.createDataFrame([("a", "b,c,z"), ("b", "a"), ("c", None)], "id string, references string")
    known = spark.createDataFrame([("m1", "a", "x"), ("m1", "b", "x"), ("m2", "c", "x")], "merged_id string, orig_id string, dataset string")
    assert {tuple(r) for r in identity.references(meta, known).collect()} == {("m1", "m1"), ("m1", "m2")}


# A whole run, twice


def catalogue(spark, rows):
    return spark.createDataFrame(rows, schemas.METADATA)


def test_two_runs_and_publishing(spark, tmp_path):
    rows = [
        ("a1", "A title", "an abstract", "10/x", 2000, ["A Li"], None, "arxiv"), ("b1", "a Title!", "An abstract.", "10/x", 2000, ["li"], "a1,c1,d1", "s2"),
        ("c1", "Other", None, None, 2001, ["Ng"], "a1", "s2"), ("d1", "other", "text", None, 2001, None, None, "lens"), ("e1", None, None, None, None, None, None, "lens"),
    ]
    links = (pairs(spark, ("e1", "ghost"), ("ghost", "e1")),)
    root = f"file://{tmp_path}/store"
    first = linkage.link(spark, catalogue(spark, rows), links=links)
    same = lambda run: sorted(sorted(x) for x in _by(run).values())
    assert same(first) == [["a1", "b1"], ["c1", "d1"], ["e1"]]
    assert {tuple(r) for r in first.references.collect()} == {("carticle_0000000001", "carticle_0000000001"), ("carticle_0000000001", "carticle_0000000002"), ("carticle_0000000002", "carticle_0000000001")}
    assert all(r.passed for r in first.checks.collect())
    linkage.publish(spark, first, root, "2024-01-31")
    old = spark.read.parquet(f"{root}/production/sources")
    assert spark.read.parquet(f"{root}/backups/sources_20240131").count() == 5
    assert old.schema[0].metadata["table_comment"] == schemas.DESCRIPTIONS["sources"]
    again = linkage.link(spark, catalogue(spark, rows), links=links, previous=old)
    assert sorted(map(str, again.sources.collect())) == sorted(map(str, first.sources.collect()))
    apart = linkage.link(spark, catalogue(spark, rows), links=links, previous=old, unlink=spark.createDataFrame([("c1", "d1")], PAIRS))
    by = _by(apart)
    assert by["carticle_0000000001"] == {"a1", "b1"} and "carticle_0000000002" not in by and len(by) == 4
    assert all(r.passed for r in apart.checks.collect())
    few = linkage.link(spark, catalogue(spark, rows[:2]), previous=old)
    with pytest.raises(checks.GateError, match="not_shrunk_sources"):
        linkage.publish(spark, few, root, "2024-02-29")
    assert spark.read.parquet(f"{root}/production/sources").count() == 5


def _by(run):
    out = {}
    for r in run.sources.collect():
        out.setdefault(r.merged_id, set()).add(r.orig_id)
    return out


def test_phantoms_bridge(spark):
    rows = [("a", None, None, None, None, None, None, "lens"), ("b", None, None, None, None, None, None, "lens")]
    run = linkage.link(spark, catalogue(spark, rows), links=(pairs(spark, ("a", "p"), ("p", "b")),))
    assert list(_by(run).values()) == [{"a", "b"}]


def test_gates(spark):
    s = spark.createDataFrame([("m1", "a", "x"), ("m1", "b", None), ("m2", "b", "x")], "merged_id string, orig_id string, dataset string")
    rows = checks.together(
        checks.unique_input_ids(spark.createDataFrame([("a",), ("a",), (None,)], "id string")), checks.unique_sources(s), checks.all_ids_survived(spark.createDataFrame([("a",), ("q",)], "id string"), s),
        checks.no_nulls(s, ("merged_id", "dataset"), "nulls"), checks.not_shrunk(s, s.unionByName(s), "shrunk"), checks.not_shrunk(s.limit(0), s.limit(0), "empty"),
        checks.all_matches_survived(spark.createDataFrame([("a", "b"), ("a", "z"), ("z", "y")], "all1_id string, all2_id string"), s.limit(2), spark.createDataFrame([("z", "y")], PAIRS)),
    )
    assert [(r.check_name, r.passed, r.found) for r in rows.collect()] == [("unique_input_ids", False, 1), ("unique_sources", False, 1), ("all_ids_survived", False, 1), ("nulls", False, 1), ("shrunk", False, 3), ("empty", True, 0), ("all_matches_survived", False, 1)]
    with pytest.raises(checks.GateError, match="unique_sources"):
        checks.enforce(rows)


# Files


def test_files(spark, tmp_path):
    path = f"file://{tmp_path}/j"
    df = spark.createDataFrame([("a", ["x", "y"], 1), ("b", None, None)], "id string, last_names array<string>, year bigint")
    files.write_json(df.coalesce(1), path, batch_rows=1)
    assert len(list((tmp_path / "j").glob("part-*"))) == 2
    (tmp_path / "j" / "more").write_text('{"id": "c", "year": 3}\n')
    got = sorted(map(tuple, files.read_json(spark, path, "id string, year bigint").collect()))
    assert got == [("a", 1), ("b", None), ("c", 3)]
    (tmp_path / "g.csv").write_text("manual_id,orig_id\n1,a\n1,a\n2,b\n")
    assert sorted(map(tuple, files.read_manual_groups(spark, f"file://{tmp_path}/g.csv").collect())) == [("1", "a"), ("2", "b")]
    at = f"file://{tmp_path}/t/unlink"
    files.append_unlink(spark, at, pairs(spark, "ab"))
    files.append_unlink(spark, at, pairs(spark, "ab", "cd"))
    assert spark.read.parquet(at).count() == 3 and sorted(p.name for p in (tmp_path / "t").iterdir()) == ["unlink"]
    files.write_lines(spark.createDataFrame([("x",)], "value string"), f"file://{tmp_path}/l")
    assert files.read_lines(spark, f"file://{tmp_path}/l").first().value == "x"
    assert [r.ids for r in files.multimap(spark.createDataFrame([("b", "v"), ("a", "v"), ("a", "v"), ("c", None)], "id string, t string"), "t").collect()] == [["a", "b"]]


def test_schema_of_a_warehouse():
    fields = [{"name": "id", "type": "STRING", "mode": "REQUIRED", "description": "An id."}, {"name": "n", "type": "INTEGER"}, {"name": "names", "type": "STRING", "mode": "REPEATED"}, {"name": "r", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "x", "type": "BOOLEAN"}]}]
    s = schemas.struct_of(fields)
    assert s.simpleString() == "struct<id:string,n:bigint,names:array<string>,r:array<struct<x:boolean>>>" and not s["id"].nullable and s["id"].metadata == {"comment": "An id."}


# Samples and near copies


def test_samples(spark):
    rows = [(f"m{k}_{g}", f"o{k}_{g}_{i}") for k in (1, 2, 6, 12, 16) for g in range(60) for i in range(k)]
    s = spark.createDataFrame(rows, "merged_id string, orig_id string")
    got = sampling.stratified(s).collect()
    counts = {}
    for r in got:
        counts[r.bin] = counts.get(r.bin, 0) + 1
    assert counts == {"count_2": 25, "count_6": 5, "count_11_15": 50}
    assert sorted(got) == sorted(sampling.stratified(s.repartition(7)).collect())
    refs = spark.createDataFrame([(f"c{i}", f"m{j}") for j in range(60) for i in range(j)], "merged_id string, ref_id string")
    top = sampling.top_cited(refs, spark.createDataFrame([("m59",)], "merged_id string"), 3).collect()
    assert [r.merged_id for r in top] == ["m58", "m57", "m56"]


@pytest.mark.parametrize("n", [5, 40, 10_000])
def test_prefix_and_reference_pairs(spark, n):
    meta = [(f"i{i:02d}", "t", ("x" * 100 if i < 30 else "y" * 100) + str(i), None, 2000, ["a"], "1,2" if i % 2 else f"r{i % 3}", "s") for i in range(50)]
    known = spark.createDataFrame([(f"m{0 if i < 20 else i // 2}", f"i{i:02d}") for i in range(48)], "merged_id string, orig_id string")
    df = spark.createDataFrame(meta, schemas.METADATA)
    m = {r.orig_id: r.merged_id for r in known.collect()}
    want = sorted((a[0], b[0]) for a in meta for b in meta if a[0] != b[0] and a[2][:100] == b[2][:100] and a[0] in m and b[0] in m and m[a[0]] != m[b[0]])
    assert [(r.orig_id1, r.orig_id2) for r in sampling.prefix_pairs(df, known, n).collect()] == want[:n]
    want = sorted((a[0], b[0]) for a in meta for b in meta if a[0] > b[0] and a[6] == b[6])
    assert [(r.orig_id1, r.orig_id2) for r in sampling.reference_pairs(df, n).collect()] == want[:n]


def test_simhash(spark):
    r = random.Random(2)
    base = "".join(r.choice("abcdefgh ") for _ in range(400))
    texts = [base, base, base.upper() + "!!"] + [base[:i] + "zz" + base[i + 2 :] for i in range(0, 400, 9)] + ["".join(r.choice("abcdefgh ") for _ in range(50)) for _ in range(60)] + ["", "ab"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(999, None)]

    def plain(t):
        hashes = [int.from_bytes(hashlib.md5(f.encode()).digest()[-8:], "big") for f in simhash.features(t)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: plain(t) for i, t in rows if t is not None}
    distinct = set(prints.values())
    got = simhash.linked(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()
    assert len(got) == len(rows) - 1
    for x in got:
        p = prints[x.id]
        assert x.simhash % (1 << 64) == p and x.copies == sum(q == p for q in prints.values())
        assert x.links == sum(q != p and bin(p ^ q).count("1") <= simhash.BITS_APART for q in distinct)
    assert max(x.links for x in got) > 0


# The driver's contract


def test_queries_and_sql():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["merged_id", "orig_id"]


def test_some_queries_equal_their_sql(spark):
    import duckdb

    from bibweave.plans import catalogue as own

    from tests.conftest import SF

    con = duckdb.connect()
    for t in ("region", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("standardise_lens", "standardise_s2", "union_metadata_remapped", "freq_filter", "metadata_match", "merged_ids_incremental", "check_all_gates", "clean_notices", "eval_positive_matches", "unlink_pairs", "references", "eval_abstract_prefix", "eval_mapped_references"):
        got = own.queries()[name](spark, SF)
        found = con.execute(own.oracle_sql()[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == sorted(got.columns), name
        assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == sorted(str(tuple(r)) for r in found.fetchall()), name


def test_command_line(spark, tmp_path):
    import json

    from bibweave.__main__ import main

    def put(name, rows):
        (tmp_path / name).mkdir()
        (tmp_path / name / "data").write_text("".join(json.dumps(r) + "\n" for r in rows))
        return f"file://{tmp_path}/{name}"

    def got(name):
        return sorted((json.loads(x) for p in (tmp_path / name).glob("part-*") for x in p.read_text().splitlines()), key=str)

    out = f"file://{tmp_path}/"
    main(["clean", put("c", [{"id": "a", "title": "A <b>t</b>!", "last_names": ["amy s. li"]}]), out + "c_out"])
    assert got("c_out") == [{"id": "a", "title": "A <b>t</b>!", "last_names": ["amy s. li"], "title_norm": "at", "last_names_norm": "li"}]
    main(["tag-language", put("l", [{"id": "a", "title": "the end of the story is in the book that was lost"}]), out + "l_out"])
    assert got("l_out")[0]["title_cld2_lid_first_result_short_code"] == "en" and got("l_out")[0]["abstract_cld2_lid_success"] is False
    matches = put("m", [{"id1": a, "id2": b} for a, b in ("AB", "BC", "DE", "EF", "GH", "II", "JJ", "KL", "MN", "NO")])
    before = put("p", [{"orig_id": i, "merged_id": f"carticle_{n:010d}"} for n, ids in ((1, "ABF"), (2, "DE"), (3, "IJ"), (4, "KL"), (5, "MN")) for i in ids])
    main(["merge-ids", matches, out + "m_out", "--previous", before, "--drop", put("d", [{"merged_id": "carticle_0000000003"}]), "--unlink", out + "nothing"])
    assert {r["orig_id"]: int(r["merged_id"][9:]) for r in got("m_out")} == {"A": 6, "B": 6, "C": 6, "D": 7, "E": 7, "F": 7, "G": 8, "H": 8, "I": 9, "J": 10, "K": 4, "L": 4, "M": 5, "N": 5, "O": 5}
    (tmp_path / "g.csv").write_text("manual_id,orig_id\n1,a\n1,b\n2,d\n2,e\n3,f\n")
    main(["unlink", out + "g.csv", out + "u"])
    assert spark.read.parquet(out + "u").count() == 16


# Pairs that are not shuffled, gates without pairs


def _rows_with_repeats(spark, seed, n=150):
    """Rows of keys, some ids with several rows, some without an id, one list of references that most share."""
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        id_ = None if dice.random() < 0.02 else f"i{i if dice.random() < 0.8 else dice.randrange(n)}"
        rows.append((id_, *(dice.choice((None, "", "a", "b", "c", f"u{i}")) for _ in range(3)), dice.choice(("1,2,3", "1,2,3", "4,5,6", "1,2", None)), dice.choice((None, 1990, 1991)), dice.choice(("x", "y", ""))))
    return spark.createDataFrame(rows, "id string, title_norm string, abstract_norm string, clean_doi string, references string, year long, last_names_norm string")


def _by_force(df):
    rows = [r.asDict() for r in df.collect()]

    def ok(k, v):
        return v is not None and v != "" and (k != "references" or len(v.split(",")) > 2)

    return {(a["id"], b["id"]) for a in rows for b in rows if any(all(ok(k, a[k]) and a[k] == b[k] for k in r) for r in RULES)}


@pytest.mark.parametrize("seed", range(2))
def test_pairs_are_distinct_without_a_shuffle(spark, seed, monkeypatch):
    monkeypatch.setattr(match, "BLOCK", 16)
    df = _rows_with_repeats(spark, seed)
    expected, out = _by_force(df), match.key_pairs(stacked(df))
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert "HashAggregate" not in out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    # of one rule
    assert sorted(map(str, match.match(df, "references", "year").collect())) == sorted(map(str, _pairs_of_rule(df, "references", "year").collect()))
    links = spark.createDataFrame([("i1", "i2"), ("i2", "i1"), ("z", "i3"), ("i3", "z"), (None, "q"), ("z", "i3")], PAIRS)
    every = [tuple(r) for r in match.every_pair(df, stacked(df), links).collect()]
    whole = match.all_match_pairs(df, spark.createDataFrame(sorted(expected, key=str), PAIRS), links)
    assert len(every) == len(set(every)) and set(every) == {tuple(r) for r in whole.collect()}


def _pairs_of_rule(df, *rule):
    k = stacked(df, (rule,))
    return k.select(F.col("id").alias("all1_id"), "key").join(k.select(F.col("id").alias("all2_id"), "key"), "key").select("all1_id", "all2_id").distinct()


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    """A group of 600 ids makes 360,000 pairs, in no task more than two blocks do."""
    monkeypatch.setattr(match, "BLOCK", 100)
    monkeypatch.setattr(match, "TASK_PAIRS", 10_000)
    df = spark.range(600).selectExpr("cast(id as string) AS id", "'1,2,3' AS references", "1L AS year")
    per = match.match(df, "references", "year").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per) == 360_000 and max(r["count"] for r in per) < 90_000


@pytest.mark.parametrize("seed", range(2))
def test_gate_on_matches_counts_without_pairs(spark, seed):
    df = _rows_with_repeats(spark, seed)
    dice = random.Random(seed)
    found = spark.createDataFrame([(f"m{dice.randrange(4)}", f"i{i}") for i in range(150) if i % 7], "merged_id string, orig_id string")
    unlink = identity.symmetric(spark.createDataFrame([(f"i{dice.randrange(40)}", f"i{dice.randrange(40)}") for _ in range(60)], PAIRS))
    expected = checks.all_matches_survived(match.key_pairs(stacked(df)), found, unlink).first()
    assert checks.keys_survived(hashed_keys(df), found, unlink).first() == expected and expected.found > 1000
    one = df.dropDuplicates(["id"]).where("id is not null")
    assert checks.keys_survived(hashed_keys(one), found, unlink).first() == checks.all_matches_survived(match.key_pairs(stacked(one)), found, unlink).first()
    assert checks.keys_survived(hashed_keys(one), found.withColumn("merged_id", F.lit("m")), unlink).first().found == checks.all_matches_survived(match.key_pairs(stacked(one)), found.withColumn("merged_id", F.lit("m")), unlink).first().found


def test_gates_and_groups_make_no_pairs(spark):
    """3,000 ids share their references and year: 9 million pairs. The gate and the groups read some rows for each id."""
    df = spark.range(3000).selectExpr("cast(id as string) AS id", "cast(null as string) AS title", "cast(null as string) AS abstract", "cast(null as string) AS clean_doi", "1L AS year", "cast(null as array<string>) AS last_names", "'1,2,3' AS references", "'d' AS dataset")
    run = linkage.link(spark, df)
    made = []
    real = run.scratch.save
    run.scratch.save = lambda x: (lambda out: (made.append(out.count()), out)[1])(real(x))
    assert run.groups.select("root").distinct().count() == 1
    assert run.checks.where("check_name = 'all_matches_survived'").first().found == 0
    assert max(made) <= 6000
    assert checks.keys_survived(run.usable, run.sources.limit(0), run.unlink).first().found == 9_000_000


def test_texts_are_fingerprinted_once(spark):
    df = spark.createDataFrame([(i, f"text number {i % 7}") for i in range(30)], "id long, text string")
    plan = simhash.linked(df, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_lists_are_put_in_order_before_records_are_repeated(spark):
    df = spark.createDataFrame(
        [("L1", "t", "a", 1990, "article", [("doi", f"V{i}") for i in range(9)], [("b",), (None,), ("a",)], [("L2",), (None,), ("L10",)])],
        "lens_id string, title string, abstract string, year_published int, publication_type string, external_ids array<struct<type string, value string>>, authors array<struct<last_name string>>, `references` array<struct<lens_id string>>",
    )
    out = C.by_doi(C.lens_records(df))
    assert sorted((r.clean_doi, r.references) for r in out.collect()) == [(f"v{i}", "L10,L2") for i in range(9)]
    above = out._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "sort_array" not in above and "array_join" not in above


def test_match_queries_normalise_only_their_keys(spark, monkeypatch):
    from bibweave.plans import catalogue

    seen, real = [], catalogue.T.normalise
    monkeypatch.setattr(catalogue.T, "normalise", lambda df, fields: (seen.append(fields), real(df, fields))[1])
    for name in ("match_references_year", "match_abstract_norm_year"):
        catalogue.queries()[name](spark, "/root/testdata/sf0.001")
    assert seen == [(), ("abstract",)]
