"""Normalisation of text fields, descriptions and language tags."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from bibweave.functions import language, text
from bibweave.functions.describe import article_desc, register_article_desc


def norm(spark, value, field):
    kind = "array<string>" if field == "last_names" else "string"
    return text.normalise(spark.createDataFrame([(value,)], f"{field} {kind}"), (field,)).first()[f"{field}_norm"]


@pytest.mark.parametrize(
    ("field", "value", "expected"),
    [
        ("title", "Something un-normalized!", "somethingunnormalized"),
        ("abstract", "你好世界 copyright (C) 2014", "你好世界"),
        ("last_names", ["smith", "amy s. li", "界"], "li smith 界"),
        ("abstract", "test (C) 2014 test1", "test"), ("abstract", "test (c) 2014 test1", "test"), ("abstract", "test copyright 2014 test1", "test"),
        ("abstract", "test copyright test1", "testcopyrighttest"),
        ("abstract", "(a) the first item (b) the second item (c) the third item", "athefirstitembtheseconditemcthethirditem"),
        ("abstract", "one copyright 2014 gone\ntwo", "onetwo"), ("abstract", "x\x1c(c) 2014 gone", "x"),
        ("title", "Crème <i>brûlée</i> ﬁn ½ x²", "cremebruleefinx"), ("title", "a < b and c > d", "ad"), ("title", "<> <", None), ("title", "İΑΣ ΣΑΣ", "iας" + "σας"),
        ("title", None, None), ("title", "123 !!! ...", None), ("abstract", "", None), ("title", "४५ ٣", "४५٣"),
        ("last_names", None, None), ("last_names", [], None), ("last_names", ["", " \t", None], None), ("last_names", ["o1b", "x smith-jones ", "É Zola"], "ob smith jones zola"),
    ],
)
def test_goldens(spark, field, value, expected):
    assert norm(spark, value, field) == expected


def plain(s):
    """The title steps one after another."""
    s = unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", unicodedata.normalize("NFKC", s)) if unicodedata.category(c) != "Mn"))
    s = re.sub(r"<([^>]+)>", "", s)
    s = re.sub(r"\W", " ", re.sub("[0-9]+", "", re.sub(r"([!-/:-@\[-`{-~])+", " ", s)))
    return "".join(w.strip().lower() for w in s.split()) or None


def test_random_strings(spark):
    import random

    r = random.Random(4)
    alphabet = "abcXYZ019 .,<>()-_'\n\té́ÀßΣσıİﬁ½²①你界日本 ​́٣४ǅЖ😀ℵ№"
    rows = [("".join(r.choice(alphabet) for _ in range(r.randint(0, 40))),) for _ in range(3000)]
    got = text.normalise(spark.createDataFrame(rows, "title string"), ("title",)).collect()
    assert [x.title_norm for x in got] == [plain(x.title) for x in got]


def test_fields(spark):
    df = spark.createDataFrame([(" 10.1/AB ", "T")], "doi string, title string")
    got = text.normalise(df, ("doi", "title", "abstract"))
    assert got.columns == ["doi", "title", "title_norm"] and got.first().doi == "10.1/ab"
    with pytest.raises(ValueError):
        text.normalise(df.withColumn("x", F.lit(1)), ("x",))


def test_many_open_brackets_take_linear_time(spark):
    assert norm(spark, "<" * 300_000 + "a", "title") == "a"
    assert norm(spark, "x" + " " * 200_000 + "y", "abstract") == "xy"


def test_ascii_rows_skip_python(spark):
    plan = text.normalise(spark.createDataFrame([("a",)], "title string"), ("title",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_streaming(spark, tmp_path):
    """The cleaners are maps: a stream takes them unchanged."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"title": "Ünder <b>x</b> 1"}\n{"title": null}\n')
    stream = spark.readStream.schema("title string").json(str(tmp_path / "in"))
    run = text.normalise(stream, ("title",)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert sorted(str(r.title_norm) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["None", "underx"]


def test_article_desc(spark):
    register_article_desc(spark)
    df = spark.createDataFrame([("t", "a", 2001, "d", "x, y"), (None, None, None, None, None)], "title string, abstract string, year bigint, doi string, authors string")
    got = df.select(article_desc(*(F.col(c) for c in df.columns)).alias("c"), F.expr("article_desc(title, abstract, year, doi, authors)").alias("s")).collect()
    assert [r.c for r in got] == [r.s for r in got] == ["title: t\nyear: 2001\ndoi: d\nauthors: x, y\nabstract: a", "title: \nyear: \ndoi: \nauthors: \nabstract: "]


def test_language(spark):
    rows = [
        ("The results of this study are shown in the table and that is the end of it for us all", "en"), ("Die Ergebnisse der Studie sind in dem Bericht nicht auf der Seite des Herrn zu finden", "de"),
        ("Les résultats de cette étude sont dans le tableau et pour la suite avec une aide du roi", "fr"), ("Los resultados de este estudio son más que la suma y como para el año en España", "es"),
        ("Результаты этого исследования", "ru"), ("研究の結果はこちらです", "ja"), ("本研究的结果", "zh"), ("1234 !!", None), ("", None), (None, None),
    ]
    got = language.tag(spark.createDataFrame([(t,) for t, _ in rows], "title string"), ("title", "abstract")).collect()
    assert [r.title_cld2_lid_first_result_short_code for r in got] == [c for _, c in rows]
    assert [r.title_cld2_lid_success for r in got] == [c is not None for _, c in rows]
    assert got[0].title_cld2_lid_is_reliable and got[-1].title_cld2_lid_is_reliable is None and "abstract_cld2_lid_success" not in got[0].asDict()

    def broken(t):
        raise ValueError(t)

    assert not language.tag(spark.createDataFrame([("x",)], "title string"), ("title",), broken).first().title_cld2_lid_success
    assert language.guess_bytes("é".encode("latin-1")) == "é" == language.guess_bytes("é".encode())


def test_learned_detector_on_documents_not_fitted_on(spark):
    from pyspark.sql import functions as F

    from bibweave.functions.language import Profiles, learn, tag

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null and lang is not null").select("doc_id", F.col("text").alias("title"), "lang")
    found = learn(docs.where("doc_id % 3 != 0"), "title", "lang")
    got = tag(docs.where("doc_id % 3 = 0"), ("title",), found).collect()
    right = [r.lang == r.title_cld2_lid_first_result_short_code for r in got]
    assert sum(right) > 0.97 * len(right) and sum(r.title_cld2_lid_is_reliable for r in got) > 0.9 * len(got)
    assert all(r.lang == r.title_cld2_lid_first_result_short_code for r in got if r.title_cld2_lid_is_reliable and len(r.title) > 200)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34"), (4, "der Hund und die Katze")], "id int, title string")
    rows = {r.id: r for r in tag(odd, ("title",), found).collect()}
    assert not rows[1].title_cld2_lid_success and not rows[2].title_cld2_lid_success and not rows[3].title_cld2_lid_success
    assert rows[4].title_cld2_lid_success and rows[4].title_cld2_lid_first_result == found("der Hund und die Katze")[0]
    none = learn(docs.where("false"), "title", "lang")
    assert isinstance(none, Profiles) and not tag(odd, ("title",), none).where("title_cld2_lid_success").count()


def test_batches_are_bared_as_single_texts_are():
    import sys
    import unicodedata

    import pyarrow as pa

    from bibweave.functions import text

    # what Python's tables don't know yet may be taken apart by Arrow's
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    texts = [*every, *(f"a{c}\u0301b" for c in every[:70_000]), None, ""]
    assert text._bare_all(pa.array(texts)).to_pylist() == [None if t is None else text._bare(t) for t in texts]


def test_texts_are_bared_run_by_run():
    """Each character beside ASCII ones, and runs of any, as the whole text would be; repeated runs take no time of their own."""
    import random
    import sys
    import time

    import pyarrow as pa

    wide = [c for c in map(chr, range(128, sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["".join(f"a{c}e{c}<" for c in wide[i : i + 500]) for i in range(0, len(wide), 500)]
    dice = random.Random(1)
    marked = [c for c in wide if text._bare(c) != c]
    texts += ["".join(dice.choice((dice.choice("aeoA<= 1"), dice.choice(marked))) for _ in range(200)) for _ in range(300)]
    assert text._bare_all(pa.array(texts)).to_pylist() == [text._bare(t) for t in texts]
    long = pa.array(["Über die Größe, süß und weiß. " * 100_000])
    text._bare_all(long)
    began = time.process_time()
    text._bare_all(long)
    took = time.process_time() - began
    began = time.process_time()
    text._bare(long[0].as_py())
    assert took < time.process_time() - began


def test_joined_words_are_lowered_as_they_stand(spark):
    """The end of a word tells which small sigma is meant; copyright notices are looked for only where there can be one."""
    texts = ["ΟΔΟΣ.Α", "ΟΔΟΣ ΑΣ 1Σ", "A1Σ2B", "Straße 12 ½ Ⅷ", "  ", "12", None, "a<b>c", "x COPYRIGHT (C) 2001 y", "x (c) 1999\nz", "(C) 12 copyright 1999a \n b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = F.nullif(F.replace(text._words(F.col("t")), F.lit(" "), F.lit("")), F.lit(""))
    cut = F.lower("t")
    for pattern in text._COPYRIGHT:
        cut = F.regexp_replace(cut, pattern, "")
    for a, b, c, d in df.select(text._joined(F.col("t")), words, text._without_copyright(F.col("t")), cut).collect():
        assert a == b and c == d
