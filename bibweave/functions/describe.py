"""Text that shows an article to a human judge."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def article_desc(title: Column, abstract: Column, year: Column, doi: Column, authors: Column) -> Column:
    """One labelled line for each field; nulls are shown as empty."""
    shown = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(F.lit("title: "), shown(title), F.lit("\nyear: "), shown(year), F.lit("\ndoi: "), shown(doi), F.lit("\nauthors: "), shown(authors), F.lit("\nabstract: "), shown(abstract))


def register_article_desc(spark: SparkSession, name: str = "article_desc") -> None:
    """The same as a temporary SQL function of this session."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(title STRING, abstract STRING, year BIGINT, doi STRING, authors STRING) RETURNS STRING "
        "RETURN concat('title: ', coalesce(title, ''), chr(10), 'year: ', coalesce(cast(year AS string), ''), chr(10), 'doi: ', coalesce(doi, ''), "
        "chr(10), 'authors: ', coalesce(authors, ''), chr(10), 'abstract: ', coalesce(abstract, ''))"
    )
