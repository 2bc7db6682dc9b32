"""Single steps from the command line, over folders of JSON lines: ``python -m bibweave STEP ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from bibweave import schemas
from bibweave.functions import language, text
from bibweave.operators import identity
from bibweave.sources import files


def clean(spark: SparkSession, a: argparse.Namespace) -> None:
    files.write_json(text.normalise(files.read_json(spark, a.input, a.schema), tuple(a.fields.split(","))), a.output)


def tag_language(spark: SparkSession, a: argparse.Namespace) -> None:
    files.write_json(language.tag(files.read_json(spark, a.input, a.schema), tuple(a.fields.split(","))), a.output)


def merge_ids(spark: SparkSession, a: argparse.Namespace) -> None:
    given = lambda path, schema: files.read_json(spark, path, schema) if path and files.exists(spark, path) else None
    groups = identity.match_groups(files.read_json(spark, a.matches, schemas.PAIRS), given(a.unlink, schemas.PAIRS))
    files.write_json(identity.assign_ids(groups, given(a.previous, "merged_id string, orig_id string"), given(a.drop, "merged_id string"), a.prefix), a.output)


def unlink(spark: SparkSession, a: argparse.Namespace) -> None:
    files.append_unlink(spark, a.output, identity.unlink_pairs(files.read_manual_groups(spark, a.input)))


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="bibweave", description=__doc__)
    steps = top.add_subparsers(required=True)
    for name, run, fields in (("clean", clean, "title,abstract,last_names"), ("tag-language", tag_language, "title,abstract")):
        p = steps.add_parser(name)
        p.add_argument("input")
        p.add_argument("output")
        p.add_argument("--fields", default=fields)
        p.add_argument("--schema", default=schemas.METADATA, help="of the input, as Spark DDL")
        p.set_defaults(run=run)
    p = steps.add_parser("merge-ids")
    p.add_argument("matches", help="pairs id1, id2")
    p.add_argument("output")
    p.add_argument("--unlink", help="pairs id1, id2 to keep apart")
    p.add_argument("--previous", help="merged_id, orig_id of the last run")
    p.add_argument("--drop", help="merged_id that may not be used again")
    p.add_argument("--prefix", default=identity.PREFIX)
    p.set_defaults(run=merge_ids)
    p = steps.add_parser("unlink")
    p.add_argument("input", help="CSV with manual_id, orig_id")
    p.add_argument("output", help="the table of unlinked pairs, to which the new ones are added")
    p.set_defaults(run=unlink)
    a = top.parse_args(args)
    spark = SparkSession.builder.appName("bibweave").getOrCreate()
    a.run(spark, a)


if __name__ == "__main__":
    main()
