"""The whole linkage: catalogues' tables -> merged ids, sources, references, checks."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.functions.language import tag
from bibweave.functions.text import normalise
from bibweave.operators import checks, identity
from bibweave.operators.keys import RULES, drop_frequent, hashed_keys, stacked
from bibweave.operators.match import all_match_pairs, group_edges, key_pairs
from bibweave.schemas import DESCRIPTIONS
from bibweave.scratch import Scratch
from bibweave.sources import files

#: The table of language tags is kept beside the run that wrote it, not published; the next run is measured by it.
TAGGED = "all_metadata_with_cld2_lid"


class Linkage:
    """The tables of one run. Each is worked out, and written, when it is first asked for."""

    def __init__(self, metadata: DataFrame, ids: DataFrame, links: tuple[DataFrame, ...], unlink: DataFrame, previous: DataFrame | None, rules, prefix: str, highest: int, scratch: Scratch):
        self.metadata, self.ids, self.links, self.unlink, self.previous = metadata, ids, links, unlink, previous
        self.rules, self.prefix, self.highest, self.scratch = rules, prefix, highest, scratch

    @cached_property
    def normalised(self) -> DataFrame:
        return self.scratch.save(normalise(self.metadata))

    @cached_property
    def filtered(self) -> DataFrame:
        """Whole rows, their frequent keys nulled."""
        return drop_frequent(self.normalised, scratch=self.scratch)

    @cached_property
    def hashed(self) -> DataFrame:
        """id, dataset and the hashes of the keys: what the rest of a run reads. No text is shuffled."""
        return self.scratch.save(hashed_keys(normalise(self.metadata), also=("dataset",)))

    @cached_property
    def usable(self) -> DataFrame:
        """The same, their frequent keys nulled."""
        return self.scratch.save(drop_frequent(self.hashed, hashed=True, scratch=self.scratch))

    @cached_property
    def keys(self) -> DataFrame:
        return self.scratch.save(stacked(self.usable, self.rules, hashed=True))

    @cached_property
    def matches(self) -> DataFrame:
        return key_pairs(self.keys, self.scratch)

    @cached_property
    def groups(self) -> DataFrame:
        """(root, orig_id) of all ids, those known from links alone included."""
        unlink = self.scratch.save(identity.symmetric(self.unlink))  # a short list is broadcast, as its size is known
        edges = group_edges(stacked(self.usable, self.rules, hashed=True, distinct=False), unlink)
        ids = self.hashed.select("id")
        for x in self.links:
            linked = x.toDF("id1", "id2").where("id1 is not null and id2 is not null")
            edges, ids = edges.unionByName(linked), ids.unionByName(linked.select(F.explode(F.array("id1", "id2")).alias("id")))
        return self.scratch.save(identity.grouped(edges, ids, unlink, self.scratch))

    @cached_property
    def mapping(self) -> DataFrame:
        dropped = None if self.previous is None else identity.ids_to_drop(self.previous, self.unlink)
        return self.scratch.save(identity.assign_ids(self.groups, self.previous, dropped, self.prefix, self.highest, self.scratch))

    @cached_property
    def sources(self) -> DataFrame:
        return self.scratch.save(identity.sources(self.mapping, self.hashed))

    @cached_property
    def references(self) -> DataFrame:
        return self.scratch.save(identity.references(self.metadata, self.sources))

    @cached_property
    def checks(self) -> DataFrame:
        return checks.together(
            checks.unique_input_ids(self.ids), checks.unique_sources(self.sources), checks.all_ids_survived(self.ids, self.sources), checks.keys_survived(self.usable, self.sources, identity.symmetric(self.unlink), self.rules, self.scratch),
            checks.no_nulls(self.references, ("merged_id", "ref_id"), "no_null_references"), checks.no_nulls(self.sources, ("dataset",), "no_null_datasets"),
        )


def link(
    spark: SparkSession, metadata: DataFrame, ids: DataFrame | None = None, links: tuple[DataFrame, ...] = (), unlink: DataFrame | None = None,
    previous: DataFrame | None = None, rules=RULES, prefix: str = identity.PREFIX, highest: int = 0, scratch: Scratch | None = None,
) -> Linkage:
    """One run over standardised ``metadata``.

    ``links`` are pairs that catalogues give, ``unlink`` pairs to keep apart,
    ``previous`` the sources of the last run. Texts are normalised once; from
    then on keys are hashes. Groups come from star edges, not from all pairs;
    all pairs are worked out for the check only.
    """
    none = spark.createDataFrame([], "id1 string, id2 string")
    return Linkage(metadata, metadata.select("id").distinct() if ids is None else ids, links, none if unlink is None else unlink, previous, rules, prefix, highest, scratch or Scratch(spark))


def match_pairs(run: Linkage, *links: DataFrame) -> DataFrame:
    return all_match_pairs(run.filtered, run.matches, *links)


def publish(spark: SparkSession, run: Linkage, root: str, date: str, fields: tuple[str, ...] = ("title", "abstract")) -> None:
    """Writes to ``{root}/staging``, checks, and only then replaces ``{root}/production`` and keeps dated copies in ``{root}/backups``.

    Begins by removing ``{root}/tmp`` and the mark of the last run, and ends by
    setting ``{root}/DONE``. The table of language tags stays in staging, where
    a copy (``_last_run``) serves the next run's comparison. Raises
    ``checks.GateError`` and leaves production as it is if a gate fails.
    """
    files.remove(spark, f"{root}/tmp")
    files.unmark(spark, f"{root}/DONE")
    tables = {"sources": run.sources, "references": run.references, TAGGED: tag(run.metadata, fields)}
    staged = {name: files.overwrite_table(df, f"{root}/staging/{name}") for name, df in tables.items()}
    gates = [run.checks]
    for name, df in staged.items():
        last = f"{root}/staging/{TAGGED}_last_run" if name == TAGGED else f"{root}/production/{name}"
        if files.exists(spark, last):
            gates.append(checks.not_shrunk(df, spark.read.parquet(last), f"not_shrunk_{name}"))
    checks.enforce(checks.together(*gates))
    for name in staged:
        target = f"{root}/staging/{name}_last_run" if name == TAGGED else f"{root}/production/{name}"
        files.copy_table(spark, f"{root}/staging/{name}", target, description=DESCRIPTIONS[name])
        files.snapshot(spark, f"{root}/staging/{name}", f"{root}/backups", date)
    files.mark(spark, f"{root}/DONE")
