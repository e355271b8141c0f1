"""Which commits are live, over the whole log at once."""

from quire.plans import visibility
from quire.sources.catalogue_log import LOG_SCHEMA


def test_live_commits(spark):
    def row(ds, version, mode, reset, carried=None):
        given = {"dataset_id": ds, "version": version, "mode": mode, "reset_version": reset, "carried": carried}
        return tuple(given.get(f) for f in LOG_SCHEMA.fieldNames())

    rows = [row("a", 1, "overwrite", 1), row("a", 2, "append", 1), row("a", 3, "overwrite", 3), row("a", 4, "replace", 3)]
    rows += [row("b", 1, "overwrite", 1), row("b", 2, "delete", 2)]
    rows += [row("c", 1, "overwrite", 1), row("c", 2, "append", 1), row("c", 3, "append", 1),
             row("c", 4, "compact", 4, [(3, "x", "x.1", "append")]), row("c", 5, "append", 4)]
    log = spark.createDataFrame(rows, LOG_SCHEMA).repartition(3)
    live = {(r["dataset_id"], r["version"]) for r in visibility.with_live(log).filter("live").collect()}
    assert live == {("a", 3), ("a", 4), ("c", 3), ("c", 4), ("c", 5)}
    assert visibility.with_live(log).count() == len(rows)
