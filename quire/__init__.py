"""quire: publish Spark DataFrames as catalogued, versioned datasets.

The catalogue itself is a set of DataFrames; every operation is a Spark job
over Parquet (or Delta Lake when that connector is installed).
"""

from quire.context import Context, shared_dir
from quire.errors import (
    DatasetExistsError,
    DatasetNotFoundError,
    PublishError,
    QuireError,
    RegistrationError,
    SchemaMismatchError,
    VersionExpiredError,
)
from quire.functions.catalogue import (
    catalogue_datasets,
    commits,
    datasets,
    history,
    lineage,
    schemas,
    search,
    tags,
)
from quire.functions.schemas import conform, register_schema, schema_violations
from quire.operators.alter import drop_column, rename_column, widen_column
from quire.operators.merge import merge_rows
from quire.operators.publish import delete_dataset, publish, publish_many, replace_partition
from quire.operators.retain import expire_versions
from quire.sources.changes import read_changes
from quire.sources.datasets import read_dataset
from quire.sources.skipping import read_where

__all__ = [
    "Context", "shared_dir",
    "QuireError", "PublishError", "RegistrationError",
    "VersionExpiredError", "DatasetExistsError", "DatasetNotFoundError", "SchemaMismatchError",
    "publish", "publish_many", "replace_partition", "merge_rows", "delete_dataset", "read_dataset", "read_where", "read_changes",
    "rename_column", "drop_column", "widen_column", "expire_versions",
    "datasets", "commits", "schemas", "lineage", "tags", "history", "search",
    "catalogue_datasets", "register_schema", "conform", "schema_violations",
]

from quire.operators.maintain import compact_dataset, partition_counts, sweep_orphans
from quire.functions.profiles import included_columns, key_columns, profile, profile_commits
from quire.functions.ranking import ranked_search, write_index
from quire.plans.column_lineage import column_lineage
from quire.plans.lineage import lineage_closure, lineage_edges
from quire.sources.listing import exists_report
from quire.sources.storage import PathStorage, session
from quire.streaming.publish_stream import publish_stream
from quire.streaming.read_stream import stream_changes


class Catalogue:
    """Object form of the API, bound to one :class:`Context`.

    ``save`` keeps the one-call publish of a frame as a new dataset: checks
    raise ``TypeError``, failures in writing or registering come back as
    ``{"error": ..., "error_type": ...}``.
    """

    def __init__(self, spark=None, base: str | None = None, format: str = "parquet"):
        spark = session(spark)
        self.ctx = Context(spark, base, format) if base else Context.scratch(spark, "catalogue", format=format)

    def save(self, df, dataset_name, dataset_description, schema_id=None, tags=None) -> dict:
        return publish(self.ctx, df, dataset_name, dataset_description, schema_id=schema_id, tags=tags)

    def publish(self, df, name, description, **kw) -> dict:
        return publish(self.ctx, df, name, description, **kw)

    def read(self, dataset_id, version=None, **options):
        return read_dataset(self.ctx, dataset_id, version, **options)

    def datasets(self):
        return catalogue_datasets(self.ctx)

    def search(self, tags=None, text=None, without=None):
        return search(self.ctx, tags, text, without)


__all__ += [
    "Catalogue", "PathStorage", "compact_dataset", "partition_counts",
    "sweep_orphans", "ranked_search", "write_index", "profile", "profile_commits", "key_columns",
    "included_columns", "column_lineage", "lineage_closure", "lineage_edges", "exists_report", "publish_stream", "stream_changes",
]
