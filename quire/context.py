"""Session-scoped settings of a catalogue: where data and entries live."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

SUPPORTED_FORMATS = ("parquet", "orc", "delta")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    A session in one process that names none gets a folder of its own (tests); a
    cluster must name one, as executors cannot see a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


@dataclass
class Context:
    """Holds the session, the storage base and the data format.

    Layout under ``base``::

        <base>/<dataset_id>/Processed/commit_id=<commit>.<attempt>/...  data of one attempt
        <base>/<dataset_id>/Replaced/commit_id=<commit>.<attempt>/...   partition values that it replaces
        <base>/<dataset_id>/Hidden/commit_id=<commit>.<attempt>/...     row positions that it hides
        <base>/<dataset_id>/Stats/commit_id=<commit>.<attempt>/...      statistics of its files
        <base>/<dataset_id>/Profiles/commit_id=<commit>.<attempt>/...   sketches of its columns
        <base>/_catalogue/log/<dataset_id>/<version>.parquet            commits, numbered
        <base>/_catalogue/schemas/<schema_id>.parquet                   registered schemas
        <base>/_catalogue/started/<attempt>.parquet                     attempts under way

    ``hooks`` maps a step name (``"write"``, ``"register"``, ``"rollback"``) to a
    callable run just before that step; tests use it to inject failures.
    """

    spark: SparkSession
    base: str
    format: str = "parquet"
    hooks: dict = field(default_factory=dict)

    def __post_init__(self):
        if not isinstance(self.spark, SparkSession):
            raise TypeError("spark must be a SparkSession")
        if not isinstance(self.base, str) or not self.base:
            raise TypeError("base must be a non-empty string")
        if self.format not in SUPPORTED_FORMATS:
            raise ValueError(f"format must be one of {SUPPORTED_FORMATS}")
        self.base = self.base.rstrip("/")
        shared_dir(self.spark)

    @classmethod
    def scratch(cls, spark: SparkSession, label: str = "scratch", **kw) -> "Context":
        """A fresh catalogue in the shared folder; it outlives the call."""
        base = f"{shared_dir(spark)}/quire/{label}-{uuid.uuid4().hex[:12]}"
        return cls(spark, base, **kw)

    @property
    def catalogue_dir(self) -> str:
        return f"{self.base}/_catalogue"

    @property
    def log_dir(self) -> str:
        return f"{self.catalogue_dir}/log"

    @property
    def schemas_dir(self) -> str:
        return f"{self.catalogue_dir}/schemas"

    @property
    def started_dir(self) -> str:
        return f"{self.catalogue_dir}/started"

    def log_of(self, dataset_id: str) -> str:
        return f"{self.log_dir}/{dataset_id}"

    def dataset_root(self, dataset_id: str) -> str:
        return f"{self.base}/{dataset_id}"

    def processed_dir(self, dataset_id: str) -> str:
        return f"{self.dataset_root(dataset_id)}/Processed"

    def replaced_dir(self, dataset_id: str) -> str:
        return f"{self.dataset_root(dataset_id)}/Replaced"

    def hidden_dir(self, dataset_id: str) -> str:
        return f"{self.dataset_root(dataset_id)}/Hidden"

    def stats_dir(self, dataset_id: str) -> str:
        return f"{self.dataset_root(dataset_id)}/Stats"

    def profiles_dir(self, dataset_id: str) -> str:
        return f"{self.dataset_root(dataset_id)}/Profiles"

    def attempt_dirs(self, dataset_id: str, folder: str) -> list[str]:
        """All folders that one attempt may have written."""
        return [f"{d}/commit_id={folder}" for d in self._kinds(dataset_id)]

    def emptied_dirs(self, dataset_id: str) -> list[str]:
        """Folders above those of attempts, to be removed when nothing is left in them."""
        return [*self._kinds(dataset_id), self.dataset_root(dataset_id)]

    def _kinds(self, dataset_id: str) -> list[str]:
        return [self.processed_dir(dataset_id), self.replaced_dir(dataset_id), self.hidden_dir(dataset_id), self.stats_dir(dataset_id), self.profiles_dir(dataset_id)]

    def commit_dir(self, dataset_id: str, folder: str) -> str:
        """Where an attempt's data lies; ``folder`` is ``<commit>.<attempt>``."""
        return f"{self.processed_dir(dataset_id)}/commit_id={folder}"

    def now(self) -> datetime:
        """The time noted with a commit; the order of commits is that of their versions."""
        return datetime.now(timezone.utc)

    def run_hook(self, step: str, **info) -> None:
        fn = self.hooks.get(step)
        if fn is not None:
            fn(**info)
