"""Reading published datasets back: live commits -> one lazy Spark scan."""

from __future__ import annotations

import json
import logging
import re
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire.context import Context
from quire.errors import DatasetNotFoundError, QuireError, VersionExpiredError
from quire.functions.fields import Fields
from quire.sources.catalogue_log import dataset_log, entries, last_entry

log = logging.getLogger(__name__)

ATTRS = ["name", "description", "schema_id", "schema_json", "folder", "format", "partition_by", "tags", "fields", "skip_by"]
_LIVE = [
    "version", "commit_id", "mode", "data_folder", "replaced", "n_replaced", "replace_where", "replace_zone", "hidden", "n_hidden", "stats",
]
#: Partition values are written and read in this zone, whatever the session's.
ZONE = {"timeZone": "UTC"}
#: Rows up to which what commits hide is sent to all tasks; their number stands in the commits' entries.
BROADCAST_ROWS = 200_000
_FILES = 10_000  # names of files that a read may list in a filter
_FEW = 64  # commits that a lookup reads one by one, without a Spark job


@dataclass
class LiveCommit:
    version: int
    commit_id: str
    mode: str
    data_folder: str
    replaced: str | None = None
    n_replaced: int | None = None
    replace_where: str | None = None
    replace_zone: str | None = None
    hidden: str | None = None
    n_hidden: int | None = None
    stats: bool | None = None

    @property
    def hides(self) -> bool:
        return bool(self.replaced or self.replace_where or self.hidden)


@dataclass
class DatasetState:
    """What a reader or writer needs to know about one dataset at one version."""

    dataset_id: str
    version: int
    reset_version: int
    last_mode: str
    total_rows: int | None
    n_live: int
    created_at: datetime
    live: list[LiveCommit] = field(default_factory=list)
    attrs: dict = field(default_factory=dict)

    @property
    def exists(self) -> bool:
        return self.last_mode != "delete"

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.attrs["schema_json"]))

    @property
    def fields(self) -> Fields:
        return Fields.parse(self.attrs["fields"], self.schema)

    @property
    def format(self) -> str | None:
        return self.attrs["format"]

    @property
    def skip_by(self) -> list[str]:
        """Columns that commits keep statistics of, as far as they are still there."""
        chosen = set(self.attrs.get("skip_by") or [])
        return [n for n, i in self.fields.ids.items() if i in chosen and n in self.schema.fieldNames()]

    @property
    def partition_by(self) -> list[str]:
        return list(self.attrs.get("partition_by") or [])


def _utc(ts):
    if isinstance(ts, str):
        ts = datetime.fromisoformat(ts)
    if not isinstance(ts, datetime):
        raise TypeError("as_of must be a datetime or an ISO-8601 string")
    return ts if ts.tzinfo else ts.replace(tzinfo=timezone.utc)


def _at(ctx: Context, dataset_id: str, version: int | None, as_of) -> dict | None:
    """The commit that was the last one at a version or an instant. As of an instant: the
    highest version committed by then, and all before it."""
    rows = dataset_log(ctx, dataset_id)
    if as_of is not None:
        # compared as a number, so no session zone comes in
        us = int(_utc(as_of).timestamp() * 1_000_000)
        top = rows.filter(F.unix_micros("committed_at") <= us).agg(F.max("version")).first()[0]
        if top is None:
            return None
        version = min(top, version) if version is not None else top
    upto = F.col("version") <= int(version)
    found = rows.agg(
        F.max_by(F.struct(*[F.col(c) for c in rows.columns]), F.when(upto, F.col("version"))).alias("r"), F.max("expired_before").alias("e"),
        F.count(F.when(upto, 1)).alias("n"),
    ).first()
    if not found["n"]:
        return None
    if found["e"] is not None and found["r"]["version"] < found["e"]:
        raise VersionExpiredError(f"version {found['r']['version']} of dataset {dataset_id} has expired; the oldest kept is {found['e']}")
    return found["r"].asDict(recursive=True)


def dataset_state(ctx: Context, dataset_id: str, version: int | None = None, as_of=None) -> DatasetState | None:
    """Live commits and attributes of a dataset: its last commit, read from one small file,
    says where the live commits begin; one Spark job over the dataset's own log folder gets them."""
    last = last_entry(ctx, dataset_id) if version is None and as_of is None else _at(ctx, dataset_id, version, as_of)
    if last is None:
        return None
    st = DatasetState(
        dataset_id, last["version"], last["reset_version"], last["mode"], last["total_rows"], last["n_live"],
        last["created_at"], attrs={a: last[a] for a in ATTRS},
    )
    if last["mode"] == "delete":
        return st
    first, top = last["reset_version"], last["version"]
    rows = [last] if first == top else entries(ctx, dataset_id, range(first, top)) if top - first < _FEW else None
    if rows is not None and first != top:
        rows.append(last)
    if rows is None:
        found = dataset_log(ctx, dataset_id).filter(F.col("version").between(first, top))
        rows = [r.asDict(recursive=True) for r in found.select(*_LIVE, "carried", "carried_stats").collect()]
    reset = min(rows, key=lambda r: r["version"])
    st.live = [LiveCommit(**{k: r[k] for k in _LIVE}) for r in rows if r["data_folder"]]
    known = set(reset["carried_stats"] or [])
    st.live += [
        LiveCommit(c["version"], c["commit_id"], c["mode"], c["data_folder"], stats=c["data_folder"] in known) for c in reset["carried"] or []
    ]
    st.live.sort(key=lambda c: c.version)
    return st


_ZONED = re.compile(r"timestamp|to_date|date_format|hour\(", re.IGNORECASE)


def _unused(stem: str, taken: set[str]) -> str:
    """A column name that nobody has."""
    while stem.lower() in taken:
        stem += "_"
    taken.add(stem.lower())
    return stem


def _small(counts: list[int | None]) -> bool:
    return all(n is not None for n in counts) and sum(counts) <= BROADCAST_ROWS


def _maybe_broadcast(df: DataFrame, counts: list[int | None]) -> DataFrame:
    """To all tasks if the entries say that it is small; else the join is Spark's to choose."""
    return F.broadcast(df) if _small(counts) else df


class Rows:
    """Stored rows of some commits, with what is needed to hide some of them.

    The columns that this takes have names that the dataset's columns don't have. Commits' version
    numbers and replaced partition values are broadcast, so rows are not shuffled by them.
    """

    def __init__(self, ctx: Context, st: DatasetState, live: list[LiveCommit], positions: bool = False, only: dict[str, list[str]] | None = None, **options):
        self.ctx, self.st, self.live = ctx, st, live
        stored, fmt = st.fields.stored_schema(st.schema), st.format or ctx.format
        taken = {n.lower() for n in (*stored.fieldNames(), *st.schema.fieldNames(), "commit_id")}
        self.file, self.row, self.version = (_unused(n, taken) for n in ("_file", "_row", "_version"))
        self.taken = taken
        spark, opts = ctx.spark, {k: str(v) for k, v in options.items() if v is not None}
        folders = [ctx.commit_dir(st.dataset_id, c.data_folder) for c in live if c.data_folder not in (only or {})]
        folders += [f for c in live for f in (only or {}).get(c.data_folder, [])]  # of some commits only these files
        if fmt == "delta":
            df = None
            for c, f in zip(live, folders):
                part = spark.read.format("delta").options(**opts).load(f).withColumn("commit_id", F.lit(c.data_folder))
                df = part if df is None else df.unionByName(part, allowMissingColumns=True)
            have = set(df.columns)
            df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in stored.fields if f.name not in have])
        else:
            df = (
                spark.read.format(fmt)
                .schema(StructType([*stored.fields, StructField("commit_id", StringType())]))
                .options(**ZONE, **opts)
                .option("basePath", ctx.processed_dir(st.dataset_id))
                .load(folders)
            )
        extra = []
        if positions:
            meta = df.metadataColumn("_metadata")
            # a value in a folder's name has its slashes escaped
            extra.append(F.substring_index(meta["file_path"], "/Processed/", -1).alias(self.file))
            if fmt == "parquet":
                extra.append(meta["row_index"].alias(self.row))
        self.df, self._numbered = df.select(*st.fields.from_files(st.schema), "commit_id", *extra), False

    def _number(self) -> DataFrame:
        rows = [(c.data_folder, c.version) for c in self.live]
        return F.broadcast(self.ctx.spark.createDataFrame(rows, f"commit_id string, `{self.version}` long"))

    def _with_version(self) -> None:
        if not self._numbered:
            self.df, self._numbered = self.df.join(self._number(), "commit_id"), True

    def _replaced(self, commits: list[LiveCommit]) -> tuple[DataFrame, Column, str]:
        """Replaced partition values with the last version that replaced each; the join condition; that version's column."""
        ctx, st = self.ctx, self.st
        types = {f.name: f for f in st.schema.fields}
        root = ctx.replaced_dir(st.dataset_id)
        tables = (
            ctx.spark.read.schema(StructType([*(types[p] for p in st.partition_by), StructField("commit_id", StringType())]))
            .options(**ZONE).option("basePath", root).parquet(*[f"{root}/commit_id={c.replaced}" for c in commits])
        )
        by = ctx.spark.createDataFrame([(c.replaced, c.version) for c in commits], f"commit_id string, `{self.version}` long")
        last, keys, same = _unused("_gone", self.taken), [], F.lit(True)
        for p in st.partition_by:
            k = _unused("_gone_value", self.taken)
            keys.append(F.col(f"`{p}`").alias(k))
            same = same & F.col(f"`{p}`").eqNullSafe(F.col(k))
        gone = tables.join(F.broadcast(by), "commit_id").groupBy(*keys).agg(F.max(self.version).alias(last))
        return _maybe_broadcast(gone, [c.n_replaced for c in commits]), same, last

    def _positions(self, commits: list[LiveCommit]) -> tuple[DataFrame, Column, str]:
        """Hidden row positions; the join condition; a column that marks them."""
        root = self.ctx.hidden_dir(self.st.dataset_id)
        f, r, mark = (_unused(n, self.taken) for n in ("_hidden_file", "_hidden_row", "_hidden"))
        rows = self.ctx.spark.read.schema("file string, row long").parquet(*[f"{root}/commit_id={c.hidden}" for c in commits])
        rows = rows.select(F.col("file").alias(f), F.col("row").alias(r))
        if len(commits) > 1:
            rows = rows.distinct()
        rows = rows.withColumn(mark, F.lit(True))
        return _maybe_broadcast(rows, [c.n_hidden for c in commits]), (F.col(self.file) == F.col(f)) & (F.col(self.row) == F.col(r)), mark

    def _where(self, c: LiveCommit) -> Column:
        zone = self.ctx.spark.conf.get("spark.sql.session.timeZone")
        if c.replace_zone != zone and _ZONED.search(c.replace_where):
            raise QuireError(f"set spark.sql.session.timeZone to {c.replace_zone}: version {c.version} replaced {c.replace_where!r} in it")
        return (F.col(self.version) < c.version) & F.coalesce(F.expr(c.replace_where), F.lit(False))

    def hide(self, commits: list[LiveCommit]) -> "Rows":
        """Without the rows that these commits hide: slices that they replaced, rows that they merged away."""
        tables, wheres, merges = self._split(commits)
        if merges:
            self._without_positions(merges)
        if tables or wheres:
            self._with_version()
        if tables:
            gone, same, last = self._replaced(tables)
            self.df = self.df.join(gone, same, "left").filter(F.col(last).isNull() | (F.col(self.version) >= F.col(last))).drop(last)
        for c in wheres:
            self.df = self.df.filter(~self._where(c))
        return self

    def _without_positions(self, commits: list[LiveCommit]) -> None:
        gone, same, mark = self._positions(commits)
        if not _small([c.n_hidden for c in commits]):
            # too many for all tasks: only the files that they lie in take part in a shuffle
            files = gone.select(gone.columns[0]).distinct().limit(_FILES + 1).collect()
            if len(files) <= _FILES:
                inside = F.col(self.file).isin([r[0] for r in files])
                touched = self.df.filter(inside).join(gone, same, "left_anti")
                self.df = self.df.filter(~inside).unionByName(touched)
                return
        self.df = self.df.join(gone, same, "left_anti")

    def only_hidden(self, commits: list[LiveCommit]) -> "Rows":
        """Only the rows that these commits hide."""
        tables, wheres, merges = self._split(commits)
        hit = F.lit(False)
        if merges:
            gone, same, mark = self._positions(merges)
            self.df = self.df.join(gone, same, "left")
            hit = hit | F.col(mark).isNotNull()
        if tables or wheres:
            self._with_version()
        if tables:
            gone, same, last = self._replaced(tables)
            self.df = self.df.join(gone, same, "left")
            hit = hit | F.coalesce(F.col(self.version) < F.col(last), F.lit(False))
        for c in wheres:
            hit = hit | self._where(c)
        self.df = self.df.filter(hit)
        return self

    @staticmethod
    def _split(commits: list[LiveCommit]) -> tuple[list[LiveCommit], ...]:
        return [c for c in commits if c.replaced], [c for c in commits if c.replace_where], [c for c in commits if c.hidden]

    def columns(self, *extra: Column) -> DataFrame:
        """The dataset's columns in registered order."""
        return self.df.select(*[F.col(f"`{n}`") for n in self.st.schema.fieldNames()], *extra)


def read_state(ctx: Context, st: DatasetState, **options) -> DataFrame:
    """A lazy scan of a dataset's live commits with the registered schema.

    Partition values are typed by the registered schema (T5), columns come back in registered
    order (T7), and commit folders are read with ``basePath`` so ``commit_id`` is a partition
    column (T9), pruned like any other. All commits are one scan, however many replacements and merges
    there were.
    """
    return visible(ctx, st, **options).columns() if st.live else ctx.spark.createDataFrame([], st.schema)


def visible(ctx: Context, st: DatasetState, positions: bool = False, **options) -> Rows:
    """The rows that readers of a dataset with data see, with their places if asked for."""
    hiders = [c for c in st.live if c.hides]
    return Rows(ctx, st, st.live, positions or any(c.hidden for c in hiders), **options).hide(hiders)


def read_dataset(ctx: Context, dataset_id: str, version: int | None = None, as_of=None, **options) -> DataFrame:
    """Dataset by id; as of ``version`` (1-based commit number) or of the
    instant ``as_of`` (datetime or ISO string, UTC when naive) when given."""
    if not isinstance(dataset_id, str) or not dataset_id:
        raise TypeError("dataset_id must be a non-empty string")
    if version is not None and (not isinstance(version, int) or version < 1):
        raise ValueError("version must be a positive int")
    st = dataset_state(ctx, dataset_id, version, as_of)
    if st is None or not st.exists:
        what = f"version {version} of " if version is not None else ""
        what += f"dataset as of {as_of} " if as_of is not None else "dataset "
        raise DatasetNotFoundError(f"no live {what}{dataset_id}")
    return read_state(ctx, st, **options)
