"""Publishing frames as commits of catalogued datasets.

A publish is: checks (raised) -> data written by one Spark job into a folder of this
attempt alone, with the row count observed in the same pass -> one numbered log entry,
created only if its number is free (the commit point). Where another commit took the number, the
new state is looked at again: the mode's rule must still hold, and then the next number is tried. A
failure after the checks removes what this attempt wrote, nothing else, and is
reported as an outcome dict, never raised.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire import messages as msg
from quire.context import Context
from quire.errors import (
    DatasetExistsError, DatasetNotFoundError, PublishError, QuireError, RegistrationError, SchemaMismatchError,
)
from quire.functions import checks
from quire.functions.fields import Fields
from quire.functions.schemas import (
    as_nullable, blocking, canonical, ensure_schema, lookup_schema, schema_id_of, widens,
)
from quire.sources import filesystem as fsys
from quire.sources.catalogue_log import STARTED, dataset_log, encode, entry_path, note_version
from quire.sources.datasets import BROADCAST_ROWS, ZONE, DatasetState, _unused, dataset_state, read_state, visible
from quire.sources.skipping import check_skip_by, write_stats

log = logging.getLogger(__name__)

ATTEMPT_NAMESPACE = uuid.UUID("2d6c9a54-7c0e-4b57-9a7a-4f0a5f1f6c11")
_TRIES = 1000  # numbers tried for one commit before giving up


@dataclass
class CommitPlan:
    dataset_id: str
    commit_id: str
    requested: str  # the mode asked for
    mode: str  # effective: overwrite | append | replace | compact
    frame: DataFrame
    name: str
    description: str
    tags: dict
    partition_by: list[str]
    schema: StructType
    schema_id: str
    fields: Fields
    inputs: list[str]
    data_folder: str  # <commit>.<attempt>
    folder: str
    fmt: str
    options: dict
    state: DatasetState | None  # as of planning, and then as last looked at
    where: str | None = None  # a replaced slice given by other columns
    replace_where: str | None = None  # it, where it is stored as it is
    partitions_where: str | None = None  # a replaced slice given by partition columns
    hide: Callable[[Context, "CommitPlan"], int] | None = None  # hides rows of the state as it is now; how many
    replaced: str | None = None  # folder of what ``hide`` wrote, and its number of rows
    hidden: str | None = None
    n_hiding: int | None = None
    after_write: Callable[[Context, "CommitPlan"], str | None] | None = None  # a problem with what was written
    skip_by: list[str] = field(default_factory=list)  # columns to keep statistics of
    stats: bool = False  # whether they are written
    create: bool = False
    skip_empty: bool = False
    metrics: list[Column] = field(default_factory=list)
    checks: list[Callable[[dict], str | None]] = field(default_factory=list)
    n_rows: int | None = None
    snapshot: int = 0  # of a compaction: the version that it read


def _first_line(e: BaseException) -> str:
    s = str(e).strip()
    return s.splitlines()[0] if s else type(e).__name__


def failure(err: BaseException, dataset_id=None, commit_id=None, message: str | None = None) -> dict:
    return {
        "dataset_id": dataset_id, "commit_id": commit_id, "accepted": False, "status": "failed",
        "error": message or str(err), "error_type": type(err).__name__,
    }


def success(plan: CommitPlan, version: int) -> dict:
    return {
        "dataset_id": plan.dataset_id, "commit_id": plan.commit_id, "accepted": True, "status": "committed",
        "mode": plan.mode, "version": version, "n_rows": plan.n_rows, "schema_id": plan.schema_id,
    }


def _norm_path(p: str) -> str:
    return re.sub(r"^file:/+", "/", p)


def inputs_of(ctx: Context, df: DataFrame) -> list[str]:
    """Datasets of this catalogue that ``df`` reads, from the root paths of its file scans
    (T14: none for frames not read from files; callers may declare inputs)."""
    base = re.escape(_norm_path(fsys.qualify(ctx.spark, ctx.base)))
    pattern = re.compile(base + r"/([0-9a-fA-F-]{36})/Processed(/|$)")
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            continue
        roots = leaf.relation().location().rootPaths()
        for k in range(roots.size()):
            if m := pattern.match(_norm_path(roots.apply(k).toString())):
                found.add(m.group(1))
    return sorted(found)


def prior_outcome(ctx: Context, dataset_id: str, commit_id: str, requested: str) -> dict | None:
    """The stored outcome of a commit id that the dataset's log has already (a replay). The
    same id for another kind of commit is an error."""
    rows = (
        dataset_log(ctx, dataset_id).filter(F.col("commit_id") == commit_id)
        .select("mode", "version", "n_rows", "schema_id").collect()
    )
    if not rows:
        return None
    r = rows[0]
    kinds = {"append": ("append", "overwrite"), "overwrite": ("overwrite", "replace"), "error": ("overwrite",), "ignore": ("overwrite",)}
    if r["mode"] not in kinds.get(requested, (requested,)):
        err = PublishError(f"commit id {commit_id} belongs to a commit of mode {r['mode']}", commit_id)
        return failure(err, dataset_id, commit_id)
    return {
        "dataset_id": dataset_id, "commit_id": commit_id, "accepted": True, "status": "committed", "mode": r["mode"],
        "version": r["version"], "n_rows": r["n_rows"], "schema_id": r["schema_id"], "replayed": True,
    }


def fit_append(frame: DataFrame, current: StructType, merge: bool) -> tuple[DataFrame, StructType]:
    """Match an appended frame to the dataset schema (T3).

    Same-named columns (case-insensitive) must have the same type or a safe
    widening, which is applied; new columns need ``mergeSchema`` and are added at
    the end; absent columns read back as null.
    """
    by_lower = {f.name.lower(): f for f in current.fields}
    cols, added = [], []
    for f in frame.schema.fields:
        cur = by_lower.get(f.name.lower())
        if cur is None:
            if not merge:
                raise SchemaMismatchError(
                    f"new column {f.name!r}; append with mergeSchema=True to add it"
                )
            added.append(StructField(f.name, as_nullable(f.dataType), True))
            cols.append(F.col(f"`{f.name}`"))
            continue
        if canonical(f.dataType) == canonical(cur.dataType):
            cols.append(F.col(f"`{f.name}`").alias(cur.name))
        elif widens(f.dataType, cur.dataType):
            cols.append(F.col(f"`{f.name}`").cast(cur.dataType).alias(cur.name))
        else:
            raise SchemaMismatchError(
                f"column {f.name!r} is {f.dataType.simpleString()}, dataset has {cur.dataType.simpleString()}"
            )
    return frame.select(*cols), StructType(list(current.fields) + added)


def guard_partition_values(frame: DataFrame, parts: list[str]) -> DataFrame:
    """An empty string would be stored as the null partition (T6): fail the
    write instead of changing the value."""
    types = {f.name: f.dataType for f in frame.schema.fields}
    for c in parts:
        if isinstance(types.get(c), StringType):
            frame = frame.withColumn(
                c,
                F.when(
                    F.col(f"`{c}`") == "",
                    F.raise_error(F.lit(f"empty string in partition column {c}")),
                ).otherwise(F.col(f"`{c}`")),
            )
    return frame


def _folder_name(commit_id: str) -> str:
    """Each attempt writes to a folder of its own, also one that repeats a commit id."""
    return f"{commit_id}.{uuid.uuid4().hex[:12]}"


def _refusal(plan_mode: str, dataset_id: str, commit_id: str | None, state: DatasetState | None, create: bool) -> dict | None:
    """What the mode says to the dataset's state; ``None`` when the commit may go on."""
    live = state is not None and state.exists
    if live and plan_mode == "error":
        return failure(DatasetExistsError(f"dataset {dataset_id} already has data"), dataset_id, None)
    if live and plan_mode == "ignore":
        return {"dataset_id": dataset_id, "commit_id": None, "accepted": False, "status": "ignored", "n_rows": 0}
    if not live and (plan_mode in ("replace", "compact") or plan_mode == "append" and not create):
        return failure(DatasetNotFoundError(f"no live dataset {dataset_id}"), dataset_id, commit_id)
    return None


def prepare(
    ctx: Context,
    df: DataFrame,
    name: str,
    description: str,
    schema_id=None,
    tags=None,
    dataset_id=None,
    mode: str = "overwrite",
    partition_by=None,
    inputs=None,
    commit_id=None,
    create: bool = False,
    options: dict | None = None,
    skip_by=None,
) -> CommitPlan | dict:
    """Checks (raised) and the commit plan; an outcome dict when nothing is to
    be written (refused, ignored, replayed)."""
    checks.check_frame(df)
    checks.check_name(name)
    checks.check_description(description)
    checks.check_tags(tags)
    checks.check_mode(mode)
    ds = checks.check_dataset_id(dataset_id)
    cid = checks.check_commit_id(commit_id)
    parts = checks.partition_list(partition_by)
    if inputs is not None and (
        not isinstance(inputs, (list, tuple)) or not all(isinstance(i, str) for i in inputs)
    ):
        raise TypeError("inputs must be a list of dataset ids or None")
    opts = checks.clean_options(options or {})
    merge = opts.pop("mergeSchema", "false") == "true"
    dynamic = opts.pop("partitionOverwriteMode", "static").lower() == "dynamic"
    if mode == "append" and ds is None:
        raise ValueError("dataset_id is required for append")
    checks.check_columns(df, parts)

    if ds is None and cid is not None:
        # a new dataset under a commit id: a replay must find the same dataset
        ds = str(uuid.uuid5(ATTEMPT_NAMESPACE, f"{ctx.base}#{cid}"))
    if ds is not None and cid is not None and (prior := prior_outcome(ctx, ds, cid, mode)):
        return prior
    state = dataset_state(ctx, ds) if ds else None
    cid, ds = cid or str(uuid.uuid4()), ds or str(uuid.uuid4())
    if refused := _refusal(mode, ds, cid, state, create):
        return refused
    live = state is not None and state.exists
    effective = "append" if live and mode == "append" else "overwrite"
    if dynamic and live and mode == "overwrite" and (parts or state.partition_by):
        effective = "replace"

    frame = df
    try:
        if schema_id is not None:
            target = as_nullable(lookup_schema(ctx, str(schema_id)))
            if bad := blocking(df.schema, target):
                raise SchemaMismatchError(f"frame does not conform to schema {schema_id}: {bad}")
            frame, schema, sid = df.to(target), target, str(schema_id)
        else:
            schema, sid = as_nullable(df.schema), None
        if effective in ("append", "replace"):
            if not parts:
                parts = state.partition_by
            elif parts != state.partition_by:
                raise SchemaMismatchError(
                    f"partitioning {parts} differs from the dataset's {state.partition_by}"
                )
            missing = [c for c in parts if c not in frame.columns]
            if missing:
                raise SchemaMismatchError(f"partition columns missing from the frame: {missing}")
            given = schema
            frame, schema = fit_append(frame, state.schema, merge)
            # an id only ever means its schema: the dataset's stays unless its columns change
            if schema == state.schema:
                sid = state.attrs["schema_id"]
            elif schema != given:
                sid = None
        sid = sid or schema_id_of(schema)
    except SchemaMismatchError as e:
        return failure(e, ds, cid)
    if effective in ("append", "replace"):
        fields = state.fields.extended(schema)
    else:
        known = state is not None and state.attrs["schema_json"] is not None
        fields = state.fields.renewed(state.schema, schema) if known else Fields().extended(schema)

    if skip_by is not None:
        skips = check_skip_by(skip_by, schema)
    else:
        skips = [n for n in (state.skip_by if live else []) if n in schema.fieldNames()]

    folder = _folder_name(cid)
    return CommitPlan(
        dataset_id=ds, commit_id=cid, requested=mode, mode=effective, skip_by=skips,
        frame=guard_partition_values(frame, parts), name=name, description=description,
        tags=checks.normalise_tags(tags)
        if tags is not None or state is None
        else dict(state.attrs.get("tags") or {}),
        partition_by=parts, schema=schema, schema_id=sid, fields=fields,
        inputs=list(inputs) if inputs is not None else inputs_of(ctx, df),
        data_folder=folder, folder=ctx.commit_dir(ds, folder),
        # commits of one dataset share its format; a reset may choose anew
        fmt=(state.attrs.get("format") or ctx.format) if effective in ("append", "replace") else ctx.format,
        options=opts, state=state, create=create, hide=_replaced_values if effective == "replace" else None,
    )


def _marker(ctx: Context, plan: CommitPlan) -> str:
    return f"{ctx.started_dir}/{plan.data_folder}.parquet"


def remove_attempt(ctx: Context, dataset_id: str, folder: str) -> None:
    """Removes what one attempt wrote. Folders above go only if nothing is left in them."""
    for d in ctx.attempt_dirs(dataset_id, folder):
        fsys.delete(ctx.spark, d)
    for above in ctx.emptied_dirs(dataset_id):
        fsys.delete_if_empty(ctx.spark, above)


def undo(ctx: Context, plan: CommitPlan) -> None:
    """Removes what this attempt wrote, and its mark."""
    remove_attempt(ctx, plan.dataset_id, plan.data_folder)
    fsys.delete(ctx.spark, _marker(ctx, plan))


def rollback(ctx: Context, plan: CommitPlan, err: QuireError) -> dict:
    """Undo of a failed attempt. Reports the first error and, if the undo failed too,
    that error as well; then the attempt's mark stays for ``sweep_orphans``."""
    try:
        ctx.run_hook("rollback", plan=plan)
        undo(ctx, plan)
    except Exception as rb:  # noqa: BLE001
        log.error("rollback of commit %s failed: %s", plan.commit_id, rb)
        return failure(err, plan.dataset_id, plan.commit_id, f"{err}; rollback failed: {_first_line(rb)}")
    return failure(err, plan.dataset_id, plan.commit_id)


def write_commit(ctx: Context, plan: CommitPlan) -> dict | None:
    """The data write: one Spark job into the attempt's folder. ``None`` on
    success (``plan.n_rows`` set), else the failure outcome after rollback."""
    try:
        mark = {"folder": plan.folder, "dataset_id": plan.dataset_id, "commit_id": plan.commit_id, "started_at": ctx.now()}
        fsys.create_new(ctx.spark, _marker(ctx, plan), encode([mark], STARTED))
        obs = Observation(f"quire-{plan.data_folder}")
        frame = plan.frame.observe(obs, F.count(F.lit(1)).alias("n_rows"), *plan.metrics)
        frame = frame.select(*plan.fields.to_files(frame.schema))
        writer = frame.write.format(plan.fmt).mode("errorifexists").options(**ZONE, **plan.options)
        if plan.partition_by:
            writer = writer.partitionBy(*plan.partition_by)
        ctx.run_hook("write", plan=plan)
        writer.save(plan.folder)
    except Exception as e:  # noqa: BLE001
        err = PublishError(msg.WRITE_FAILED.format(path=plan.folder, error=_first_line(e)), plan.commit_id)
        return rollback(ctx, plan, err)
    try:
        values = obs.get
        plan.n_rows = int(values["n_rows"])
        for check in plan.checks:
            problem = check(values)
            if problem:
                return rollback(ctx, plan, PublishError(problem, plan.commit_id))
        if plan.skip_by and plan.fmt == "parquet" and plan.n_rows:
            write_stats(ctx, plan.dataset_id, plan.data_folder, plan.fields, plan.schema, plan.skip_by, plan.fmt)
            plan.stats = True
        if plan.after_write and (problem := plan.after_write(ctx, plan)):
            return rollback(ctx, plan, PublishError(problem, plan.commit_id))
    except Exception as e:  # noqa: BLE001 - nothing may stay behind unregistered
        return rollback(ctx, plan, PublishError(f"check after write failed: {_first_line(e)}", plan.commit_id))
    return None


def written_rows(ctx: Context, plan: CommitPlan) -> DataFrame:
    """What the attempt wrote, under the columns' names."""
    df = ctx.spark.read.format(plan.fmt).schema(plan.fields.stored_schema(plan.schema)).options(**ZONE).load(plan.folder)
    return df.select(*plan.fields.from_files(plan.schema))


def _replaced_values(ctx: Context, plan: CommitPlan) -> int:
    """Writes the partition values that the commit replaces, as typed columns of a small
    table, and returns how many live rows they hold now. Only partition columns are scanned."""
    names = plan.partition_by
    taken = {n.lower() for n in names}
    rows, mine, n = (_unused(x, taken) for x in ("_n", "_own", "n"))
    parts = [F.col(f"`{p}`") for p in names]
    old = read_state(ctx, plan.state).select(*parts).groupBy(*parts).agg(F.count(F.lit(1)).alias(rows))
    own = written_rows(ctx, plan).select(*parts).distinct().withColumn(mine, F.lit(True))
    same = F.lit(True)
    for p in names:
        same = same & F.col(f"o.`{p}`").eqNullSafe(F.col(f"w.`{p}`"))
    both = old.alias("o").join(own.alias("w"), same, "full_outer")
    both = both.select(*[F.coalesce(F.col(f"o.`{p}`"), F.col(f"w.`{p}`")).alias(p) for p in names], rows, mine)
    hit = F.coalesce(F.col(mine), F.lit(False))
    if plan.partitions_where:
        hit = hit | F.coalesce(F.expr(plan.partitions_where), F.lit(False))
    obs = Observation(f"replaced-{uuid.uuid4().hex}")
    gone = both.filter(hit).observe(obs, F.coalesce(F.sum(rows), F.lit(0)).alias(n), F.count(F.lit(1)).alias(mine))
    target = f"{ctx.replaced_dir(plan.dataset_id)}/commit_id={plan.data_folder}"
    gone.select(*parts).write.mode("overwrite").options(**ZONE).parquet(target)
    plan.replaced, plan.n_hiding = plan.data_folder, int(obs.get[mine])
    return int(obs.get[n])


def hide_places(ctx: Context, plan: CommitPlan, places: DataFrame) -> int:
    """Writes the places (file, row) of rows that the commit hides; returns how many there are."""
    obs = Observation(f"hidden-{uuid.uuid4().hex}")
    target = f"{ctx.hidden_dir(plan.dataset_id)}/commit_id={plan.data_folder}"
    rows = places.hint("rebalance").observe(obs, F.count(F.lit(1)).alias("n"))  # few files, of measured sizes
    rows.write.mode("overwrite").parquet(target)
    plan.hidden, plan.n_hiding = plan.data_folder, int(obs.get["n"])
    return plan.n_hiding


def _hide_where(ctx: Context, plan: CommitPlan) -> int:
    """Hides the live rows that match the predicate now: by their places if they are few, so that reads do not get a filter
    for each replacement; else by the predicate itself."""
    hit = F.coalesce(F.expr(plan.where), F.lit(False))
    plan.hidden = plan.replace_where = None
    if plan.fmt != "parquet":
        plan.replace_where = plan.where
        return read_state(ctx, plan.state).filter(hit).count()
    old = visible(ctx, plan.state, positions=True)
    n = hide_places(ctx, plan, old.df.filter(hit).select(F.col(old.file).alias("file"), F.col(old.row).alias("row")))
    if n > BROADCAST_ROWS:
        fsys.delete(ctx.spark, f"{ctx.hidden_dir(plan.dataset_id)}/commit_id={plan.data_folder}")
        plan.hidden, plan.replace_where = None, plan.where
    return n


def _entry(ctx: Context, plan: CommitPlan, n_removed: int) -> dict:
    """The log row of the commit after ``plan.state``."""
    st, now = plan.state, ctx.now()
    version = (st.version if st else 0) + 1
    carried, later = [], []
    if plan.mode in ("append", "replace", "merge"):
        reset, n_live, total = st.reset_version, st.n_live + 1, st.total_rows
        total = None if total is None else total - n_removed + plan.n_rows
    elif plan.mode == "compact":
        later = [c for c in st.live if c.version > plan.snapshot]
        carried = [{k: getattr(c, k) for k in ("version", "commit_id", "data_folder", "mode")} for c in later]
        reset, n_live, total = version, 1 + len(later), st.total_rows
    else:
        reset, n_live, total = version, 1, plan.n_rows
    fresh = st is None or not st.exists
    return {
        "dataset_id": plan.dataset_id, "version": version, "reset_version": reset, "carried": carried,
        "carried_stats": [c.data_folder for c in later if c.stats],
        "commit_id": plan.commit_id, "data_folder": plan.data_folder, "mode": plan.mode, "committed_at": now,
        "created_at": now if fresh else st.created_at, "n_rows": plan.n_rows, "total_rows": total, "n_live": n_live,
        "replaced": plan.replaced, "n_replaced": plan.n_hiding if plan.replaced else None, "replace_where": plan.replace_where,
        "hidden": plan.hidden, "n_hidden": plan.n_hiding if plan.hidden else None, "fields": plan.fields.text(),
        "stats": plan.stats, "skip_by": [plan.fields.ids[n] for n in plan.skip_by if n in plan.fields.ids],
        "replace_zone": ctx.spark.conf.get("spark.sql.session.timeZone") if plan.replace_where else None,
        "name": plan.name, "description": plan.description, "folder": ctx.dataset_root(plan.dataset_id),
        "format": plan.fmt, "partition_by": plan.partition_by, "tags": plan.tags, "schema_id": plan.schema_id,
        "schema_json": plan.schema.json(), "inputs": plan.inputs,
    }


_CHANGES = ("append", "replace", "merge", "compact")  # commits that build on what is there


def _join_created(plan: CommitPlan, st: DatasetState) -> dict | None:
    """An append that meant to create its dataset, which came to life meanwhile, becomes an append to
    it, if what it wrote has the dataset's columns and layout."""
    old = {f.name: f.dataType for f in st.schema.fields}
    same = all(
        f.name in old and canonical(old[f.name]) == canonical(f.dataType)
        and (plan.fields.ids[f.name], plan.fields.stored[f.name]) == (st.fields.ids[f.name], st.fields.stored[f.name])
        for f in plan.schema.fields
    )
    if not same or plan.partition_by != st.partition_by or plan.fmt != st.format:
        return failure(SchemaMismatchError("another writer created the dataset with another schema or layout meanwhile"), plan.dataset_id, plan.commit_id)
    plan.mode, plan.schema, plan.schema_id, plan.fields = "append", st.schema, st.attrs["schema_id"], st.fields
    return None


def _still_valid(ctx: Context, plan: CommitPlan, base: DatasetState | None) -> dict | None:
    """The mode's rule against the state as it is now; an outcome when it no longer holds."""
    st = plan.state
    since = dataset_log(ctx, plan.dataset_id).filter(F.col("version") > (base.version if base else 0))
    if not since.filter(F.array_contains("fenced", plan.data_folder)).isEmpty():
        return failure(PublishError("the attempt was swept as unfinished while it was at work", plan.commit_id), plan.dataset_id, plan.commit_id)
    if prior := prior_outcome(ctx, plan.dataset_id, plan.commit_id, plan.requested):
        return prior
    if refused := _refusal(plan.mode if plan.mode in _CHANGES else plan.requested, plan.dataset_id, plan.commit_id, st, plan.mode == "overwrite"):
        return refused
    if plan.mode == "overwrite" and plan.requested == "append" and st.exists:
        return _join_created(plan, st)
    if plan.mode in _CHANGES and base is not None:
        kept = ("schema_json", "partition_by", "format", "fields")
        if any(st.attrs[k] != base.attrs[k] for k in kept):
            return failure(SchemaMismatchError("the dataset's schema or layout changed while this commit was written"), plan.dataset_id, plan.commit_id)
    if plan.mode == "compact":
        if st.reset_version != base.reset_version or any(c.mode != "append" for c in st.live if c.version > base.version):
            return failure(PublishError("the dataset was changed while it was compacted", plan.commit_id), plan.dataset_id, plan.commit_id)
    return None


def register(ctx: Context, plan: CommitPlan) -> dict:
    """The commit: the entry with the next free number. Undoes the attempt where the commit
    cannot be made."""
    base = plan.state
    try:
        ctx.run_hook("register", plans=[plan])
        ensure_schema(ctx, plan.schema, plan.schema_id)
        for _ in range(_TRIES):
            n_removed = plan.hide(ctx, plan) if plan.hide else 0
            row = _entry(ctx, plan, n_removed)
            if fsys.create_new(ctx.spark, entry_path(ctx, plan.dataset_id, row["version"]), encode([row])):
                fsys.delete(ctx.spark, _marker(ctx, plan))
                note_version(ctx, plan.dataset_id, row["version"])
                return success(plan, row["version"])
            plan.state = dataset_state(ctx, plan.dataset_id)
            if outcome := _still_valid(ctx, plan, base):
                undo(ctx, plan)
                return outcome
            if plan.mode in _CHANGES and (base is None or not base.exists):  # it has joined what another created
                base = plan.state
        raise QuireError(f"no free version after {_TRIES} tries")
    except Exception as e:  # noqa: BLE001
        text = msg.REGISTER_FAILED.format(correlation_id=plan.commit_id) + f": {_first_line(e)}"
        return rollback(ctx, plan, RegistrationError(text, plan.commit_id))


def change_entry(ctx: Context, dataset_id: str, mode: str, change: Callable[[DatasetState | None], dict | None]) -> dict | None:
    """A commit without data: ``change`` gets the state and gives the fields that differ from the last
    commit's, or None for no commit. Made under the next free number; where another commit takes
    it, ``change`` is asked again."""
    for _ in range(_TRIES):
        st = dataset_state(ctx, dataset_id)
        differs = change(st)
        if differs is None:
            return None
        version, now = (st.version if st else 0) + 1, ctx.now()
        row = {
            "dataset_id": dataset_id, "version": version, "commit_id": str(uuid.uuid4()), "mode": mode, "committed_at": now, "n_rows": 0,
            "inputs": [], "folder": ctx.dataset_root(dataset_id),
        }
        if st is not None:
            row |= {**st.attrs, "reset_version": st.reset_version, "created_at": st.created_at, "total_rows": st.total_rows, "n_live": st.n_live}
        if st is None or not st.exists:  # stays without data
            row |= {"mode": "delete", "reset_version": version, "total_rows": 0, "n_live": 0, "created_at": st.created_at if st else now}
        row |= differs
        if fsys.create_new(ctx.spark, entry_path(ctx, dataset_id, version), encode([row])):
            note_version(ctx, dataset_id, version)
            return row
    raise QuireError(f"no free version after {_TRIES} tries")


def fence(ctx: Context, dataset_id: str, folders: list[str]) -> set[str]:
    """Keeps unfinished attempts from committing: each commit takes the next number of the log, and an attempt
    that finds its number taken looks for its own name here. Those that have committed already
    are left out of the answer."""
    def change(_st) -> dict | None:
        done = {r[0] for r in dataset_log(ctx, dataset_id).filter(F.col("data_folder").isin(folders)).select("data_folder").collect()}
        left[:] = [f for f in folders if f not in done]
        return {"fenced": left} if left else None

    left: list[str] = []
    change_entry(ctx, dataset_id, "fence", change)
    return set(left)


def commit(ctx: Context, plan: CommitPlan) -> dict:
    failed = write_commit(ctx, plan)
    if failed is not None:
        return failed
    if plan.skip_empty and plan.n_rows == 0:
        undo(ctx, plan)
        return {"dataset_id": plan.dataset_id, "commit_id": None, "accepted": True, "status": "empty", "n_rows": 0}
    return register(ctx, plan)


def publish(
    ctx: Context,
    df: DataFrame,
    name: str,
    description: str,
    schema_id=None,
    tags=None,
    dataset_id=None,
    mode: str = "overwrite",
    partition_by=None,
    inputs=None,
    commit_id=None,
    create: bool = False,
    skip_by=None,
    **options,
) -> dict:
    """Publish ``df`` as a commit. Without ``dataset_id`` a new dataset is made.

    Modes on an existing dataset: ``overwrite`` replaces what readers see,
    ``append`` adds rows, ``error`` refuses (outcome ``DatasetExistsError``),
    ``ignore`` does nothing. An append to a dataset that is not there, or no longer, is
    refused (``DatasetNotFoundError``) unless ``create`` is given. A ``commit_id`` that the
    dataset has already writes nothing and returns the stored outcome, so retries count once.
    ``skip_by``: columns of which this and later commits keep statistics, for ``read_where``; by
    default those of the dataset.
    """
    plan = prepare(
        ctx, df, name, description, schema_id, tags, dataset_id, mode, partition_by, inputs, commit_id, create, options, skip_by,
    )
    return plan if isinstance(plan, dict) else commit(ctx, plan)


OUTCOME_SCHEMA = (
    "spec_no int, dataset_name string, dataset_id string, commit_id string, "
    "accepted boolean, status string, error_type string, error string, n_rows bigint"
)


def _spec_ids(spec) -> tuple[str | None, str | None]:
    if not isinstance(spec, dict):
        return None, None
    try:
        return checks.check_dataset_id(spec.get("dataset_id")), checks.check_commit_id(spec.get("commit_id"))
    except TypeError:
        return None, None


def _waves(specs: Sequence, live_before: set[str]) -> list[list[int]]:
    """Spec numbers in waves. Specs of one dataset keep their order across
    waves, one per wave, except that plain appends (no ``mergeSchema``) to a
    dataset live before the batch commute and share the first wave."""
    waves: list[list[int]] = [[]]
    pos: dict[str, int] = {}
    only_appends: dict[str, bool] = {}
    for i, spec in enumerate(specs, start=1):
        ds, _ = _spec_ids(spec)
        if ds is None:
            waves[0].append(i)
            continue
        plain_append = spec.get("mode") == "append" and str(spec.get("mergeSchema", "")).lower() != "true"
        if only_appends.get(ds, ds in live_before) and plain_append:
            only_appends[ds] = True
            pos[ds] = 0
            waves[0].append(i)
            continue
        only_appends[ds] = False
        k = pos[ds] + 1 if ds in pos else 0
        pos[ds] = k
        while len(waves) <= k:
            waves.append([])
        waves[k].append(i)
    return waves


def publish_many(ctx: Context, specs: Sequence[dict], parallelism: int = 4) -> DataFrame:
    """Publish a batch; one outcome row per spec (1-based ``spec_no``).

    Each spec is a dict of :func:`publish` arguments (``df``, ``name``,
    ``description``, ...). Bad arguments are reported, not raised. Several
    specs for one dataset behave as if published one after another: they run
    in successive waves (plain appends to a live dataset commute and share a
    wave). The specs of a wave run ``parallelism`` at a time.
    """
    outcomes: dict[int, dict] = {}
    ids = sorted({ds for ds, _ in map(_spec_ids, specs) if ds})
    states = dict(zip(ids, fsys.each(lambda ds: dataset_state(ctx, ds), ids)))
    live_before = {ds for ds, st in states.items() if st is not None and st.exists}

    def one(i: int) -> dict:
        try:
            spec = specs[i - 1]
            if not isinstance(spec, dict):
                raise TypeError("a spec must be a dict of publish arguments")
            args = dict(spec)
            return publish(ctx, args.pop("df", None), args.pop("name", None), args.pop("description", None), **args)
        except (TypeError, ValueError) as e:
            return failure(e)

    for wave in _waves(specs, live_before):
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            outcomes |= dict(zip(wave, pool.map(one, wave)))

    rows = []
    for i in range(1, len(specs) + 1):
        o = outcomes[i]
        spec = specs[i - 1]
        name = spec.get("name") if isinstance(spec, dict) else None
        rows.append(
            (
                i,
                name if isinstance(name, str) else None,
                o.get("dataset_id"),
                o.get("commit_id"),
                bool(o.get("accepted")),
                o.get("status"),
                o.get("error_type"),
                o.get("error"),
                o.get("n_rows"),
            )
        )
    return ctx.spark.createDataFrame(rows, OUTCOME_SCHEMA)


_UNSTABLE = re.compile(r"current_(?:timestamp|date|time)\(|localtimestamp\(|\bnow\(|scalar-subquery#|exists#|\blist#", re.IGNORECASE)


def referenced(df: DataFrame, where: str) -> list[str]:
    """Columns of a predicate that means the same at every read; others are refused."""
    plan = df.filter(F.expr(where))._jdf.queryExecution().analyzed()
    if not plan.deterministic() or _UNSTABLE.search(plan.expressions().apply(0).toString()):
        raise ValueError(f"a predicate must not depend on time, chance or other tables: {where!r}")
    refs = plan.expressions().apply(0).references().toSeq()
    return [refs.apply(i).name() for i in range(refs.size())]


def replace_partition(ctx: Context, df: DataFrame, dataset_id, where: str, commit_id=None, **options) -> dict:
    """Replace the rows matching the SQL predicate ``where`` with ``df``.

    Nothing old is rewritten: the new commit holds only ``df``. A predicate on partition
    columns alone is resolved to the partition values it holds for now, which are stored as typed columns; any other
    to the places of the rows it holds for. Only where these are very many it is stored as it is and hides older rows at
    every read. It must not depend on time, chance or other tables. Every new row must match ``where``; this is checked in the same pass as the write.
    """
    checks.check_frame(df)
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    if not isinstance(where, str) or not where.strip():
        raise TypeError("where must be a non-empty SQL predicate")
    cid = checks.check_commit_id(commit_id)
    opts = checks.clean_options(options)
    merge = opts.pop("mergeSchema", "false") == "true"
    checks.check_columns(df, [])
    if cid is not None and (prior := prior_outcome(ctx, ds, cid, "replace")):
        return prior
    cid = cid or str(uuid.uuid4())
    state = dataset_state(ctx, ds)
    if refused := _refusal("replace", ds, cid, state, False):
        return refused
    try:
        frame, schema = fit_append(df, state.schema, merge)
        missing = [c for c in state.partition_by if c not in frame.columns]
        if missing:
            raise SchemaMismatchError(f"partition columns missing from the frame: {missing}")
    except SchemaMismatchError as e:
        return failure(e, ds, cid)
    used = referenced(ctx.spark.createDataFrame([], state.schema), where)
    by_partition = bool(used) and set(used) <= set(state.partition_by)
    pred = F.coalesce(F.expr(where), F.lit(False))
    folder = _folder_name(cid)
    return commit(ctx, CommitPlan(
        dataset_id=ds, commit_id=cid, requested="replace", mode="replace",
        frame=guard_partition_values(frame, state.partition_by),
        name=state.attrs["name"], description=state.attrs["description"], tags=dict(state.attrs["tags"] or {}),
        partition_by=state.partition_by, schema=schema,
        schema_id=state.attrs["schema_id"] if schema == state.schema else schema_id_of(schema), fields=state.fields.extended(schema),
        inputs=inputs_of(ctx, df), data_folder=folder, folder=ctx.commit_dir(ds, folder), skip_by=state.skip_by,
        fmt=state.attrs["format"] or ctx.format, options=opts, state=state,
        hide=_replaced_values if by_partition else _hide_where, partitions_where=where if by_partition else None,
        where=None if by_partition else where,
        metrics=[F.sum(F.when(~pred, 1).otherwise(0)).alias("n_outside")],
        checks=[
            lambda v: f"{v['n_outside']} new rows do not match {where!r}" if (v.get("n_outside") or 0) > 0 else None
        ],
    ))


def delete_dataset(ctx: Context, dataset_id) -> dict:
    """A deletion is a commit: readers stop seeing the dataset at once. Then the folders of the
    commits before it go, and no others. What cannot be removed is left to ``sweep_orphans``."""
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    def change(st: DatasetState | None) -> dict | None:
        if st is None or not st.exists:
            return None
        return {"reset_version": st.version + 1, "total_rows": 0, "n_live": 0}

    row = change_entry(ctx, ds, "delete", change)
    if row is None:
        return failure(DatasetNotFoundError(f"no live dataset {ds}"), ds, None)
    cid, version = row["commit_id"], row["version"]
    mark = f"{ctx.started_dir}/{cid}.parquet"
    row = {"folder": ctx.dataset_root(ds), "dataset_id": ds, "commit_id": cid, "started_at": ctx.now()}
    fsys.create_new(ctx.spark, mark, encode([row], STARTED))
    removed = remove_before(ctx, ds, version)
    if removed:
        fsys.delete(ctx.spark, mark)
    return {"dataset_id": ds, "commit_id": cid, "accepted": True, "status": "deleted", "folder_removed": removed}


def remove_before(ctx: Context, dataset_id: str, version: int) -> bool:
    """Removes the data of a deleted dataset's commits before ``version``."""
    spark = ctx.spark
    try:
        rows = dataset_log(ctx, dataset_id).filter((F.col("version") < version) & F.col("data_folder").isNotNull())
        names = [r[0] for r in rows.select("data_folder").toLocalIterator()]
        fsys.each(lambda n: [fsys.delete(spark, d) for d in ctx.attempt_dirs(dataset_id, n)], names)
        for above in ctx.emptied_dirs(dataset_id):
            fsys.delete_if_empty(spark, above)
        return not fsys.exists(spark, ctx.dataset_root(dataset_id))
    except Exception as e:  # noqa: BLE001
        log.warning("dataset %s is deleted from the catalogue; its folders are left: %s", dataset_id, e)
        return False
