"""Property: any sequence of modes equals a list model; concurrent publishers."""

import threading

from hypothesis import HealthCheck, given, settings, strategies as st

from quire import Context, publish, read_dataset


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["overwrite", "append", "error", "ignore"]), st.integers(0, 3)), min_size=1, max_size=4))
def test_modes_match_list_model(spark, steps):
    ctx = Context.scratch(spark, "model")
    model = None
    ds = None
    for i, (mode, n) in enumerate(steps):
        rows = [(i, j) for j in range(n)]
        df = spark.createDataFrame(rows, "step int, j int")
        if ds is None:
            out = publish(ctx, df, "m", "d", mode="overwrite" if mode == "append" else mode)
            ds = out["dataset_id"]
            model = list(rows)
            continue
        out = publish(ctx, df, "m", "d", dataset_id=ds, mode=mode)
        if mode == "overwrite":
            model = list(rows)
        elif mode == "append":
            model += rows
        elif mode == "error":
            assert out["error_type"] == "DatasetExistsError"
        else:
            assert out["status"] == "ignored"
    got = sorted(tuple(r) for r in read_dataset(ctx, ds).collect())
    assert got == sorted(model)


def test_eight_concurrent_appends(ctx, spark):
    base = spark.range(1000).selectExpr("id", "0 AS w")
    ds = publish(ctx, base, "c", "d")["dataset_id"]
    outs = []

    def work(w):
        df = spark.range(1000).selectExpr("id", f"{w} AS w")
        outs.append(publish(ctx, df, "c", "d", dataset_id=ds, mode="append"))

    threads = [threading.Thread(target=work, args=(w,)) for w in range(1, 9)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert all(o["accepted"] for o in outs), outs
    assert read_dataset(ctx, ds).count() == 9000


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["overwrite", "append", "replace", "delete"]), st.integers(0, 2), st.integers(1, 3)),
        min_size=1,
        max_size=5,
    ),
    st.booleans(),
)
def test_replace_and_versions_match_model(spark, steps, partitioned):
    """Overwrite / append / replace-where / delete against a list model,
    including reads of every earlier version."""
    from quire import delete_dataset, replace_partition

    ctx = Context.scratch(spark, "model2")
    ds = publish(ctx, spark.createDataFrame([(0, 0, 0)], "k int, step int, j int"), "m", "d",
                 partition_by="k" if partitioned else None)["dataset_id"]
    model = [(0, 0, 0)]
    versions = [list(model)]
    deleted = False
    for i, (op, k, n) in enumerate(steps, start=1):
        if deleted:
            break
        rows = [(k, i, j) for j in range(n)]
        df = spark.createDataFrame(rows, "k int, step int, j int")
        if op == "overwrite":
            assert publish(ctx, df, "m", "d", dataset_id=ds, mode="overwrite")["accepted"]
            model = list(rows)
        elif op == "append":
            assert publish(ctx, df, "m", "d", dataset_id=ds, mode="append")["accepted"]
            model += rows
        elif op == "replace":
            assert replace_partition(ctx, df, ds, f"k = {k}")["accepted"]
            model = [r for r in model if r[0] != k] + rows
        else:
            assert delete_dataset(ctx, ds)["accepted"]
            deleted = True
            break
        versions.append(list(model))
    if deleted:
        assert datasets_count(ctx) == 0
        return
    assert sorted(tuple(r) for r in read_dataset(ctx, ds).collect()) == sorted(model)
    for v, want in enumerate(versions, start=1):
        got = sorted(tuple(r) for r in read_dataset(ctx, ds, version=v).collect())
        assert got == sorted(want), (v, steps)
    from quire import catalogue_datasets

    assert catalogue_datasets(ctx).collect()[0]["n_rows"] == len(model)


def datasets_count(ctx):
    from quire import datasets

    return datasets(ctx).count()
