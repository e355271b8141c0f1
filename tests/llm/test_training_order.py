import numpy as np
import pytest
from pyspark.errors import PySparkException

from quire.llm.common import fresh_path
from quire.llm.training_order import GUARD, RANKS, Feistel, read_training_order, tokenizer, write_training_order


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000, 4097])
def test_permutation(n):
    f = Feistel(n, 9)
    x = f.slot(np.arange(n))
    assert sorted(x.tolist()) == list(range(n)) and f.sequence(x).tolist() == list(range(n))
    if n >= 63:
        assert x.tolist() != Feistel(n, 10).slot(np.arange(n)).tolist()


def test_order_is_spread():
    x = Feistel(100_000, 3).slot(np.arange(100_000))
    assert abs(np.corrcoef(x, np.arange(100_000))[0, 1]) < 0.02


def stream(spark, path):
    rows = sorted(spark.read.parquet(f"{path}/tokens").collect(), key=lambda r: (r.part, r.start))
    return rows, b"".join(bytes(r.ids) for r in rows)


def test_every_token_once_and_resumable(spark, docs_of, odd_rows):
    path = fresh_path(spark, "t")
    layout = write_training_order(docs_of(odd_rows), path, length=64, slots=7)
    rows, all_ids = stream(spark, path)
    enc = tokenizer(RANKS)
    decoded = sorted((str(r.doc_id), enc.decode(np.frombuffer(bytes(r.ids), "<u2")[:-1].tolist())) for r in rows)
    assert decoded == sorted((str(i), t or "") for i, t in odd_rows)
    got = read_training_order(spark, path, layout).collect()
    assert b"".join(bytes(r.ids) for r in sorted(got, key=lambda r: r.sequence)) == all_ids
    assert sorted(r.slot for r in got) == list(range(layout["sequences"]))
    assert all(r.shard == r.slot // 7 and r.offset == r.slot % 7 * (128 + len(GUARD)) for r in got)
    later = read_training_order(spark, path, layout, first_slot=10).collect()
    assert sorted((r.slot, bytes(r.ids)) for r in later) == sorted((r.slot, bytes(r.ids)) for r in got if r.slot >= 10)
    # raw bytes at the stated offset, as any reader would seek them
    files = {r.path.split("shard=")[1].split("/")[0]: bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/shards").collect()}
    for r in got[::5]:
        assert files[str(r.shard)][r.offset : r.offset + 2 * r.n_tokens] == bytes(r.ids)


def test_damaged_shard_fails(spark, docs_of, odd_rows):
    path = fresh_path(spark, "t")
    layout = write_training_order(docs_of(odd_rows), path, length=64, slots=7)
    with pytest.raises(PySparkException, match="bytes, not"):
        read_training_order(spark, path, layout | {"stride": layout["stride"] + 2}).collect()


def test_empty_table(spark, docs_of):
    path = fresh_path(spark, "t")
    layout = write_training_order(docs_of([]), path)
    assert layout["sequences"] == 0 and read_training_order(spark, path, layout).collect() == []
