"""Results at the borders of a rule: exactly at a threshold."""

import numpy as np
import pytest

from larder.llm import prob_minhash


def plain_set(*keys):
    return np.array(sorted(keys), np.uint64), np.ones(len(keys), np.int64)


def test_similarity_of_exactly_four_fifths():
    for union in range(5, 1001, 5):
        whole, part = plain_set(*range(union)), plain_set(*range(union * 4 // 5))
        assert prob_minhash.similarity(whole, part, 0.8) == 0.8
        less = plain_set(*range(union * 4 // 5 - 1))
        assert prob_minhash.similarity(whole, less, 0.8) < 0.8


def test_weighted_similarity_of_exactly_three_quarters():
    for w in range(1, 40):
        x = np.array([1, 2, 3], np.uint64), np.array([w, 2 * w, w])
        y = np.array([1, 2], np.uint64), np.array([3 * w, 6 * w])
        assert prob_minhash.similarity(x, y, 0.75) == 0.75


@pytest.mark.parametrize("union", [60, 75])
def test_texts_exactly_four_fifths_alike_are_linked(spark, union):
    words = [f"w{i}" for i in range(union + 4)]
    rows = [(1, " ".join(words)), (2, " ".join(words[: union * 4 // 5 + 4]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in prob_minhash.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1}


def test_prefixes_are_cut_without_an_object_per_shingle():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from larder.llm.prob_minhash import _cut_prefix

    rng = np.random.default_rng(3)
    sizes = [0, 1, 5000, 20000, 40000]
    rows = [[(3, int(x), float(y)) for x, y in zip(rng.integers(-9, 9, n), rng.random(n) / max(n, 1), strict=True)] for n in sizes]
    kind = pa.list_(pa.struct([("n", pa.int64()), ("shingle", pa.int64()), ("share", pa.float64())]))
    dicts = [[{"n": n, "shingle": x, "share": y} for n, x, y in row] for row in rows]
    nodes = pa.array([b"%d" % n for n in sizes], pa.binary())
    batch = pa.RecordBatch.from_arrays([nodes, pa.array(dicts, kind)], ["node", "common"]).slice(1)
    plain = []
    for row in rows[1:]:
        shares = np.array([y for _, _, y in row])
        before = 1 - shares.sum() + np.cumsum(shares) - shares
        plain.append([x for (_, x, _), m in zip(row, before, strict=True) if m <= 0.7])
    tracemalloc.start()
    found = list(_cut_prefix(iter([batch]), 0.7))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0]["prefix"].to_pylist() == plain and any(plain)
    assert found[0]["node"].to_pylist() == [b"%d" % n for n in sizes[1:]]
    assert peak < 3 * batch.nbytes
