"""What reaches the tensor product and the driver, and what Python workers hold."""

import importlib.util
import pickle
import subprocess
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa

from vetline.llm import minhash, packing, toxicity
from vetline.llm.queries import tokenizer_path
from vetline.llm.token_ids import TokenIds


def test_only_shared_sub_keys_reach_the_tensor_product(spark):
    m, r = 4, np.random.default_rng(5)
    subs = {n: [int(x) for x in r.integers(0, 6, 2 * m)] for n in range(40)}
    subs |= {n: [1000 * n + i for i in range(2 * m)] for n in range(40, 60)}         # shared with no one
    subs |= {n: [*subs[0][:m], *(1000 * n + i for i in range(m))] for n in (60, 61)}  # of A only
    nodes = spark.createDataFrame([(n, x) for n, x in subs.items()], "node long, sub array<long>").repartition(5)
    keys = minhash._keys(minhash._shared_subs(nodes), m)
    got, wanted = {}, {}
    for x in keys.collect():
        got.setdefault(x["key"], []).append(x["node"])
    for n, x in subs.items():
        for i in range(m):
            for j in range(m, 2 * m):
                wanted.setdefault((i, j, x[i], x[j]), []).append(n)
    many = lambda buckets: Counter(tuple(sorted(b)) for b in buckets.values() if len(b) > 1)     # noqa: E731
    assert many(got) == many(wanted)
    assert {n for b in got.values() for n in b} <= set(range(40))


def test_model_passes_the_driver_packed():
    r = np.random.default_rng(3)
    words = [f"word{i}" for i in range(3000)]
    rows = [(i, " ".join(r.choice(words, 300)).encode(), int(i % 7 == 0)) for i in range(300)]
    hashes = np.unique(toxicity.c.hashed_words([" ".join(words).encode()])[0])
    terms = toxicity.Terms(hashes, np.empty(0, np.uint64))
    model = toxicity.Model(terms, r.random(terms.size).astype(np.float32) + np.float32(0.1), rows)
    of, term, x = model.entries()
    assert len(of) == sum(len(set(t.split())) for _, t, _ in rows) and (np.diff(of * terms.size + term) > 0).all()
    assert np.allclose(np.bincount(of, x.astype(float) ** 2), 1, atol=1e-5)
    there = pickle.dumps(model)
    assert len(there) < 4 * len(of)         # 12 bytes an entry before
    again = pickle.loads(there)
    assert all((a == b).all() for a, b in zip(model.entries(), again.entries()))
    texts = [t for _, t, _ in rows[:70]] + [b"", b"nothing known"]
    assert again.scores(texts, {}) == model.scores(texts, {})


def test_workers_keep_one_table_of_powers():
    spec = importlib.util.find_spec("vetline.llm.common")
    common = importlib.util.module_from_spec(spec)      # as in a new worker
    spec.loader.exec_module(common)
    tracemalloc.start()
    try:
        for n in (1, 2, 3, 1000, 1024, 1025, 70_000, 300_000, 500, 2 ** 19):
            up, down = common.powers(n)
            assert min(len(up), len(down)) >= n and (up[:n] * down[:n] == 1).all()
            assert (up[1:n] == up[:n - 1] * np.uint64(common._BASE)).all()
        del up, down
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 1.2 * 2 * 8 * 2 ** 19         # a table for each size takes more


def test_token_ids_of_large_batches_take_little_memory():
    r = np.random.default_rng(8)
    words = ["".join(map(chr, r.integers(97, 123, n))) for n in r.integers(2, 9, 2000)]
    texts = [" ".join(r.choice(words, 400)) for _ in range(2500)]
    ids_of = TokenIds(tokenizer_path())
    ids_of([" ".join(words)])
    size = sum(map(len, texts))
    assert size > 5_000_000
    tracemalloc.start()
    try:
        got = ids_of(texts)
        peak = tracemalloc.get_traced_memory()[1] - sum(x.nbytes for x in got)
    finally:
        tracemalloc.stop()
    assert peak < 80_000_000, peak
    for i in range(0, len(texts), 250):
        assert got[i].tolist() == ids_of.tok.encode(texts[i], add_special_tokens=False).ids


def test_packing_brings_no_pandas_into_workers():
    code = "import sys, vetline.llm.packing, vetline.llm.token_ids; print('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(packing.__file__).parents[2], capture_output=True, text=True,
                          check=True).stdout == "False\n"


def test_short_pieces_are_fitted_as_arrow():
    t = pa.table({"salt": pa.array([1] * 6, pa.int32()), "bin": pa.array([7, None, None, 5, None, None], pa.int64()),
                  "size": pa.array([60, 50, 60, 45, 90, 40], pa.int64()), "piece_key": pa.array([None, 3, 9, None, 1, 2], pa.int64())})
    got = packing._fit(100, 10, 4)((pa.scalar(1),), t)
    assert got.to_pydict() == {"piece_key": [1, 2, 3, 9], "length": [90, 40, 50, 60], "bin": [11, 5, 15, 7]}
