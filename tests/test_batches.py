"""Batches in small parts."""

import pyarrow as pa

from pagemill import batches
from pagemill.functions import splitter as sp
from pagemill.operators import index as ix


def test_parts_are_small_and_whole():
    rows = ["x" * 10_000] * 300 + ["y"] * 700
    batch = pa.RecordBatch.from_pydict({"t": rows})
    cut = list(batches.parts(batch))
    assert [v for p in cut for v in p.column(0).to_pylist()] == rows
    assert max(len(p) for p in cut) <= batches.ROWS
    assert list(batches.parts(batch.slice(0, 0))) == []
    long = pa.array(["z" * (batches.BYTES + 1)] * 3)
    assert [len(p) for p in batches.parts(long)] == [1, 1, 1]


def test_map_parts():
    values = pa.array(["a", None, "b"] * 500)
    seen = []

    def fn(part):
        seen.append(len(part))
        return pa.array([v and v * 2 for v in part.to_pylist()], pa.string())

    assert batches.map_parts(values, fn, pa.string()).to_pylist() == ["aa", None, "bb"] * 500
    assert max(seen) <= batches.ROWS
    assert batches.map_parts(values.slice(0, 0), fn, pa.string()) == pa.array([], pa.string())


def test_chunking_leaves_in_small_batches(monkeypatch):
    """One input batch of many articles does not become one output batch."""
    class Rows:
        sparkSession = None

        def mapInArrow(self, fn, schema):
            return fn

    class Context:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(ix, "ship_package", lambda spark: None)
    monkeypatch.setattr(ix.TaskContext, "get", classmethod(lambda cls: Context))
    run = ix._chunk_ranges(Rows(), False, sp.safe_splitter())
    n = 2000
    batch = pa.RecordBatch.from_pydict({
        "mark": [False] * n, "pos": list(range(n)), "link_key": ["l"] * n, "title": ["t"] * n,
        "publish_date": [None] * n, "text": ["some text"] * n})
    out = list(run(iter([batch])))
    assert max(len(b) for b in out) <= batches.ROWS
    assert [v for b in out for v in b.column(1).to_pylist()] == list(range(n))
