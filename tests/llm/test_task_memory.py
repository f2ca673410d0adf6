"""What a task of the corpus operators holds at most, and gives back at its end."""

import gc
import tracemalloc
import weakref
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyspark
import pytest

from alarmloom.llm import common, packing


class Rows:
    """Stands for a table: keeps the function that its tasks would run."""

    rdd = SimpleNamespace(getNumPartitions=lambda: 1)

    def mapInArrow(self, function, schema):
        self.function = function
        return self

    def __getattr__(self, name):
        return lambda *_, **__: self


def counters(slots_of, batches, width, monkeypatch):
    rows = Rows()
    common.slot_counts(rows, slots_of, width)
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    total = np.zeros(-(-width // common.SEGMENT) * common.SEGMENT, np.uint32)
    for made in rows.function(iter(batches)):
        at = made.column("segment")[0].as_py() * common.SEGMENT
        total[at : at + common.SEGMENT] += common.unpacked(made.column("counts")[0].as_py())
    return total


def test_slots_of_a_task_take_little_memory(spark, monkeypatch):
    width, each = 1 << 22, 1 << 17

    def slots_of(batch):
        yield common.mixed(np.arange(each, dtype=np.uint64) + np.uint64(batch * each)) >> np.uint64(42)

    tracemalloc.start()
    found = counters(slots_of, range(33), width, monkeypatch)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = np.bincount(np.concatenate([s for b in range(33) for s in slots_of(b)]).astype(np.int64), minlength=width)
    assert (found == expected).all()
    # The counters found here are 16 MB of it; waiting slots and one sorted copy may take 32.
    assert most < 80 << 20


@pytest.mark.parametrize("width", [1, 65536, 65537, 200000])
def test_slots_are_counted_at_the_edges_of_segments(spark, width, monkeypatch):
    edges = [x for x in (0, 1, 65535, 65536, 131071, 131072, width - 1) if x < width]
    slots = [np.array(edges * 3, np.uint64), np.zeros(0, np.uint64), np.array([width - 1], np.int64)]
    found = counters(lambda batch: iter(slots), [None], width, monkeypatch)
    assert found.sum() == sum(map(len, slots))
    assert (found[:width] == np.bincount(np.concatenate(slots).astype(np.int64), minlength=width)).all()


def test_a_packing_task_drops_its_words_before_it_gives_memory_back(spark, monkeypatch):
    held, alive = [], []

    def release():
        gc.collect()
        alive.append(held[0]() is not None)

    class Encoder:
        def __call__(self, texts):
            return [b"\x07\0\0\0" for _ in texts]

    def encoder(path):
        made = packing._ENCODERS[path] = Encoder()
        held.append(weakref.ref(made))
        return made

    monkeypatch.setattr(packing, "encoder", encoder)
    monkeypatch.setattr(packing.common, "release", release)

    class Docs(Rows):
        columns = ["doc_id", "text"]

        def select(self, *columns):
            return self

    docs = Docs()
    packing.pieces(docs, "vocabulary", remember=False)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"a"])], ["doc_id", "text"])
    made = list(docs.function(iter([batch])))
    assert made[0].num_rows == 1
    assert alive == [False]


def test_a_packing_task_that_forgets_works_in_short_slices(spark, monkeypatch):
    class Docs(Rows):
        columns = ["doc_id", "text"]

        def select(self, *columns):
            return self

    def most(remember):
        docs, sizes, made = Docs(), [], packing.Encoder(packing.vocabulary())
        monkeypatch.setattr(packing, "encoder", lambda path: made)
        own = made._encode
        monkeypatch.setattr(made, "_encode", lambda texts: sizes.append(sum(map(len, texts))) or own(texts))
        packing.pieces(docs, "vocabulary", remember=remember)
        texts = [f"word{i % 50} and {i} more ".encode() * 2000 for i in range(150)]
        batches = [
            pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t])], ["doc_id", "text"])
            for i, t in enumerate(texts)
        ]
        found = pa.Table.from_batches(list(docs.function(iter(batches)))).to_pylist()
        return max(sizes), made.most, found

    short, long = most(False), most(True)
    assert short[0] < 2 * packing.SHORT_SLICE < packing.SLICE < long[0] * 2
    assert (short[1], long[1]) == (packing.FEW_REMEMBERED, packing.REMEMBERED)
    assert short[2] == long[2]
