"""What a Python worker holds when a task is over: Spark keeps it, and it counts beside the heap of its executor."""

import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql.types import LongType

from tallybook.llm import packing, queries
from tallybook.llm.bpe import tokenizer
from tallybook.llm.textkit import lean

ROLLUP = Path("/proc/self/smaps_rollup")

SCRIPT = """
import random, re, sys
import numpy as np, pyarrow as pa
from pyspark.sql.types import LongType, StringType, StructType
from tallybook.llm import ngram_join, toxicity

class Docs:  # gives the function that mapInArrow gets
    schema = StructType().add("id", LongType()).add("text", StringType())
    columns = ["id", "text"]
    select = lambda self, *columns: self
    mapInArrow = lambda self, task, schema: task

class Counts:
    value = np.ones(1 << ngram_join.COUNTER_BITS, np.uint32)

def held():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def batches(n):
    rng = random.Random(n)
    for k in range(n):
        texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300 + rng.randrange(3000))) for _ in range(60)]
        yield pa.record_batch([pa.array(range(60), pa.int64()), pa.array(texts)], names=["id", "text"])

chain = toxicity.ToxicityChain(np.arange(0, 1 << 32, 1 << 20, dtype=np.uint32), ["toxic"],
                               [toxicity.Linear.of(np.zeros(4096), np.zeros(0), 0.0)])
tasks = [toxicity.score_toxicity(Docs(), chain), ngram_join.scan_documents(Docs(), 5)]
sizes = []
for n in (1, 12):
    for task in tasks:
        for out in task(batches(n)):
            del out
    rows = ngram_join.prefix_rows(Docs(), Counts, 5, 75)
    for out in rows(b.select(["text"]) for b in batches(n)):
        del out
    sizes.append(held())
print(*sizes, held())
"""


def test_memory_goes_back_however_a_task_ends(monkeypatch):
    told = []
    monkeypatch.setattr("tallybook.llm.textkit.give_back", lambda: told.append(1))
    assert list(lean(lambda batches: (2 * b for b in batches))(iter([1, 2]))) == [2, 4] and told == [1]
    some = lean(lambda batches: (b for b in batches))(iter([1, 2]))  # as for a limit
    assert next(some) == 1 and told == [1]
    some.close()
    with pytest.raises(ZeroDivisionError):
        list(lean(lambda batches: (1 // b for b in batches))(iter([0])))
    assert told == [1, 1, 1]
    assert list(lean(lambda batches: batches)(iter([]))) == []


@pytest.mark.skipif(not ROLLUP.exists() or sys.platform != "linux", reason="memory is read from /proc")
def test_an_idle_worker_holds_little_more_than_its_modules():
    root = str(Path(__file__).resolve().parents[2])
    base = "import re, numpy, pyarrow, pyspark.sql\n" + SCRIPT[SCRIPT.index("def held"):SCRIPT.index("def batches")] + "print(held())"
    run = lambda code: subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": root}, check=True,
                                      capture_output=True, text=True, timeout=120).stdout.split()
    modules, (first, last, _) = float(run(base)[0]), map(float, run(SCRIPT))
    assert last - modules < 75, (modules, first, last)  # 45 MB; 112 MB without giving back


def test_a_packing_task_leaves_no_cache_of_pieces(monkeypatch):
    class Docs:
        schema = {"doc_id": type("Field", (), {"dataType": LongType()})}
        select = lambda self, *columns: self
        mapInArrow = lambda self, task, schema: task

    monkeypatch.setattr(packing, "F", type("F", (), {"col": str}))
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    paths = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("byte_bpe_50k.tiktoken")
    task = packing.pack_documents(Docs(), *paths)
    batch = pa.record_batch([pa.array([1, 2], pa.int64()), pa.array(["some words here", None])], names=["doc_id", "text"])
    first, again = ([b.to_pydict() for b in task(iter([batch]))] for _ in range(2))
    assert first == again and sum(first[0]["length"]) > 3
    assert tokenizer(*paths).keys is None and tokenizer(*paths).pool is None
