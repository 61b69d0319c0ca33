"""Memory a task needs for the language of texts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from postgrove.llm import language_vectors


def test_a_task_holds_some_ninety_bytes_for_each_of_a_slice():
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyzäöüßéèñ", k=draw.randint(2, 9))) for _ in range(900)]
    texts = [" ".join(draw.choices(words, k=400)) for _ in range(900)]
    assert sum(len(text.encode()) for text in texts) > 2 << 20
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    shared = type("Shared", (), {"value": (["x", "y"], np.ones((2, 1024), np.float32) / 32)})
    tracemalloc.start()
    scored = list(language_vectors._scorer(shared, 1024)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scored[0].num_rows == len(texts)
    assert peak < 90 << 20
