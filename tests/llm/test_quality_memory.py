"""What fitting the quality classifier holds in memory."""

import random
import tracemalloc

import numpy as np
from appkpi.llm import quality


def test_quality_steps_hold_no_copies_of_all_shares(monkeypatch):
    random_ = random.Random(3)
    rows = [("".join(random_.choices("abcdefgh ", k=600)), i % 2) for i in range(600)]
    *shares, y = quality.bucket_shares(rows)
    balance = np.full(len(y), 1 / len(y))
    monkeypatch.setattr(quality, "STEPS", 3)
    tracemalloc.start()
    weights, bias = quality.descend(*shares, y, balance)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * 8 * len(weights) + 64 * quality.PIECE_SHARES
    monkeypatch.setattr(quality, "PIECE_SHARES", 1)
    again = quality.descend(*shares, y, balance)
    assert (again[0] == weights).all() and again[1] == bias
