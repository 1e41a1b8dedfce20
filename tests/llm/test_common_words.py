"""Which words the toxicity classifier learns."""

import numpy as np
from appkpi.llm import toxicity


def test_common_words_are_told_without_hashing_every_text(monkeypatch):
    random_ = np.random.default_rng(2)
    sample = [random_.integers(0, 40, (3, n)) for n in (0, 1, 5, 60, 60, 60, 60, 60)]
    sample.append(sample[-1])
    words = [(at[0] << toxicity.TABLE_BITS) | at[1] for at in sample]
    texts = {}
    for own in {w.tobytes(): w for w in words}.values():
        for w in set(own.tolist()):
            texts[w] = texts.get(w, 0) + 1
    calls = []
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **k: calls.append(1) or unique(*a, **k))
    found = toxicity.common_words(sample)
    assert [f.tolist() for f in found] == [[texts[x] >= toxicity.LEAST_TEXTS for x in w.tolist()] for w in words]
    assert len(calls) <= 1
