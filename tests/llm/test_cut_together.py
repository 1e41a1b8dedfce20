"""Texts cut together have the ids that each has by itself."""

import random

import pytest
from appkpi.llm import tokens
from appkpi.llm.tokens import LibraryCoder, encoded, vocabulary_path

SIGNS = ["a", "B", "é", "ß", "'", "'s", "'ll", "'re", "'v", "e", "1", "23", ".", "--", " ", " ", "\n", "\t", "\xa0", "ǰ"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_cut_together_have_the_librarys_ids(name, monkeypatch):
    # So few words are remembered that they go again and again.
    monkeypatch.setattr(tokens, "CACHED_WORDS", 1 << 10)
    coder, random_ = LibraryCoder(vocabulary_path(name)), random.Random(5)
    usual = ["".join(random_.choices(SIGNS, k=random_.randint(0, 12))) for _ in range(400)]
    texts = [None, "", *usual, "x" * 300, "一 <|endoftext|>", "a\x1fb", "\n\n", " \n 's"]
    found = [i for _, i in encoded(coder, iter([(n, x) for n, x in enumerate(texts)]))]
    plain = [coder.tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert [list(memoryview(i).cast("H")) for i in found] == plain
