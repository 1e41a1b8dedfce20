"""Token ids of whole texts by the public vocabulary files, with a cache of words inside the task."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

from appkpi.llm.words import PIECE_BYTES, _tables, mix

# Rows whose texts are cut together.
GROUP_ROWS = 64
# Words a worker remembers, some 25 bytes each; when there are more, all of them go. No result changes.
CACHED_WORDS = 1 << 20
# Longer words are not remembered there.
LONG_WORD = 256
# Words that ``Words`` remembers. When half of them are new, those not met since the last time go.
SPELLED_WORDS = 400_000

# Letters, numbers and blanks for which every library agrees on case, composition and classes.
# A text with any other sign is given to the tokenizer whole.
LETTERS, NUMBERS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
UNUSUAL = "[^\\t-\\r -įı-ɏ]"

# How the two vocabularies cut a text into words, over the signs above.
BYTE_LEVEL_WORDS = (
    rf" ?[{LETTERS}]++|'(?:[stmd]|re|ve|ll)| ?[{NUMBERS}]++"
    rf"| ?[^{BLANKS}{LETTERS}{NUMBERS}]++|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
LOWER_CASE_WORDS = (
    rf"[{LETTERS}]++|'(?:[stmd]|re|ve|ll)|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]++"
)
# Bytes of the signs below U+0100 that are not unusual.
USUAL_BYTES = bytes([*range(9, 14), *range(32, 256)])
# What a sign is; the last one parts texts that are cut together, which are free of it.
OTHER, LETTER, NUMBER, BLANK, BORDER = range(5)
LAST_USUAL = 0x24F


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return letters


class Words(dict):
    """Ids of a word as little-endian 16-bit bytes, made when first asked for."""

    def __init__(self, ids_of) -> None:
        super().__init__()
        self.ids_of = ids_of
        self.before: dict[str, bytes] = {}

    def made(self, word: str) -> bytes:
        import array

        return array.array("H", self.ids_of(word)).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.made(word)
        if len(self) >= SPELLED_WORDS // 2:
            self.before = self.copy()
            self.clear()
        self[word] = ids
        return ids


class KnownWords:
    """Ids of words by 64-bit hash, in flat arrays: thousands of words are looked up in a few passes.

    Words of up to ``LONG_WORD`` signs; shorter ones do not share a hash but by a chance of 2**-64 for each pair.
    """

    def __init__(self) -> None:
        self.bits = (2 * CACHED_WORDS - 1).bit_length()
        self.clear()

    def clear(self) -> None:
        import array

        import numpy as np

        # Slots; 0 is a free one. Pages are taken as they fill.
        self.hashes = np.zeros(1 << self.bits, np.uint64)
        self.numbers = np.zeros(1 << self.bits, np.int32)
        self.ends = array.array("q", [0])
        self.ids = array.array("H")

    def find(self, hashes):
        """The slot of each hash, or -1."""
        import numpy as np

        slots = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        while len(left):
            there = self.hashes[slots]
            hit = there == hashes[left]
            out[left[hit]] = slots[hit]
            more = ~hit & (there != 0)
            left, slots = left[more], (slots[more] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, hashes, words: list[bytes]) -> None:
        """Different hashes that are not there yet, with their words' ids."""
        import numpy as np

        if len(self.ends) + len(words) > CACHED_WORDS:
            self.clear()
        numbers = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words)) // 2
        self.ends.frombytes((self.ends[-1] + np.cumsum(sizes)).tobytes())
        self.ids.frombytes(b"".join(words))
        slots = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(hashes):
            free = self.hashes[slots] == 0
            self.hashes[slots[free]] = hashes[free]
            # Of those that wanted one free slot, one has it now.
            put = free & (self.hashes[slots] == hashes)
            self.numbers[slots[put]] = numbers[put]
            hashes, numbers = hashes[~put], numbers[~put]
            slots = (slots[~put] + 1) & ((1 << self.bits) - 1)

    def gather(self, slots):
        """The ids of the words in these slots, one after another, and how many each has."""
        import numpy as np

        numbers, ends = self.numbers[slots], np.frombuffer(self.ends, np.int64)
        begin = ends[numbers]
        sizes = ends[numbers + 1] - begin
        before = np.cumsum(sizes) - sizes
        places = np.repeat(begin - before, sizes) + np.arange(int(sizes.sum()))
        return np.frombuffer(self.ids, np.uint16)[places], sizes


@lru_cache(maxsize=1)
def _kinds():
    """For each usual sign, what it is."""
    import numpy as np

    kinds = np.full(LAST_USUAL + 1, OTHER, np.int8)
    for kind, signs in ((LETTER, LETTERS), (NUMBER, NUMBERS), (BLANK, BLANKS)):
        is_kind = re.compile(f"[{signs}]").match
        kinds[[c for c in range(LAST_USUAL + 1) if is_kind(chr(c))]] = kind
    kinds[0] = BORDER
    return kinds


def cut_points(codes, kinds, spaced: bool):
    """Where the words begin, as the two fixed patterns cut usual texts that end with a border each.

    ``spaced``: as ``BYTE_LEVEL_WORDS``, else as ``LOWER_CASE_WORDS``; blanks and borders are cut off too.
    """
    import numpy as np

    n = len(codes)
    start = np.ones(n, bool)
    start[1:] = kinds[1:] != kinds[:-1]
    start[kinds == BORDER] = True
    if spaced:
        # The last blank before a sign stands alone; a space goes with the sign.
        ends = np.flatnonzero(start & (kinds != BLANK) & (kinds != BORDER))
        ends = ends[ends > 0]
        ends = ends[kinds[ends - 1] == BLANK]
        start[ends - 1] = True
        start[ends[codes[ends - 1] == 32]] = False
    else:
        start[kinds == NUMBER] = True
    # Endings such as 's, where a word begins with the apostrophe.
    marks = np.flatnonzero((codes == ord("'")) & start)
    if len(marks):
        # A text's border comes at the latest two signs on, and is no letter.
        one, two = codes[marks + 1], codes[np.minimum(marks + 2, n - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
        for found, size in ((marks[short], 2), (marks[long], 3)):
            start[found + 1] = False
            start[found + size] = True
    return np.flatnonzero(start)


class LibraryCoder:
    """The ids that the tokenizers library gives, as 16-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        lower = self.tokenizer.normalizer is not None
        self.lower = str.lower if lower else str
        self.cut = re.compile(LOWER_CASE_WORDS if lower else BYTE_LEVEL_WORDS).findall
        self.unusual = re.compile(UNUSUAL).search
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in special)).search
        letters = byte_letters()
        shown, model = {b: letters[b] for b in range(256)}, self.tokenizer.model

        def ids_of(word: str) -> list[int]:
            if word.isascii() and word.isprintable():
                spelled = word.replace(" ", letters[32])
            else:
                spelled = word.encode().decode("latin-1").translate(shown)
            return [t.id for t in model.tokenize(spelled)]

        self.spaced = not lower
        self.words = Words(ids_of)
        self.known = KnownWords()

    def encode(self, text: str) -> bytes:
        if self._needs_library(text):
            import array

            return array.array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.words.__getitem__, self.cut(self.lower(text))))

    def _needs_library(self, text: str) -> bool:
        try:
            unusual = text.encode("latin-1").translate(None, USUAL_BYTES)
        except UnicodeEncodeError:
            unusual = self.unusual(text)
        return bool(unusual or self.special(text))

    def encode_all(self, texts: Iterable[str]) -> list[bytes]:
        """As ``encode`` of each. Texts are cut together, and a word they share is looked up once."""
        out: list[bytes] = []
        held: list[str] = []
        places: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if len(text) >= PIECE_BYTES or self._needs_library(text):
                out.append(self.encode(text))
                continue
            text = self.lower(text)
            if size + len(text) + 1 > PIECE_BYTES:
                self._encode_into(out, places, held)
                held, places, size = [], [], 0
            held.append(text)
            places.append(i)
            size += len(text) + 1
            out.append(b"")
        if held:
            self._encode_into(out, places, held)
        return out

    def _encode_into(self, out: list[bytes], places: list[int], texts: list[str]) -> None:
        import numpy as np

        joined = "\0".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        kinds = _kinds()[codes]
        starts = cut_points(codes, kinds, self.spaced)
        borders = np.flatnonzero(kinds[starts] == BORDER)
        ends = np.append(starts[1:], len(codes))
        wanted = kinds[starts] != BORDER if self.spaced else (kinds[starts] != BORDER) & (kinds[starts] != BLANK)
        # How many words come before the end of each text.
        upto = np.concatenate([[0], np.cumsum(wanted)])[borders]
        starts, ends = starts[wanted], ends[wanted]
        if (ends - starts).max(initial=0) > LONG_WORD:
            for place, text in zip(places, texts, strict=True):
                out[place] = b"".join(map(self.words.__getitem__, self.cut(text)))
            return
        # As in ``hash_words``.
        up, down, _ = _tables()
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
        hashes = mix(((sums[ends] - sums[starts]) * down[starts]) ^ (ends - starts).astype(np.uint64))
        hashes[hashes == 0] = 1
        # Again where adding has cleared the words that were there.
        while (new := np.flatnonzero((slots := self.known.find(hashes)) < 0)).size:
            different, first = np.unique(hashes[new], return_index=True)
            spans = zip(starts[new[first]].tolist(), ends[new[first]].tolist(), strict=True)
            self.known.add(different, [self.words.made(joined[a:b]) for a, b in spans])
        ids, sizes = self.known.gather(slots)
        stop = np.concatenate([[0], np.cumsum(sizes)])
        raw, at = ids.tobytes(), 0
        for place, end in zip(places, (2 * stop[upto]).tolist(), strict=True):
            out[place] = raw[at:end]
            at = end


def encoded(coder: LibraryCoder, rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows that end with a text, which may be null, with the text's ids for the text."""
    while group := list(islice(rows, GROUP_ROWS)):
        ids = coder.encode_all(r[-1] or "" for r in group)
        yield from ((*r[:-1], i) for r, i in zip(group, ids, strict=True))


@lru_cache(maxsize=4)
def library_coder(path: str) -> LibraryCoder:
    return LibraryCoder(path)
