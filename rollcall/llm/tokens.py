"""Token ids of whole texts by a public tokenizer, inside Spark tasks."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np

CACHE_WORDS = 300_000
CACHE_UNITS = 250_000

# texts of these characters only are cut into units here; all others go to the tokenizer whole
PLAIN = re.compile(r"[\n\t\x20-\x7eÀ-ÖØ-öø-ÿ]*")
# fixed values: the tokenizer's own units, for lower-case texts of plain characters
UNIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\n\t a-zß-öø-ÿ0-9]+")


class Encoder:
    """A tokenizer file with a bounded cache of the ids of single units.

    The tokenizer lowers a text, cuts it into units (words, digits, runs of other
    signs) and encodes each by itself, so the ids of a text are the ids of its
    units in order. No unit has white space, so words are remembered as well as
    units, and a unit goes through the tokenizer once while it is remembered. Texts
    with characters beyond ``PLAIN``, or with control strings, go through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.last = np.zeros(self.vocabulary, dtype=bool)  # ids that end a unit
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.last[number] = token.endswith("</w>")
        self.by_units = self._check_units()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in made]

    def _encoded_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, from one text of them all, cut after the ids that end a unit."""
        ids = np.frombuffer(self._encoded([" ".join(units)])[0], dtype="<u4")
        ends = np.nonzero(self.last[ids])[0] + 1
        if len(ends) != len(units):
            return self._encoded(units)
        data, places = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(places, places[1:])]

    def _check_units(self) -> bool:
        """Whether this tokenizer's units are the ones above; others encode whole texts."""
        probe = "It's 42 été,\n\tWE'LL don't--a_b!! x's'' (ÄÖ) aßb Maßÿø 3.14"
        return b"".join(self._encoded(UNIT.findall(probe.lower()))) == self._encoded([probe])[0]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.by_units or "<|" in text or not PLAIN.fullmatch(text):
            return self._encoded([text])[0]
        words = text.lower().split()
        parts = list(map(self.words.get, words))
        if None in parts:
            missing = [i for i, p in enumerate(parts) if p is None]
            more = self._of_units(list({words[i] for i in missing}))
            for i in missing:
                parts[i] = more[words[i]]
            if len(self.words) < CACHE_WORDS:  # the frequent words have come by then
                self.words.update(more)
        return b"".join(parts)

    def _of_units(self, words: list[str]) -> dict[str, bytes]:
        parts, units = [UNIT.findall(w) for w in words], self.units
        wanted = set(chain.from_iterable(parts))
        new = [u for u in wanted if u not in units]
        if len(units) + len(new) > CACHE_UNITS:
            units.clear()
            new = list(wanted)
        units.update(zip(new, self._encoded_units(new), strict=True))
        return {w: b"".join([units[u] for u in p]) for w, p in zip(words, parts, strict=True)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker, kept between its tasks."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
