"""Ids of whole texts under a tokenizer whose tokens never cross white space.

The tokenizer file is one of the ``tokenizers`` library whose pre-tokenizer drops white
space. Its ids of a text are then those of the words one after another, so a task
encodes each different word once and looks the rest up. The table of words is bounded
(``CACHED_WORDS``; it starts anew when full), which changes the time and never the ids.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from longform.llm.wordhash import WordTable, groups, split_words, utf8

CACHED_WORDS = 700_000
#: New words are encoded so many at a time, with a special token between them.
JOINED_WORDS = 64
#: Fixed value: the pattern by which the public word-level file cuts normalised text.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of Latin letters, perhaps with a comma or full stop: each part is one word to that pattern.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = [(i, t.content) for i, t in self._tokenizer.get_added_tokens_decoder().items() if t.special]
        self._cut_id, self._cut = special[0] if special else (None, None)
        rules = json.loads(self._tokenizer.to_str())
        steps = [x.get("type") for x in (rules["normalizer"] or {}).get("normalizers", [])]
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        # with these rules a plain word goes to the model as it is, in lower case
        self._plain = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": WORD_PATTERN}
            and not cuts[1]["add_prefix_space"]
        )
        self._letters, self._marks, self._model = _byte_letters(), {}, self._tokenizer.model
        self.n_ids = 1 + max(self._tokenizer.get_vocab(with_added_tokens=True).values())
        self._table = WordTable(self._encode_words, np.uint32, CACHED_WORDS)

    def _encode_words(self, words: list[bytes]) -> list:
        texts = [w.decode("utf-8", "replace") for w in words]
        out: list = [None] * len(texts)
        # a special token ends what stands before it, so words joined by one are encoded as if alone
        for i, t in enumerate(texts) if self._plain else ():
            if plain := PLAIN.fullmatch(t):
                out[i] = self._model_ids(plain[1].lower()) + (self._mark(plain[2]) if plain[2] else [])
        alone = [i for i, t in enumerate(texts) if out[i] is None and (self._cut is None or self._cut in t)]
        for i, e in zip(alone, self._tokenizer.encode_batch([texts[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = np.asarray(e.ids, np.uint32)
        rest = [i for i, x in enumerate(out) if x is None]
        runs = [rest[k : k + JOINED_WORDS] for k in range(0, len(rest), JOINED_WORDS)]
        joined = [self._cut.join([texts[i] for i in run]) for run in runs]
        for run, e in zip(runs, self._tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.asarray(e.ids, np.uint32)
            cuts = np.flatnonzero(ids == self._cut_id).tolist()
            for i, a, b in zip(run, [-1, *cuts], [*cuts, len(ids)], strict=True):
                out[i] = ids[a + 1 : b]
        return out

    def _model_ids(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._letters)
        return [t.id for t in self._model.tokenize(word)]

    def _mark(self, mark: str) -> list[int]:
        if mark not in self._marks:
            self._marks[mark] = self._model_ids(mark)
        return self._marks[mark]

    def encode(self, texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For groups of the texts in order: all their ids, and the number of ids of each text."""
        data = [utf8(t) for t in texts]
        for part in groups(data):
            yield self._table.look_up(split_words(data[part]))

    def encode_each(self, texts: list) -> list[np.ndarray]:
        return [x for ids, n in self.encode(texts) for x in np.split(ids, np.cumsum(n)[:-1])]

    def forget(self) -> None:
        """Drop the words known so far."""
        self._table.clear()

    def count(self, texts: list) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *[n for _, n in self.encode(texts)]])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and file."""
    return WordEncoder(path)
