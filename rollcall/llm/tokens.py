"""Token ids of whole texts, made by a public tokenizer inside Spark tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Words kept per worker in two generations, and the longest one kept: a bound on memory, not on what is encoded.
KEPT_WORDS, KEPT_CHARS = 1_000_000, 40
#: Bytes of text encoded together (or one longer text).
SLICE = 12_000_000
#: Other new words encoded in one call; longer calls cost more for each word.
TOGETHER = 50
#: Marks that may join a letter in front of them to one code point; some join a capital only once it is lowered, or the other way round.
_MARKS = "[\u0300-\u036f]"
#: Letters that are one code point in every normal form and have a lower form of one code point, and a mark behind them.
_UNIT = re.compile("([a-zA-Z\u00c0-\u00d6\u00d8-\u00de\u00df-\u00f6\u00f8-\u00ff]+)([.,]?)").fullmatch


class WordEncoder:
    """Encodes texts word by word with a memory of words met before.

    This tokenizer drops white space and never joins ids across it, so the ids of a text are the ids
    of its white-space-separated words, one after the other. A word of plain letters is one unit of
    the tokenizer's model, as is a stop or comma behind it. Ids are little-endian unsigned 32-bit.
    """

    def __init__(self, path: str, kept_words: int | None = None) -> None:
        self._kept_words = KEPT_WORDS if kept_words is None else kept_words
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        written = self._tokenizer.pre_tokenizer.pre_tokenize_str
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        self._written = str.maketrans({c: written(c)[0][0] for c in letters})  # how the model writes a letter's bytes
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _unit(self, letters: str) -> bytes:
        tokens = self._model.tokenize(letters.lower().translate(self._written))
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words. Those that are no unit are encoded several at a time and told apart by where their ids begin."""
        found, older, others = {}, self._older, []
        for word in words:
            if (ids := older.get(word)) is not None:
                found[word] = ids
            elif unit := _UNIT(word):
                found[word] = self._unit(unit[1]) + self._unit(unit[2]) if unit[2] else self._unit(word)
            elif len(word) > KEPT_CHARS:
                found[word] = np.array(self._ids(word), dtype="<u4").tobytes()
            else:
                others.append(word)
        for at in range(0, len(others), TOGETHER):
            some = others[at : at + TOGETHER]
            encoded = self._tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.cumsum([0, *(len(w) + 1 for w in some)])
            places = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded.ids))
            ends = np.searchsorted(places, begins).tolist()
            data = np.array(encoded.ids, dtype="<u4").tobytes()
            for word, start, end in zip(some, ends, ends[1:], strict=False):
                found[word] = data[4 * start : 4 * end]
        return found

    def _lookup(self, words: list[str]) -> list[bytes]:
        known = self._known
        ids = list(map(known.get, words))
        new = [k for k, i in enumerate(ids) if i is None]
        if new:
            learnt = self._learn([words[k] for k in new])
            for k in new:
                ids[k] = learnt[words[k]]
            if 2 * (len(known) + len(learnt)) > self._kept_words:
                self._older, self._known = known, (known := {})
            known.update((w, i) for w, i in learnt.items() if len(w) <= KEPT_CHARS)
        return ids

    def encode(self, texts: pa.StringArray) -> Iterator[bytes]:
        """The ids of each text, as bytes; null and blank texts have none."""
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE)))
            some = texts.slice(at, upto - at)
            # The tokenizer lowers letters itself, but knows its special marks by their own letters only, and joins letters and marks first.
            as_it_is = pc.or_(pc.match_substring(some, "<|"), pc.match_substring_regex(some, _MARKS))
            words = pc.ascii_split_whitespace(pc.if_else(as_it_is, some, pc.ascii_lower(some)))
            distinct = words.flatten().dictionary_encode()
            ids = pa.array(self._lookup(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary()).take(distinct.indices)
            edges = np.frombuffer(ids.buffers()[1], np.int32)[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist() if len(ids) else [0] * (len(some) + 1)
            data = memoryview(ids.buffers()[2] or b"")
            yield from (data[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False))
            at = upto


@cache
def encoder(path: str, kept_words: int | None = None) -> WordEncoder:
    """One encoder per worker process, tokenizer file and bound on its memory."""
    return WordEncoder(path, kept_words)
