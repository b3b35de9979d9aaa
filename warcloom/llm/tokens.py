"""Ids of the public word tokenizer, chunk by chunk.

The tokenizer's pre-tokens never hold white space and its normaliser works within them, so a text's ids are those of its
chunks between spaces and line ends, one after another. Chunks repeat, so a worker keeps the ids of the first ones, as many
as fit into ``CACHED_BYTES``.
A chunk of Latin letters with at most a full stop or comma after them is two pre-tokens, and lower-casing is all that
the normaliser does to it, so the model gets it as it is.
"""

from __future__ import annotations

import os
import re
from array import array

from tokenizers import Tokenizer, pre_tokenizers

#: Bytes of known chunks that a worker keeps, each with what its entry takes.
CACHED_BYTES, ENTRY_BYTES = 60_000_000, 200
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
_made: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids as unsigned 32-bit bytes in the machine's order, which is little-endian wherever Spark runs."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.room = CACHED_BYTES
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in range(0x61, 0x100) if chr(c).isalpha()}
        self.signs = {x: self._encode(x) for x in (".", ",")} | {"": b""}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One per worker process, so that chunks stay known between batches."""
        if path not in _made:
            _made[path] = cls(path)
        return _made[path]

    def _encode(self, chunk: str) -> bytes:
        if not (word := _WORD.fullmatch(chunk)):
            return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        core = word[1].lower()
        ids = self.known.get(core)
        if ids is None:
            ids = array("I", [x.id for x in self.tokenizer.model.tokenize(core.translate(self.as_bytes))]).tobytes()
            self._keep(core, ids)
        return ids + self.signs[word[2]]

    def _keep(self, chunk: str, ids: bytes) -> None:
        size = ENTRY_BYTES + 4 * len(chunk) + len(ids)
        if size <= self.room:  # what comes later is rare
            self.known[chunk] = ids
            self.room -= size

    def ids(self, text: str) -> bytes:
        chunks = text.replace("\n", " ").split(" ")
        found = list(map(self.known.get, chunks))
        if None in found:
            new = {x: self._encode(x) for x in {x for x, ids in zip(chunks, found, strict=True) if ids is None}}
            for chunk, ids in new.items():
                self._keep(chunk, ids)
            found = [new[x] if ids is None else ids for x, ids in zip(chunks, found, strict=True)]
        return b"".join(found)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
