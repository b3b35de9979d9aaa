"""Terms of a text: runs of ASCII letters and digits and of all other than ASCII characters, A-Z in lower case."""

from __future__ import annotations

import numpy as np

from warcloom.llm.arrays import Words

# every byte of a character above U+007F belongs to a term; what separates terms becomes a blank
_TERM = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else (c if c >= 128 else 32) for c in range(256))


def as_terms(text: str | None) -> bytes:
    """The text's terms in UTF-8 at their places, everything else blank; null has none."""
    return (text or "").encode().translate(_TERM)


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all terms in order, number of terms of each text) of texts from ``as_terms``."""
    words = Words(texts)
    return words.hashes, words.counts
