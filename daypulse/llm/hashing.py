"""64-bit hashes of words that tell long words apart too."""

from __future__ import annotations

import numpy as np
import xxhash

from daypulse.llm.common import Words

#: Bytes after which the table hash of :class:`Words` repeats its places.
PLACES = 256


def word_hashes(words: Words) -> np.ndarray:
    """A hash of each word; words beyond the table's places are hashed whole."""
    h = words.hashes(None)[0]
    for i in np.flatnonzero(words.end - words.start > PLACES).tolist():
        h[i] = xxhash.xxh64_intdigest(words.buf[words.start[i] : words.end[i]].tobytes(), PLACES)
    return h
