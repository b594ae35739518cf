"""Where the public vocabularies are: ``public_tokenizers`` if installed, else $TOKENIZER_DIR."""

from __future__ import annotations

import os


def vocabulary(name: str) -> str:
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
