"""Where the public vocabulary files are. They are read from there and never copied."""

from __future__ import annotations


def tokenizer_path(name: str, folder: str | None = None) -> str:
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)
