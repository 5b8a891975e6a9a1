"""Where the public vocabularies are; operators take them as parameters."""

from __future__ import annotations

import json

import public_tokenizers


def added_tokens(path: str) -> dict[str, int]:
    """Marks of a vocabulary that are one token each wherever a text holds them."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


# (file of ranks, pattern of pieces); with the added tokens the same ids as the library ``tokenizers`` gives with byte_bpe_50k.json.
BYTE_BPE = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
BYTE_BPE_ADDED = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")
