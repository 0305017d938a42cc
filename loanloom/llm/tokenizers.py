"""Where the public tokenizer files are. The folder is a parameter; files are read on the driver and sent with the tasks."""

from __future__ import annotations

import os

FOLDER = "/opt/tokenizers"
#: fixed value: the pre-tokeniser pattern that belongs to the byte-level vocabulary
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def file_bytes(name: str, folder: str = FOLDER) -> bytes:
    with open(os.path.join(folder, name), "rb") as f:
        return f.read()


def byte_bpe(folder: str = FOLDER) -> tuple[bytes, str]:
    """(rank file, pattern) of the byte-level vocabulary."""
    return file_bytes("byte_bpe_50k.tiktoken", folder), BYTE_PATTERN


def pieces(folder: str = FOLDER) -> bytes:
    """The SentencePiece model file (BPE with byte fallback)."""
    return file_bytes("piece_bpe_32k.model", folder)
