"""Public tokenizers inside tasks: loaded once per Python worker, from a path parameter.

The byte-level vocabulary is read from the tokenizers library's own JSON file and run by
tiktoken, whose regular expression, ranks and special token are taken from that file; both
give the same ids (tested), tiktoken several times faster.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

#: Fixed value: the split pattern of byte-level vocabularies of this family.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                      r"|\s+(?!\S)|\s+")


def default_path(name: str) -> str:
    """Where the installed public vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def byte_chars() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, others follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    out.update({chr(256 + i): b for i, b in enumerate(hidden)})
    return out


@lru_cache(maxsize=4)
def byte_level(path: str):
    """(encoder, special tokens) of a byte-level JSON vocabulary."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    alphabet = byte_chars()
    ranks = {bytes(alphabet[c] for c in token): at
             for token, at in spec["model"]["vocab"].items() if token not in added}
    return tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                             special_tokens=added), added


def encode(path: str, text: str) -> np.ndarray:
    """Ids of one text as unsigned 32-bit integers.

    Runs of white space too long for the library's regular expression (it raises an error) are
    encoded by the rank-array encoder, which gives the same ids.
    """
    try:
        return byte_level(path)[0].encode_to_numpy(text, allowed_special="all")
    except ValueError:
        from fieldcast.llm import bpe

        return bpe.encoder(path).encode([text])[0]


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    alphabet = byte_chars()
    vocab = spec["model"]["vocab"]
    out = [b""] * (max([*vocab.values(), *added], default=-1) + 1)
    for token, at in vocab.items():
        out[at] = added[at] if at in added else bytes(alphabet[c] for c in token)
    for at, raw in added.items():
        out[at] = raw
    return out
