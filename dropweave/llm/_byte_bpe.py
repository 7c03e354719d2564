"""A byte-level BPE vocabulary file as an encoder."""

from __future__ import annotations

import json

# Fixed value: what a byte-level vocabulary's pre-tokenizer takes as a word.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else the next one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level(vocabulary: bytes) -> tuple:
    """An encoder without special tokens, and the bytes of every id.

    The ids of the vocabulary must follow its merges, so that an id is a rank; others are a ``ValueError``.
    """
    import tiktoken
    model, letters = json.loads(vocabulary)["model"], byte_letters()
    words = [b""] * (max(model["vocab"].values()) + 1)
    for word, rank in model["vocab"].items():
        words[rank] = bytes(map(letters.__getitem__, word))
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != list(range(256, 256 + len(merged))):
        raise ValueError("ids of the vocabulary do not follow its merges")
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks={w: i for i, w in enumerate(words)}, special_tokens={}), words
