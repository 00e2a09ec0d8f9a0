"""Encoders of public vocabulary files, one for each worker process.

A byte-level BPE file of the tokenizers library whose ids follow its merges is read by tiktoken as well, which gives the
same ids in about a quarter of the time; every other file is read by its own library.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from pathlib import Path

#: The split pattern that the tokenizers library has for ByteLevel with use_regex (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_BPE = "byte_bpe_50k.json"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=4)
def version(path: str) -> str:
    """A digest of all that decides the ids: the file and how it is read."""
    return hashlib.sha256(b"ordinary text, added tokens as in the file\n" + Path(path).read_bytes()).hexdigest()


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_encoding(path: str):
    """A tiktoken Encoding with the ids of a byte-level BPE file, or None where these need the file's own library."""
    if not path.endswith(".json"):
        return None
    import tiktoken

    file = json.loads(Path(path).read_text(encoding="utf-8"))
    model, before, added = file["model"], file["pre_tokenizer"] or {}, file["added_tokens"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if file["normalizer"] or {k: before.get(k) for k in plain} != plain or model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
        return None
    if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added) or file.get("truncation") or file.get("padding"):
        return None
    symbols, special = byte_symbols(), {x["content"]: x["id"] for x in added}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    ids = [model["vocab"][m] for m in merges]
    if any(a >= b for a, b in zip(ids, ids[1:])) or len(set(merges)) != len(merges):
        return None
    ranks = {bytes(symbols[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    if sum(len(x) == 1 for x in ranks) != 256 or len(ranks) != 256 + len(merges) or min(ids) < max(i for x, i in ranks.items() if len(x) == 1):
        return None
    return tiktoken.Encoding(Path(path).stem, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def counter(path: str):
    """A function from a list of texts to their numbers of tokens, special strings read as the library does by default."""
    if (fast := byte_encoding(path)) is not None:
        return lambda texts: [len(fast.encode(t, allowed_special="all")) for t in texts]
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
