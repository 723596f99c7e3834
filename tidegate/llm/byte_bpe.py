"""Ids of many short texts by a byte-level tokenizer file.

A file whose ids rise in the order of its merges is the same thing as a table of ranks, which
the rank library encodes several times faster per call. Files that are not, and texts that
hold a special token's string where it counts as one, go to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pattern by which byte-level tokenizers split a text ahead of the merges.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_MODEL = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")


def byte_characters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself where it is
    printable, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Ranks that encode as the file does, None where there are none."""
    with open(path, encoding="utf-8") as file:
        layout = json.load(file)
    model, split = layout["model"], layout.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or layout.get("normalizer") or any(model.get(k) for k in PLAIN_MODEL):
        return None
    if model.get("ignore_merges") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    vocab, of = model["vocab"], byte_characters()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    special = {t["content"] for t in layout.get("added_tokens", [])}
    ranks = {
        bytes(of[c] for c in t): i for t, i in vocab.items() if t not in special and all(c in of for c in t)
    }
    whole = len(ranks) == 256 + len(merges) and all(bytes([b]) in ranks for b in range(256))
    first = max((ranks[bytes([b])] for b in range(256)), default=-1) if whole else -1
    rising = all(x < y for x, y in zip([first, *made], made))
    return ranks if whole and rising else None


def byte_level_encoder(path: str, special_as_text: bool = False) -> Callable[[list[bytes]], list[list[int]]]:
    """A function from texts to their ids, without special tokens added. With special_as_text
    the strings of special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    special = [] if special_as_text else [t["content"].encode() for t in added]
    ranks = ranks_of(path)
    fast = None
    if ranks is not None:
        fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    loaded: list[Tokenizer] = []

    def encode(texts: list[bytes]) -> list[list[int]]:
        if fast is None:
            return slow(texts)
        odd = [i for i, t in enumerate(texts) if any(s in t for s in special)] if special else []
        out = [fast(t.decode("utf-8", "replace")) for t in texts]
        if odd:
            for i, ids in zip(odd, slow([texts[i] for i in odd])):
                out[i] = ids
        return out

    def slow(texts: list[bytes]) -> list[list[int]]:
        if not loaded:  # a second copy of the vocabulary, seldom needed
            loaded.append(Tokenizer.from_file(path))
            loaded[0].encode_special_tokens = special_as_text
        found = loaded[0].encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [e.ids for e in found]

    return encode
