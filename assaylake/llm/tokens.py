"""Token ids of the public byte-level vocabulary of 50,257 ids.

The ids are those of ``tokenizers`` with ``byte_bpe_50k.json``. ``token_ids`` reads
special strings as ordinary text, ``document_ids`` as the vocabulary's added tokens,
which is what ``tokenizers`` does by default. They are computed by ``tiktoken`` from the same vocabulary,
which takes a quarter of the time; ``tests/llm/test_tokens.py`` holds both
against each other.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import cache

import public_tokenizers
import tiktoken

#: Only where two white-space characters meet does the vocabulary's pattern need
#: its look-ahead, without which it runs on a faster matcher.
_RUN = re.compile(r"\s\s")
_LOOK_AHEAD = r"|\s+(?!\S)"


@cache
def _encodings(path: str | None) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    pattern = public_tokenizers.PATTERN
    return tuple(
        tiktoken.Encoding("byte_bpe_50k", pat_str=p, mergeable_ranks=ranks, special_tokens={})
        for p in (pattern, pattern.replace(_LOOK_AHEAD, ""))
    )


def token_ids(text: str, path: str | None = None) -> array:
    """The ids as unsigned 32-bit integers; ``path`` is another file of ranks."""
    whole, fast = _encodings(path)
    return array("I", (whole if _RUN.search(text) else fast).encode_ordinary(text))


def token_count(text: str, path: str | None = None) -> int:
    whole, fast = _encodings(path)
    return len((whole if _RUN.search(text) else fast).encode_ordinary(text))


@cache
def _added() -> tuple[re.Pattern, dict[str, int]]:
    """The added tokens of the vocabulary, the longest first where several match."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        ids = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return re.compile("|".join(map(re.escape, sorted(ids, key=len, reverse=True)))), ids


def document_ids(text: str, path: str | None = None) -> array:
    """``token_ids`` with the added tokens' own ids; another file of ranks has no added tokens."""
    pattern, added = _added()
    if path is not None or not added or not pattern.search(text):
        return token_ids(text, path)
    ids, at = array("I"), 0
    for m in pattern.finditer(text):
        ids.extend(token_ids(text[at : m.start()]))
        ids.append(added[m[0]])
        at = m.end()
    ids.extend(token_ids(text[at:]))
    return ids


def document_token_count(text: str, path: str | None = None) -> int:
    pattern, added = _added()
    if path is not None or not added or not pattern.search(text):
        return token_count(text, path)
    return len(document_ids(text))
