"""Token ids of whole texts by the public byte-level BPE, with a word cache.

Ids are those of ``tokenizers`` for ``byte_bpe_50k.json``. A text is cut before single
spaces, where the pre-tokenizer always cuts as well, and each piece is encoded once per
worker. Plain pieces (Latin letters, digits, ASCII signs) that are not cached go through
``tiktoken`` with the same vocabulary, which gives the same ids and starts faster; other
pieces, and texts whose white space or special strings make the cut ambiguous, go through
``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array

# A space beside other white space, or the opening of a special string.
_AMBIGUOUS = re.compile(r"  |\s \s|\s \Z|<\|")
_PLAIN = re.compile("[\x20-\x7e\nÀ-ÖØ-öø-ſ]+")
CACHE_ENTRIES = 400_000
#: Longer pieces are rare words or unbroken runs; keeping them would only fill the cache.
CACHE_PIECE_CHARS = 40


def public_files() -> tuple[str, str]:
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"))


class Encoder:
    """``ids_bytes(text)``: the ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN,
                                        mergeable_ranks=merges, special_tokens={})
        self._known: dict[str, bytes] = {}

    def ids_bytes(self, text: str) -> bytes:
        if _AMBIGUOUS.search(text):
            return self._encode(text)
        first, *rest = text.split(" ")
        known, found = self._known, []
        for piece in rest:
            ids = known.get(piece)
            if ids is None:
                ids = self._encode(" " + piece)
                if len(piece) <= CACHE_PIECE_CHARS:
                    if len(known) >= CACHE_ENTRIES:
                        known.clear()
                    known[piece] = ids
            found.append(ids)
        return self._encode(first) + b"".join(found)

    def _encode(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            ids = self._plain.encode_ordinary(text)
        else:
            ids = self._whole.encode(text, add_special_tokens=False).ids
        packed = array("I", ids)
        if packed.itemsize != 4:
            raise RuntimeError("this platform has no 32-bit unsigned int")
        return packed.tobytes()


@functools.lru_cache(maxsize=1)
def encoder(vocabulary: str, ranks: str) -> Encoder:
    """One encoder, and one cache, per Python worker."""
    return Encoder(vocabulary, ranks)
