"""Token ids of texts by a public byte-level BPE tokenizer file, with a cache of the pieces between spaces.

The tokenizer cuts a text before it merges bytes, and always before a space that is followed by
something that is not white space.  So the ids of a text are the ids of the pieces that begin at
such spaces, one after the other, and a frequent piece is tokenised once for each worker process.
Merging uses the ranks of the same file in tiktoken; texts that hold a special token's string go
through the tokenizers library whole.
"""

from __future__ import annotations

import json
import re
from array import array

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|$)")
#: The public split pattern of byte-level BPE (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces kept by each worker process; once it is full, further pieces are tokenised each time.
CACHE_PIECES = 500_000


def _byte_of() -> dict[str, int]:
    """Printable stand-ins of bytes in a byte-level vocabulary: printable bytes stand for themselves, others follow from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Cache(dict):
    """Packed ids by piece, filled up to a number of pieces."""

    def __init__(self, of, most: int):
        self.of, self.most = of, most

    def __missing__(self, piece: str) -> bytes:
        got = self.of(piece)
        if len(self) < self.most:
            self[piece] = got
        return got


class Ids:
    """``packed(text)``: little-endian unsigned 32-bit ids of a text as bytes; ``plain(text)``: the same, special tokens' strings being text."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = _byte_of()
        self.path = path
        self.whole = None  # loaded only for texts that hold a special token's string
        self.specials = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.specials}
        self.ranks = ranks
        core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.merge, self.merge_one = core.encode_ordinary, core.encode_single_piece
        self.mark = {c: array("I", self.merge(c)).tobytes() for c in ".,;:!?"}
        self.cache = _Cache(self._piece, cache_pieces)

    def _piece(self, p: str) -> bytes:
        """Ids of a space and ``p``; letters, or letters and one mark, need no split by the pattern."""
        if p.isalpha():
            return array("I", self.merge_one((" " + p).encode())).tobytes()
        if p[-1:] in self.mark and p[:-1].isalpha():
            known = self.cache.get(p[:-1])
            return (known or array("I", self.merge_one((" " + p[:-1]).encode())).tobytes()) + self.mark[p[-1]]
        return array("I", self.merge(" " + p)).tobytes()

    def packed(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.specials):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        """Ids where a special token's string is plain text."""
        parts = _CUT.split(text) if _ODD.search(text) else text.split(" ")
        head = array("I", self.merge(parts[0])).tobytes()
        return head + b"".join(map(self.cache.__getitem__, parts[1:]))


_ids: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The worker's tokenizer for ``path``; kept between tasks."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]
