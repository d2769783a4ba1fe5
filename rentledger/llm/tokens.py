"""Token ids of texts by the ``tokenizers`` library, with a memo of what stands between spaces.

The tokenizer splits a text before it merges bytes, and a space that follows a non-space character always starts
a new split. Text between such spaces can therefore be encoded once, split by split, and looked up afterwards. Texts with
other white space than single spaces and single line feeds, with characters outside the common Latin blocks, or with an
added token of the vocabulary (special ones included) are given to the library whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import cache

# A text that matches is encoded whole: control and rare characters, or runs of white space.
_WHOLE = re.compile("[^\n\x20-\x7e¡-ɏ‐-‧€]|[ \n][ \n]")
_CUT = "\x00"
# Fixed value: the split pattern of byte-level BPE vocabularies.
_SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Longer texts are encoded in segments of about this many characters.
SEGMENT = 1 << 20
# Pieces that one Python worker remembers; at the limit it keeps those it has.
MEMO = 1_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Cut a text before single spaces, where the tokenizer cuts as well. Joined, they are the text."""
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while True:
            at = text.find(" ", at + 1)
            if at < 0 or at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
                break
        if at < 0:
            break
        out.append(text[start:at])
        start = at
    out.append(text[start:])
    return out


class _Memo(dict):
    """Packed ids by piece; computes what it lacks."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, piece: str) -> bytes:
        ids = self.compute(piece)
        if len(self) < self.limit:
            self[piece] = ids
        return ids


class Encoder:
    """Encode batches of texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, memo: int = MEMO):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.memo = self.tokenizer.model, _Memo(self._piece, memo)
        parts = json.loads(self.tokenizer.to_str())
        added = [re.escape(t["content"]) for t in parts["added_tokens"] if t["content"]]
        self.added = re.compile("|".join(added)).search if added else lambda text: None
        # Added tokens that take in white space, or look at what stands beside them, leave no safe place for a cut.
        self.apart = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in parts["added_tokens"])
        pre = parts["pre_tokenizer"] or {}
        self.byte_level = (
            parts["model"]["type"] == "BPE"
            and parts["normalizer"] is None
            and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == ("ByteLevel", False, True)
        )
        self.splits = regex.compile(_SPLITS).findall
        self.letters = _letters()

    def _library(self, texts: list[str]) -> list[bytes]:
        found = []
        for i in range(0, len(texts), 64):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 64], add_special_tokens=False):
                found.append(_packed(e.ids))
        return found

    def _piece(self, piece: str) -> bytes:
        splits = self.splits(piece)
        if len(splits) > 1:
            return b"".join(map(self.memo.__getitem__, splits))
        return _packed([x.id for x in self.model.tokenize(piece.encode().decode("latin1").translate(self.letters))])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        parts = [(i, s) for i, t in enumerate(texts) for s in (segments(t) if len(t) > SEGMENT and (self.apart or not self.added(t)) else (t,))]
        done: list[bytes | None] = [None] * len(parts)
        whole, get = [], self.memo.__getitem__
        for k, (_, s) in enumerate(parts):
            if not self.byte_level or _WHOLE.search(s) or self.added(s):
                whole.append(k)
            else:
                pieces = s.replace(" ", _CUT + " ").replace("\n", _CUT + "\n" + _CUT).split(_CUT)
                done[k] = b"".join(map(get, pieces))
        for k, ids in zip(whole, self._library([parts[k][1] for k in whole])):
            done[k] = ids
        if len(parts) == len(texts):
            return done
        joined: list[list[bytes]] = [[] for _ in texts]
        for (i, _), ids in zip(parts, done):
            joined[i].append(ids)
        return [b"".join(x) for x in joined]


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; its memo lives as long as the worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def text_batches(batch, size: int = 256):
    """Slices of an Arrow batch, so that the pieces of only a few texts are held at a time."""
    for i in range(0, batch.num_rows, size):
        yield batch.slice(i, size)
