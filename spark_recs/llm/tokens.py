"""Token ids of whole texts by the tokenizers library, each distinct word
encoded once per cache.

A text of plain Latin characters is cut into pieces by the vocabulary's
pre-tokenizer pattern, and each piece is passed to the library's BPE model; merges
stay inside a piece, so a piece always has the same ids, which are kept in a cache
of at most `CACHE_WORDS` per worker.  Any other text is cut where white space
follows something else, as no token spans such a place, and the chunks (one word
with what precedes it) are encoded alike, or by the whole tokenizer where they
aren't plain.  A text with white space other than space, \\n, \\t, \\r is encoded by
the whole tokenizer.
An added token's content in a text (`<|endoftext|>`) is plain text, or with
`special` the token's id, as the library has it unless told otherwise; such a
text is encoded by the whole tokenizer.
"""

from __future__ import annotations

import json
import re
from array import array

from spark_recs.llm.text import process_state, row_slices, text_buffers

CACHE_WORDS = 800_000
CACHE_CHARS = 64        # longer chunks are encoded each time
_STRANGE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # white space but space, \n, \t, \r
_CHUNK = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[ -~\n{_L}]*")
# fixed values: the pre-tokenizer patterns of the two vocabulary files, for plain Latin text
_SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_PIECE = re.compile(rf"{_SUFFIX}| ?[{_L}]+| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")
_WORD_PIECE = re.compile(rf"{_SUFFIX}|[{_L}]+|[0-9]|[^\s{_L}0-9]+")


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_chars() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Cache:
    """At most about `size` values by key, in two generations: what the younger
    one lacks is taken over from the older, and a full younger one becomes the
    older.  Keys of over `CACHE_CHARS` characters aren't kept."""

    def __init__(self, size: int):
        self.half = size // 2
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def all(self, keys: list[str], make) -> list[bytes]:
        new = self.new
        got = list(map(new.get, keys))
        if None in got:
            if len(new) > self.half:
                self.old, self.new = new, {}
                new = self.new
            for i, key in enumerate(keys):
                if got[i] is None:
                    value = new.get(key)
                    if value is None:
                        value = self.old.get(key)
                        if value is None:
                            value = make(key)
                        if len(key) <= CACHE_CHARS:
                            new[key] = value
                    got[i] = value
        return got


class ChunkEncoder:
    """`path`: a tokenizers file.  `kind`: the array type code that ids are kept
    as, "I" (32 bits) or "H" (16 bits, for vocabularies of up to 65,536).
    `special`: added tokens' contents in a text get their ids."""

    def __init__(self, path: str, kind: str = "I", cache_words: int = CACHE_WORDS, special: bool = False):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()] if special else []
        self.model, self.bytes = self.tok.model, _byte_chars()
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf["pre_tokenizer"]
        kinds = [x["type"] for x in (conf["normalizer"] or {}).get("normalizers", [])]
        self.lower = kinds == ["NFC", "Replace", "Lowercase"]
        if conf["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.pieces = _BYTE_PIECE
        elif self.lower and [x["type"] for x in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            self.pieces = _WORD_PIECE
        else:
            self.pieces = None
        self.kind = kind
        self.chunks, self.parts = Cache(cache_words), Cache(cache_words)

    def _whole(self, chunk: str) -> bytes:
        return array(self.kind, self.tok.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece.encode().decode("latin-1").translate(self.bytes)
        return array(self.kind, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(self.parts.all(self.pieces.findall(text.lower() if self.lower else text), self._piece))

    def _chunk(self, chunk: str) -> bytes:
        return self._plain(chunk) if self.pieces is not None and _PLAIN.fullmatch(chunk) else self._whole(chunk)

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes; a null is empty."""
        return [self.one(t) if t else b"" for t in texts]

    def one(self, text: str) -> bytes:
        for content in self.added:
            if content in text:
                return self._whole(text)
        if self.pieces is not None and _PLAIN.fullmatch(text):
            return self._plain(text)
        if _STRANGE.search(text):
            return self._whole(text)
        return b"".join(self.chunks.all(_CHUNK.findall(text), self._chunk))


def encoder(path: str, kind: str = "I", special: bool = False) -> ChunkEncoder:
    """The worker's encoder of a vocabulary file."""
    return process_state(f"encoder:{path}:{kind}:{special}", lambda: ChunkEncoder(path, kind, special=special))


def text_slices(col, limit: int):
    """Row ranges of an Arrow text column of about `limit` bytes, with their texts."""
    _, offsets = text_buffers(col)
    for i, j in row_slices(offsets, limit):
        yield i, j, col.slice(i, j - i).to_pylist()
