"""Token ids of whole texts by the tokenizers library, with each distinct chunk encoded once per task.

The library splits a text into pieces before it merges, so ids of a text are the ids of its chunks as
long as no piece crosses a chunk's border. Chunks begin at a single space or line break between two
characters that are not white space, a border that no piece crosses; and trailing punctuation after
an ASCII letter, or a word of Latin letters, is a piece of its own. Texts with other white space are cut only where that is safe.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import cache, reduce
from itertools import islice
from operator import add

from tokenizers import Tokenizer

# Forms of white space that send a text to the careful way of cutting.
_ODD_CONTROLS = bytes((9, 11, 12, 13, 28, 29, 30, 31))
_ODD_PAIRS = [b"  ", b"\n\n", b" \n", b"\n "]
_ODD_WIDE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]
_BORDER = re.compile(r"(?<=\S)(?= \S)")
_TAIL = b".,;:!?$%&*#"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
CACHE_ENTRIES = 650_000
# Spark runs a task per core; threads of the library's own would only compete with them.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def _odd_space(text: bytes) -> bool:
    if text[:1].isspace() or text[-1:].isspace() or len(text.translate(None, _ODD_CONTROLS)) < len(text):
        return True
    pairs = _ODD_PAIRS if b"\n" in text else _ODD_PAIRS[:1]
    return any(odd in text for odd in (pairs if text.isascii() else pairs + _ODD_WIDE))


def chunks(text: bytes) -> list[bytes]:
    """Keys of the pieces of UTF-8 text whose token ids, one after the other, are those of the text; see ``literal``."""
    if _odd_space(text):
        return [b"\xff" + c.encode() for c in _BORDER.split(text.decode())]
    return (b"\xff" + text.replace(b"\n", b" \n")).split(b" ") if text else []


def literal(key: bytes) -> bytes:
    """The piece of text a key of ``chunks`` stands for: with the space before it, but for line breaks and what 255 marks."""
    return key[1:] if key[:1] == b"\xff" else key if key[:1] == b"\n" else b" " + key


def folded_chunks(text: bytes) -> list[bytes]:
    """The same for a vocabulary that drops white space and folds case; a marker of special tokens keeps the case."""
    return (text if b"<|" in text else text.lower()).replace(b"\n", b" ").split(b" ")


class ChunkCache:
    """Values of chunks, computed by ``encode`` on lists of unseen ones.

    Beyond ``entries`` the later half is forgotten: frequent chunks were met early.
    """

    def __init__(self, encode: Callable[[list[bytes]], list], folded: bool = False, entries: int = CACHE_ENTRIES):
        self.encode, self.folded, self.entries, self.known = encode, folded, entries, {}
        self.cut = folded_chunks if folded else chunks

    def values(self, texts: list[bytes]) -> list[list]:
        """For each text the values of its chunks."""
        if len(self.known) > self.entries:
            self.known = dict(islice(self.known.items(), self.entries // 2))
        known, out, gaps, new = self.known, [], [], set()
        for text in texts:
            pieces = self.cut(text)
            found = list(map(known.get, pieces))
            if None in found:
                at = [i for i, v in enumerate(found) if v is None]
                new.update([pieces[i] for i in at])
                gaps.append((found, pieces, at))
            out.append(found)
        if new:
            self._learn(new)
            for found, pieces, at in gaps:
                for i in at:
                    found[i] = known[pieces[i]]
        return out

    def _learn(self, new: set[bytes]) -> None:
        known, ask, words, pairs, parts = self.known, set(), set(), [], {}
        mark = b"" if self.folded else b"\xff"
        for chunk in new:
            if chunk.isalpha():
                words.add(chunk)
                continue
            core = chunk.rstrip(_TAIL)
            if core.isalpha():  # a word of ASCII letters and punctuation after it, the most frequent case
                tail = mark + chunk[len(core) :]
                if core not in known:
                    words.add(core)
                if tail not in known:
                    ask.add(tail)
                pairs.append((chunk, core, tail))
                continue
            head, body = b"", chunk
            if chunk[:1] == b"\n" and len(chunk) > 1:  # a line break before other than white space is a piece of its own
                head, body = b"\xff\n", b"\xff" + chunk[1:]
                core = body.rstrip(_TAIL)
            if core != body and core and (core[-1] in _LETTERS or core[-1] > 127 and plain_word(core if self.folded else literal(core))):
                keys = [core, mark + body[len(core) :]]
            else:
                keys = [body]
            if head:
                keys.insert(0, head)
            if len(keys) > 1:
                parts[chunk] = keys
            ask.update([k for k in keys if k not in known])
        if words:
            known.update(zip(words, self.encode(list(words) if self.folded else [b" " + c for c in words])))
        if ask:
            known.update(zip(ask, self.encode(list(ask) if self.folded else [literal(c) for c in ask])))
        for chunk, core, tail in pairs:
            known[chunk] = known[core] + known[tail]
        for chunk, keys in parts.items():
            known[chunk] = reduce(add, map(known.get, keys))


def _byte_alphabet() -> dict[int, int]:
    """The characters that stand for bytes: printable Latin-1 ones for themselves, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (256 + i for i in range(256))
    return {byte: byte if byte in plain else next(others) for byte in range(256)}


_ALPHABET = _byte_alphabet()
_SPACE = chr(_ALPHABET[ord(" ")])
_WORD = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_LOWER_WORD = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def plain_word(chunk: bytes, pattern: re.Pattern = _WORD) -> str | None:
    """A word of Latin letters in the byte alphabet, None for any other chunk."""
    if pattern is _WORD and chunk[:1] == b" ":
        word = chunk[1:]
        if word.isalpha():
            return _SPACE + word.decode()
    elif chunk.isalpha() and (pattern is _WORD or chunk.islower()):
        return chunk.decode()
    return chunk.decode("latin-1").translate(_ALPHABET) if pattern.fullmatch(chunk.decode()) else None


@cache
def _ids_cache(path: str) -> ChunkCache:
    library = tokenizer(path)
    library.no_truncation()
    library.no_padding()
    # A vocabulary that drops white space gives no id for a lone space.
    drops = not library.encode(" \n", add_special_tokens=False).ids
    pattern, merge = _LOWER_WORD if drops else _WORD, library.model.tokenize

    def whole(chunk: bytes) -> list[int]:
        return library.encode(chunk.decode(), add_special_tokens=False).ids

    def merged(word: str) -> list[int]:
        return [t.id for t in merge(word)]

    # A plain word is one piece to the library, which its model alone then merges.
    trials = ["a", "the", "zqxj", "tionable", "éñüß"]
    plain = all(merged(plain_word(t.encode(), pattern)) == whole(t.encode()) for t in trials)

    def encode(ask: list[bytes]) -> list[bytes]:
        return [array("I", whole(c) if not plain or (word := plain_word(c, pattern)) is None else merged(word)).tobytes() for c in ask]

    return ChunkCache(encode, bool(drops))


def token_ids(path: str, texts: list[bytes]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit values."""
    return [b"".join(v) for v in _ids_cache(path).values(texts)]


def byte_texts(column) -> list[bytes]:
    """UTF-8 texts of an Arrow column, null as empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
