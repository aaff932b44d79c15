"""Byte-level BPE of whole texts with the tokenizers library, each distinct space-led chunk encoded once per worker.

The split pattern of byte-level BPE always starts a new piece at a space that is followed by a non-space, so a text may be
cut there and the ids of the parts joined. A line feed between two non-spaces is a piece of its own, so a text may be cut
there as well. Words repeat, so a worker keeps the ids of the chunks it has met.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

#: A space before a non-space: the pattern starts a piece there.
CUT = re.compile(r" (?=\S)")
#: A space that no such cut may take.
ODD = re.compile(r" (?!\S)")
#: A line feed beside other white space, or at an end.
ODD_FEED = re.compile(r"\n(?:(?!\S)|(?<!\S\n))")
#: Chunks met lately in one worker; as many that were met before them are kept too. Bounds memory, not results.
KEPT = 300_000
#: Longer chunks are encoded whenever they occur, and not kept.
KEPT_CHARS = 64
#: Marks that, after an ASCII letter, start a piece of the pattern.
MARKS = ".,;:!?#$%&*"
#: Letters by every version of Unicode in use, so that a word of them, led by a space or not, is one piece of the pattern.
ONE_PIECE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁぁ-ゖァ-ヺ一-龥가-힣]+").fullmatch
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def chunks_of(text: str) -> list[str]:
    """The text cut before every space that leads a word; all chunks but the first have lost that space.

    Where each line feed stands between two non-spaces the text is cut before them too; those chunks keep the line feed.
    No other chunk but the first starts with one.
    """
    if ODD.search(text):
        return CUT.split(text)
    if "\n" in text and not ODD_FEED.search(text):
        text = text.replace("\n", " \n")
    return text.split(" ")


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Memory:
    """Values by key. Once ``kept`` new keys have come, those that were not asked for since the last time are forgotten.

    ``learn`` makes the value of a key that is not known; long keys are not kept.
    """

    def __init__(self, kept: int, learn: Callable[[str], bytes]) -> None:
        self.kept, self.learn = kept, learn
        self.old: dict[str, bytes] = {}
        self.new: dict[str, bytes] = _Known(self)

    def __len__(self) -> int:
        return len(self.new) + len(self.old)

    def turn(self) -> None:
        if len(self.new) > self.kept:
            self.old, self.new = self.new, _Known(self)


class _Known(dict):
    """The new keys of a memory; an absent one is looked for among the old ones, then learned."""

    def __init__(self, memory: Memory) -> None:
        self.memory = memory

    def __missing__(self, key: str) -> bytes:
        value = self.memory.old.pop(key, None)
        if value is None:
            value = self.memory.learn(key)
            if len(key) > KEPT_CHARS:
                return value
        self[key] = value
        return value


class Encoder:
    """Ids of texts as packed bytes. ``many`` encodes a list of strings into a list of packed ids, ``one`` a single string."""

    def __init__(self, many: Callable[[list[str]], list[bytes]], kept: int = KEPT, one: Callable[[str], bytes] | None = None) -> None:
        self.many, self.one = many, one or (lambda x: many([x])[0])
        self.led = Memory(kept, self._learn)  # by the chunk without its space
        self.bare = Memory(kept // 4, self.one)
        self.feed = many(["\n"])[0]

    def __call__(self, texts: list[str]) -> list[bytes]:
        self.led.turn()
        self.bare.turn()
        parts = [chunks_of(x) for x in texts]
        heads = self.many([x[0] for x in parts])
        for x in parts:
            del x[0]
        # Chunks are looked up as they come; the memory learns those it lacks.
        known = self.led.new.__getitem__
        return [head + b"".join(map(known, x)) for head, x in zip(heads, parts, strict=True)]

    def _learn(self, chunk: str) -> bytes:
        """Ids of a new chunk: a line feed, the word, and marks after it are pieces of their own."""
        if chunk.isalpha():
            return self.one(" " + chunk)
        fed = chunk[:1] == "\n"
        word = chunk[1:] if fed else chunk
        base = word.rstrip(MARKS)
        if not base or len(base) == len(word) or base[-1] not in LETTERS:
            base = word
        if not fed and len(base) == len(word):
            return self.one(" " + chunk)
        ids = self.feed + self.bare.new[base] if fed else self.led.new[base]
        return ids + self.bare.new[word[len(base) :]] if len(base) < len(word) else ids


def byte_pieces(tokenizer) -> Callable[[str], bytes] | None:
    """For a plain byte-level BPE file: packed ids of a string that the pattern leaves whole, straight from the library's model.

    That skips the library's splitting and its alignments. None for files with other parts.
    """
    from tokenizers import models, pre_tokenizers

    split = tokenizer.pre_tokenizer
    if tokenizer.normalizer is not None or not isinstance(tokenizer.model, models.BPE) or not isinstance(split, pre_tokenizers.ByteLevel):
        return None
    if split.add_prefix_space or not split.use_regex:
        return None
    # The letter that stands for each byte: the byte's own where that prints, else the next from U+0100 on.
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    tokenize = tokenizer.model.tokenize
    space = table[0x20]

    def ids(text: str) -> bytes:
        # ASCII letters stand for themselves, and the only space leads.
        shown = text.replace(" ", space) if text.isascii() else text.encode("utf-8").decode("latin-1").translate(table)
        found = tokenize(shown)
        return found[0].id.to_bytes(4, "little") if len(found) == 1 else packed([x.id for x in found])

    return ids


_ENCODERS: dict[str, Callable[[list[str]], list[bytes]]] = {}


def library_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Packed ids of texts by a tokenizer file, as the library's ``encode`` gives them without special tokens around; kept for
    the life of the worker. A text that holds the string of an added token goes to the library whole."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        one_piece = byte_pieces(tokenizer)

        def whole(strings: list[str]) -> list[bytes]:
            out: list[bytes] = []
            for at in range(0, len(strings), 4096):
                part = tokenizer.encode_batch_fast(strings[at : at + 4096], add_special_tokens=False)
                out += [packed(x.ids) for x in part]
            return out

        def many(strings: list[str]) -> list[bytes]:
            if one_piece is None:
                return whole(strings)
            others = iter(whole([x for x in strings if not ONE_PIECE(x)]))
            return [one_piece(x) if ONE_PIECE(x) else next(others) for x in strings]

        def one(text: str) -> bytes:
            return one_piece(text) if one_piece is not None and ONE_PIECE(text) else whole([text])[0]

        by_chunks = Encoder(many, one=one)

        def encode(texts: list[str]) -> list[bytes]:
            marked = [i for i, x in enumerate(texts) if any(t in x for t in added)]
            if not marked:
                return by_chunks(texts)
            apart = dict(zip(marked, whole([texts[i] for i in marked]), strict=True))
            others = iter(by_chunks([x for i, x in enumerate(texts) if i not in apart]))
            return [apart[i] if i in apart else next(others) for i in range(len(texts))]

        _ENCODERS[path] = encode
    return _ENCODERS[path]


def vocabulary_path(name: str, path: str | None = None) -> str:
    """The given path, or the place of a public tokenizer file."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)
