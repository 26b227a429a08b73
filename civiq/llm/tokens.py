"""Token ids of whole texts by a public tokenizer file, with each distinct word encoded once in a worker."""

from __future__ import annotations

import os
import sys
import unicodedata
import zlib
from array import array

import numpy as np
from tokenizers import Tokenizer

_KNOWN = 1_000_000  # words a worker remembers before it starts afresh
_TAIL = b".,;:!?%$&*#|"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str) -> dict:
    """What a worker needs to encode: broadcast it. ``words`` fills up with what the worker has met."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    by_word = ids("Ab\n c") == ids("Ab") + ids("c") and ids("a b") == ids("b a")[::-1]
    folds = by_word and ids("AbC") == ids("abc")
    return {"tokenizer": tokenizer, "words": {}, "by_word": by_word, "folds": folds,
            "width": "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4", "bytes": _byte_characters(),
            "code": "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I",
            "special": [t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()]}


def _byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write a printable byte as its own character, the others as those from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in printable else next(spare)) for b in range(256)}


def encode(text: str | None, state: dict) -> bytes:
    """The ids of a whole text, little-endian in ``state['width']``; a null text has none.

    Where the vocabulary drops white space, a text is the sum of its words, so each is encoded once and remembered.
    """
    if not text:
        return b""
    if not state["by_word"]:
        return _pack(state["tokenizer"].encode(text, add_special_tokens=False).ids, state)
    known = state["words"]
    if not isinstance(known, _Words) or len(known) > _KNOWN:
        known = state["words"] = _Words(state)
    return b"".join([known[w] for w in text.encode("utf-8").split()])


class _Words(dict):
    """The ids of words; one that is not there yet is encoded when asked for."""

    def __init__(self, state: dict):
        super().__init__()
        self.state = state
        state["model"] = state["tokenizer"].model

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = _word(word, self.state)
        return found


def _pack(ids, state: dict) -> bytes:
    packed = array(state["code"], ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _word(word: bytes, state: dict) -> bytes:
    if not state["folds"]:
        return _encode(word, state)
    low, known = word.lower(), state["words"]
    for special in state["special"]:
        if special in low:
            return _encode(word, state)
    base = low.rstrip(_TAIL)
    if base and base != low and (last := base.decode()[-1]).isalpha() and last.lower().isalpha():
        # Punctuation after a letter is a token of its own.
        return _remembered(base, state) + _remembered(low[len(base):], state)
    return known.get(low) or _encode(low, state)


def _remembered(part: bytes, state: dict) -> bytes:
    known = state["words"]
    found = known.get(part)
    if found is None:
        found = known[part] = _encode(part, state)
    return found


def _encode(word: bytes, state: dict) -> bytes:
    """One word through the tokenizer; plain words of Latin letters go straight to its model, which is much faster."""
    text = word.decode()
    if state["folds"] and not text.isascii():
        text = unicodedata.normalize("NFC", text)
    if state["folds"] and text.isalpha() and (text.isascii() or max(text) < "ƀ" and "İ" not in text):
        spelled = text.lower()
        if not text.isascii():
            spelled = spelled.encode().decode("latin-1").translate(state["bytes"])
        return _pack([t.id for t in state["model"].tokenize(spelled)], state)
    return _pack(state["tokenizer"].encode(word.decode(), add_special_tokens=False).ids, state)


def id_array(packed: bytes, state: dict, end: int) -> np.ndarray:
    """The ids as unsigned 32-bit numbers, with the end id behind them."""
    return np.append(np.frombuffer(packed, state["width"]), end).astype("<u4")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
