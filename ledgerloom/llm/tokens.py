"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

Both public vocabularies cut a text before every blank that a visible character follows, whatever
stands to the left: one drops white space and starts anew after it, the other lets such a blank begin
the next word. Ids of a text are therefore the ids of its blank-separated words in a row. A word is
encoded by the library when a worker first meets it and looked up afterwards; letters with signs
behind them are put together from both. Where a run of white
space makes the cut depend on its surroundings, the stretch is handed to the library uncut.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
#: Distinct words that a worker remembers at most: the first it meets, which the frequent ones are among.
MEMORY_WORDS = 900_000
#: Longer words are not remembered.
MEMORY_CHARS = 48
#: Characters of a text that are worked on at once.
STRETCH = 1 << 18

_loaded: dict[str, object] = {}

#: Letters and then signs, which both vocabularies cut apart and encode each on its own. Restricted to
#: characters that every version of the character tables calls a letter or a sign.
_STEM_AND_TAIL = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([!-/:-@\[-`{-~]+)")


def vocabulary(name_or_path: str) -> str:
    """Path of a vocabulary file: itself, or the one of that name among the public tokenizers."""
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def load(path: str):
    """The library's tokenizer as the file describes it, without truncation or padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in pieces of about that many characters, cut before single blanks inside it."""
    start, n = 0, len(text)
    while n - start > size:
        cut = text.find(" ", start + size)
        while 0 <= cut < n - 1 and (text[cut + 1].isspace() or text[cut - 1].isspace()):
            cut = text.find(" ", cut + 1)
        if not 0 <= cut < n - 1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]
#: Letters up to here are letters in every version of the character tables.
_LAST_LETTER = "\u024f"


class WordEncoder:
    """Encodes texts word by word with a memory of words; `pack` turns a library encoding into bytes."""

    def __init__(self, name_or_path: str, leading_blank: bool, pack: Callable[[object], bytes]) -> None:
        self.tokenizer = load(vocabulary(name_or_path))
        self.leading_blank = leading_blank
        self.pack = pack
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> list[bytes]:
        return [self.pack(e) for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _encode_pieces(self, words: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct words that the tokenizer cuts apart before their blanks and nowhere else."""
        encoding = self.tokenizer.encode("".join([f" {w}" for w in words]), add_special_tokens=False)
        packed, cuts, last = self.pack(encoding), [], None
        for i, word in enumerate(encoding.word_ids):
            if word != last:
                cuts.append(4 * i)
                last = word
        if len(cuts) != len(words):
            return dict(zip(words, self._encode([f" {w}" for w in words])))
        return {w: packed[a:b] for w, a, b in zip(words, cuts, [*cuts[1:], len(packed)])}

    def _uneven(self, words: set[str]) -> bool:
        """Whether the cut before one of these words depends on what stands to its left."""
        if not self.leading_blank:
            return False
        firsts = {w[:1] for w in words}
        if "" in firsts or any(map(str.isspace, firsts)):
            return True
        return any(s[0] in firsts for s in self.special) and any(w.startswith(self.special) for w in words)

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Bytes of new words; they go into the memory while it has room.

        Letters with signs behind them are quick to put together, so they take a fifth of it at most.
        """
        known, tails = self.later, self.tails
        parts = {w: m.groups() for w in new if (m := _STEM_AND_TAIL.fullmatch(w))}
        letters = {stem for stem, _ in parts.values() if stem not in known}
        others = new.difference(parts)
        if self.leading_blank:
            # words of letters alone are one piece each for the tokenizer, so they can go in one text
            whole = {w for w in others if w.isalpha() and max(w) <= _LAST_LETTER}
            letters |= whole
            others -= whole
        else:
            others |= letters
            letters = set()
        fresh = self._encode_pieces(list(letters)) if letters else {}
        if others:
            listed = list(others)
            fresh |= zip(listed, self._encode([f" {w}" for w in listed] if self.leading_blank else listed))
        out = fresh.copy()
        for w, (stem, tail) in parts.items():
            if tail not in tails:
                if len(tails) >= MEMORY_WORDS // 8:
                    tails.clear()
                tails[tail] = self.pack_tail(tail)
            out[w] = (fresh.get(stem) or known[stem]) + self.moved(tails[tail], len(stem))
        room = MEMORY_WORDS - len(known)
        for w in (fresh if room <= 0.8 * MEMORY_WORDS else out):
            if room > 0 and len(w) <= MEMORY_CHARS:
                known[w] = out[w]
                room -= 1
        return out

    def pack_tail(self, tail: str) -> bytes:
        return self._encode([tail])[0]

    def moved(self, packed: bytes, by: int) -> bytes:
        """Bytes of a tail that stands behind `by` characters: ids stay as they are."""
        return packed

    def word_bytes(self, stretch: str) -> list[bytes] | None:
        """Packed ids of each blank-separated word, or None if the stretch must stay whole."""
        starts_blank = self.leading_blank and stretch.startswith(" ")
        words = (stretch[1:] if starts_blank else stretch).split(" ")
        head: bytes | None = None
        if self.leading_blank and not starts_blank:
            opening = words[0]
            words = words[1:]
            head = self.first.get(opening)
            if head is None:
                head = self._encode([opening])[0]
                if len(opening) <= MEMORY_CHARS and len(self.first) < MEMORY_WORDS // 8:
                    self.first[opening] = head
        out = list(map(self.later.get, words))
        if None in out:
            missing = [i for i, packed in enumerate(out) if packed is None]
            new = {words[i] for i in missing}
            if self._uneven(new):
                return None
            learned = self._learn(new)
            for i in missing:
                out[i] = learned[words[i]]
        return out if head is None else [head, *out]

    def encode(self, text: str) -> bytes:
        """Packed ids of the whole text."""
        parts = []
        for stretch in stretches(text):
            words = self.word_bytes(stretch)
            parts.append(self._encode([stretch])[0] if words is None else b"".join(words))
        return parts[0] if len(parts) == 1 else b"".join(parts)


class StartEncoder(WordEncoder):
    """Encodes texts into the first characters of their tokens."""

    def moved(self, packed: bytes, by: int) -> bytes:
        starts = struct.unpack(f"<{len(packed) // 4}I", packed)
        return struct.pack(f"<{len(starts)}I", *[s + by for s in starts])


def pack_ids(encoding) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    ids = encoding.ids
    return struct.pack(f"<{len(ids)}I", *ids)


def pack_starts(encoding) -> bytes:
    """First characters of the tokens, in the same form."""
    offsets = encoding.offsets
    return struct.pack(f"<{len(offsets)}I", *[o[0] for o in offsets])


def id_encoder(name_or_path: str = BYTE_BPE) -> WordEncoder:
    """This worker's id encoder of a byte-level vocabulary."""
    key = f"ids {name_or_path}"
    if key not in _loaded:
        _loaded[key] = WordEncoder(name_or_path, True, pack_ids)
    return _loaded[key]


def start_encoder(name_or_path: str = WORD_BPE) -> StartEncoder:
    """This worker's encoder of token starts for a vocabulary that drops white space."""
    key = f"starts {name_or_path}"
    if key not in _loaded:
        _loaded[key] = StartEncoder(name_or_path, False, pack_starts)
    return _loaded[key]
