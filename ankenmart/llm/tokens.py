"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Callable

import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Chunks an encoder remembers, of about 200 bytes each.
REMEMBERED = 1_500_000

# What \s stands for in the tokenizer's pre-splitting pattern.
_SPACE = "\t-\r \x85\xa0  -     　"
#: White space and the run after it. The pre-splitting pattern never joins a character with white
#: space after it, so a text's ids are those of these chunks, one after the other.
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: The same characters, and no character.
_WHITE = {"", *(chr(i) for i in range(0x3001) if re.match(f"[{_SPACE}]", chr(i)))}

#: Signs that end words. The pattern splits a letter or digit from a sign after it, whatever follows,
#: but for the apostrophe.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters below this one are letters to every version of Unicode.
_LATIN = "\u0250"
#: The characters that stand for bytes without a printable Latin-1 character of their own.
_OTHER_BYTES = [*range(33), *range(127, 161), 173]
_BYTES = {b: 256 + i for i, b in enumerate(_OTHER_BYTES)}


class Encoder:
    """Encodes piece by piece and remembers pieces, since most of a corpus is words seen before.

    Pieces are what single spaces part, each with the space before it; a text with more white space before a
    space is cut into chunks instead. The memory is a cache: past ``remembered`` entries it starts anew, which
    costs time, not results. Pieces over ``longest`` characters are encoded each time. ``code`` is the array type
    of the ids: "I" for 32 bits, "H" for 16 where the vocabulary allows.
    """

    def __init__(self, path: str, code: str = "I", remembered: int = REMEMBERED, longest: int = 40) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code, self.remembered, self.longest = code, remembered, longest
        first = self.tokenizer.pre_tokenizer
        self.bytewise = isinstance(first, ByteLevel) and first.use_regex and not first.add_prefix_space and self.tokenizer.normalizer is None
        self._forget()

    def _forget(self) -> None:
        #: Ids of chunks, and of words with a space before them by the word alone.
        self.known: dict[str, bytes] = {}
        self.after: dict[str, bytes] = {}

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _direct(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it. The pattern keeps one of letters whole, so the library's model
        can get it at once, as the characters that stand for its bytes."""
        tokenise, out, rest = self.tokenizer.model.tokenize, [b""] * len(words), []
        for n, word in enumerate(words):
            if self.bytewise and word.isalpha() and (word.isascii() or max(word) < _LATIN):
                text = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
                out[n] = array(self.code, [x.id for x in tokenise("\u0120" + text)]).tobytes()
            else:
                rest.append(n)
        for n, ids in zip(rest, self._direct([" " + words[n] for n in rest]), strict=True):
            out[n] = ids
        return out

    def _learn(self, chunks: list[str], memory: dict[str, bytes], encode: Callable[[list[str]], list[bytes]]) -> None:
        """Remember the ids of chunks; a word is looked up or encoded apart from the signs after it."""
        known, parts, fresh, signs = self.known, [], set(), set()
        for chunk in chunks:
            stem = chunk.rstrip(_SIGNS)
            if stem and stem != chunk and stem[-1].isalnum():
                parts.append((chunk, stem, tail := chunk[len(stem) :]))
                fresh.add(stem)
                signs.add(tail)
            else:
                fresh.add(chunk)
        for own, of, by in ((known, signs, self._direct), (memory, fresh, encode)):
            new = [c for c in of if c not in own]
            own.update(zip(new, by(new), strict=True))
        for chunk, stem, tail in parts:
            memory[chunk] = memory[stem] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers."""
        if len(self.known) + len(self.after) > self.remembered:
            self._forget()
        known, after = self.known, self.after
        out, waiting, whole = [b""] * len(texts), [], []
        words, chunks = set(), set()
        for n, text in enumerate(texts):
            if any(s in text for s in self.special):  # their own rules apply across chunks
                out[n] = self._direct([text])[0]
                continue
            pieces = text.split(" ")
            ids, first = [*map(after.get, pieces)], pieces[0]
            ids[0] = b"" if not first else None if first[-1] in _WHITE else known.get(first)
            if None not in ids:
                out[n] = b"".join(ids)
                continue
            missing = [i for i, x in enumerate(ids) if x is None]
            if any([pieces[i][-1:] in _WHITE for i in missing]):
                whole.append((n, cut := _CHUNK.findall(text)))
                chunks.update(cut)
                continue
            head = [] if missing[0] else _CHUNK.findall(first)
            chunks.update(head)
            waiting.append((n, pieces, ids, missing[1:] if head else missing, head))
            words.update([pieces[i] for i in waiting[-1][3]])
        cuts = {}
        for piece in words:
            if piece[0] in _WHITE:
                cuts[piece] = None, _CHUNK.findall(" " + piece)
            elif len(piece.split()) > 1:
                word, *rest = _CHUNK.findall(piece)
                cuts[piece] = word, rest
        words.difference_update(cuts)
        words.update([word for word, _ in cuts.values() if word])
        chunks.update(*(rest for _, rest in cuts.values()))
        words, chunks = ([c for c in new if c not in memory] for new, memory in ((words, after), (chunks, known)))
        self._learn(words, after, self._words)
        self._learn(chunks, known, self._direct)
        for piece, (word, rest) in cuts.items():
            after[piece] = (after[word] if word else b"") + b"".join(map(known.__getitem__, rest))
        for n, pieces, ids, missing, head in waiting:
            if head:
                ids[0] = b"".join(map(known.__getitem__, head))
            for i in missing:
                ids[i] = after[pieces[i]]
            out[n] = b"".join(ids)
        for n, cut in whole:
            out[n] = b"".join(map(known.__getitem__, cut))
        for piece in cuts:
            del after[piece]
        for new, memory in ((words, after), (chunks, known)):
            for chunk in new:
                if len(chunk) > self.longest:
                    memory.pop(chunk, None)
        return out


@functools.cache
def encoder(path: str, code: str = "I", remembered: int = REMEMBERED) -> Encoder:
    """One encoder a Python worker and set of arguments; Spark reuses workers."""
    return Encoder(path, code, remembered)
