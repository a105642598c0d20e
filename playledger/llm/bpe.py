"""BPE encoding by a streaming transducer with bounded lookahead, and incremental decoding.

The tokenizer is a file of the ``tokenizers`` library: a BPE over the byte alphabet with an end-of-word
mark, lower case, white space dropped. Nothing is trained here.

*Encoding.* Merges never cross a piece (a word, a digit, a run of signs), and within a piece a merge of
rank ``r`` can only be disturbed by an overlapping merge of lower rank. ``lookahead`` follows from the
merge list: the longest chain of overlapping merges with falling rank, times the longest token. A
token that ends further than this before the end of what has been read can no longer change,
so it is emitted and dropped; the rest is kept. Memory is thus bound by the merge list, not by the text.

*Decoding.* Token by token, through the inverse byte alphabet and a UTF-8 state machine that holds at most three bytes.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import regex

from playledger.llm.common import process_cache

TOKENIZER = "word_bpe_49k.json"
#: White space as the tokenizer has it. Python's own ``\s`` also takes the separators 0x1C to 0x1F.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_ODD_SPACE = re.compile("[\x85\xa0  -     　]")
#: Fixed value: how the tokenizer splits a normalised text into pieces.
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACES}\p{{L}}\p{{N}}]+")
END = "</w>"
#: Distinct words whose ids a worker remembers before it starts anew, and the longest that it remembers.
CACHE_WORDS = 500_000
CACHE_BYTES = 64
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte: itself if printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Symbols after a token that suffice to know that it stays; merges in order of rank.

    A merge can be disturbed by one of lower rank that overlaps its end: some end of its string is a
    beginning of the other's. The longest chain of such steps, times the longest string, bounds how far
    to the left new symbols can have an effect.
    """
    reach: dict[str, int] = {}
    chain = longest = 1
    for left, right in merges:
        text = left + right
        longest = max(longest, len(text))
        own = 1 + max((reach.get(text[i:], 0) for i in range(len(text))), default=0)
        for i in range(1, len(text) + 1):
            if reach.get(text[:i], 0) < own:
                reach[text[:i]] = own
        chain = max(chain, own)
    return chain * longest


class Merges:
    """Merges over ids, with the lookahead that suffices for them.

    ``pairs``: ``(left, right)`` to ``(rank, result)``.
    """

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], lookahead: int) -> None:
        self.pairs = {left << 32 | right: rank << 32 | new for (left, right), (rank, new) in pairs.items()}
        self.lookahead = lookahead

    def merge(self, ids: list[int]) -> list[int]:
        """All merges of a short piece, lowest rank first, leftmost first."""
        get, none = self.pairs.get, 1 << 63
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            ids[i] = new = best & 0xFFFFFFFF
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | new, none)
            if i < len(ranks):
                ranks[i] = get(new << 32 | ids[i + 1], none)
        return ids

    def merge_long(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """The same for a long piece, with a heap: ids, and where each begins."""
        n, get = len(ids), self.pairs.get
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m >> 32, i, m) for i in range(n - 1) if (m := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, m = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 32 | ids[j]) != m:
                continue
            ids[i], ids[j], after[i] = m & 0xFFFFFFFF, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and (b := after[a]) < n and (m := get(ids[a] << 32 | ids[b])) is not None:
                    heappush(heap, (m >> 32, a, m))
        starts = [i for i in range(n) if ids[i] >= 0]
        return [ids[i] for i in starts], starts


class Transducer:
    """Encodes one piece that arrives in parts: ``feed`` gives the ids that can no longer change."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.held: list[int] = []
        self.block = 4 * merges.lookahead

    def feed(self, symbols: Iterable[int]) -> Iterator[int]:
        for symbol in symbols:
            self.held.append(symbol)
            if len(self.held) >= self.block:
                ids, starts = self.merges.merge_long(self.held)
                ends = [*starts[1:], len(self.held)]
                n = sum(1 for e in ends if e <= len(self.held) - self.merges.lookahead)
                yield from ids[:n]
                self.held = self.held[ends[n - 1] if n else 0 :]

    def end(self) -> Iterator[int]:
        yield from self.merges.merge_long(self.held)[0]
        self.held = []


class WordBpe:
    """The tokenizer of a file: ``encode`` texts to ids, ``decode`` ids to texts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, pairs = spec["model"]["vocab"], [tuple(m) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + END] for c in alphabet]
        # A byte with the end mark is one symbol, so the mark counts as one more character at most.
        self.merges = Merges(
            {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)},
            lookahead((a.replace(END, "\0"), b.replace(END, "\0")) for a, b in pairs),
        )
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self._utf8 = [t.encode() for t in self.tokens]
        # Two generations: what is used again moves to the new one, the rest goes with the old one.
        self._words: dict[bytes, bytes] = {}
        self._old_words: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    # Encoding. Ids travel as 32-bit little-endian bytes.

    def _piece(self, piece: str) -> bytes:
        """The ids of one piece."""
        raw = piece.encode()
        if len(raw) <= self.merges.lookahead // 4 or len(raw) <= CACHE_BYTES:
            if len(raw) > 200:
                ids = self.merges.merge_long([*(self.inner[b] for b in raw[:-1]), self.last[raw[-1]]])[0]
            else:
                inner = self.inner
                ids = [inner[b] for b in raw]
                ids[-1] = self.last[raw[-1]]
                ids = self.merges.merge(ids)
        else:
            machine = Transducer(self.merges)
            ids = [*machine.feed(self.inner[b] for b in raw[:-1]), *machine.feed([self.last[raw[-1]]]), *machine.end()]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()

    def _known_piece(self, piece: str) -> bytes:
        ids = self._pieces.get(piece)
        if ids is None:
            ids = self._piece(piece)
            if len(piece) <= CACHE_BYTES:
                self._pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """The ids of a run of characters without white space. No merge or normal form crosses it."""
        if not word.isascii():
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")
        word = word.lower()
        if word.isalpha():
            return self._known_piece(word)
        if word[:-1].isalpha() and word[-1] in ",.!":
            return self._known_piece(word[:-1]) + self._known_piece(word[-1])
        return b"".join(map(self._known_piece, _PIECES.findall(word)))

    def _plain(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        if not text.isascii():
            text = _ODD_SPACE.sub(" ", text)
        words, known = text.encode().split(), self._words
        found = list(map(known.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    w = words[i]
                    ids = found[i] = known.get(w) or self._old_words.get(w) or self._word(w.decode())
                    if len(w) <= CACHE_BYTES:
                        known[w] = ids
            if len(known) > CACHE_WORDS:
                self._old_words, self._words = known, {}
            if len(self._pieces) > CACHE_WORDS:
                self._pieces.clear()
        return b"".join(found)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text as the library gives them, without added special tokens; null is empty."""
        text = text or ""
        if "<|" not in text:
            return np.frombuffer(self._plain(text), "<u4")
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [self._plain(text[at : m.start()]), np.uint32(self.special[m[0]]).tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._plain(text[at:])]), "<u4")

    # Decoding.

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens with a space between them, in UTF-8: what the library's ``decode`` gives for this file."""
        return b" ".join(map(self._utf8.__getitem__, ids.tolist()))

    def text_decoder(self) -> TextDecoder:
        return TextDecoder(self)


class TextDecoder:
    """Ids to readable text, a part at a time: ``feed`` gives the characters that are complete.

    The state is the UTF-8 decoder's, at most three bytes of an unfinished character. Bytes that form no
    character become U+FFFD. An end-of-word mark becomes a space; special tokens stand as they are.
    """

    def __init__(self, bpe: WordBpe) -> None:
        self.bpe = bpe
        self.byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.names = set(bpe.special.values())
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        out = []
        for i in ids:
            token = self.bpe.tokens[i]
            if i in self.names:
                out += [self.utf8.decode(b"", True), token]
                continue
            closed = token.endswith(END)
            out.append(self.utf8.decode(bytes(self.byte[c] for c in token.removesuffix(END))))
            if closed:
                out += [self.utf8.decode(b"", True), " "]
        return "".join(out)

    def end(self) -> str:
        return self.utf8.decode(b"", True)


def tokenizer(name: str = TOKENIZER) -> WordBpe:
    """The tokenizer of a public file, read once per process."""
    return process_cache(f"tokenizer {name}", lambda: WordBpe(public_tokenizers.path(name)))
