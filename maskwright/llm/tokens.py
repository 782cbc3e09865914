"""Ids of whole texts by a tokenizer file of the tokenizers library.

Text comes as words that repeat, and these tokenizers never merge across the gap between two words, so each distinct
piece is encoded once per Python worker and looked up from then on. A text is cut only where the tokenizer itself
always cuts; the ids are those of the whole text by the library, which reads the string of a special token in a text
as that token.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

from maskwright.llm.worker import kept

# Held by a worker; beyond it, those that came up once only are forgotten. A dict doubles at 699,050.
MOST_PIECES = 660_000
MOST_CHARS = 32 << 20

_GAP_AFTER_GAP = re.compile(r"\s[ \n]")
_RARE_GAPS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_WORD = re.compile(r"(\n?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@[-`{-~]*)")  # and signs behind it


def keep_gaps(text: str) -> list:
    """For byte-level tokenizers that put a space in front of the word it precedes.

    Cut in front of every space or newline that follows something else. A plain string stands for itself with a space
    in front, unless it begins with a newline; a 1-tuple holds a piece to be taken as it is.
    """
    if ("  " in text or " \n" in text or "\n " in text or "\n\n" in text
            or any(c in text for c in _RARE_GAPS) and _GAP_AFTER_GAP.search(text)):
        return [(piece,) for piece in _SAFE_CUT.split(text)]
    pieces = text.replace("\n", " \n").split(" ")
    pieces[0] = (pieces[0],)
    return pieces


def drop_gaps(text: str) -> list:
    """For tokenizers that drop white space: cut at every space and newline."""
    return text.replace("\n", " ").split(" ")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level tokenizers write each byte: itself, or one above 255 if it doesn't show."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Pieces(dict):
    """Numbers pieces in the order in which they are first seen."""

    def __init__(self):
        self.new = []

    def __missing__(self, piece):
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """``path`` is a tokenizer file; ``gaps`` says whether spaces belong to ids (``keep_gaps``) or not (``drop_gaps``)."""

    def __init__(self, path: str, gaps: bool):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder().values()
        # strings that could reach over a cut; the library finds all others within their piece
        self.wide = [t.content for t in special if t.rstrip or re.search(r"\s", t.content)]
        self.cut = keep_gaps if gaps else drop_gaps
        self.gaps = gaps
        # ids that begin with a space, which byte-level tokenizers write as this letter
        words = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(words.values()) + 1, bool)
        self.opens[[i for word, i in words.items() if word.startswith("\u0120")]] = True
        # Where a tokenizer is known to part a word from the signs behind it, the model gets each by itself.
        parts = json.loads(self.tokenizer.to_str())
        cut = parts["pre_tokenizer"] or {}
        self.model = None
        if (gaps and not parts["normalizer"] and parts["model"]["type"] == "BPE" and cut.get("type") == "ByteLevel"
                and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
                and not any(_WORD.fullmatch("a" + t.content.strip()) for t in special)):
            self.model, self.letters = self.tokenizer.model, _byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.pieces, self.chars = _Pieces(), 0
        self.ids = np.empty(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 14, np.int64)  # where a piece's ids begin; one more than pieces
        self.uses = np.zeros(1 << 14, np.int32)

    def _most(self) -> int:
        """How many pieces to hold: half as many where the model gets words by themselves, as that is quick."""
        return MOST_PIECES // 2 if self.model else MOST_PIECES

    def _forget(self) -> None:
        """Keep the pieces that are met again and again, half the table at most."""
        n = len(self.pieces)
        uses, least = self.uses[:n], 2
        while np.count_nonzero(uses >= least) > self._most() // 2:
            least += 1
        often = np.flatnonzero(uses >= least)
        names, bounds, ids = list(self.pieces), self.bounds, self.ids
        self._clear()
        sizes = bounds[often + 1] - bounds[often]
        ends = np.cumsum(sizes)
        at = np.repeat(bounds[often] - (ends - sizes), sizes) + np.arange(sizes.sum())
        self.ids = np.concatenate([ids[at], self.ids])
        self.bounds = np.concatenate([[0], ends, self.bounds]).astype(np.int64)
        self.uses = np.concatenate([uses[often] // 2, self.uses])
        for k, i in enumerate(often.tolist()):
            self.pieces[names[i]] = k
        self.chars = sum(len(p) for p in self.pieces if isinstance(p, str))
        if self.chars > MOST_CHARS // 2:
            self._clear()

    def _whole(self, piece) -> str:
        if isinstance(piece, tuple):
            return piece[0]
        return piece if not self.gaps or piece.startswith("\n") else " " + piece

    def _learn(self) -> None:
        new, self.pieces.new = self.pieces.new, []
        first = len(self.pieces) - len(new)
        found = self._words(new, first) if self.model else [None] * len(new)
        rest = [i for i, x in enumerate(found) if x is None]
        texts = [self._whole(new[i]) for i in rest]
        for i, x in zip(rest, self._joined(texts) if self.gaps else self._single(texts)):
            found[i] = x
        self.chars += sum(len(p[0]) if isinstance(p, tuple) else len(p) for p in new)
        ends = self.bounds[first] + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        if len(self.pieces) + 1 > len(self.bounds):
            more = len(self.pieces) + 1 + len(self.pieces) // 4 - len(self.bounds)
            self.bounds = np.concatenate([self.bounds, np.zeros(more, np.int64)])
            self.uses = np.concatenate([self.uses, np.zeros(more, np.int32)])
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(ends[-1] + ends[-1] // 4 - len(self.ids), np.uint32)])
        self.ids[self.bounds[first]:ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32)
        self.bounds[first + 1:len(self.pieces) + 1] = ends

    def _words(self, pieces: list, first: int) -> list[list[int] | None]:
        """Ids of the pieces that are one word of Latin letters and signs; None for others. Words below ``first`` are known."""
        known, tokenize, space, line = {}, self.model.tokenize, self.letters[32], self.letters[10]
        out: list[list[int] | None] = [None] * len(pieces)
        for i, piece in enumerate(pieces):
            if isinstance(piece, tuple):
                continue
            if piece.isascii() and piece.isalpha():
                out[i] = known.get(piece) or [t.id for t in tokenize(space + piece)]
                continue
            match = _WORD.fullmatch(piece)
            if match is None:
                continue
            new_line, word, signs = match.groups()
            ids = known.get(new_line + word)
            if ids is None:
                at = first if new_line else self.pieces.get(word, first)
                if at < first:
                    ids = self.ids[self.bounds[at]:self.bounds[at + 1]].tolist()
                else:
                    shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                    ids = [t.id for text in ([line, shown] if new_line else [space + shown]) for t in tokenize(text)]
                known[new_line + word] = ids
            if signs:
                if signs not in known:
                    known[signs] = [t.id for t in tokenize(signs)]
                ids = ids + known[signs]
            out[i] = ids
        return out

    def _single(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, texts: list[str]) -> list[list[int]]:
        """Many words in one go: each begins with its only space, which shows where its ids begin."""
        plain = [i for i, t in enumerate(texts) if t[:1] == " " and t[1:].split() == [t[1:]]]
        out: list[list[int] | None] = [None] * len(texts)
        for at in range(0, len(plain), 512):
            some = plain[at:at + 512]
            ids = self.tokenizer.encode("".join(texts[i] for i in some), add_special_tokens=False).ids
            starts = np.flatnonzero(self.opens[ids]).tolist()
            if len(starts) == len(some) and starts[0] == 0:
                for i, a, b in zip(some, starts, [*starts[1:], len(ids)]):
                    out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._single([texts[i] for i in rest])):
            out[i] = x
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind each other, and where each text's begin (one more than texts); null is empty."""
        if len(self.pieces) > self._most() or self.chars > MOST_CHARS:
            self._forget()
        number = self.pieces.__getitem__
        numbers, count = [], [0]
        for text in texts:
            pieces = self.cut(text) if text else []
            if text and any(w.lower() in text.lower() for w in self.wide):
                pieces = [(text,)]
            numbers.append(np.fromiter(map(number, pieces), np.int64, len(pieces)))
            count.append(len(pieces))
        if self.pieces.new:
            self._learn()
        number = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        self.uses[:len(self.pieces)] += np.bincount(number, minlength=len(self.pieces)).astype(np.int32)
        n = self.bounds[number + 1] - self.bounds[number]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.bounds[number] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[np.cumsum(count)]


def encoder(path: str, gaps: bool) -> Encoder:
    """The worker's encoder for a file."""
    return kept(("encoder", path, gaps), lambda: Encoder(path, gaps))


def with_end(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with id ``end`` after each text."""
    out = np.insert(ids, starts[1:], np.uint32(end))
    return out, starts + np.arange(len(starts))
