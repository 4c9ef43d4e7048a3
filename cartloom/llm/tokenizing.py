"""Whole texts to token ids with the tokenizers library, each distinct word encoded once per worker.

Both vocabularies split a text into words before they merge bytes, so the ids of a text are the ids of
its space-separated pieces one after the other. A worker keeps the ids of the pieces it has met (up to
``CACHE_PIECES``, then it starts anew) and encodes only new ones.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np

CACHE_PIECES = 900_000

# A space between white spaces, or after one at the end, is cut otherwise in the whole text than alone.
ENTANGLED_SPACE = re.compile(r"\s (?:\s|\Z)")
# Texts of other characters than these (which stay one letter or sign in every normal form and case, and know no
# white space but spaces and line ends) are cut at spaces only.
UNUSUAL = re.compile("[^ -~\n¡-įı-ɏ‐-‧]")
PLAIN_WORDS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ \n]*")
# Signs behind a letter, up to the end of a word: both vocabularies part the two. Without those of contractions and special tokens.
SIGNS = r"[!\"#$%&()*+,\-./:;=?@\[\]^_`{}~]"
WORD_END = re.compile(f"({SIGNS})(?<=[A-Za-zÀ-ÖØ-öø-įı-ɏ]{SIGNS})({SIGNS}*)(?![^ \n])")
# Marks a piece that no space goes before.
BARE = "\x01"
# New words that are encoded as one text.
WORDS_AT_ONCE = 2_000


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class TextEncoder:
    """Texts to ids as little-endian unsigned 32-bit integers, equal to encoding each whole text.

    ``keeps_spaces``: a space belongs to the word that follows it (byte-level vocabulary); otherwise white
    space only separates words and case is ignored.
    """

    def __init__(self, path: str, keeps_spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_spaces = keeps_spaces
        # Ids that begin a word, in one vocabulary, or end one, in the other.
        vocabulary = self.tokenizer.get_vocab()
        self.is_edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.is_edge[i] = token.startswith("\u0120") if keeps_spaces else token.endswith("</w>")
        self.line_end = vocabulary.get("\u010a", -1)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        cut = self._pieces if self.keeps_spaces else self._words
        texts = [text or "" for text in texts]
        pieces = [cut(text) for text in texts]
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        self._learn(set().union(*[p for p in pieces if p is not None]))
        lookup = self.known.__getitem__
        return [
            self._direct([text])[0] if split is None else b"".join(map(lookup, split))
            for text, split in zip(texts, pieces)
        ]

    def _words(self, text: str) -> list[str]:
        """Pieces of a text whose white space counts for nothing."""
        if UNUSUAL.search(text) is None:
            text = WORD_END.sub(r" \1\2", text.lower())
        return text.replace("\n", " ").split(" ")

    def _pieces(self, text: str) -> list[str] | None:
        """Pieces of a text whose spaces count; none if it must be encoded whole."""
        if BARE in text or ENTANGLED_SPACE.search(text):
            return None
        if UNUSUAL.search(text) is None:
            text = WORD_END.sub(f" {BARE}\\1\\2", text)
            if "\n\n" not in text and " \n" not in text and "\n " not in text and not text.endswith("\n"):
                text = text.replace("\n", f" {BARE}\n {BARE}")
        split = text.split(" ")
        split[0] = BARE + split[0]
        return split

    def _direct(self, texts: Sequence[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def _learn(self, pieces: set[str]) -> None:
        new = pieces - self.known.keys()
        if not self.keeps_spaces:
            self._learn_like(list(new), "", "", " ")
            return
        bare = [p for p in new if p.startswith(BARE)]
        self._learn_like([p[1:] for p in bare], BARE, "", "\n")
        self._learn_like(list(new.difference(bare)), "", " ", " ")

    def _learn_like(self, pieces: list[str], mark: str, before: str, between: str) -> None:
        """Learn ``pieces`` as they are with ``before`` in front; words many at a time with ``between`` them."""
        words = [p for p in pieces if p.isalpha()]
        other = [p for p in pieces if not p.isalpha()]
        for start in range(0, len(words), WORDS_AT_ONCE):
            part = words[start : start + WORDS_AT_ONCE]
            text = before + between.join(part)
            encoded = self._direct([text])[0] if PLAIN_WORDS.fullmatch(text) else b""
            ids = np.frombuffer(encoded, dtype="<u4")
            if between == "\n":
                edges = np.flatnonzero(ids == self.line_end)
                starts, ends = np.append(0, edges + 1), np.append(edges, len(ids))
            elif before:
                edges = np.flatnonzero(self.is_edge[ids])
                starts, ends = edges, np.append(edges[1:], len(ids))
            else:
                edges = np.flatnonzero(self.is_edge[ids])
                starts, ends = np.append(0, edges[:-1] + 1), edges + 1
            if len(starts) != len(part) or not encoded:
                other += part
                continue
            slices = [encoded[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]
            self.known.update(zip([mark + w for w in part] if mark else part, slices))
        self.known.update(zip([mark + p for p in other], self._direct([before + p for p in other])))


@lru_cache(maxsize=2)
def encoder(path: str, keeps_spaces: bool) -> TextEncoder:
    """The worker's encoder of a vocabulary, kept from task to task."""
    return TextEncoder(path, keeps_spaces)
