"""Exact pieces of a text: places where a tokenizer's split is proven not to look across.

Both public byte-level vocabularies cut a text with a pattern that reads from left to right and
never looks back, and both end a pre-token in front of a single blank that stands between two
visible characters: blanks only occur in white-space runs or as the one optional leading blank
of a pre-token. So encoding the pieces between such blanks one by one and concatenating gives
the library's own result. Special strings hold no blank, so no cut falls inside one.
"""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Iterator

VISIBLE = frozenset(string.ascii_letters + string.digits + string.punctuation)


def is_visible(ch: str) -> bool:
    """Letters, digits and ASCII punctuation: no white space, control or combining character."""
    return ch in VISIBLE or ch.isalnum()


def load_tokenizer(name: str):
    """The library's tokenizer for a file of ``public_tokenizers`` or a full path."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
    tk.no_truncation()
    tk.no_padding()
    return tk


def stable_cut(text: str, lo: int, hi: int) -> int:
    """The first stable cut x in [lo, hi): ``text[x]`` is a blank between two visible
    characters. -1 where there is none."""
    x = text.find(" ", max(lo, 1), hi)
    while x != -1:
        if x + 1 < len(text) and is_visible(text[x - 1]) and is_visible(text[x + 1]):
            return x
        x = text.find(" ", x + 1, hi)
    return -1


def pieces(text: str) -> Iterator[str]:
    """Pieces between stable cuts; each but the first begins with its blank."""
    start, x = 0, stable_cut(text, 0, len(text))
    while x != -1:
        yield text[start:x]
        start, x = x, stable_cut(text, x + 1, len(text))
    yield text[start:]


class PieceMemo:
    """What ``encode`` makes of each distinct piece, remembered within a Python worker.

    ``encode`` takes a list of pieces and gives a value each. The memo is cleared when it holds
    ``limit`` pieces, so its memory is bounded; pieces over ``longest`` characters never stay.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int, longest: int = 200):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.known: dict[str, object] = {}  # by the piece without its leading blank
        self.first: dict[str, object] = {}

    def values(self, text: str) -> list:
        """The values of the pieces of ``text`` in order."""
        words = text.split(" ")
        head, rest = words[0], words[1:]
        if rest and not (head and is_visible(head[-1])):
            return self._slow(text)
        out = list(map(self.known.get, rest))
        if None in out:
            holes = [i for i, v in enumerate(out) if v is None]
            missing = list({rest[i] for i in holes})
            if not all(w and is_visible(w[0]) and is_visible(w[-1]) for w in missing):
                return self._slow(text)
            made = self._learn(self.known, missing, " ")
            for i in holes:
                out[i] = made[rest[i]]
        return self._fill(self.first, [head], "") + out

    def _learn(self, memo: dict, missing: list[str], blank: str) -> dict:
        made = dict(zip(missing, self.encode([blank + w for w in missing]), strict=True))
        if len(memo) + len(made) > self.limit:
            memo.clear()
        memo.update((w, v) for w, v in made.items() if len(w) <= self.longest)
        return made

    def _fill(self, memo: dict, words: list[str], blank: str) -> list:
        out = list(map(memo.get, words))
        if None in out:
            made = self._learn(memo, list({w for w, v in zip(words, out, strict=True) if v is None}), blank)
            out = [made[w] if v is None else v for w, v in zip(words, out, strict=True)]
        return out

    def _slow(self, text: str) -> list:
        """Texts with runs of white space or odd characters next to a blank."""
        return self.of_pieces(list(pieces(text)))

    def of_pieces(self, parts: list[str]) -> list:
        out = self._fill(self.first, parts[:1], "")
        return out + self._fill(self.known, [p[1:] for p in parts[1:]], " ")
