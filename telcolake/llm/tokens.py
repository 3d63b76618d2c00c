"""Token ids of whole texts inside Spark tasks, with a bounded memo of words.

Byte-pair encoders work word by word, so a text may be cut between words and encoded
piece by piece with the same ids. ``WordEncoder`` encodes each distinct word once and
joins the results. Cuts lie only where the tokenizer itself always cuts: between a
visible character and white space. ``tests/llm`` holds it against whole-text encoding.
"""

from __future__ import annotations

import os
import re

import numpy as np

# White space as the tokenizers see it: Python also counts the separators 1C-1F.
_SPACE = r"[^\S\x1c-\x1f]"
_WORD = r"[\S\x1c-\x1f]"
# Leading space belongs to the word that follows.
WITH_SPACE = re.compile(f"{_SPACE}*{_WORD}+|{_SPACE}+").findall
WITHOUT_SPACE = re.compile(f"{_WORD}+").findall
# Marks that a tokenizer may join to a full stop or comma.
_MARKS = re.compile(r"[^\w\s][.,] |_[.,] ").search
# Bytes of texts whose only marks are full stops and commas, and two of these in a row.
_SIMPLE = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n.,"
_TWO_MARKS = re.compile(r"[.,][.,] ").search
_PLAIN = re.compile(r"[^\S \n]|[\x1c-\x1f]").search

# Words kept per Python process; the memo starts afresh when it is full.
MEMO_WORDS = 700_000
# Words joined into one call of the tokenizer.
JOINED = 400
_MARK = "<|endoftext|>"

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Encode texts with one tokenizer file; ids come as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        self.marked = Tokenizer.from_file(path)
        self.mark = self.marked.token_to_id(_MARK)
        # A tokenizer that drops white space gives the same ids with and without it.
        self.drops_space = self.exact.encode("a b", add_special_tokens=False).ids == [
            i for w in ("a", "b") for i in self.exact.encode(w, add_special_tokens=False).ids
        ]
        plain = lambda t: self.exact.encode(t, add_special_tokens=False).ids
        self.lowers = plain("ABC xY") == plain("abc xy")
        self.parts_marks = all(plain(f"a{m}") == plain("a") + plain(m) and plain(f"1{m}") == plain("1") + plain(m) for m in ".,")
        self.memo: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        if not self.drops_space:
            return WITH_SPACE(text)
        simple = text.isascii() and not text.encode().translate(None, _SIMPLE)
        if not simple and _PLAIN(text):
            return WITHOUT_SPACE(text)
        text = text.replace("\n", " ")
        if self.lowers and text.isascii():
            text = text.lower()
        # A full stop or comma after a letter or digit is a word of its own.
        if self.parts_marks and not (_TWO_MARKS if simple else _MARKS)(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if "<|" not in w and "|>" not in w] if self.mark is not None else []
        if len(plain) < len(new):
            for w in set(new).difference(plain):
                self.memo[w] = np.array(self.exact.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        joined = self.marked.encode_batch_fast([_MARK.join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, joined):
            ids = np.array(encoding.ids, "<u4")
            ends = (np.flatnonzero(ids == self.mark) * 4).tolist()
            raw = ids.tobytes()
            start = 0
            for word, end in zip(group, [*ends, len(raw)]):
                self.memo[word] = raw[start:end]
                start = end + 4

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One byte string of ids per text; a missing text has none."""
        split = [self.words(t) if t else [] for t in texts]
        seen = set().union(*split)
        new = seen.difference(self.memo)
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo = {}
            new = seen
        if new:
            self._learn(list(new))
        get = self.memo.__getitem__
        return [b"".join(map(get, ws)) for ws in split]


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python process for one file; workers are reused between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def batches(texts: list, most: int = 2_000_000):
    """Slices of ``texts`` of about ``most`` characters, so that long texts don't pile up."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
