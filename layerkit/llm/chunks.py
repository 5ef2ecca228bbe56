"""Texts cut where a byte-level BPE always cuts: at a space between two characters that aren't white.

Its pre-tokenizer (`public_tokenizers.PATTERN`, the pattern inside the JSON
file too) takes white space only at the head of a match, so no token ever
crosses from a visible character over a space into the next one. What a chunk
gives is therefore the same wherever it stands, and can be kept by chunk.
"""

from __future__ import annotations

import os

#: Marks behind a word; the pre-tokenizer always cuts between a letter and these.
MARKS = ".,;:!?|"


def resolved(path: str) -> str:
    """A file's place on this machine; a bare name is one of the public tokenizers."""
    if os.path.isabs(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


class Kept(dict):
    """What `work` gives for a chunk, computed once while it stays in use.

    When `limit` chunks are kept, they become the old ones, and those of the
    old ones that come again move back; so common chunks stay and memory is
    bounded. None stands for a chunk that white space touches: its text needs
    to be worked on whole. Values of a letter run and of the marks behind it
    add up.
    """

    def __init__(self, work, limit: int = 600_000):
        super().__init__()
        self.work, self.limit = work, limit
        self.old: dict = {}

    def __missing__(self, chunk: str):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        if chunk in self.old:
            value = self.old.pop(chunk)
        elif not (bare := chunk.strip()) or bare != chunk:
            value = None
        else:
            word = chunk.rstrip(MARKS)
            if word != chunk and word and word[-1].isalpha():
                value = self[word] + self.work(chunk[len(word) :])
            else:
                value = self.work(" " + chunk)
        if len(chunk) <= 64:
            self[chunk] = value
        return value
