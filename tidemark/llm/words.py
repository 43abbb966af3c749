"""Numbering of words inside a task."""

from __future__ import annotations


class Index(dict):
    """Numbers words as they come, and tells which are new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def taken(self) -> list[str]:
        new, self.new = self.new, []
        return new
