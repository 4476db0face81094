"""A bounded memory of what a worker has computed for distinct words."""

from __future__ import annotations


class Remembered(dict):
    """``find(word)`` by word, in two generations of ``most`` words each: bounded, and frequent words stay."""

    def __init__(self, find, most: int = 300_000, longest: int = 64):
        super().__init__()
        self.find, self.most, self.longest, self.older = find, most, longest, {}

    def __missing__(self, word: str):
        value = self.older[word] if word in self.older else self.find(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value
