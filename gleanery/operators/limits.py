"""The lengths that texts and lists are cut to, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    """Greatest lengths in characters, and the number of tags kept.

    Texts beyond them are cut, and the rows concerned are counted (``stats.with_rule_counts``). The rules of ``validate`` stay as
    they are: a text that a wider limit lets through, but a rule does not, sends its row to the quarantine.
    """

    title: int = 500
    url: int = 2000
    description: int = 2000
    author: int = 255
    tags: int = 20
    tag_length: int = 100
    error_message: int = 1000

    @property
    def texts(self) -> dict[str, int]:
        return {"title": self.title, "url": self.url, "description": self.description, "author": self.author}
