"""Regular expressions as trees, as far as their mandatory text is concerned.

A sequence is a list of nodes:

    ("set", characters)         one of a few characters; None for a class of many
    ("group", sequence)         whatever its kind
    ("either", [sequence, ...])
    ("repeat", low, high, sequence)     high is None without an upper bound
    ("free",)                   says nothing: a place, a look around, a reference

Expressions are those Java and Python share; an expression that cannot be read is refused.
"""

from __future__ import annotations

import re

_QUANTITY = re.compile(r"(?:([*+?])|\{(\d+)(,?)(\d*)\})[?+]?")
_CONTROL = {"t": "\t", "n": "\n", "r": "\r", "f": "\f", "a": "\a", "e": "\x1b"}
_PLACES = "bBAZzG"
_HEX = re.compile(r"x([0-9a-fA-F]{2})|u([0-9a-fA-F]{4})")


class _Reader:
    def __init__(self, pattern: str):
        self.pattern, self.at = pattern, 0

    def peek(self) -> str:
        return self.pattern[self.at : self.at + 1]

    def take(self) -> str:
        if self.at >= len(self.pattern):
            raise ValueError(f"unfinished expression: {self.pattern}")
        self.at += 1
        return self.pattern[self.at - 1]

    def branches(self) -> list:
        found = [self.sequence()]
        while self.peek() == "|":
            self.take()
            found.append(self.sequence())
        return found[0] if len(found) == 1 else [("either", found)]

    def sequence(self) -> list:
        nodes = []
        while self.peek() not in ("", "|", ")"):
            node = self.atom()
            while found := _QUANTITY.match(self.pattern, self.at):
                self.at = found.end()
                mark, low, comma, high = found.groups()
                if mark:
                    span = {"*": (0, None), "+": (1, None), "?": (0, 1)}[mark]
                else:
                    span = (int(low), int(high) if high else None if comma else int(low))
                node = ("repeat", *span, [node])
            nodes.append(node)
        return nodes

    def atom(self):
        first = self.take()
        if first == "(":
            return self.group()
        if first == "[":
            return ("set", self.members())
        if first == "\\":
            return self.escape()
        if first in "^$":
            return ("free",)
        return ("set", None if first == "." else {first})

    def group(self):
        free = False
        if self.peek() == "?":
            kind = re.compile(r"\?(?:[:>]|[a-zA-Z]*(?:-[a-zA-Z]+)?:|P?<\w+>|(<?[=!]))").match(self.pattern, self.at)
            if kind is None:
                raise ValueError(f"unknown group in {self.pattern}")
            free, self.at = kind[1] is not None, kind.end()
        inside = self.branches()
        if self.take() != ")":
            raise ValueError(f"unclosed group in {self.pattern}")
        return ("free",) if free else ("group", inside)

    def character(self) -> str | None:
        """What a backslash and the next characters stand for; None for a class."""
        found = _HEX.match(self.pattern, self.at)
        if found:
            self.at = found.end()
            return chr(int(found[1] or found[2], 16))
        letter = self.take()
        if letter in "pP":
            self.at = self.pattern.index("}", self.at) + 1 if self.peek() == "{" else self.at + 1
            return None
        if letter.isdigit() or letter.isalpha():
            return _CONTROL.get(letter)
        return letter

    def escape(self):
        letter = self.peek()
        if letter in _PLACES or (letter.isdigit() and letter != "0"):
            self.take()
            return ("free",)
        found = self.character()
        return ("set", None if found is None else {found})

    def members(self) -> set[str] | None:
        """Characters of a class that lists them one by one; None where it has ranges or more."""
        found, listed = set(), True
        if self.peek() == "^":
            self.take()
            listed = False
        first = True
        while first or self.peek() != "]":
            first = False
            here = self.take()
            if here == "[" or (here == "&" and self.peek() == "&"):
                raise ValueError(f"class within a class in {self.pattern}")
            one = self.character() if here == "\\" else here
            if self.peek() == "-" and self.pattern[self.at + 1 : self.at + 2] not in ("", "]"):
                self.take()
                if self.take() == "\\":
                    self.character()
                listed = False
            if one is None:
                listed = False
            found.add(one)
        self.take()
        return found if listed else None


def parse(pattern: str) -> list:
    """The sequence an expression stands for."""
    reader = _Reader(pattern)
    found = reader.branches()
    if reader.at < len(pattern):
        raise ValueError(f"unopened group in {pattern}")
    return found
