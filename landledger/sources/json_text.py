"""Syntax of JSON documents, checked block by block."""

from __future__ import annotations

import codecs
import re

_BLANK = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"[-+.0-9A-Za-z]+")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?")
_STRING = re.compile(r'[^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4})[^"\\\x00-\x1f]*)*')
_WORDS = {"true", "false", "null", "NaN", "Infinity", "-Infinity"}
# An escape is at most this long; a shorter rest of a block may be the start of one.
_ESCAPE = 6


class JsonSyntax:
    """Fed with the blocks of one document in UTF-8; holds no more than a block and the open brackets.

    Accepts what Python's own parser accepts, with numbers of any length.
    """

    def __init__(self):
        self.decoder = codecs.getincrementaldecoder("utf-8")()
        self.rest, self.open, self.inside, self.key = "", [], False, False
        # what may come next: a value, a key, a colon, a comma, or an end
        self.want = {"value"}

    def feed(self, block: bytes, last: bool = False) -> bool:
        """Whether the text so far can be the beginning of a document; with ``last``, whether it is one."""
        try:
            text = self.rest + self.decoder.decode(block, last)
        except UnicodeDecodeError:
            return False
        at = 0
        while True:
            if self.inside:
                at = _STRING.match(text, at).end()
                if at < len(text) and text[at] == '"':
                    self.inside, at = False, at + 1
                    self._done(self.key)
                    continue
                if at < len(text) and (text[at] != "\\" or len(text) - at >= _ESCAPE or last):
                    return False
                break
            at = _BLANK.match(text, at).end()
            if at == len(text):
                break
            c = text[at]
            if c == '"':
                if not self.want & {"value", "key"}:
                    return False
                self.inside, self.key, at = True, "key" in self.want, at + 1
            elif c in "{[":
                if "value" not in self.want:
                    return False
                self.open.append(c)
                self.want, at = ({"key", "}"} if c == "{" else {"value", "]"}), at + 1
            elif c in "}]":
                if c not in self.want:
                    return False
                self.open.pop()
                self._done(False)
                at += 1
            elif c in ":,":
                if c not in self.want:
                    return False
                self.want, at = ({"value"} if c == ":" or self.open[-1] == "[" else {"key"}), at + 1
            else:
                word = _SCALAR.match(text, at)
                if word is None or "value" not in self.want:
                    return False
                if word.end() == len(text) and not last:
                    break
                if word[0] not in _WORDS and not _NUMBER.fullmatch(word[0]):
                    return False
                self._done(False)
                at = word.end()
        self.rest = text[at:]
        return not last or (not self.inside and not self.open and not self.want and not self.rest)

    def _done(self, key: bool) -> None:
        if key:
            self.want = {":"}
        elif self.open:
            self.want = {",", "}" if self.open[-1] == "{" else "]"}
        else:
            self.want = set()
