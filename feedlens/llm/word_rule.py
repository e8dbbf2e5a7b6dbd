"""How the word vocabulary cuts texts: special strings, normalising, and the splitting rule."""

from __future__ import annotations

import json
import re
import unicodedata

from tokenizers import Tokenizer

from feedlens.llm.byte_table import byte_characters

#: Below this code point composing changes nothing and the rule needs no more than a list
#: of the letters, numbers and spaces.
PLAIN_END = 0x250


def _class(test) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN_END) if test(chr(c)))


class WordRule:
    """Words of a part of text that lies between ASCII white space.

    No word of the vocabulary spans white space, so a text's words are those of its parts.
    Plain parts are cut here, all others by the library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.settings = json.load(file)
        self.library = Tokenizer.from_file(path)
        self._normalize = self.library.normalizer.normalize_str
        self._split = self.library.pre_tokenizer.pre_tokenize_str
        names = [t["content"] for t in self.settings["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")")
        rule = self.settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        letters = _class(str.isalpha)
        numbers = _class(lambda c: unicodedata.category(c)[0] == "N")
        spaces = _class(lambda c: c in "\t\n\v\f\r \x85\xa0")
        for escape, plain in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", spaces)):
            rule = rule.replace(escape, plain)
        self._plain = re.compile(rule).findall
        self._chars = byte_characters()
        # Some capitals below the border have their small letter above it.
        self._other = re.compile(f"[^{_class(lambda c: max(c.lower()) < chr(PLAIN_END))}]").search

    @staticmethod
    def is_far(word: str) -> bool:
        """Whether normalising an already normalised word might change it."""
        return not word.isascii() and max(word) >= chr(PLAIN_END)

    def symbols(self, word: str) -> str:
        """A normalised word as the model takes it: one sign for each byte."""
        return "".join([self._chars[b] for b in word.encode()])

    def words(self, part: str) -> list[str]:
        """Normalised words of a part without special strings."""
        if part.isascii():
            return [part.lower()] if part.isalpha() else self._plain(part.lower())
        if not self._other(part):
            return self._plain(part.lower())
        text = self._normalize(part)
        return [text[a:b] for _, (a, b) in self._split(text)]
