"""The byte-to-character mapping of byte-level vocabularies."""

from __future__ import annotations


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 characters for
    themselves, the other bytes from U+0100 on in their order."""
    visible = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    other = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + other.index(b)) for b in range(256)]
