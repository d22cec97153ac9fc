"""Cut a text into pieces that byte-level pre-tokenizers never join, so that results can be kept per piece."""

from __future__ import annotations

from collections.abc import Iterator


def space_units(text: str) -> list[str]:
    """Cut before every space that stands between two characters that are not white space.

    The usual pre-token pattern takes a space only in front of a word or inside a run of white space, so each pre-token
    lies within one unit, and the units joined give the text. Long texts are cut like short ones.
    """
    head, *rest = text.split(" ")
    units = [head]
    open_end = not head or head[-1].isspace()
    for part in rest:
        if open_end or not part or part[0].isspace():
            units[-1] += " " + part
        else:
            units.append(" " + part)
        open_end = not part or part[-1].isspace()
    return units


def separated(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Bytes in parts of about `size` that end at spaces, so that the words of a very long text are not held at once."""
    start = 0
    while len(data) - start > size:
        stop = data.find(b" ", start + size)
        if stop < 0:
            break
        yield data[start:stop]
        start = stop + 1
    yield data[start:]
