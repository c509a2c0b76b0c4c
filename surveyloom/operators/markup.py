"""A reader of HTML that goes over a page once and forgives what is wrong with it.

Every search starts where the last one ended, or is known to fail from there on, so a page takes time in proportion
to its length, whatever is left open in it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

# Elements without content, and elements whose content is not markup.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes"}
RAW_WITH_REFERENCES = {"textarea", "title"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW | RAW_WITH_REFERENCES}


class Reader:
    """Events of a page: ``("text", text, None)``, ``("start", name, attributes)``, ``("empty", name, attributes)``, ``("end", name, None)``.

    ``empty`` is an element without content. Character references are decoded, comments and declarations left out, also
    those that are misspelt; a comment or quoted value that never ends stops at the next ``>``. The content of scripts
    and the like is a text as it stands.
    """

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.absent: set[str] = set()
        self.place = 0  # where the last event ended

    def find(self, wanted: str, start: int) -> int:
        """Place of ``wanted`` from ``start`` on, -1 if there is none; what is not found is not looked for again."""
        if wanted in self.absent:
            return -1
        at = self.page.find(wanted, start)
        if at < 0:
            self.absent.add(wanted)
        return at

    def past(self, wanted: str, start: int) -> int:
        """Place after the next ``wanted``; the end of the page if there is none."""
        at = self.find(wanted, start)
        return self.size if at < 0 else at + len(wanted)

    def closes(self, name: str) -> bool:
        """Whether there is an end tag of this name after the last event."""
        if "</" + name in self.absent:
            return False
        found = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.IGNORECASE).search(self.page, self.place)
        if found is None:
            self.absent.add("</" + name)
        return found is not None

    def attributes(self, at: int) -> tuple[dict[str, str], int, bool]:
        """Attributes of a tag from ``at`` on, the place after the tag, and whether it ends in ``/>``. Of equal names the first counts."""
        page, found = self.page, {}
        while True:
            gap = _GAP.match(page, at)
            at = gap.end()
            if at >= self.size:
                return found, self.size, False
            if page[at] == ">":
                return found, at + 1, gap.group().endswith("/")
            name = _ATTRIBUTE.match(page, at)
            at, value = name.end(), ""
            if equals := _EQUALS.match(page, at):
                at = equals.end()
                if at < self.size and page[at] in "\"'":
                    end = self.find(page[at], at + 1)
                    closed = end >= 0
                    if not closed:
                        end = self.past(">", at) - 1
                    value, at = page[at + 1 : end], end + closed
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare.group(), bare.end()
            found.setdefault(name.group().lower(), entities.unescape(value) if "&" in value else value)

    def __iter__(self) -> Iterator[tuple[str, str, dict[str, str] | None]]:
        page, at, text_from = self.page, 0, 0

        def text(until: int):
            piece = page[text_from:until]
            return ("text", entities.unescape(piece) if "&" in piece else piece, None)

        while True:
            at = self.find("<", at)
            if at < 0 or at + 1 >= self.size:
                break
            mark, tag = page[at + 1], None
            if mark.isascii() and mark.isalpha():
                tag = _NAME.match(page, at + 1)
            elif mark == "/" and at + 2 < self.size and page[at + 2].isascii() and page[at + 2].isalpha():
                tag = _NAME.match(page, at + 2)
            elif mark not in "!?/":
                at += 1  # a plain character
                continue
            if text_from < at:
                yield text(at)
            if tag is None:
                end = self.find("-->", at + 2) if page.startswith("<!--", at) else -1
                at = text_from = end + 3 if end >= 0 else self.past(">", at)
            elif mark == "/":
                _, at, _ = self.attributes(tag.end())
                text_from = self.place = at
                yield ("end", tag.group().lower(), None)
            else:
                name = tag.group().lower()
                found, at, closed = self.attributes(tag.end())
                text_from = self.place = at
                yield ("empty" if closed or name in VOID else "start", name, found)
                if not closed and name in _RAW_END:
                    end = _RAW_END[name].search(page, at)
                    at = end.start() if end else self.size
                    if text_from < at:
                        yield text(at) if name in RAW_WITH_REFERENCES else ("text", page[text_from:at], None)
                    text_from = at
        if text_from < self.size:
            yield text(self.size)
