"""The standard library's HTML parser with a short way for plain markup, which most of a page is."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

#: A text and the plain tag behind it: nothing in it reads differently by any rule of the full parser.
PLAIN = re.compile(r'([^<]*)<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z][a-zA-Z-]*="[^"<>]*")*))>')
ATTRIBUTE = re.compile(r' ([a-zA-Z-]+)="([^"]*)"')
#: Elements whose content is no markup, in any version of the library.
RAW = frozenset((*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"))


class Walk(HTMLParser):
    """``feed`` takes a whole page; handlers are called as the parser would call them, without its count of lines.

    From the first markup that is not plain the full parser reads on, after an element of raw text the short way goes on.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)

    def feed(self, data: str) -> None:
        at, match = 0, PLAIN.match
        start, end, text = self.handle_starttag, self.handle_endtag, self.handle_data
        while m := match(data, at):
            before, closed, opened, attrs = m.groups()
            if opened and (opened := opened.lower()) in RAW:
                close = data.find(f"</{opened}>", m.end())
                if close < 0:
                    break
                upto = close + len(opened) + 3
                super().feed(data[at:upto])
                at = upto
                if self.rawdata or self.cdata_elem:
                    break
                continue
            at = m.end()
            if before:
                text(unescape(before) if "&" in before else before)
            if closed:
                end(closed.lower())
            else:
                start(opened, [(k.lower(), unescape(v) if "&" in v else v) for k, v in ATTRIBUTE.findall(attrs)] if attrs else [])
        super().feed(data[at:])
