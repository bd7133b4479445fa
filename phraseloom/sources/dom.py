"""Pages as trees: elements by tag and class, visible strings and link targets, in Arrow batches.

Tags are kept on a stack: an end tag closes the innermost open element of its name and all within it, one without an open element is
ignored, void elements hold nothing. All character references are resolved; scripts, styles and comments hold no text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from phraseloom.shipping import ship

VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
SILENT = frozenset(("script", "style", "template"))
SELECTOR = re.compile(r"([a-z][a-z0-9-]*)?((?:\.[\w-]+)*)")


def selector(text: str) -> list[tuple[str, frozenset[str]]]:
    """``.word, a.word, h1`` -> (tag or '', classes) of each alternative."""
    found = []
    for part in text.split(","):
        m = SELECTOR.fullmatch(part.strip())
        if not m or not part.strip():
            raise ValueError(f"not a tag or class selector: {part!r}")
        found.append((m[1] or "", frozenset(c for c in m[2].split(".") if c)))
    return found


class Page(HTMLParser):
    """``texts``: for each selector the texts of its elements in document order; ``strings``: visible strings; ``links``: targets."""

    def __init__(self, selectors: list[list[tuple[str, frozenset[str]]]]):
        super().__init__(convert_charrefs=True)
        self.selectors, self.texts, self.strings, self.links = selectors, [[] for _ in selectors], [], []
        self.open: list[tuple[str, list]] = []  # name and the text lists that end with the element
        self.silent = 0
        self.pending = ""

    def handle_starttag(self, tag, attrs):
        self._flush()
        given = dict(reversed(attrs))  # of repeated attributes the first
        if tag == "a" and given.get("href"):
            self.links.append(given["href"])
        classes = frozenset((given.get("class") or "").split())
        own = []
        for place, alternatives in enumerate(self.selectors):
            if any((not name or name == tag) and wanted <= classes for name, wanted in alternatives):
                own.append([])
                self.texts[place].append(own[-1])
        if tag not in VOID:
            self.open.append((tag, own))
            self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        if any(name == tag for name, _ in self.open):
            while True:
                name, _ = self.open.pop()
                self.silent -= name in SILENT
                if name == tag:
                    break

    def handle_data(self, data):
        if not self.silent:
            self.pending += data

    def handle_comment(self, data):
        self._flush()

    def _flush(self):
        text, self.pending = self.pending.strip(), ""
        if text:
            self.strings.append(text)
            for _, own in self.open:
                for parts in own:
                    parts.append(text)


def parse(html: str | None, selectors: list[list[tuple[str, frozenset[str]]]]) -> Page:
    page = Page(selectors)
    page.feed(html or "")
    page.close()
    page._flush()
    return page


def parsed_pages(pages: DataFrame, selectors: dict[str, str], html: str = "html") -> DataFrame:
    """``pages`` without its html, with an array of texts for each selector, ``page_strings`` and ``page_links``.

    An element's text is that of all strings in it, joined by blanks. A null page is an empty one.
    """
    chosen, keep = [selector(s) for s in selectors.values()], [c for c in pages.columns if c != html]
    schema = ", ".join([*(f"`{c}` {dict(pages.dtypes)[c]}" for c in keep), *(f"`{name}` array<string>" for name in selectors), "page_strings array<string>, page_links array<string>"])

    ship(pages.sparkSession)

    def run(batches):
        kind = pa.list_(pa.string())
        for batch in batches:
            found = [parse(h, chosen) for h in batch.column(html).to_pylist()]
            texts = [pa.array([[" ".join(parts) for parts in p.texts[k]] for p in found], kind) for k in range(len(chosen))]
            lists = [*texts, pa.array([p.strings for p in found], kind), pa.array([p.links for p in found], kind)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *lists], names=[*keep, *selectors, "page_strings", "page_links"])

    return pages.mapInArrow(run, schema)
