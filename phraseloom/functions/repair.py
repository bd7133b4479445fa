"""Repair of JSON that a model wrote badly: a reader that goes through the text once, with a stack of open objects and arrays."""

from __future__ import annotations

import json
import re

QUOTES = {'"': '"', "'": "'", "“": "”", "`": "`"}
WORDS = {"true": True, "false": False, "null": None, "none": None, "nan": None, "undefined": None}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
BLANK = re.compile(r"(?:\s+|//[^\n]*|/\*.*?(?:\*/|\Z)|#[^\n]*)+", re.S)
#: What may follow a string: punctuation, the end, or the next key or item where a comma is missing.
AFTER = re.compile(r"\s*(?:[,}\]:]|\Z|//|/\*|#|```)")
NEXT_KEY = re.compile(r"""\s*(?:["'“`][^"'”`\n]*["'”`]|[A-Za-z_]\w*)\s*:""")
NEXT_ITEM = re.compile(r"""\s*(?:["'“`][^"'”`\n]*["'”`]\s*[,\]]|[\[{]|-?\d)""")
BARE = re.compile(r"[^,:\]}\n]+")


class Reader:
    def __init__(self, text: str, at: int):
        self.text, self.at = text, at

    def blank(self) -> str:
        """Skips white space and comments; the next character, '' at the end."""
        found = BLANK.match(self.text, self.at)
        if found:
            self.at = found.end()
        return self.text[self.at : self.at + 1]

    def string(self, place: str) -> str:
        """From an opening quote to the one that can be the end in a key, an object's value or an array's item; else to the text's end."""
        end, out = QUOTES[self.text[self.at]], []
        self.at += 1
        while self.at < len(self.text):
            c = self.text[self.at]
            self.at += 1
            if c == "\\" and self.at < len(self.text):
                e = self.text[self.at]
                self.at += 1
                code = re.compile(r"[0-9a-fA-F]{4}").match(self.text, self.at) if e == "u" else None
                if code:
                    out.append(chr(int(code[0], 16)))
                    self.at = code.end()
                else:
                    out.append(ESCAPES.get(e, e))
            elif c == end and (place == "key" and c == '"' or AFTER.match(self.text, self.at) or place == "value" and NEXT_KEY.match(self.text, self.at) or place == "item" and NEXT_ITEM.match(self.text, self.at)):
                break
            else:
                out.append(c)
        text = "".join(out)
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if any("\ud800" <= x <= "\udfff" for x in text) else text

    def bare(self):
        """A number, a word of JSON or Python, or a text without quotes, up to punctuation or the end of the line."""
        found = BARE.match(self.text, self.at)
        word = re.split(r"\s*(?://|/\*|#|```)", found[0], maxsplit=1)[0].strip()
        self.at += len(found[0]) if word == found[0].strip() else max(len(word), 1)
        if word.lower() in WORDS:
            return WORDS[word.lower()]
        try:
            value = json.loads(word, parse_constant=lambda _: None)
        except ValueError:
            return word
        return value


def read(text: str, start: int):
    """The object or array that begins at ``start``, read to its end or that of the text. What is missing is left out."""
    r = Reader(text, start)
    top = [] if text[start] == "[" else {}
    stack, key = [top], [None]  # open values, and the key that waits for a value in each
    r.at += 1

    def put(value) -> None:
        if isinstance(stack[-1], list):
            stack[-1].append(value)
        elif key[-1] is not None:
            stack[-1][key[-1]], key[-1] = value, None

    while stack and (c := r.blank()):
        in_object = isinstance(stack[-1], dict)
        if c in "}]":
            r.at += 1
            while len(stack) > 1 and isinstance(stack[-1], dict) != (c == "}") and any(isinstance(s, dict) == (c == "}") for s in stack):
                stack.pop(), key.pop()  # closers of what is within were forgotten
            if isinstance(stack[-1], dict) == (c == "}"):
                stack.pop(), key.pop()
        elif c in ",:":
            r.at += 1
            if c == "," and in_object:
                key[-1] = None
        elif text.startswith("```", r.at):
            break
        elif in_object and key[-1] is None and c not in "{[":
            name = r.string("key") if c in QUOTES else str(r.bare())
            key[-1] = name if r.blank() == ":" else None
        elif c in "{[":
            value = [] if c == "[" else {}
            put(value)
            stack.append(value)
            key.append(None)
            r.at += 1
        else:
            put(r.string("value" if in_object else "item") if c in QUOTES else r.bare())
    return top


def filled(value) -> bool:
    """Whether there is anything but brackets in it."""
    return any(map(filled, value.values() if isinstance(value, dict) else value)) if isinstance(value, (dict, list)) else True


def repaired(text: str | None, opening: str) -> str | None:
    """JSON of what can be read from the first opening bracket on, null if there is nothing in it."""
    start = text.find(opening) if text else -1
    if start < 0:
        return None
    try:
        value = read(text, start)
        return json.dumps(value, ensure_ascii=False) if filled(value) else None
    except (RecursionError, ValueError):
        return None
