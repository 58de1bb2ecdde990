"""Settings and prompts in YAML: nested maps and lists, quoted and plain scalars, lists and maps in one line, block text.

What settings files use, and no more: anchors, aliases, tags and plain text
over several lines are errors that name their line.
"""

from __future__ import annotations

import json
import re
from typing import Any

_KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s"'\[\]{}#&*!|>%@,-][^#]*?|-[^\s#][^#]*?)\s*:(?:\s+(.*)|$)""")
_BLOCK = re.compile(r"([|>])([+-]?)([1-9]?)([+-]?)\s*(?:#.*)?$")
_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^']|'')*')|([\[\]{},])|:(?=\s)|([^\s,\[\]{}"'][^,\[\]{}]*?)(?=\s*(?:[,\[\]{}]|:\s|$|\s#)))""")
#: Words that stand for values (fixed values of the format).
WORDS = {"": None, "~": None, "null": None, "true": True, "yes": True, "on": True, "false": False, "no": False, "off": False}
_INT, _HEX, _OCTAL = re.compile(r"[-+]?(?:0|[1-9][0-9_]*)$"), re.compile(r"[-+]?0x[0-9a-fA-F_]+$"), re.compile(r"[-+]?0[0-7_]+$")
_FLOAT = re.compile(r"[-+]?(?:[0-9][0-9_]*)?\.[0-9_]*(?:[eE][-+][0-9]+)?$")


class YamlError(ValueError):
    """Text outside the subset."""


def scalar(text: str) -> Any:
    """The value of a plain scalar."""
    low = text.lower()
    if low in WORDS and text in (low, low.capitalize(), low.upper()):
        return WORDS[low]
    digits = text.replace("_", "")
    for pattern, base in ((_INT, 10), (_HEX, 16), (_OCTAL, 8)):
        if pattern.match(text):
            return int(digits, base)
    if _FLOAT.match(text) and any(c.isdigit() for c in text):
        return float(digits)
    if m := re.fullmatch(r"([-+]?)\.(inf|Inf|INF|nan|NaN|NAN)", text):
        return float(m[1] + m[2])
    return text


def quoted(text: str) -> str:
    """The text of a quoted scalar."""
    if text[0] == "'":
        return text[1:-1].replace("''", "'")
    body = re.sub(r"\\(x[0-9A-Fa-f]{2}|[0ae])", lambda m: "\\u00" + (m[1][1:] if m[1][0] == "x" else {"0": "00", "a": "07", "e": "1b"}[m[1]]), text)
    return json.loads(body.replace("\t", "\\t"))


class Reader:
    """Lines of a file, read from the top."""

    def __init__(self, text: str):
        self.lines, self.at = text.removeprefix("﻿").splitlines(), 0

    def fail(self, why: str) -> YamlError:
        return YamlError(f"line {self.at + 1}: {why}")

    def peek(self) -> tuple[int, str]:
        """Indentation and text of the next line that says something; -1 at the end."""
        while self.at < len(self.lines):
            line = self.lines[self.at]
            body = line.strip(" ")
            if body.strip() and not body.startswith("#") and not (body.startswith("---") and self.at == 0):
                if body.startswith("\t"):
                    raise self.fail("a tab indents")
                return len(line) - len(line.lstrip(" ")), body.rstrip()
            self.at += 1
        return -1, ""

    def block(self, indent: int) -> Any:
        """The list, map or scalar whose lines are indented so far."""
        own, body = self.peek()
        if body == "-" or body.startswith("- "):
            return self.sequence(own)
        if _KEY.match(body):
            return self.mapping(own)
        self.at += 1
        return self.inline(body)

    def sequence(self, indent: int) -> list:
        out = []
        while (at := self.peek())[0] == indent and (at[1] == "-" or at[1].startswith("- ")):
            rest = at[1][1:].lstrip()
            if rest and not rest.startswith("#") and (_KEY.match(rest) or rest.startswith("- ") or rest == "-"):
                deeper = indent + len(at[1]) - len(rest)
                self.lines[self.at] = " " * deeper + rest  # what follows the dash is a block of its own
                out.append(self.block(deeper))
            else:
                out.append(self.value(rest, indent))
        return out

    def mapping(self, indent: int) -> dict:
        out: dict[Any, Any] = {}
        while (at := self.peek())[0] == indent and not at[1].startswith("- "):
            m = _KEY.match(at[1])
            if not m:
                raise self.fail(f"no key: {at[1]!r}")
            key = quoted(m[1]) if m[1][0] in "\"'" else scalar(m[1])
            out[key] = self.value(m[2] or "", indent, lists=True)
        if at[0] > indent:
            raise self.fail("indented too far")
        return out

    def value(self, rest: str, indent: int, lists: bool = False) -> Any:
        """What follows a key or a dash: on its line, or indented below; a key's list may stand as far left as the key."""
        self.at += 1
        if m := _BLOCK.match(rest):
            return self.text(indent, m)
        if rest and not rest.startswith("#"):
            return self.inline(rest)
        own, body = self.peek()
        if own > indent or lists and own == indent and (body == "-" or body.startswith("- ")):
            return self.block(own)
        return None

    def text(self, indent: int, how: re.Match) -> str:
        """Block text: its lines as they are, or folded; the last line breaks kept, dropped, or made one."""
        start = self.at
        while self.at < len(self.lines) and (not self.lines[self.at].strip() or len(self.lines[self.at]) - len(self.lines[self.at].lstrip(" ")) > indent):
            self.at += 1
        lines = self.lines[start : self.at]
        depth = max(indent, 0) + int(how[3]) if how[3] else next((len(x) - len(x.lstrip(" ")) for x in lines if x.strip()), 0)
        lines = [x[depth:] if x.strip() else x[depth:].strip() for x in lines]
        full = len(lines)
        while full and not lines[full - 1]:
            full -= 1
        body, chomp = lines[:full], how[2] or how[4]
        if how[1] == "|":
            out = "\n".join(body)
        else:
            out = ""
            for k, x in enumerate(body):
                near = k and x and body[k - 1] and not x.startswith((" ", "\t")) and not body[k - 1].startswith((" ", "\t"))
                out += (" " if near else "\n" if k and (not x or body[k - 1] or x.startswith((" ", "\t"))) else "") + x
        return out + ("\n" * (len(lines) - full + bool(body)) if chomp == "+" else "" if chomp == "-" or not body else "\n")

    def inline(self, text: str) -> Any:
        """A value on one line."""
        if text[0] in "&*!%@`":
            raise self.fail(f"not in the subset: {text!r}")
        if text[0] in "[{":
            tokens = self.tokens(text)
            out = self.flow(tokens)
            if tokens:
                raise self.fail(f"more than one value: {text!r}")
            return out
        if text[0] in "\"'":
            m = _TOKEN.match(text)
            if not m or not m[1] or text[m.end() :].strip() and not re.match(r"\s+#", text[m.end() :]):
                raise self.fail(f"a quote has no end: {text!r}")
            return quoted(m[1])
        plain = re.split(r"\s+#", text)[0].rstrip()
        if re.search(r":\s", plain):
            raise self.fail(f"a key inside a value: {text!r}")
        return scalar(plain)

    def tokens(self, text: str) -> list[tuple[str, Any]]:
        """Marks and values of a flow, in order; a flow may go on over lines."""
        out, open_ = [], 0
        while True:
            at = 0
            while at < len(text) and text[at:].strip() and not re.match(r"\s*#", text[at:] if at else "x"):
                m = _TOKEN.match(text, at)
                if not m:
                    raise self.fail(f"not in the subset: {text!r}")
                at = m.end()
                if m[1]:
                    out.append(("value", quoted(m[1])))
                elif m[3]:
                    out.append(("value", scalar(m[3])))
                else:
                    out.append((m[2] or ":", None))
                    open_ += (m[2] or "") in ("[", "{") and m[2] is not None
                    open_ -= (m[2] or "") in ("]", "}") and m[2] is not None
            if open_ <= 0:
                return out
            if self.at >= len(self.lines):
                raise self.fail("a list or map has no end")
            text = self.lines[self.at].strip()
            self.at += 1

    def flow(self, tokens: list[tuple[str, Any]]) -> Any:
        kind, value = tokens.pop(0) if tokens else ("end", None)
        if kind == "value":
            return value
        if kind not in "[{":
            raise self.fail("a value is missing")
        out: Any = [] if kind == "[" else {}
        end = "]" if kind == "[" else "}"
        while tokens and tokens[0][0] != end:
            own = self.flow(tokens)
            if kind == "{":
                has = tokens and tokens[0][0] == ":"
                if has:
                    tokens.pop(0)
                out[own] = self.flow(tokens) if has and tokens and tokens[0][0] not in (",", end) else None
            else:
                out.append(own)
            if tokens and tokens[0][0] == ",":
                tokens.pop(0)
            elif not tokens or tokens[0][0] != end:
                raise self.fail("a comma is missing")
        if not tokens:
            raise self.fail("a list or map has no end")
        tokens.pop(0)
        return out


def loads(text: str) -> Any:
    """The value of a file; None of an empty one."""
    reader = Reader(text)
    own = reader.peek()[0]
    if own < 0:
        return None
    out = reader.block(own)
    if reader.peek()[0] >= 0:
        raise reader.fail("indented less than before")
    return out
