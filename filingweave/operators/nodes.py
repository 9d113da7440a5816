"""Markup text -> text nodes and tables in document order (runs inside Spark tasks)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa

from filingweave import fixed_values as fv
from filingweave.functions.text import SQUASHED

NODE_TYPE = (
    "struct<texts: array<struct<pos: int, text: string, marked: boolean>>, "
    "tables: array<struct<pos: int, text: string, rows: array<struct<section: string, "
    "cells: array<struct<kind: string, text: string>>>>, body: boolean>>>"
)
_CELL = pa.struct([("kind", pa.string()), ("text", pa.string())])
_ROW = pa.struct([("section", pa.string()), ("cells", pa.list_(_CELL))])
_TABLE = pa.struct([("pos", pa.int32()), ("text", pa.string()), ("rows", pa.list_(_ROW)), ("body", pa.bool_())])
_TEXT = pa.struct([("pos", pa.int32()), ("text", pa.string()), ("marked", pa.bool_())])
NODE_TYPE_ARROW = pa.struct([("texts", pa.list_(_TEXT)), ("tables", pa.list_(_TABLE))])

# fixed values: tags that never hold content, and tags whose text is not document text
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr keygen menuitem "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
_SILENT = frozenset(["script", "style", "template"])


_SQUASHED = dict.fromkeys(map(ord, SQUASHED))

# fixed values: tags whose content the parser does not take for markup
_RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext noscript".split())

# well-formed pieces of markup; a document made only of these needs no lenient parser
_WS = r"[ \t\n\r\f]"
_ATTRIBUTE = rf"{_WS}++[a-zA-Z_:][-\w:.]*+(?:{_WS}*+={_WS}*+(?:\"[^\"]*+\"|'[^']*+'|[-\w.%#:]++(?=[ \t\n\r\f>])))?+"
_PIECE = re.compile(
    rf"([^<]++|<([a-zA-Z][-\w:.]*+)(?:{_ATTRIBUTE})*+{_WS}*+(/?)>|</([a-zA-Z][-\w:.]*+)>"
    rf"|<!--([^->][^-]*+(?:-[^-]++)*+)-->|<\?([^>]*+)>|<!((?i:doctype) [^>]*+)>)"
)


#: What a tag's text between its angle brackets is, as ``_PIECE`` reads it; cleared when it holds many.
_KNOWN: dict[str, tuple | None] = {}
_KNOWN_TAGS = 20_000


def _known(inside: str) -> tuple | None:
    """(name of an opening tag, is it empty, name of an end tag, is it other markup), None if ``<inside>`` is no piece."""
    if len(_KNOWN) >= _KNOWN_TAGS:
        _KNOWN.clear()
    piece = _PIECE.fullmatch(f"<{inside}>")
    found = None
    if piece:
        _, name, empty, closed, *_ = piece.groups(default="")
        found = name.lower(), bool(empty), closed.lower(), not (name or closed)
    _KNOWN[inside] = found
    return found


class _Tag:
    """An element. Its children are tags, visible texts (str) and, for comments and the like, None.

    ``first`` and ``last`` bound the visible texts below it among those of the document; an open tag has them to the end.
    """

    __slots__ = ("name", "parent", "children", "pos", "at", "first", "last")

    def __init__(self, name: str, parent: _Tag | None, pos: int, first: int = 0) -> None:
        self.name, self.parent, self.pos = name, parent, pos
        self.children: list = []
        self.at = len(parent.children) if parent is not None else 0
        self.first, self.last = first, None

    def strings(self):
        """Visible texts in document order, at any depth; what scripts hold is not text."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if type(child) is str:
                    yield child
                elif child is not None and child.name not in _SILENT:
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def stripped(self) -> str:
        children = self.children
        if len(children) == 1 and type(children[0]) is str:
            return children[0].strip()
        return "".join([s.strip() for s in self.strings()])

    def lead(self, limit: int) -> str:
        out, size = [], 0
        for s in self.strings():
            out.append(s)
            size += len(s)
            if size >= limit:
                break
        return "".join(out)[:limit]


def _plain_inside(following: list[tuple], tag: str) -> bool:
    """Is what follows the opening tag at most one text without entities, then its end tag?"""
    if following and following[0][0][0] != "<" and "&" not in following[0][0]:
        following = following[1:]
    return bool(following) and following[0][3].lower() == tag


class _Reader(HTMLParser):
    """Lenient tree: an end tag closes the nearest open tag of its name, others stay open around it."""

    def __init__(self, wanted: re.Pattern, squashed: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.holds_word, self.squashed = wanted.search, squashed
        self.pos, self.pending = 0, []
        self.stripped: list[str] = []
        self.silent = False
        self.root = self.here = _Tag("", None, 0)
        self.open_tags: dict[str, int] = {}
        self.hits: list[tuple[int, str, _Tag]] = []
        self.tags: list[_Tag] = []

    def flush(self) -> None:
        if self.pending:
            self.add_text("".join(self.pending), True)
            self.pending.clear()

    def add_text(self, text: str, visible: bool) -> None:
        self.pos += 1
        if visible:
            bare = text.strip()
            if not bare and not text.strip(" \t\n\r\f\v"):
                text = "\n" if "\n" in text else " "
            self.stripped.append(bare)
        self.here.children.append(text if visible else None)
        if self.squashed:
            text = text.translate(_SQUASHED)
        if self.holds_word(text):
            self.hits.append((self.pos, text, self.here))

    def read(self, text: str) -> None:
        self.feed(text)
        self.close()
        self.flush()

    def read_plain(self, text: str) -> bool:
        """As ``read_well_formed``, if each piece between angle brackets is one by itself: tags are looked up, not matched."""
        parts = text.split("<")
        known, here, open_tags, stripped = _KNOWN, self.here, self.open_tags, self.stripped
        if parts[0]:
            self.add_text(unescape(parts[0]) if "&" in parts[0] else parts[0], True)
        for i in range(1, len(parts)):
            inside, ended, words = parts[i].partition(">")
            if not ended:
                return False
            found = known[inside] if inside in known else _known(inside)
            if found is None:
                return False
            name, empty, closed, other = found
            if name:
                if name in _RAW and (empty or "&" in words or not parts[i + 1 : i + 2] or _end_tag(parts[i + 1]) != name):
                    return False
                self.pos += 1
                tag = _Tag(name, here, self.pos, len(stripped))
                here.children.append(tag)
                self.tags.append(tag)
                if name in _VOID or empty:
                    tag.last = tag.first
                else:
                    here = tag
                    open_tags[name] = open_tags.get(name, 0) + 1
                if name in _SILENT:
                    self.silent = True
            elif closed:
                if open_tags.get(closed):
                    while True:
                        shut, here = here, here.parent
                        shut.last = len(stripped)
                        open_tags[shut.name] -= 1
                        if shut.name == closed:
                            break
            self.here = here
            if other:
                self.add_text(_PIECE.fullmatch(f"<{inside}>").expand(r"\5\6\7"), False)
            if words:
                self.add_text(unescape(words) if "&" in words else words, True)
        return True

    def read_well_formed(self, text: str) -> bool:
        """The same events several times faster; False (and no result) if any piece is out of the ordinary."""
        pieces = _PIECE.findall(text)
        if sum(len(p[0]) for p in pieces) != len(text):
            return False
        for i, (whole, name, empty, closed, comment, pi, doctype) in enumerate(pieces):
            if name:
                tag = name.lower()
                if tag in _RAW and (empty or not _plain_inside(pieces[i + 1 : i + 3], tag)):
                    return False
                if empty:
                    self.handle_startendtag(tag, ())
                else:
                    self.handle_starttag(tag, ())
            elif closed:
                self.handle_endtag(closed.lower())
            elif whole[0] != "<":
                self.add_text(unescape(whole) if "&" in whole else whole, True)
            elif comment:
                self.handle_comment(comment)
            elif doctype:
                self.handle_decl(doctype)
            else:
                self.handle_pi(pi)
        return True

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self.flush()
        self.add_text(data, False)

    def handle_decl(self, decl: str) -> None:
        self.flush()
        self.add_text(decl, False)

    def handle_pi(self, data: str) -> None:
        self.flush()
        self.add_text(data, False)

    def unknown_decl(self, data: str) -> None:
        self.flush()
        is_cdata = data.upper().startswith("CDATA[")
        self.add_text(data[6:] if is_cdata else data, is_cdata)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.flush()
        self.pos += 1
        node = _Tag(tag, self.here, self.pos, len(self.stripped))
        self.here.children.append(node)
        self.tags.append(node)
        if tag in _SILENT:
            self.silent = True
        if tag in _VOID:
            node.last = node.first
        else:
            self.here = node
            self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        if not self.open_tags.get(tag):
            return
        while True:
            closed, self.here = self.here, self.here.parent
            closed.last = len(self.stripped)
            self.open_tags[closed.name] -= 1
            if closed.name == tag:
                return


def _text_of(node: _Tag | str | None) -> str:
    return "".join(node.strings()) if isinstance(node, _Tag) else node or ""


def _end_tag(part: str) -> str:
    """The name of the end tag that a part of a text behind an opening angle bracket begins with, else ''."""
    inside, ended, _ = part.partition(">")
    found = ended and (_KNOWN[inside] if inside in _KNOWN else _known(inside))
    return found[2] if found else ""


def _owner(tag: _Tag, names: tuple[str, ...]) -> _Tag | None:
    node = tag.parent
    while node is not None and node.name not in names:
        node = node.parent
    return node


def _tables(tags: list[_Tag], after: int = -1, stripped: list[str] | None = None) -> list[tuple]:
    """(pos, text, rows, whether it has a body) of each table, with its own rows (section, cells) and each row's own cells
    (kind, text), decided by position in the tree. Only tables that begin behind the position ``after``.
    ``stripped``: the document's visible texts, if nothing in it is silent."""
    tables: dict[_Tag, list] = {t: [] for t in tags if t.name == "table" and t.pos > after}
    sections: dict[tuple[_Tag, str], _Tag] = {}
    rows: dict[_Tag, list] = {}

    def text(tag: _Tag) -> str:
        if stripped is None:
            return tag.stripped()
        return stripped[tag.first] if tag.last == tag.first + 1 else "".join(stripped[tag.first : tag.last])

    for tag in tags:
        name, parent = tag.name, tag.parent
        if name == "td" or name == "th":
            if (row := parent if parent.name == "tr" else _owner(tag, ("tr", "table"))) in rows:
                rows[row].append((name, text(tag)))
        elif name == "tr":
            part = _owner(tag, ("table", "tbody", "thead"))
            if part is not None and (table := part if part.name == "table" else _owner(part, ("table",))) in tables:
                section = "other"
                if part is not table and sections.get((table, part.name)) is part:
                    section = "body" if part.name == "tbody" else "head"
                rows[tag] = cells = []
                tables[table].append((section, cells))
        elif name == "tbody" or name == "thead":
            sections.setdefault((_owner(tag, ("table",)), name), tag)
        elif parent in rows:
            rows[parent].append(("other", text(tag)))
    return [(tag.pos, text(tag), found, (tag, "tbody") in sections) for tag, found in tables.items()]


def _context(tag: _Tag) -> str:
    """The start of a tag's text, then the text of the siblings just before it, nearest first."""
    before: list = []
    if tag.parent is not None:
        before = tag.parent.children[max(0, tag.at - fv.CONTEXT_SIBLINGS) : tag.at][::-1]
    return tag.lead(fv.CONTEXT_CHARS) + " ".join(map(_text_of, before))


def any_of(words: Sequence[str]) -> re.Pattern:
    """Finds any of the words; without words, anything."""
    return re.compile("|".join(map(re.escape, words)))


def read_nodes(
    text: str | None, wanted: re.Pattern, mark: str, behind_hits: bool = False, squashed: bool = False
) -> tuple | None:
    """(texts, tables) of one document, of its texts those with a wanted word; with ``behind_hits``, of its
    tables those that begin behind the first such text. ``squashed``: texts are looked at, and given, without
    blanks and quotes.

    A text is marked when ``mark`` occurs around it. That is decided here, once for each parent tag, so that
    no long context has to leave with every hit.
    """
    if text is None:
        return None
    for way in (_Reader.read_plain, _Reader.read_well_formed, _Reader.read):
        reader = _Reader(wanted, squashed)
        if way(reader, text) is not False:
            break
    first = min((h[0] for h in reader.hits), default=reader.pos) if behind_hits else -1
    marked = {tag: mark in _context(tag) for tag in {h[2] for h in reader.hits}}
    found = [(p, t, marked[tag]) for p, t, tag in reader.hits], _tables(reader.tags, first, None if reader.silent else reader.stripped)
    for tag in reader.tags:  # a tree without cycles goes at once, the collector need not look for it
        tag.parent = None
    return found
