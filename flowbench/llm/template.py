"""A small template language for conversations, compiled to Python closures.

Text is copied, ``{{ expression }}`` prints, and the statements are ``{% for x in y %}``, ``{% if %}`` / ``{% elif %}`` /
``{% else %}``, ``{% set x = expression %}`` and ``{% generation %}``, each block closed by ``{% endfor %}`` and so on. ``{%-``
and ``-%}`` strip the white space beside a tag. Expressions have strings, integers, names, ``a.b`` and ``a['b']``, the
filters given to the compiler, ``~`` (joins as text), ``+``, comparisons, ``in``, ``and``, ``or``, ``not``.

Sandbox: a name or key is looked up in dictionaries only, never as a Python attribute; there are no calls but the filters,
so a template reaches nothing that it was not handed. Missing names and keys print as nothing.

Parsing gives a tree of tuples; constant parts are folded; each node then becomes a closure. A compiled template is a
generator of (text, marked) pieces, where ``marked`` tells whether the piece stands in a generation block, so that a
conversation of any length is rendered one turn at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

_TAG = re.compile(r"\{\{-?|\{%-?|\{#")
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~|.<>()\[\]=,]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
}
Pieces = Iterator[tuple[str, bool]]


class TemplateError(ValueError):
    """The template cannot be parsed."""


def _show(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


# --- parsing ------------------------------------------------------------------------------------------------------------


def _pieces(source: str) -> list[tuple[str, str]]:
    """('text' | 'print' | 'do', content) in order, with white space stripped where a tag asks for it."""
    out, at, strip = [], 0, False
    while True:
        m = _TAG.search(source, at)
        text = source[at:m.start() if m else len(source)]
        if strip:
            text = text.lstrip()
        if m and m[0].endswith("-"):
            text = text.rstrip()
        if text:
            out.append(("text", text))
        if not m:
            return out
        close = {"{{": "}}", "{%": "%}", "{#": "#}"}[m[0][:2]]
        end = _tag_end(source, m.end(), close)
        inner = source[m.end():end]
        strip = inner.endswith("-") and close != "#}"
        if close != "#}":
            out.append(("print" if close == "}}" else "do", inner.removesuffix("-").strip()))
        at = end + 2


def _tag_end(source: str, at: int, close: str) -> int:
    """Where ``close`` stands outside of a quoted string."""
    quote = ""
    while at < len(source):
        c = source[at]
        if quote:
            at += c == "\\"
            quote = "" if c == quote else quote
        elif source.startswith(close, at):
            return at
        elif c in "'\"" and close != "#}":
            quote = c
        at += 1
    raise TemplateError(f"no {close} for an open tag")


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, text: str, filters: dict[str, Callable]):
        self.tokens, at = [], 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at, self.filters = 0, filters

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        found = self.peek(*values)
        self.at += found
        return found

    def need(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"{kind} expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        while self.peek(*_COMPARE) or self.peek("not"):
            if self.take("not"):
                if not self.take("in"):
                    raise TemplateError("in expected")
                node = ("not", ("compare", "in", node, self.joined()))
            else:
                self.at += 1
                node = ("compare", self.tokens[self.at - 1][1], node, self.joined())
        return node

    def joined(self):
        node = self.filtered()
        while self.peek("~", "+"):
            self.at += 1
            node = ("join" if self.tokens[self.at - 1][1] == "~" else "add", node, self.filtered())
        return node

    def filtered(self):
        node = self.value()
        while self.take("|"):
            name = self.need("name")
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def value(self):
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError(") expected")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "str":
            node = ("const", re.sub(r"(?s)\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), self.need("str")[1:-1]))
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "int":
            node = ("const", int(self.need("int")))
        else:
            name = self.need("name")
            node = ("const", {"true": True, "false": False, "none": None}[name]) if name in ("true", "false", "none") else ("name", name)
        while self.peek(".", "["):
            if self.take("."):
                node = ("key", node, ("const", self.need("name")))
            else:
                self.at += 1
                node = ("key", node, self.either())
                if not self.take("]"):
                    raise TemplateError("] expected")
        return node


def parse(source: str, filters: dict[str, Callable]) -> tuple:
    """The tree of a template: ('block', nodes...)."""
    pieces, at = _pieces(source), 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes = []
        while at < len(pieces):
            kind, text = pieces[at]
            at += 1
            if kind == "text":
                nodes.append(("print", ("const", text)))
            elif kind == "print":
                nodes.append(("print", _Expression(text, filters).whole()))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return ("block", *nodes), text
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} expected")
        return ("block", *nodes), ""

    def statement(word: str, rest: str) -> tuple:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError("for x in y expected")
            return ("for", m[1], _Expression(m[2], filters).whole(), block("endfor")[0])
        if word == "if":
            test = _Expression(rest, filters).whole()
            body, end = block("elif", "else", "endif")
            if end.startswith("elif"):
                return ("if", test, body, ("block", statement("if", end[4:])))
            return ("if", test, body, block("endif")[0] if end == "else" else ("block",))
        if word == "set":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.S)
            if not m:
                raise TemplateError("set x = y expected")
            return ("set", m[1], _Expression(m[2], filters).whole())
        if word == "generation":
            return ("generation", block("endgeneration")[0])
        raise TemplateError(f"unknown statement {word!r}")

    return block()[0]


# --- constant folding -----------------------------------------------------------------------------------------------------


def fold(node: tuple, filters: dict[str, Callable]) -> tuple:
    """The tree with constant expressions computed, constant branches chosen and neighbouring constant text joined."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "block":
        out: list[tuple] = []
        for n in (fold(n, filters) for n in node[1:]):
            for x in n[1:] if n[0] == "block" else (n,):
                if x[0] == "print" and x[1][0] == "const":
                    if out and out[-1][0] == "print" and out[-1][1][0] == "const":
                        x = ("print", ("const", _show(out.pop()[1][1]) + _show(x[1][1])))
                    if not _show(x[1][1]):
                        continue
                out.append(x)
        return ("block", *out)
    parts = tuple(fold(x, filters) if isinstance(x, tuple) else x for x in node)
    if kind == "if" and parts[1][0] == "const":
        return parts[2] if parts[1][1] else parts[3]
    if kind in ("print", "for", "if", "set", "generation"):
        return parts
    if all(x[0] == "const" for x in parts[1:] if isinstance(x, tuple)):
        return ("const", _value(parts, filters)({}))
    return parts


# --- closures -------------------------------------------------------------------------------------------------------------


def _value(node: tuple, filters: dict[str, Callable]) -> Callable[[dict], object]:
    kind, *rest = node
    if kind == "const":
        return lambda scope, v=rest[0]: v
    if kind == "name":
        return lambda scope, k=rest[0]: scope.get(k)
    if kind == "filter":
        f, inner = filters[rest[0]], _value(rest[1], filters)
        return lambda scope: f(inner(scope))
    if kind == "not":
        inner = _value(rest[0], filters)
        return lambda scope: not inner(scope)
    if kind == "compare":
        test, a, b = _COMPARE[rest[0]], _value(rest[1], filters), _value(rest[2], filters)
        return lambda scope: test(a(scope), b(scope))
    a, b = (_value(x, filters) for x in rest)
    if kind == "key":
        def key(scope: dict):
            holder = a(scope)
            return holder.get(b(scope)) if isinstance(holder, dict) else None
        return key
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    if kind == "add":
        return lambda scope: a(scope) + b(scope)
    return lambda scope: _show(a(scope)) + _show(b(scope))


def _with_last(items) -> Iterator[tuple[object, bool]]:
    """Items of any iterator, each with whether it is the last."""
    items = iter(items)
    for held in items:
        for x in items:
            yield held, False
            held = x
        yield held, True


def _writer(node: tuple, filters: dict[str, Callable]) -> Callable[[dict, bool], Pieces]:
    kind, *rest = node
    if kind == "block":
        writers = [_writer(n, filters) for n in rest]

        def block(scope: dict, marked: bool) -> Pieces:
            for w in writers:
                yield from w(scope, marked)
        return block
    if kind == "print":
        value = _value(rest[0], filters)

        def show(scope: dict, marked: bool) -> Pieces:
            yield _show(value(scope)), marked
        return show
    if kind == "set":
        value = _value(rest[1], filters)

        def assign(scope: dict, marked: bool) -> Pieces:
            scope[rest[0]] = value(scope)
            yield from ()
        return assign
    if kind == "generation":
        body = _writer(rest[0], filters)
        return lambda scope, marked: body(scope, True)
    if kind == "if":
        test, yes, no = _value(rest[0], filters), _writer(rest[1], filters), _writer(rest[2], filters)
        return lambda scope, marked: (yes if test(scope) else no)(scope, marked)
    name, items, body = rest[0], _value(rest[1], filters), _writer(rest[2], filters)

    def loop(scope: dict, marked: bool) -> Pieces:
        for n, (x, last) in enumerate(_with_last(items(scope) or ())):
            yield from body(scope | {name: x, "loop": {"index": n + 1, "first": n == 0, "last": last}}, marked)
    return loop


def compile_template(source: str, filters: dict[str, Callable]) -> Callable[[dict], Pieces]:
    """A function from the names in scope to the (text, marked) pieces of the output."""
    write = _writer(fold(parse(source, filters), filters), filters)
    return lambda scope: write(dict(scope), False)
