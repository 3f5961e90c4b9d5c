"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}   {% for x in list %} .. {% endfor %}   {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set x = e %}    {% generation %} .. {% endgeneration %}   {# comment #}

Expressions have names, text and whole numbers, true, false, none, ``a.b``, ``a['b']``, ``a | filter``, ``+ ~ == != < <= > >= in``,
``not and or`` and parentheses. There are no calls, and attributes are looked up in dicts only, so a template reaches nothing
but what it is given. A template becomes a syntax tree, whose constant parts are folded, and then closures that yield
(text, is inside generation) piece by piece: a conversation of any length is rendered without being held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import regex

TAG = regex.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", regex.S)
TOKEN = regex.compile(r"\s*(?:(\d+)|([A-Za-z_]\w*)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|(==|!=|<=|>=|[-+~<>|.()\[\]=]))")
LITERALS = {"true": True, "false": False, "none": None}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
Scope = dict


class TemplateError(ValueError):
    """The template cannot be compiled, or reaches for something it was not given."""


@dataclass(frozen=True)
class Node:
    """kind and parts: expressions const, name, item, filter, binary, not, and, or; statements text, out, for, if, set, mark."""

    kind: str
    parts: tuple


def tokens(source: str) -> list[tuple[str, object]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at : at + 20]!r}")
        at = m.end()
        if m[1]:
            out.append(("const", int(m[1])))
        elif m[2]:
            out.append(("const", LITERALS[m[2]]) if m[2] in LITERALS else ("name", m[2]))
        elif m[5]:
            out.append(("sign", m[5]))
        else:
            text = m[3] if m[3] is not None else m[4]
            out.append(("const", regex.sub(r"\\(.)", lambda x: ESCAPES.get(x[1], x[1]), text)))
    return out


class Expressions:
    """Parser of one tag's expression, by precedence."""

    LEVELS = [[("name", "or")], [("name", "and")]]
    COMPARE = {("sign", s) for s in ("==", "!=", "<", "<=", ">", ">=")} | {("name", "in")}

    def __init__(self, items: list[tuple[str, object]]):
        self.items, self.at = items, 0

    def peek(self) -> tuple[str, object]:
        return self.items[self.at] if self.at < len(self.items) else ("end", None)

    def take(self) -> tuple[str, object]:
        self.at += 1
        return self.items[self.at - 1] if self.at <= len(self.items) else ("end", None)

    def expect(self, kind: str, value: object = None) -> object:
        got = self.take()
        if got[0] != kind or (value is not None and got[1] != value):
            raise TemplateError(f"expected {value or kind}, got {got[1]!r}")
        return got[1]

    def end(self) -> None:
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def expression(self, level: int = 0) -> Node:
        if level == 2:
            return self.negation()
        left = self.expression(level + 1)
        while self.peek() in self.LEVELS[level]:
            word = self.take()[1]
            left = Node(word, (left, self.expression(level + 1)))
        return left

    def negation(self) -> Node:
        if self.peek() == ("name", "not"):
            self.take()
            return Node("not", (self.negation(),))
        left = self.sum()
        while self.peek() in self.COMPARE:
            left = Node("binary", (self.take()[1], left, self.sum()))
        return left

    def sum(self) -> Node:
        left = self.postfix()
        while self.peek() in {("sign", "+"), ("sign", "~")}:
            left = Node("binary", (self.take()[1], left, self.postfix()))
        return left

    def postfix(self) -> Node:
        kind, value = self.take()
        if kind == "const":
            node = Node("const", (value,))
        elif kind == "name":
            node = Node("name", (value,))
        elif (kind, value) == ("sign", "("):
            node = self.expression()
            self.expect("sign", ")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while True:
            if self.peek() == ("sign", "."):
                self.take()
                node = Node("item", (node, Node("const", (self.expect("name"),))))
            elif self.peek() == ("sign", "["):
                self.take()
                node = Node("item", (node, self.expression()))
                self.expect("sign", "]")
            elif self.peek() == ("sign", "|"):
                self.take()
                node = Node("filter", (self.expect("name"), node))
            else:
                return node


def parse(source: str) -> tuple[Node, ...]:
    """The statements of a template."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in TAG.finditer(source):
        if source[at : m.start()]:
            pieces.append(("text", source[at : m.start()]))
        if m[1] is not None:
            pieces.append(("out", m[1]))
        elif m[2] is not None:
            pieces.append(("tag", m[2]))
        at = m.end()
    if source[at:]:
        pieces.append(("text", source[at:]))
    body, rest, stop = statements(pieces, ())
    if stop:
        raise TemplateError(f"unexpected {stop[0][1]}")
    return body


def statements(pieces: list[tuple[str, str]], until: tuple[str, ...]) -> tuple[tuple[Node, ...], list, list]:
    """Statements up to one of the tags named, what follows it, and that tag's tokens."""
    out: list[Node] = []
    while pieces:
        (kind, content), pieces = pieces[0], pieces[1:]
        if kind == "text":
            out.append(Node("text", (content,)))
            continue
        items = tokens(content)
        if kind == "out":
            e = Expressions(items)
            out.append(Node("out", (e.expression(),)))
            e.end()
            continue
        word = items[0][1] if items else None
        if word in until:
            return tuple(out), pieces, items
        e = Expressions(items[1:])
        if word == "for":
            name = e.expect("name")
            e.expect("name", "in")
            source = e.expression()
            body, pieces, _ = statements(pieces, ("endfor",))
            out.append(Node("for", (name, source, body)))
        elif word == "if":
            branches, condition = [], e.expression()
            while True:
                body, pieces, items = statements(pieces, ("elif", "else", "endif"))
                branches.append((condition, body))
                if items[0][1] == "endif":
                    break
                condition = Node("const", (True,)) if items[0][1] == "else" else Expressions(items[1:]).expression()
            out.append(Node("if", (tuple(branches),)))
        elif word == "set":
            name = e.expect("name")
            e.expect("sign", "=")
            out.append(Node("set", (name, e.expression())))
        elif word == "generation":
            body, pieces, _ = statements(pieces, ("endgeneration",))
            out.append(Node("mark", (body,)))
        else:
            raise TemplateError(f"unknown tag {word!r}")
        if word != "if":
            e.end()
    if until:
        raise TemplateError(f"missing {' or '.join(until)}")
    return tuple(out), [], []


def shown(value: object) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def item(value: object, key: object) -> object:
    if not isinstance(value, dict):
        raise TemplateError(f"{type(value).__name__} has no members")
    return value.get(key)


BINARY: dict[str, Callable] = {
    "+": lambda a, b: a + b if type(a) is type(b) and isinstance(a, (int, str)) else shown(a) + shown(b),
    "~": lambda a, b: shown(a) + shown(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: shown(x).strip(),
    "upper": lambda x: shown(x).upper(),
    "lower": lambda x: shown(x).lower(),
    "length": len,
}


def folded(node: Node, filters: dict[str, Callable]) -> Node:
    """The expression with constant parts computed."""
    kind, parts = node.kind, node.parts
    if kind in ("const", "name"):
        return node
    done = tuple(folded(p, filters) if isinstance(p, Node) else p for p in parts)
    constant = [p.parts[0] for p in done if isinstance(p, Node) and p.kind == "const"]
    if len(constant) < sum(isinstance(p, Node) for p in done):
        if kind in ("and", "or") and done[0].kind == "const":
            return done[1] if bool(done[0].parts[0]) == (kind == "and") else done[0]
        return Node(kind, done)
    return Node("const", (evaluator(Node(kind, done), filters)({}),))


def evaluator(node: Node, filters: dict[str, Callable]) -> Callable[[Scope], object]:
    kind, parts = node.kind, node.parts
    if kind == "const":
        value = parts[0]
        return lambda scope: value
    if kind == "name":
        name = parts[0]

        def lookup(scope: Scope) -> object:
            if name not in scope:
                raise TemplateError(f"{name} is not defined")
            return scope[name]

        return lookup
    inner = [evaluator(p, filters) for p in parts if isinstance(p, Node)]
    if kind == "filter":
        if parts[0] not in filters:
            raise TemplateError(f"unknown filter {parts[0]}")
        apply, (of,) = filters[parts[0]], inner
        return lambda scope: apply(of(scope))
    if kind == "not":
        (of,) = inner
        return lambda scope: not of(scope)
    a, b = inner
    if kind == "item":
        return lambda scope: item(a(scope), b(scope))
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    combine = BINARY[parts[0]]
    return lambda scope: combine(a(scope), b(scope))


def simplified(body: Iterable[Node], filters: dict[str, Callable]) -> list[Node]:
    """Statements with folded expressions, decided branches and joined constant text."""
    out: list[Node] = []
    for node in body:
        if node.kind == "out":
            e = folded(node.parts[0], filters)
            node = Node("text", (shown(e.parts[0]),)) if e.kind == "const" else Node("out", (e,))
        elif node.kind == "if":
            branches = []
            for condition, inner in node.parts[0]:
                condition = folded(condition, filters)
                if condition.kind == "const" and not condition.parts[0]:
                    continue
                branches.append((condition, tuple(simplified(inner, filters))))
                if condition.kind == "const":
                    break
            if not branches or branches[0][0].kind == "const":
                for inner in branches[0][1] if branches else ():
                    joined(out, inner)
                continue
            node = Node("if", (tuple(branches),))
        elif node.kind == "for":
            node = Node("for", (node.parts[0], folded(node.parts[1], filters), tuple(simplified(node.parts[2], filters))))
        elif node.kind == "set":
            node = Node("set", (node.parts[0], folded(node.parts[1], filters)))
        elif node.kind == "mark":
            node = Node("mark", (tuple(simplified(node.parts[0], filters)),))
        joined(out, node)
    return out


def joined(out: list[Node], node: Node) -> None:
    if node.kind == "text" and out and out[-1].kind == "text":
        out[-1] = Node("text", (out[-1].parts[0] + node.parts[0],))
    elif node != Node("text", ("",)):
        out.append(node)


Render = Callable[[Scope, bool], Iterator[tuple[str, bool]]]


def renderer(body: Iterable[Node], filters: dict[str, Callable]) -> Render:
    steps = [step(node, filters) for node in body]

    def render(scope: Scope, marked: bool) -> Iterator[tuple[str, bool]]:
        for s in steps:
            yield from s(scope, marked)

    return render


def step(node: Node, filters: dict[str, Callable]) -> Render:
    kind, parts = node.kind, node.parts
    if kind == "text":
        text = parts[0]

        def constant(scope: Scope, marked: bool) -> Iterator[tuple[str, bool]]:
            yield text, marked

        return constant
    if kind == "out":
        value = evaluator(parts[0], filters)

        def out(scope: Scope, marked: bool) -> Iterator[tuple[str, bool]]:
            yield shown(value(scope)), marked

        return out
    if kind == "set":
        name, value = parts[0], evaluator(parts[1], filters)

        def assign(scope: Scope, marked: bool) -> Iterator[tuple[str, bool]]:
            scope[name] = value(scope)
            yield from ()

        return assign
    if kind == "mark":
        inner = renderer(parts[0], filters)
        return lambda scope, marked: inner(scope, True)
    if kind == "if":
        branches = [(evaluator(c, filters), renderer(b, filters)) for c, b in parts[0]]

        def choose(scope: Scope, marked: bool) -> Iterator[tuple[str, bool]]:
            for condition, body in branches:
                if condition(scope):
                    yield from body(scope, marked)
                    return

        return choose
    name, source, body = parts[0], evaluator(parts[1], filters), renderer(parts[2], filters)

    def repeat(scope: Scope, marked: bool) -> Iterator[tuple[str, bool]]:
        inner, following, number = dict(scope), iter(source(scope)), 0
        current = next(following, END)
        while current is not END:
            after = next(following, END)
            number += 1
            inner[name] = current
            inner["loop"] = {"index": number, "first": number == 1, "last": after is END}
            yield from body(inner, marked)
            current = after

    return repeat


END = object()


def compiled(source: str, filters: dict[str, Callable] | None = None) -> Callable[[Scope], Iterator[tuple[str, bool]]]:
    """A function from given names to pieces of (text, is inside generation)."""
    known = FILTERS | (filters or {})
    render = renderer(simplified(parse(source), known), known)
    return lambda scope: render(dict(scope), False)
