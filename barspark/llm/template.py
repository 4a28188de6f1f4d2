"""A small sandboxed template language, compiled to Python closures.

Syntax::

    {{ expr }}   {# comment #}   {% set name = expr %}
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% for name in expr %} .. {% endfor %}
    {% generation %} .. {% endgeneration %}      (what it prints is under the loss mask)

A dash inside a tag (``{%-``, ``-%}``) strips the white space beside it.  Expressions: strings,
integers, ``true false none``, names, ``a.b`` and ``a['b']`` (keys of mappings and fields of ``loop``
only), ``+ - * % ~``, comparisons, ``in``, ``and or not``, ``x if c else y``, and filters ``e | name``
from a fixed table.  There are no calls, no attributes of Python objects and no imports, so a
template can only compute on what it is given.

Compiling goes text -> tokens -> syntax tree -> folded tree (constant expressions evaluated,
constant branches chosen, neighbouring text joined) -> closures.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

MAX_DEPTH = 50

_TAG = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<int>\d+)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+*%~<>()\[\].|,]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}


class TemplateError(ValueError):
    """The template's text is wrong, or an expression met values it can't work on."""


# --- syntax tree: tuples headed by their kind ---------------------------------------------------


class _Expr:
    """Recursive-descent parser of one expression."""

    def __init__(self, text: str):
        self.tokens: list[tuple[str, object]] = []
        at, text = 0, text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m or m.end() == at:
                raise TemplateError(f"unexpected {text[at:at + 10]!r} in {text!r}")
            at, kind = m.end(), m.lastgroup
            value: object = m[kind]
            if kind == "int":
                value = int(m[kind])
            elif kind == "str":
                value = re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], "\\" + e[1]), m[kind][1:-1], flags=re.S)
            self.tokens.append((kind, value))
        self.at, self.text, self.depth = 0, text, 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r} in {self.text!r}")

    def whole(self) -> tuple:
        tree = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"trailing {self.tokens[self.at][1]!r} in {self.text!r}")
        return tree

    def choice(self) -> tuple:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("expression nested too deeply")
        value = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            value = ("pick", test, value, self.choice())
        self.depth -= 1
        return value

    def either(self) -> tuple:
        left = self.both()
        while self.take("or"):
            left = ("or", left, self.both())
        return left

    def both(self) -> tuple:
        left = self.negated()
        while self.take("and"):
            left = ("and", left, self.negated())
        return left

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        left = self.summed()
        while True:
            if op := self.take("==", "!=", "<", ">", "<=", ">=", "in"):
                left = ("binary", op, left, self.summed())
            elif self.peek("not") and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == "in":
                self.at += 2
                left = ("not", ("binary", "in", left, self.summed()))
            else:
                return left

    def summed(self) -> tuple:
        left = self.product()
        while op := self.take("+", "-", "~"):
            left = ("binary", op, left, self.product())
        return left

    def product(self) -> tuple:
        left = self.filtered()
        while op := self.take("*", "%"):
            left = ("binary", op, left, self.filtered())
        return left

    def filtered(self) -> tuple:
        value = self.reached()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name":
                raise TemplateError(f"a filter's name is missing in {self.text!r}")
            self.at += 1
            value = ("filter", name, value)
        return value

    def reached(self) -> tuple:
        value = self.atom()
        while True:
            if self.take("."):
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError(f"a key is missing in {self.text!r}")
                self.at += 1
                value = ("key", value, ("const", name))
            elif self.take("["):
                value = ("key", value, self.choice())
                self.need("]")
            else:
                return value

    def atom(self) -> tuple:
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError(f"{self.text!r} ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind in ("int", "str"):
            return ("const", value)
        if kind == "name":
            fixed = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
            return ("const", fixed[value]) if value in fixed else ("name", value)
        raise TemplateError(f"unexpected {value!r} in {self.text!r}")


def _pieces(source: str) -> list[tuple[str, str]]:
    """('text' | 'print' | 'tag', content) pieces of a template, white space stripped where dashes say so."""
    out: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        if strip:
            text = text.lstrip()
        if m[0][2] == "-":
            text = text.rstrip()
        out.append(("text", text))
        if m[1] is not None:
            out.append(("print", m[1].strip()))
        elif m[2] is not None:
            out.append(("tag", m[2].strip()))
        at, strip = m.end(), m[0][-3] == "-"
    out.append(("text", source[at:].lstrip() if strip else source[at:]))
    return [p for p in out if p[0] != "text" or p[1]]


def parse(source: str) -> list[tuple]:
    """The statements of a template."""
    pieces = _pieces(source)
    at = 0

    def block(ends: tuple[str, ...], depth: int) -> tuple[list[tuple], str]:
        nonlocal at
        if depth > MAX_DEPTH:
            raise TemplateError("tags nested too deeply")
        body: list[tuple] = []
        while at < len(pieces):
            kind, text = pieces[at]
            at += 1
            if kind == "text":
                body.append(("text", text))
                continue
            if kind == "print":
                body.append(("print", _Expr(text).whole()))
                continue
            word, _, rest = text.partition(" ")
            if word in ends:
                return body, text
            if word == "if":
                branches, test = [], _Expr(rest).whole()
                while True:
                    inner, end = block(("elif", "else", "endif"), depth + 1)
                    branches.append((test, inner))
                    word, _, rest = end.partition(" ")
                    if word == "endif":
                        break
                    test = _Expr(rest).whole() if word == "elif" else ("const", True)
                body.append(("if", branches))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"a loop reads 'for name in expr', not {text!r}")
                inner, _ = block(("endfor",), depth + 1)
                body.append(("for", m[1], _Expr(m[2]).whole(), inner))
            elif word == "generation":
                inner, _ = block(("endgeneration",), depth + 1)
                body.append(("generation", inner))
            elif word == "set" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.S)):
                body.append(("set", m[1], _Expr(m[2]).whole()))
            else:
                raise TemplateError(f"unknown tag {text!r}")
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return body, ""

    return block((), 0)[0]


# --- constant folding ----------------------------------------------------------------------------

_BINARY: dict[str, Callable] = {
    "+": operator.add, "-": operator.sub, "*": operator.mul, "%": operator.mod, "==": operator.eq, "!=": operator.ne,
    "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "in": lambda a, b: a in b, "~": lambda a, b: show(a) + show(b),
}


def show(value: object) -> str:
    """How a value prints: none prints nothing."""
    return "" if value is None else value if isinstance(value, str) else str(value)


def _apply(op: str, a: object, b: object) -> object:
    if op in "+-*%" and not (isinstance(a, int) and isinstance(b, int)) and not (op == "+" and isinstance(a, str) and isinstance(b, str)):
        raise TemplateError(f"{op!r} needs two integers, or two strings for '+'")
    try:
        return _BINARY[op](a, b)
    except (TypeError, ZeroDivisionError) as exc:
        raise TemplateError(str(exc)) from None


def fold_expr(tree: tuple, filters: dict[str, Callable[[object], object]]) -> tuple:
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    if kind == "filter":
        if tree[1] not in filters:
            raise TemplateError(f"unknown filter {tree[1]!r}")
        inner = fold_expr(tree[2], filters)
        return ("const", filters[tree[1]](inner[1])) if inner[0] == "const" else ("filter", tree[1], inner)
    if kind == "binary":
        a, b = fold_expr(tree[2], filters), fold_expr(tree[3], filters)
        return ("const", _apply(tree[1], a[1], b[1])) if a[0] == b[0] == "const" else ("binary", tree[1], a, b)
    parts = [fold_expr(t, filters) for t in tree[1:]]
    first = parts[0]
    if first[0] == "const":
        if kind == "not":
            return ("const", not first[1])
        if kind in ("and", "or"):
            return parts[1] if bool(first[1]) == (kind == "and") else first
        if kind == "pick":
            return parts[1] if first[1] else parts[2]
    return (kind, *parts)


def fold(body: list[tuple], filters: dict[str, Callable[[object], object]]) -> list[tuple]:
    out: list[tuple] = []
    for s in body:
        kind = s[0]
        if kind == "print":
            e = fold_expr(s[1], filters)
            new = [("text", show(e[1]))] if e[0] == "const" else [("print", e)]
        elif kind == "if":
            branches = []
            for test, inner in s[1]:
                test = fold_expr(test, filters)
                if test == ("const", False) or test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold(inner, filters)))
                if test[0] == "const":
                    break
            new = branches[0][1] if branches and branches[0][0][0] == "const" else [("if", branches)] if branches else []
        elif kind == "for":
            new = [("for", s[1], fold_expr(s[2], filters), fold(s[3], filters))]
        elif kind == "generation":
            new = [("generation", fold(s[1], filters))]
        elif kind == "set":
            new = [("set", s[1], fold_expr(s[2], filters))]
        else:
            new = [s]
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


# --- closures -------------------------------------------------------------------------------------


@dataclass
class Run:
    """State of one rendering: variables, and what was printed as (text, under the mask)."""

    names: dict[str, object]
    out: list[tuple[str, bool]] = field(default_factory=list)
    masked: bool = False


def _expr(tree: tuple, filters: dict[str, Callable[[object], object]]) -> Callable[[Run], object]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda run: value
    if kind == "name":
        name = tree[1]
        return lambda run: run.names.get(name)
    if kind == "filter":
        inner, fn = _expr(tree[2], filters), filters[tree[1]]
        return lambda run: fn(inner(run))
    if kind == "binary":
        op, a, b = tree[1], _expr(tree[2], filters), _expr(tree[3], filters)
        return lambda run: _apply(op, a(run), b(run))
    parts = [_expr(t, filters) for t in tree[1:]]
    if kind == "key":
        holder, key = parts

        def get(run: Run) -> object:
            value = holder(run)
            return value.get(key(run)) if isinstance(value, dict) else None

        return get
    if kind == "not":
        return lambda run: not parts[0](run)
    if kind == "and":
        return lambda run: parts[0](run) and parts[1](run)
    if kind == "or":
        return lambda run: parts[0](run) or parts[1](run)
    return lambda run: parts[1](run) if parts[0](run) else parts[2](run)


def _steps(items: Iterable) -> Iterator[tuple[object, dict]]:
    """(item, loop fields) with one item of look-ahead."""
    it = iter(items)
    nothing = object()
    before, now, k = None, next(it, nothing), 0
    while now is not nothing:
        after = next(it, nothing)
        last = after is nothing
        yield now, {"index0": k, "index": k + 1, "first": k == 0, "last": last, "previtem": before, "nextitem": None if last else after}
        before, now, k = now, after, k + 1


def _statement(s: tuple, filters: dict[str, Callable[[object], object]]) -> Callable[[Run], Iterator[None]]:
    """A closure that prints into the run; as a generator it pauses after every turn of an outermost loop."""
    kind = s[0]
    if kind == "text":
        text = s[1]

        def step(run: Run) -> None:
            run.out.append((text, run.masked))

        return step
    if kind == "print":
        value = _expr(s[1], filters)

        def step(run: Run) -> None:
            run.out.append((show(value(run)), run.masked))

        return step
    if kind == "set":
        name, value = s[1], _expr(s[2], filters)

        def step(run: Run) -> None:
            run.names[name] = value(run)

        return step
    if kind == "generation":
        body = _block(s[1], filters)

        def step(run: Run) -> None:
            was, run.masked = run.masked, True
            body(run)
            run.masked = was

        return step
    if kind == "if":
        branches = [(_expr(test, filters), _block(body, filters)) for test, body in s[1]]

        def step(run: Run) -> None:
            for test, body in branches:
                if test(run):
                    body(run)
                    return

        return step
    turns = _loop(s, filters)

    def step(run: Run) -> None:
        for _ in turns(run):
            pass

    return step


def _block(body: list[tuple], filters: dict[str, Callable[[object], object]]) -> Callable[[Run], None]:
    steps = [_statement(s, filters) for s in body]

    def run_all(run: Run) -> None:
        for step in steps:
            step(run)

    return run_all


def _loop(s: tuple, filters: dict[str, Callable[[object], object]]) -> Callable[[Run], Iterator[None]]:
    name, items, body = s[1], _expr(s[2], filters), _block(s[3], filters)

    def turns(run: Run) -> Iterator[None]:
        saved = {k: run.names.get(k) for k in (name, "loop")}
        values = items(run)
        if isinstance(values, (str, bytes)) or not isinstance(values, Iterable):
            values = ()
        for item, loop in _steps(values):
            run.names[name], run.names["loop"] = item, loop
            body(run)
            yield
        run.names.update(saved)

    return turns


class Template:
    """A compiled template; ``stream`` renders with the memory of one turn of an outermost loop."""

    def __init__(self, source: str, filters: dict[str, Callable[[object], object]] | None = None):
        table = {
            "trim": lambda v: show(v).strip(),
            "upper": lambda v: show(v).upper(),
            "lower": lambda v: show(v).lower(),
            "length": lambda v: len(v) if isinstance(v, (str, list, tuple, dict)) else 0,
            **(filters or {}),
        }
        self.tree = fold(parse(source), table)
        self.steps = [(_loop(s, table), True) if s[0] == "for" else (_statement(s, table), False) for s in self.tree]

    def stream(self, **names: object) -> Iterator[list[tuple[str, bool]]]:
        """Printed (text, masked) pieces, handed over after every turn of an outermost loop."""
        run = Run(dict(names))
        for step, loops in self.steps:
            if loops:
                for _ in step(run):
                    yield run.out
                    run.out = []
            else:
                step(run)
        if run.out:
            yield run.out

    def render(self, **names: object) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and the spans (code points) under the mask."""
        text, spans, at = [], [], 0
        for pieces in self.stream(**names):
            for piece, masked in pieces:
                if masked:
                    spans.append((at, at + len(piece)))
                text.append(piece)
                at += len(piece)
        return "".join(text), spans
