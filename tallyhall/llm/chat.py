"""Chat formatting by a compiled template language.

A template is parsed into a syntax tree, constants are folded, and the tree becomes Python
closures. Rendering yields pieces of text, each with whether a ``generation`` block made
it, so a conversation of any length is written while its turns are read. The language is
sandboxed: it knows texts, numbers, truth values, the variables it is given, fields of
mappings by name, and the filters listed in :data:`FILTERS`; no Python attribute, method
or import can be reached.

    {{ expression }}   {# comment #}   {%- trims the white space before it; -%} after it
    {% for x in list %} .. {{ loop.first }} {{ loop.last }} {{ loop.index0 }} .. {% endfor %}
    {% if a %} .. {% elif b %} .. {% else %} .. {% endif %}   {% set x = expression %}
    {% generation %} text that the model is to learn {% endgeneration %}
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import small_batches

SPECIAL = re.compile(r"[\\\[\]<>]")
PART_CHARS = 1 << 20  # formatted characters in one row of output

#: Control strings of the default template begin with [ or <, which texts hold only escaped.
CHAT = (
    "{% for turn in turns %}{% if loop.first %}<s>{% endif %}"
    "{% if turn.role == 'system' %}[SYS]{{ turn.text | escape }}[/SYS]"
    "{% elif turn.role == 'user' %}[INST]{{ turn.text | escape }}[/INST]"
    "{% elif turn.role == 'assistant' %}[ANS]{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
    "{% else %}[TURN {{ turn.role | escape }}]{{ turn.text | escape }}[/TURN]{% endif %}"
    "{% endfor %}"
)


def escape(text: str) -> str:
    """A backslash before each character that control strings are made of."""
    return SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": lambda x: len(x),
    "string": lambda x: _text(x),
    "default": lambda x, other="": other if x is None else x,
    "replace": lambda x, old, new: _text(x).replace(old, new),
}


class TemplateError(ValueError):
    """A template that can't be parsed or reaches for what it may not."""


def _text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int, float)):
        return str(value)
    raise TemplateError(f"not a text: {type(value).__name__}")


# Syntax tree -----------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Call:
    """An operation on expressions; ``op`` names it in :data:`OPERATIONS`."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    args: tuple


@dataclass(frozen=True)
class Output:
    expr: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    expr: object


@dataclass(frozen=True)
class Generation:
    body: tuple


def _field(value: object, key: object) -> object:
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple, str)) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    raise TemplateError(f"no field {key!r}")


def _add(a: object, b: object) -> object:
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("+ takes two texts or two numbers; ~ joins anything")
    return a + b


OPERATIONS: dict[str, Callable] = {
    "field": _field,
    "+": _add,
    "-": lambda a, b: a - b,
    "~": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b,
    "not": lambda a: not a,
    "list": lambda *a: list(a),
}

TOKEN = re.compile(
    r"""\s*(?:(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
    r"""|(?P<op>==|!=|<=|>=|[-+~<>=|.,()\[\]]))""",
    re.S,
)
MARKUP = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
WORDS = frozenset("and or not in if else elif endif for endfor set true false none generation endgeneration".split())


class Parser:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"can't read {source[at:]!r}")
            kind = found.lastgroup
            self.tokens.append((kind, found[kind]))
            at = found.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        if self.peek(*values):
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name" or self.tokens[self.at][1] in WORDS:
            raise TemplateError("expected a name")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def expression(self) -> object:
        value = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            return Call("?", (test, value, self.expression()))
        return value

    def either(self) -> object:
        left = self.both()
        while self.take("or"):
            left = Call("or", (left, self.both()))
        return left

    def both(self) -> object:
        left = self.negation()
        while self.take("and"):
            left = Call("and", (left, self.negation()))
        return left

    def negation(self) -> object:
        return Call("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> object:
        left = self.sum()
        for op in ("==", "!=", "<=", ">=", "<", ">", "in"):
            if self.take(op):
                return Call(op, (left, self.sum()))
        if self.take("not"):
            self.need("in")
            return Call("not in", (left, self.sum()))
        return left

    def sum(self) -> object:
        left = self.filtered()
        while self.peek("+", "-", "~"):
            op = self.tokens[self.at][1]
            self.at += 1
            left = Call(op, (left, self.filtered()))
        return left

    def filtered(self) -> object:
        value = self.postfix()
        while self.take("|"):
            name, args = self.name(), []
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.take("("):
                while not self.take(")"):
                    args.append(self.expression())
                    if not self.peek(")"):
                        self.need(",")
            value = Filter(name, (value, *args))
        return value

    def postfix(self) -> object:
        value = self.atom()
        while True:
            if self.take("."):
                value = Call("field", (value, Const(self.name())))
            elif self.take("["):
                value = Call("field", (value, self.expression()))
                self.need("]")
            else:
                return value

    def atom(self) -> object:
        if self.take("("):
            value = self.expression()
            self.need(")")
            return value
        if self.take("["):
            items = []
            while not self.take("]"):
                items.append(self.expression())
                if not self.peek("]"):
                    self.need(",")
            return Call("list", tuple(items))
        if self.take("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[self.tokens[self.at - 1][1]])
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind == "number":
                self.at += 1
                return Const(int(value))
            if kind == "text":
                self.at += 1
                return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        return Name(self.name())


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    stack: list[tuple[str, list, object]] = [("", [], None)]

    def text(piece: str, trim_left: bool, trim_right: bool) -> None:
        piece = piece.lstrip() if trim_left else piece
        piece = piece.rstrip() if trim_right else piece
        if piece:
            stack[-1][1].append(Output(Const(piece)))

    def close(kind: str) -> tuple[list, object]:
        if stack[-1][0] != kind or len(stack) == 1:
            raise TemplateError(f"no open {kind!r} to end")
        return stack.pop()[1:]

    at, trim = 0, False
    for found in MARKUP.finditer(source):
        left = bool(found[1] or found[4] or found[7])
        text(source[at : found.start()], trim, left)
        at, trim = found.end(), bool(found[3] or found[6] or found[8])
        if found[2] is not None:
            own = Parser(found[2])
            stack[-1][1].append(Output(own.expression()))
            own.end()
        elif found[5] is not None:
            own = Parser(found[5])
            if own.take("if"):
                stack.append(("if", [], [(own.expression(), None)]))
            elif own.peek("elif", "else"):
                body, branches = close("if")
                branches[-1] = (branches[-1][0], tuple(body))
                test = own.expression() if own.take("elif") else Const(own.take("else"))
                stack.append(("if", [], [*branches, (test, None)]))
            elif own.take("endif"):
                body, branches = close("if")
                branches[-1] = (branches[-1][0], tuple(body))
                stack[-1][1].append(If(tuple(branches)))
            elif own.take("for"):
                name = own.name()
                own.need("in")
                stack.append(("for", [], (name, own.expression())))
            elif own.take("endfor"):
                body, (name, items) = close("for")
                stack[-1][1].append(For(name, items, tuple(body)))
            elif own.take("set"):
                name = own.name()
                own.need("=")
                stack[-1][1].append(Set(name, own.expression()))
            elif own.take("generation"):
                stack.append(("generation", [], None))
            elif own.take("endgeneration"):
                body, _ = close("generation")
                stack[-1][1].append(Generation(tuple(body)))
            else:
                raise TemplateError(f"unknown statement {found[5].strip()!r}")
            own.end()
    text(source[at:], trim, False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} is not ended")
    return tuple(stack[0][1])


# Folding ---------------------------------------------------------------------


def fold(node: object) -> object:
    """The expression with operations on constants carried out."""
    if isinstance(node, (Const, Name)):
        return node
    args = tuple(fold(a) for a in node.args)
    if isinstance(node, Filter):
        if all(isinstance(a, Const) for a in args):
            return Const(FILTERS[node.name](*[a.value for a in args]))
        return Filter(node.name, args)
    first = args[0] if args else None
    if node.op in ("and", "or", "?") and isinstance(first, Const):
        if node.op == "?":
            return args[1] if first.value else args[2]
        return args[1] if bool(first.value) == (node.op == "and") else first
    if node.op in OPERATIONS and node.op != "list" and all(isinstance(a, Const) for a in args):
        return Const(OPERATIONS[node.op](*[a.value for a in args]))
    return Call(node.op, args)


def fold_body(body: tuple) -> tuple:
    """Statements with folded expressions, dead branches gone and neighbouring texts joined."""
    out: list = []

    def add(expr: object) -> None:
        if isinstance(expr, Const):
            expr = Const(_text(expr.value))
            if not expr.value:
                return
            if out and isinstance(out[-1], Output) and isinstance(out[-1].expr, Const):
                expr = Const(out.pop().expr.value + expr.value)
        out.append(Output(expr))

    for node in body:
        if isinstance(node, Output):
            add(fold(node.expr))
        elif isinstance(node, If):
            branches = []
            for test, inner in node.branches:
                test = fold(test)
                if isinstance(test, Const) and not test.value:
                    continue
                branches.append((test, fold_body(inner)))
                if isinstance(test, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    add(inner.expr) if isinstance(inner, Output) else out.append(inner)
            elif branches:
                out.append(If(tuple(branches)))
        elif isinstance(node, For):
            out.append(For(node.name, fold(node.items), fold_body(node.body)))
        elif isinstance(node, Set):
            out.append(Set(node.name, fold(node.expr)))
        else:
            out.append(Generation(fold_body(node.body)))
    return tuple(out)


# Closures --------------------------------------------------------------------

Pieces = Iterator[tuple[str, bool]]


def expression(node: object) -> Callable[[dict], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    args = [expression(a) for a in node.args]
    if isinstance(node, Filter):
        run = FILTERS[node.name]
    elif node.op == "and":
        return lambda env: args[0](env) and args[1](env)
    elif node.op == "or":
        return lambda env: args[0](env) or args[1](env)
    elif node.op == "?":
        return lambda env: args[1](env) if args[0](env) else args[2](env)
    else:
        run = OPERATIONS[node.op]
    if len(args) == 1:
        only = args[0]
        return lambda env: run(only(env))
    return lambda env: run(*[a(env) for a in args])


def _looked_ahead(items: Iterable) -> Iterator[tuple[object, bool]]:
    """Each item with whether it is the last; holds one item more than it has given."""
    stream = iter(items)
    try:
        held = next(stream)
    except StopIteration:
        return
    for item in stream:
        yield held, False
        held = item
    yield held, True


def statements(body: tuple, learnt: bool = False) -> Callable[[dict], Pieces]:
    steps = [_statement(node, learnt) for node in body]

    def run(env: dict) -> Pieces:
        for step in steps:
            yield from step(env)

    return run


def _statement(node: object, learnt: bool) -> Callable[[dict], Pieces]:
    if isinstance(node, Output):
        value = expression(node.expr)

        def output(env: dict) -> Pieces:
            yield _text(value(env)), learnt

        return output
    if isinstance(node, If):
        branches = [(expression(t), statements(b, learnt)) for t, b in node.branches]

        def choose(env: dict) -> Pieces:
            for test, inner in branches:
                if test(env):
                    yield from inner(env)
                    return

        return choose
    if isinstance(node, For):
        items, inner, name = expression(node.items), statements(node.body, learnt), node.name

        def loop(env: dict) -> Pieces:
            own = dict(env)
            for i, (item, last) in enumerate(_looked_ahead(items(env) or ())):
                own[name] = item
                own["loop"] = {"first": i == 0, "last": last, "index0": i, "index": i + 1}
                yield from inner(own)

        return loop
    if isinstance(node, Set):
        value, name = expression(node.expr), node.name

        def assign(env: dict) -> Pieces:
            env[name] = value(env)
            return
            yield

        return assign
    return statements(node.body, True)


class Template:
    """A compiled template."""

    def __init__(self, source: str):
        self.tree = fold_body(parse(source))
        self.run = statements(self.tree)

    def render(self, **variables: object) -> Pieces:
        """Pieces of text and whether each is to be learned; lists may be streams."""
        return self.run(dict(variables))


# Over tables -----------------------------------------------------------------

FORMATTED = "conv_id long, part int, formatted string, spans array<struct<start:int,end:int>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _stream(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _in_order(df: DataFrame, *order: str) -> DataFrame:
    return small_batches(df).repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(turns: DataFrame, template: str = CHAT) -> DataFrame:
    """``conv_id, part, formatted, spans`` of every conversation.

    Turns go by ``turn``, ties by role and text, nulls first; null roles and texts are
    empty; turns of a null id are one conversation. ``spans`` are the places of generated
    text within the part. A conversation's turns meet in one task, since their order is the
    result, but stream through it: a part of PART_CHARS characters is held at most, beside
    one turn. Repeated rows are turns of their own; an empty table gives an empty result.
    """
    columns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, parts, texts, spans = zip(*done)
            done.clear()
            return pa.record_batch(
                {
                    "conv_id": pa.array(ids, pa.int64()),
                    "part": pa.array(parts, pa.int32()),
                    "formatted": pa.array(texts, pa.string()),
                    "spans": pa.array(spans, SPANS),
                }
            )

        held = 0
        for conv, rows in groupby(_stream(batches, "conv_id", "role", "text"), key=lambda r: r[0]):
            part, size, pieces, spans = 0, 0, [], []
            for piece, learnt in compiled.render(turns=({"role": r, "text": t} for _, r, t in rows)):
                if size >= PART_CHARS:
                    done.append((conv, part, "".join(pieces), spans))
                    yield flush()
                    part, size, pieces, spans, held = part + 1, 0, [], [], 0
                if learnt:
                    spans.append({"start": size, "end": size + len(piece)})
                pieces.append(piece)
                size += len(piece)
            done.append((conv, part, "".join(pieces), spans))
            held += size
            if held >= PART_CHARS:
                yield flush()
                held = 0
        if done:
            yield flush()

    return _in_order(columns, "turn", "role", "text").mapInArrow(render, FORMATTED)


BODY = r"((?:[^\\\[<]++|\\.)*+)"
TURN = re.compile(
    rf"\[(?:(SYS)\]{BODY}\[/SYS\]|(INST)\]{BODY}\[/INST\]|(ANS)\]{BODY}</s>|TURN ((?:[^\\\[\]]++|\\.)*+)\]{BODY}\[/TURN\])",
    re.S,
)
ROLES = {"SYS": "system", "INST": "user", "ANS": "assistant"}


def read_turns(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Role and text of every turn in the formatted parts of a conversation, default template."""
    rest = ""
    for part in parts:
        rest += part
        at = 0
        for found in TURN.finditer(rest):
            kind = found[1] or found[3] or found[5]
            text = next(g for g in (found[2], found[4], found[6], found[8]) if g is not None)
            yield ROLES[kind] if kind else unescape(found[7]), unescape(text)
            at = found.end()
        rest = rest[at:]
    if rest.removeprefix("<s>"):
        raise ValueError("formatted text ends within a turn")


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted output says when it is read back: turns, learned text, lengths."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DIGEST.split(", ")]
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            out = pa.record_batch(dict(zip(names, map(list, zip(*rows)))))
            rows.clear()
            return out.cast(SCHEMA)

        stream = _stream(batches, "conv_id", "formatted", "spans")
        for conv, parts in groupby(stream, key=lambda r: r[0]):
            learnt, n_learnt, size = hashlib.sha256(), 0, 0

            def texts() -> Iterator[str]:
                nonlocal n_learnt, size
                for _, text, spans in parts:
                    size += len(text)
                    for span in spans:
                        own = unescape(text[span["start"] : span["end"]])
                        n_learnt += len(own)
                        learnt.update(own.encode("utf-8"))
                    yield text

            turns, count = hashlib.sha256(), 0
            for role, text in read_turns(texts()):
                turns.update(f"{role}\n{text}\n".encode())
                count += 1
            rows.append((conv, count, turns.hexdigest(), n_learnt, learnt.hexdigest(), size))
            if len(rows) >= 4096:
                yield flush()
        if rows:
            yield flush()

    return _in_order(formatted, "part").mapInArrow(read, DIGEST)


SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
