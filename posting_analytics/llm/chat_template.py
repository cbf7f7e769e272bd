"""Chat formatting by a template compiler.

``compile_template`` reads a small sandboxed template language, builds a syntax
tree, folds constants and generates Python closures.  The closures yield
``(text, is_generation)`` pieces, so a conversation is rendered turn by turn and
never needs to be whole in memory.

Language: ``{{ expression }}``, ``{% for x in xs %}``, ``{% if %} {% elif %}
{% else %}``, ``{% set x = e %}``, ``{% generation %} ... {% endgeneration %}``
and ``{# comment #}``.  Expressions have strings, integers, true / false / none,
names, ``a.b`` and ``a['b']`` (keys of mappings only, never attributes), ``+ ~``,
comparisons, ``in``, ``and or not``, ``x if c else y`` and filters.  There are no
calls, and names are only those that the caller passes in.

Control strings inside texts are escaped reversibly: ``escape`` puts one
backslash after the ``<`` of every ``<`` ``\\``* ``|``, ``unescape`` takes it away.

Cases: rows of a conversation are ordered by turn, then role and text, nulls
first; a null role or text is empty; a null conv_id is a conversation of its
own; repeated rows are turns of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"

CHAT = (
    "{% for m in messages %}{{ '<|im_start|>' + (m.role | escape) + '\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '<|im_end|>' ~ '\n' }}{% endfor %}")

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


FILTERS: dict[str, Callable] = {
    "escape": escape, "trim": lambda s: s.strip(), "upper": lambda s: s.upper(),
    "lower": lambda s: s.lower(), "length": len, "string": str,
}


class TemplateError(ValueError):
    """The template is malformed or asks for something outside the sandbox."""


_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKENS = re.compile(
    r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>.|()\[\],=]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _lex(source: str) -> list[tuple[str, object]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = _TOKENS.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:at + 20]!r}")
        if m[1] is not None:
            out.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), m[1][1:-1], flags=re.S)))
        elif m[2] is not None:
            out.append(("const", int(m[2])))
        elif m[3] is not None:
            out.append(("name", m[3]))
        else:
            out.append(("op", m[4]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over one expression; nodes are tuples ``(kind, ...)``."""

    def __init__(self, tokens: list[tuple[str, object]]):
        self.tokens, self.at = tokens, 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" \
            and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def want(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def whole(self) -> tuple:
        node = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def choice(self) -> tuple:
        node = self.either()
        if self.take("if"):
            test = self.either()
            self.want("else")
            return ("if", test, node, self.choice())
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negation()
        while self.take("and"):
            node = ("and", node, self.negation())
        return node

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> tuple:
        node = self.total()
        while op := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
            node = (op, node, self.total())
        return node

    def total(self) -> tuple:
        node = self.filtered()
        while op := self.take("+", "-", "~"):
            node = (op, node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            self.at += 1
            node = ("filter", node, name)
        return node

    def atom(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "const":
            node = ("const", value)
        elif kind == "name":
            fixed = {"true": True, "false": False, "none": None}
            node = ("const", fixed[value]) if value in fixed else ("name", value)
        elif value == "(":
            node = self.choice()
            self.want(")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while True:
            if self.take("."):
                kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError("a key must follow the dot")
                self.at += 1
                node = ("key", node, ("const", value))
            elif self.take("["):
                node = ("key", node, self.choice())
                self.want("]")
            else:
                return node


def parse(template: str) -> list[tuple]:
    """The syntax tree: a list of ``text / print / for / if / set / generation`` nodes."""
    parts, at = [], 0
    for m in _PARTS.finditer(template):
        if m.start() > at:
            parts.append(("text", template[at:m.start()]))
        if m[1] is not None:
            parts.append(("print", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    if at < len(template):
        parts.append(("text", template[at:]))
    expr = lambda s: _Expression(_lex(s)).whole()
    place = 0

    def body(*stops: str) -> tuple[list[tuple], str]:
        nonlocal place
        nodes = []
        while place < len(parts):
            kind, value = parts[place]
            place += 1
            if kind == "text":
                nodes.append(("text", value))
            elif kind == "print":
                nodes.append(("print", expr(value)))
            else:
                word, _, rest = value.partition(" ")
                if word in stops:
                    return nodes, value
                if word == "for":
                    m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                    if not m:
                        raise TemplateError(f"malformed for: {value!r}")
                    nodes.append(("for", m[1], expr(m[2]), body("endfor")[0]))
                elif word == "if":
                    branches, test, otherwise = [], expr(rest), []
                    while True:
                        inner, stop = body("elif", "else", "endif")
                        branches.append((test, inner))
                        if stop.startswith("elif"):
                            test = expr(stop[4:])
                            continue
                        if stop == "else":
                            otherwise = body("endif")[0]
                        break
                    nodes.append(("if", branches, otherwise))
                elif word == "set":
                    name, eq, rest = rest.partition("=")
                    if not eq or not name.strip().isidentifier():
                        raise TemplateError(f"malformed set: {value!r}")
                    nodes.append(("set", name.strip(), expr(rest)))
                elif word == "generation":
                    nodes.append(("generation", body("endgeneration")[0]))
                else:
                    raise TemplateError(f"unexpected {value!r}")
        if stops:
            raise TemplateError(f"{stops[-1]!r} is missing")
        return nodes, ""

    return body()[0]


_BINARY: dict[str, Callable] = {
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "~": lambda a, b: f"{a}{b}",
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
}


def _key(value: object, name: object) -> object:
    if not isinstance(value, dict):
        raise TemplateError("only mappings have keys")
    return value.get(name)


def fold(node: tuple) -> tuple:
    """The expression with constant parts computed."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        inner = fold(node[1])
        return ("const", FILTERS[node[2]](inner[1])) if inner[0] == "const" else ("filter", inner, node[2])
    args = tuple(fold(x) for x in node[1:])
    if kind == "if" and args[0][0] == "const":
        return args[1] if args[0][1] else args[2]
    if kind in ("and", "or") and args[0][0] == "const":
        return args[1] if bool(args[0][1]) == (kind == "and") else args[0]
    if all(a[0] == "const" for a in args):
        return ("const", expression((kind, *args))({}))
    return (kind, *args)


def fold_body(nodes: list[tuple]) -> list[tuple]:
    """The statements with constants folded, dead branches gone and texts joined."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        kind = node[0]
        if kind == "text":
            add(node)
        elif kind == "print":
            e = fold(node[1])
            add(("text", _shown(e[1])) if e[0] == "const" else ("print", e))
        elif kind == "for":
            add(("for", node[1], fold(node[2]), fold_body(node[3])))
        elif kind == "set":
            add(("set", node[1], fold(node[2])))
        elif kind == "generation":
            add(("generation", fold_body(node[1])))
        else:
            branches, otherwise = [], node[2]
            for test, inner in node[1]:
                test = fold(test)
                if test[0] == "const":
                    if not test[1]:
                        continue
                    otherwise = inner
                    break
                branches.append((test, fold_body(inner)))
            if branches:
                add(("if", branches, fold_body(otherwise)))
            else:
                for x in fold_body(otherwise):
                    add(x)
    return out


def _shown(value: object) -> str:
    return "" if value is None else str(value)


def expression(node: tuple) -> Callable[[dict], object]:
    """A closure that evaluates an expression."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]

        def read(env: dict) -> object:
            if name not in env:
                raise TemplateError(f"unknown name {name!r}")
            return env[name]
        return read
    if kind == "filter":
        inner, apply = expression(node[1]), FILTERS[node[2]]
        return lambda env: apply(inner(env))
    args = [expression(x) for x in node[1:]]
    if kind == "key":
        return lambda env: _key(args[0](env), args[1](env))
    if kind == "not":
        return lambda env: not args[0](env)
    if kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if kind == "or":
        return lambda env: args[0](env) or args[1](env)
    if kind == "if":
        return lambda env: args[1](env) if args[0](env) else args[2](env)
    apply, left, right = _BINARY[kind], *args
    return lambda env: apply(left(env), right(env))


Piece = tuple[str, bool]


def statements(nodes: list[tuple], generation: bool = False) -> Callable[[dict], Iterator[Piece]]:
    """A closure that yields the pieces of a statement list."""

    def one(node: tuple) -> Callable[[dict], Iterator[Piece]]:
        kind = node[0]
        if kind == "text":
            fixed = ((node[1], generation),)
            return lambda env: iter(fixed)
        if kind == "print":
            value = expression(node[1])
            return lambda env: iter(((_shown(value(env)), generation),))
        if kind == "set":
            value, name = expression(node[2]), node[1]

            def put(env: dict) -> Iterator[Piece]:
                env[name] = value(env)
                return iter(())
            return put
        if kind == "generation":
            return statements(node[1], True)
        if kind == "for":
            items, inner, name = expression(node[2]), statements(node[3], generation), node[1]

            def loop(env: dict) -> Iterator[Piece]:
                for item in items(env):
                    yield from inner({**env, name: item})
            return loop
        branches = [(expression(t), statements(b, generation)) for t, b in node[1]]
        otherwise = statements(node[2], generation)

        def pick(env: dict) -> Iterator[Piece]:
            for test, inner in branches:
                if test(env):
                    return inner(env)
            return otherwise(env)
        return pick

    parts = [one(n) for n in nodes]

    def run(env: dict) -> Iterator[Piece]:
        for part in parts:
            yield from part(env)
    return run


def compile_template(template: str) -> Callable[[dict], Iterator[Piece]]:
    """``env -> pieces``; ``env['messages']`` may be any iterable of ``{role, text}``."""
    run = statements(fold_body(parse(template)))
    return lambda env: run(dict(env))


class Reader:
    """Reads turns and the loss mask back from the pieces of a formatted conversation.

    ``turns`` is fed with every complete ``(role, text)``; text under the mask
    goes to ``loss``.  Only the turn that is being read is kept.
    """

    def __init__(self) -> None:
        self.buffer, self.marks, self.n_turns, self.formatted, self.loss_chars = [], [], 0, 0, 0
        self.size = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, generation: bool) -> None:
        self.formatted += len(text)
        if generation:
            self.marks.append((self.size, self.size + len(text)))
        self.buffer.append(text)
        self.size += len(text)
        if END in text:  # control strings inside texts are escaped: this one is a marker
            self._drain()

    def _drain(self) -> None:
        whole, at = "".join(self.buffer), 0
        while (stop := whole.find(END, at)) >= 0:
            start = whole.index(START, at)
            role, _, text = whole[start + len(START):stop].partition("\n")
            self.turn_hash.update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
            at = stop + len(END)
        masked, later = "", []
        for a, b in self.marks:
            if b <= at:
                masked += whole[a:b]
            else:
                later.append((a - at, b - at))
        masked = unescape(masked) if masked else ""
        self.loss_chars += len(masked)
        self.loss_hash.update(masked.encode("utf-8", "surrogatepass"))
        self.buffer, self.marks, self.size = [whole[at:]], later, len(whole) - at


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(3)))


_PIECES = "conv_id long, piece long, text string, generation boolean"


def _render(template: str):
    def run(batches):
        render = compile_template(template)
        rows, held = _rows(batches), []
        current = next(rows, None)
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.bool_())],
                ["conv_id", "piece", "text", "generation"])
            out.clear()
            return batch

        held = [current]
        while held[0] is not None:
            conv = held[0][0]

            def messages(conv=conv):
                while held[0] is not None and held[0][0] == conv:
                    yield {"role": held[0][1] or "", "text": held[0][2] or ""}
                    held[0] = next(rows, None)

            n = size = 0
            source = messages()
            for n, (text, generation) in enumerate(render({"messages": source})):
                out.append((conv, n, text, generation))
                size += len(text)
                if len(out) >= 4096 or size > 4_000_000:
                    yield flush()
                    size = 0
            for _ in source:  # a template may leave messages unread
                pass
        if out:
            yield flush()
    return run


def format_conversations(conversations: DataFrame, template: str = CHAT) -> DataFrame:
    """The formatted conversations as ``conv_id, piece, text, generation``.

    The pieces of a conversation, joined in order, are its formatted text; those
    marked ``generation`` are the loss mask.  A conversation's rows are sorted in
    one partition and streamed through the template, so a conversation of any
    length is rendered in bounded memory; pieces stay together and in order.
    """
    compile_template(template)  # a malformed template fails here, not in a task
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("role").cast("string"),
                                F.col("text").cast("string"), "turn")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_render(template), _PIECES)


def _read(batches):
    reader, conv, started = Reader(), None, False
    out: list[tuple] = []

    def close() -> None:
        reader._drain()  # markers that a template split over pieces
        out.append((conv, reader.n_turns, reader.turn_hash.hexdigest(), reader.loss_chars,
                    reader.loss_hash.hexdigest(), reader.formatted))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
        out.clear()
        return batch

    for batch in batches:
        ids, place, text, mask = (batch.column(i).to_pylist() for i in range(4))
        for i in range(batch.num_rows):
            if place[i] == 0:
                if started:
                    close()
                reader, conv, started = Reader(), ids[i], True
            reader.feed(text[i], mask[i])
        if len(out) >= 1024:
            yield flush()
    if started:
        close()
    if out:
        yield flush()


def read_back(pieces: DataFrame) -> DataFrame:
    """Digest of each formatted conversation, read from its pieces alone."""
    return pieces.mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
               "loss_sha256 string, formatted_chars long")
