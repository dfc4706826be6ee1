"""Chat formatting: a compiler for a small sandboxed template language.

A template is parsed into a syntax tree, constants are folded (expressions of
literals, branches with a known condition, neighbouring text), and the tree
becomes Python closures.  Rendering emits pieces with a flag that tells
whether a piece was written inside ``{% generation %}`` (the loss mask).

Language: ``{{ expr }}``, ``{% for x in expr %}``, ``{% if %}/{% elif %}/{% else %}``,
``{% set x = expr %}``, ``{% generation %}``, ``{# comment #}``, ``-`` to strip
white space.  Expressions have literals, names, ``a.b``, ``a['b']``, ``~ + == != < <=
> >= in not and or``, ``x if c else y`` and the filters of ``FILTERS``.  Sandbox:
names come from the given variables only, members are mapping keys or list
items, there are no calls, and nothing reaches Python attributes.

Defined cases: null role and text are empty; turns sort by turn (null first),
then role and text; repeated turns all count; a null conv_id is a conversation
of its own; empty tables give empty results; a conversation of any length is
rendered and read back as a stream, in parts of bounded size.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfline.llm import store

# Control strings of the format, and how texts escape them.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}<s>{{ m.role | escape }}"
    "{% if m.role == 'assistant' %}[/INST]{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}[INST]{{ m.text | escape }}{% endif %}</s>{% endfor %}"
)
_ESCAPE = re.compile(r"\\|([<\[])(?=/?(?:s>|INST\]))")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
PART_CHARS = 1 << 20


def escape(text: str) -> str:
    """Make control strings of a text harmless; ``unescape`` reverses it."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


FILTERS: dict[str, Callable[..., Any]] = {
    "escape": lambda x: escape(_text(x)), "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(), "length": lambda x: len(x), "string": lambda x: _text(x),
    "default": lambda x, other="": other if x is None else x, "first": lambda x: x[0] if x else None,
    "last": lambda x: x[-1] if x else None,
    "replace": lambda x, a, b: _text(x).replace(a, b),
}


class TemplateError(ValueError):
    """A template that does not follow the language."""


def _text(x: Any) -> str:
    if x is None:
        return ""
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, str | int | float):
        return str(x)
    raise TemplateError("only texts and numbers can be written")


_PIECES = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.DOTALL)
_TOKENS = re.compile(r"""\s*(?:(?P<num>\d+(?:\.\d+)?)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
                     r"""|(?P<name>[A-Za-z][A-Za-z0-9_]*)|(?P<op>==|!=|<=|>=|[-~+<>()\[\].,|=]))""", re.DOTALL)
_WORDS = {"and", "or", "not", "in", "if", "else", "is", "true", "false", "none", "defined"}
_BINARY = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


class _Expression:
    """Recursive descent over the tokens of one expression; trees are tuples."""

    def __init__(self, source: str):
        self._tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self._tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self._at = 0

    def _peek(self, *words: str) -> bool:
        return self._at < len(self._tokens) and self._tokens[self._at][0] != "str" and self._tokens[self._at][1] in words

    def _take(self, *words: str) -> bool:
        if self._peek(*words):
            self._at += 1
            return True
        return False

    def _need(self, word: str) -> None:
        if not self._take(word):
            raise TemplateError(f"{word!r} expected")

    def _next(self, kind: str) -> str:
        if self._at >= len(self._tokens) or self._tokens[self._at][0] != kind:
            raise TemplateError(f"{kind} expected")
        self._at += 1
        return self._tokens[self._at - 1][1]

    def whole(self) -> tuple:
        tree = self.choice()
        if self._at != len(self._tokens):
            raise TemplateError("expression goes on where it should end")
        return tree

    def choice(self) -> tuple:
        tree = self.either()
        if self._take("if"):
            test = self.either()
            other = self.choice() if self._take("else") else ("const", None)
            return ("choice", test, tree, other)
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self._take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self._take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self._take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.joined()
        while self._at < len(self._tokens):
            if self._peek(*_BINARY):
                op = self._tokens[self._at][1]
                self._at += 1
                tree = ("compare", op, tree, self.joined())
            elif self._take("in"):
                tree = ("in", tree, self.joined())
            elif self._take("is"):
                wanted = not self._take("not")
                self._need("defined")
                tree = ("defined", tree) if wanted else ("not", ("defined", tree))
            else:
                break
        return tree

    def joined(self) -> tuple:
        tree = self.filtered()
        while self._peek("~", "+"):
            op = self._tokens[self._at][1]
            self._at += 1
            tree = (op, tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.member()
        while self._take("|"):
            name = self._next("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            args = []
            if self._take("("):
                while not self._take(")"):
                    args.append(self.choice())
                    if not self._peek(")"):
                        self._need(",")
            tree = ("filter", name, tree, *args)
        return tree

    def member(self) -> tuple:
        tree = self.atom()
        while True:
            if self._take("."):
                tree = ("member", tree, ("const", self._next("name")))
            elif self._take("["):
                tree = ("member", tree, self.choice())
                self._need("]")
            else:
                return tree

    def atom(self) -> tuple:
        if self._take("("):
            tree = self.choice()
            self._need(")")
            return tree
        if self._take("-"):
            return ("const", -_number(self._next("num")))
        if self._at >= len(self._tokens):
            raise TemplateError("expression expected")
        kind, value = self._tokens[self._at]
        self._at += 1
        if kind == "num":
            return ("const", _number(value))
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "name" and value in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[value])
        if kind == "name" and value not in _WORDS:
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def _number(text: str) -> int | float:
    return float(text) if "." in text else int(text)


def parse(source: str) -> tuple:
    """Syntax tree of a template: ("block", nodes...)."""
    pieces, tags = [], _PIECES.split(source)
    for i, piece in enumerate(tags):
        if i % 2 == 0:
            if i and tags[i - 1][-3:-2] == "-":
                piece = piece.lstrip()
            if i + 1 < len(tags) and tags[i + 1][2:3] == "-":
                piece = piece.rstrip()
            if piece:
                pieces.append(("text", piece))
        elif piece[1] != "#":
            pieces.append((piece[:2], piece[2:-2].strip("-").strip()))
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes = []
        while at < len(pieces):
            kind, body = pieces[at]
            at += 1
            if kind == "text":
                nodes.append(("text", body))
            elif kind == "{{":
                nodes.append(("write", _Expression(body).whole()))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return ("block", *nodes), body
                nodes.append(statement(word, rest.strip()))
        if ends:
            raise TemplateError(f"{ends[-1]!r} expected")
        return ("block", *nodes), ""

    def statement(word: str, rest: str) -> tuple:
        if word == "for":
            m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.DOTALL)
            if not m:
                raise TemplateError("for needs 'name in expression'")
            body, _ = block("endfor")
            return ("for", m[1], _Expression(m[2]).whole(), body)
        if word == "if":
            body, end = block("elif", "else", "endif")
            return ("if", _Expression(rest).whole(), body, follow(end))
        if word == "set":
            m = re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest, re.DOTALL)
            if not m:
                raise TemplateError("set needs 'name = expression'")
            return ("set", m[1], _Expression(m[2]).whole())
        if word == "generation":
            body, _ = block("endgeneration")
            return ("generation", body)
        raise TemplateError(f"no statement {word!r}")

    def follow(end: str) -> tuple:
        word, _, rest = end.partition(" ")
        if word == "elif":
            body, nxt = block("elif", "else", "endif")
            return ("block", ("if", _Expression(rest).whole(), body, follow(nxt)))
        return block("endif")[0] if word == "else" else ("block",)

    return block()[0]


def fold(node: tuple) -> tuple:
    """The tree with its constant parts worked out."""
    kind = node[0]
    if kind in ("const", "name", "text"):
        return node
    if kind == "block":
        nodes: list[tuple] = []
        for child in map(fold, node[1:]):
            for x in child[1:] if child[0] == "block" else (child,):
                if x[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + x[1])
                else:
                    nodes.append(x)
        return ("block", *nodes)
    node = tuple(fold(x) if isinstance(x, tuple) else x for x in node)
    kids = [x for x in node[1:] if isinstance(x, tuple)]
    if kind == "write" and node[1][0] == "const":
        return ("text", _text(node[1][1])) if _text(node[1][1]) else ("block",)
    if kind == "if" and node[1][0] == "const":
        return node[2] if node[1][1] else node[3]
    if kind == "choice" and node[1][0] == "const":
        return node[2] if node[1][1] else node[3]
    if kind in ("and", "or") and node[1][0] == "const":
        return node[2] if bool(node[1][1]) == (kind == "and") else node[1]
    if kind in ("not", "compare", "in", "~", "+", "filter") and all(k[0] == "const" for k in kids):
        return ("const", _expression(node)({}))
    return node


Scope = dict[str, Any]


def _member(base: Any, key: Any) -> Any:
    if isinstance(base, dict):
        return base.get(key)
    if isinstance(base, list | tuple | str) and isinstance(key, int) and -len(base) <= key < len(base):
        return base[key]
    return None


def _expression(node: tuple) -> Callable[[Scope], Any]:
    """Closure that works out an expression in a scope."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda s: value
    if kind == "name":
        name = node[1]
        return lambda s: s.get(name)
    if kind == "filter":
        f, args = FILTERS[node[1]], [_expression(x) for x in node[2:]]
        if len(args) == 1:
            only = args[0]
            return lambda s: f(only(s))
        return lambda s: f(*(a(s) for a in args))
    if kind == "compare":
        op, a, b = _BINARY[node[1]], _expression(node[2]), _expression(node[3])
        return lambda s: op(a(s), b(s))
    parts = [_expression(x) for x in node[1:]]
    a, b = parts[0], parts[1] if len(parts) > 1 else None
    if kind == "member":
        return lambda s: _member(a(s), b(s))
    if kind == "choice":
        yes, no = parts[1], parts[2]
        return lambda s: yes(s) if a(s) else no(s)
    if kind == "and":
        return lambda s: b(s) if (x := a(s)) else x
    if kind == "or":
        return lambda s: x if (x := a(s)) else b(s)
    if kind == "in":
        return lambda s: a(s) in (b(s) or ())
    return {"not": lambda s: not a(s), "defined": lambda s: a(s) is not None,
            "~": lambda s: _text(a(s)) + _text(b(s)), "+": lambda s: a(s) + b(s)}[kind]


Render = Callable[[Scope, bool], Iterator[tuple[str, bool]]]


def _statement(node: tuple) -> Render:
    """Closure that renders a node: yields (piece, inside generation)."""
    kind = node[0]
    if kind == "text":
        text = node[1]

        def plain(s: Scope, mark: bool) -> Iterator[tuple[str, bool]]:
            yield text, mark
        return plain
    if kind == "write":
        value = _expression(node[1])

        def write(s: Scope, mark: bool) -> Iterator[tuple[str, bool]]:
            yield _text(value(s)), mark
        return write
    if kind == "set":
        name, value = node[1], _expression(node[2])

        def assign(s: Scope, mark: bool) -> Iterator[tuple[str, bool]]:
            s[name] = value(s)
            return iter(())
        return assign
    if kind == "generation":
        body = _statement(node[1])
        return lambda s, mark: body(s, True)
    if kind == "if":
        test, yes, no = _expression(node[1]), _statement(node[2]), _statement(node[3])
        return lambda s, mark: yes(s, mark) if test(s) else no(s, mark)
    if kind == "for":
        name, items, body = node[1], _expression(node[2]), _statement(node[3])

        def loop(s: Scope, mark: bool) -> Iterator[tuple[str, bool]]:
            inner, rest, end = dict(s), iter(items(s) or ()), object()
            now, i, before = next(rest, end), 0, None
            while now is not end:  # one item ahead, so a stream has loop.last too
                nxt = next(rest, end)
                inner[name] = now
                inner["loop"] = {"index": i + 1, "index0": i, "first": i == 0, "last": nxt is end, "previtem": before,
                                 "nextitem": None if nxt is end else nxt}
                yield from body(inner, mark)
                before, now, i = now, nxt, i + 1
        return loop
    nodes = [_statement(x) for x in node[1:]]
    if len(nodes) == 1:
        return nodes[0]

    def block(s: Scope, mark: bool) -> Iterator[tuple[str, bool]]:
        for n in nodes:
            yield from n(s, mark)
    return block


class Template:
    """A compiled template."""

    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self._render = _statement(self.tree)

    def pieces(self, **variables: Any) -> Iterator[tuple[str, bool]]:
        return self._render(dict(variables), False)

    def render(self, **variables: Any) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and the spans of generated characters in it."""
        out, spans, at = [], [], 0
        for piece, mark in self.pieces(**variables):
            if mark and piece:
                spans.append((at, at + len(piece)))
            out.append(piece)
            at += len(piece)
        return "".join(out), spans


_PARTS = "part long, formatted string, generated array<struct<start:int,end:int>>, ended boolean"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, dict]]:
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            yield conv, {"role": role or "", "text": text or ""}


def format_conversations(turns: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """One row per part of each formatted conversation.

    Columns: conv_id, part (from 0), formatted, generated (spans under the
    loss mask, positions in the part), ended (last part).  Conversations up to
    ``part_chars`` characters have one part.  The parts of a conversation stay
    together and in order, so ``read_back`` needs no further shuffle.
    """
    spark = turns.sparkSession
    store.prepare(spark)
    src = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                       F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    src = src.repartition(store.fan_out(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = src.schema["conv_id"].dataType
    id_type = to_arrow_type(kind)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)
        stream = _turns(batches)
        ahead = next(stream, None)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            types = (id_type, pa.int64(), pa.string(), spans_type, pa.bool_())
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, names=["conv_id", "part", "formatted", "generated", "ended"])

        while ahead is not None:
            conv = ahead[0]

            def mine() -> Iterator[dict]:
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:  # noqa: B023 - used up before conv changes
                    message = ahead[1]
                    ahead = next(stream, None)
                    yield message

            source = mine()
            out, spans, at, part = [], [], 0, 0
            for piece, mark in compiled.pieces(messages=source):
                for cut in range(0, len(piece), part_chars):
                    bit = piece[cut: cut + part_chars]
                    if at + len(bit) > part_chars:
                        rows.append((conv, part, "".join(out), spans, False))
                        out, spans, at, part = [], [], 0, part + 1
                        yield flush()
                        held = 0
                    if mark:
                        spans.append({"start": at, "end": at + len(bit)})
                    out.append(bit)
                    at += len(bit)
            for _ in source:  # turns that the template does not look at
                pass
            rows.append((conv, part, "".join(out), spans, True))
            held += at
            if held > PART_CHARS:
                yield flush()
                held = 0
        if rows:
            yield flush()

    return src.mapInArrow(run, f"conv_id {kind.simpleString()}, {_PARTS}")


_TURN = re.compile(r"<s>(.*?)(\[/?INST\])(.*?)</s>", re.DOTALL)


class _Reader:
    """Reads turns and the loss text back from the parts of one conversation."""

    def __init__(self) -> None:
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.turn_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()
        self._text, self._loss = "", ""

    def add(self, text: str, spans: list[dict]) -> None:
        self.chars += len(text)
        self._text += text
        last = 0
        for m in _TURN.finditer(self._text):
            if m.start() != last:
                raise ValueError("text between turns")
            self.turns += 1
            self.turn_digest.update(f"{unescape(m[1])}\n{unescape(m[3])}\n".encode())
            last = m.end()
        self._text = self._text[last:]
        self._loss += "".join(text[s["start"]: s["end"]] for s in spans)
        # An escape may be cut by the end of the part: keep an odd last backslash.
        ready = self._loss
        if (len(ready) - len(ready.rstrip("\\"))) % 2:
            ready = ready[:-1]
        self._loss = self._loss[len(ready):]
        plain = unescape(ready)
        self.loss_chars += len(plain)
        self.loss_digest.update(plain.encode())


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``parts`` must be the result of ``format_conversations`` with the standard
    template (its partitions hold the parts in order).
    """
    kind = parts.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            done = []
            for conv, _, text, spans, ended in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                reader.add(text, spans)
                if ended:
                    done.append((conv, reader.turns, reader.turn_digest.hexdigest(), reader.loss_chars,
                                 reader.loss_digest.hexdigest(), reader.chars))
                    reader = _Reader()
            types = (batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[i] for d in done], t) for i, t in enumerate(types)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return parts.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long")
