"""Chat formatting with a small compiled template language.

``{{ expression }}`` prints, ``{% for x in list %}``, ``{% if %}`` / ``{% elif %}``
/ ``{% else %}`` branch, and ``{% generation %}`` marks what a model is trained to
say. Expressions have names, fields (``m.role`` or ``m['role']``), string and
integer literals, ``== != + and or not``, parentheses and filters after ``|``.
A template becomes a tree, constants are folded, and the tree becomes nested
Python closures. The language is a sandbox: it reads fields of plain dicts and
calls nothing but the filters named here.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings that a model may know as turn marks; none survives escaping.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
#: Each control string holds < or [, so escaping those (and the escape itself) suffices.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' + '' }}{{ m.role | escape | oneline }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
TURN = re.compile(r"<\|im_start\|>([^\n<]*)\n([^<]*)<\|im_end\|>\n")


def escape(text: str) -> str:
    for plain, name in ESCAPES:
        text = text.replace(plain, name)
    return text


def unescape(text: str) -> str:
    for plain, name in (("\n", "&#10;"), *ESCAPES[::-1]):
        text = text.replace(name, plain)
    return text


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "oneline": lambda s: s.replace("\n", "&#10;"), "trim": str.strip, "upper": str.upper, "lower": str.lower}

PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
WORD = re.compile(r"\s*(?:(\d+)|'([^']*)'|\"([^\"]*)\"|([A-Za-z_]\w*)|(==|!=|[().+|\[\]]))")


class TemplateError(ValueError):
    """A template that does not parse, or a field that isn't there."""


class Expression:
    """Recursive descent over one expression; yields nested tuples."""

    def __init__(self, source: str):
        self.items, at, source = [], 0, source.strip()
        while at < len(source):
            m = WORD.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, one, two, name, sign = m.groups()
            self.items.append(("const", int(number)) if number else ("const", one if one is not None else two) if one is not None or two is not None else ("name", name) if name else ("sign", sign))
            at = m.end()

    def take(self, *wanted: tuple) -> tuple | None:
        if self.items and (self.items[0] in wanted or not wanted):
            return self.items.pop(0)
        return None

    def whole(self) -> tuple:
        node = self.either()
        if self.items:
            raise TemplateError(f"unexpected {self.items[0][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take(("name", "or")):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take(("name", "and")):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take(("name", "not")) else self.compared()

    def compared(self) -> tuple:
        node = self.sum()
        while sign := self.take(("sign", "=="), ("sign", "!=")):
            node = (sign[1], node, self.sum())
        return node

    def sum(self) -> tuple:
        node = self.filtered()
        while self.take(("sign", "+")):
            node = ("+", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.field()
        while self.take(("sign", "|")):
            name = self.take()
            if not name or name[1] not in FILTERS:
                raise TemplateError(f"unknown filter {name and name[1]!r}")
            node = ("filter", node, name[1])
        return node

    def field(self) -> tuple:
        node = self.take()
        if node == ("sign", "("):
            node = self.either()
            if not self.take(("sign", ")")):
                raise TemplateError("missing )")
        elif not node or node[0] == "sign":
            raise TemplateError("an expression is missing")
        while sign := self.take(("sign", "."), ("sign", "[")):
            key = self.take()
            if not key or key[0] == "sign" or sign[1] == "[" and (key[0] != "const" or not self.take(("sign", "]"))):
                raise TemplateError("a field name is missing")
            node = ("field", node, key[1])
        return node


def folded(node: tuple) -> tuple:
    """The expression with constant parts computed."""
    kind, *rest = node
    if kind in ("const", "name"):
        return node
    rest = [folded(x) if isinstance(x, tuple) else x for x in rest]
    known = [x[1] for x in rest if isinstance(x, tuple) and x[0] == "const"]
    node = (kind, *rest)
    if len(known) == sum(isinstance(x, tuple) for x in rest) and kind != "field":
        return "const", closure(node)({})
    if kind in ("and", "or") and rest[0][0] == "const":
        return rest[1] if bool(rest[0][1]) == (kind == "and") else rest[0]
    return node


def text_of(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def closure(node: tuple) -> Callable[[dict], object]:
    """A function of the variables that computes the expression."""
    kind, a, *rest = node
    if kind == "const":
        return lambda env: a
    if kind == "name":

        def name(env: dict) -> object:
            if a not in env:
                raise TemplateError(f"no variable {a!r}")
            return env[a]

        return name
    left = closure(a)
    if kind == "field":
        key = rest[0]

        def field(env: dict) -> object:
            holder = left(env)
            if type(holder) is not dict or key not in holder:
                raise TemplateError(f"no field {key!r}")
            return holder[key]

        return field
    if kind == "filter":
        change = FILTERS[rest[0]]
        return lambda env: change(text_of(left(env)))
    if kind == "not":
        return lambda env: not left(env)
    right = closure(rest[0])
    if kind == "+":
        return lambda env: text_of(left(env)) + text_of(right(env))
    if kind in ("==", "!="):
        return lambda env: (left(env) == right(env)) == (kind == "==")
    return (lambda env: left(env) and right(env)) if kind == "and" else (lambda env: left(env) or right(env))


def parsed(source: str) -> list[tuple]:
    """The syntax tree: text, print, for, if and generation nodes."""
    top: list[tuple] = []
    stack: list[tuple[str, list]] = [("", top)]
    at = 0
    for m in PARTS.finditer(source):
        if m.start() > at:
            stack[-1][1].append(("text", source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1][1].append(("print", Expression(m[1]).whole()))
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "for":
            parts = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not parts:
                raise TemplateError(f"for {rest!r}")
            body: list[tuple] = []
            stack[-1][1].append(("for", parts[1], Expression(parts[2]).whole(), body))
            stack.append(("for", body))
        elif word == "if":
            arms: list[tuple] = [(Expression(rest).whole(), [])]
            stack[-1][1].append(("if", arms))
            stack.append(("if", arms[0][1]))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            stack.pop()
            arms = stack[-1][1][-1][1]
            arms.append((Expression(rest).whole() if word == "elif" else ("const", True), []))
            stack.append(("if", arms[-1][1]))
        elif word == "generation":
            body = []
            stack[-1][1].append(("generation", body))
            stack.append(("generation", body))
        elif word.startswith("end") and word[3:] == stack[-1][0]:
            stack.pop()
        else:
            raise TemplateError(f"unexpected {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    if at < len(source):
        top.append(("text", source[at:]))
    return top


def simplified(nodes: list[tuple]) -> list[tuple]:
    """Constants folded, dead branches dropped, neighbouring texts joined."""
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "print":
            value = folded(node[1])
            node = ("text", text_of(value[1])) if value[0] == "const" else ("print", value)
        elif node[0] == "for":
            node = ("for", node[1], folded(node[2]), simplified(node[3]))
        elif node[0] == "generation":
            node = ("generation", simplified(node[1]))
        elif node[0] == "if":
            arms = []
            for test, body in node[1]:
                test = folded(test)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, simplified(body)))
                if test[0] == "const":
                    break
            if arms and arms[0][0][0] == "const":
                for inner in arms[0][1]:
                    add(out, inner)
                continue
            node = ("if", arms)
        add(out, node)
    return out


def add(out: list[tuple], node: tuple) -> None:
    if node[0] == "text" and out and out[-1][0] == "text":
        out[-1] = ("text", out[-1][1] + node[1])
    elif node != ("text", ""):
        out.append(node)


class Rendered:
    """Output under construction: parts, length, and generated spans."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def generated(nodes: list[tuple]) -> Callable[[dict, Rendered], None]:
    """One closure for a list of nodes."""

    def one(node: tuple) -> Callable[[dict, Rendered], None]:
        if node[0] == "text":
            return lambda env, out: out.write(node[1])
        if node[0] == "print":
            value = closure(node[1])
            return lambda env, out: out.write(text_of(value(env)))
        if node[0] == "for":
            name, items, body = node[1], closure(node[2]), generated(node[3])

            def loop(env: dict, out: Rendered) -> None:
                for item in items(env) or ():
                    body({**env, name: item}, out)

            return loop
        if node[0] == "generation":
            inner = generated(node[1])

            def marked(env: dict, out: Rendered) -> None:
                start = out.length
                inner(env, out)
                out.spans.append((start, out.length))

            return marked
        arms = [(closure(test), generated(body)) for test, body in node[1]]

        def branch(env: dict, out: Rendered) -> None:
            for test, body in arms:
                if test(env):
                    return body(env, out)
            return None

        return branch

    steps = [one(node) for node in nodes]

    def run(env: dict, out: Rendered) -> None:
        for step in steps:
            step(env, out)

    return run


def compiled(source: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages to (text, generated spans in code points)."""
    body = generated(simplified(parsed(source)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = Rendered()
        body({"messages": messages}, out)
        return "".join(out.parts), out.spans

    return render


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of text formatted by TEMPLATE."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def grouped(turns: DataFrame) -> DataFrame:
    """(conv_id, messages): the turns of each conversation in order of turn,
    ties by role and text. Null roles and texts are empty; a row without an id
    is a conversation of its own. A conversation is one row, as its template
    renders it whole."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0))
    rows = turns.select("conv_id", own.alias("own"), F.struct(F.col("turn").alias("turn"), text("role"), text("text")).alias("m"))
    return rows.groupBy("conv_id", "own").agg(F.sort_array(F.collect_list("m")).alias("messages")).drop("own")


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Per conversation: (conv_id, formatted, spans); spans are code points
    (start, end exclusive) under the loss mask. Repeated turns are kept; empty
    texts are empty turns; texts of any length are kept whole; rows without an
    id are conversations of their own; an empty table gives no rows; other
    columns are not read."""
    compiled(template)  # a bad template fails here, not on an executor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        for batch in batches:
            done = [render(m) for m in batch.column(1).to_pylist()]
            spans = [[{"start": s, "end": e} for s, e in x[1]] for x in done]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in done], pa.string()), pa.array(spans, kind)], ["conv_id", "formatted", "spans"])

    rows = grouped(turns.withColumn("conv_id", F.col("conv_id").cast("long")))
    return rows.mapInArrow(run, "conv_id long, formatted string, spans array<struct<start:int,end:int>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            rows: list[list] = [[] for _ in range(5)]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[x["start"] : x["end"]]) for x in spans)
                for column, value in zip(rows, (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(rows, kinds, strict=True))], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
