"""Chat formatting: a small sandboxed template language, compiled to Python closures, over Spark-grouped conversations."""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.llm.shipping import ship_package

# -- template language ----------------------------------------------------------------------------------------------
#
# {{ expression }}, {% for name in expression %} ... {% endfor %}, {% if %} ... {% else %} ... {% endif %},
# {% generation %} ... {% endgeneration %}. Expressions: 'text', name, name.field, ==, !=, and, or, not, brackets and
# | filter. Fields are looked up in dicts only and filters in a fixed table, so a template reaches nothing else.

TOKEN = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
LEXEME = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*')|([A-Za-z_]\w*)|(==|!=|[().|]))")

Piece = tuple[str, bool]  # text, under the generation marker
Scope = dict[str, object]


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Literal:
    value: object


@dataclass(frozen=True)
class Path:
    name: str
    fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Op:
    """An operator or a filter applied to expressions."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Loop:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Branch:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def escape(text: str) -> str:
    """Control strings all hold a '<', which never stays in an escaped text."""
    return text.replace("&", "&amp;").replace("<", "&lt;")


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "&nl;")


def unescape(text: str) -> str:
    return text.replace("&nl;", "\n").replace("&lt;", "<").replace("&amp;", "&")


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_line": escape_line}
OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
}


class _Expression:
    """Recursive descent over the lexemes of one expression."""

    def __init__(self, source: str) -> None:
        self.lexemes: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            found = LEXEME.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            text, name, sign = found.groups()
            self.lexemes.append(("text", text) if text else ("name", name) if name else ("sign", sign))
            at = found.end()
        self.at = 0

    def take(self, *values: str) -> str | None:
        if self.at < len(self.lexemes) and self.lexemes[self.at][1] in values and self.lexemes[self.at][0] != "text":
            self.at += 1
            return self.lexemes[self.at - 1][1]
        return None

    def whole(self):
        value = self.either()
        if self.at != len(self.lexemes):
            raise TemplateError(f"unexpected {self.lexemes[self.at][1]!r}")
        return value

    def either(self):
        value = self.both()
        while self.take("or"):
            value = Op("or", (value, self.both()))
        return value

    def both(self):
        value = self.negation()
        while self.take("and"):
            value = Op("and", (value, self.negation()))
        return value

    def negation(self):
        return Op("not", (self.negation(),)) if self.take("not") else self.equality()

    def equality(self):
        value = self.filtered()
        while sign := self.take("==", "!="):
            value = Op(sign, (value, self.filtered()))
        return value

    def filtered(self):
        value = self.atom()
        while self.take("|"):
            kind, name = self.next()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            value = Op(name, (value,))
        return value

    def next(self) -> tuple[str, str]:
        if self.at == len(self.lexemes):
            raise TemplateError("expression ends early")
        self.at += 1
        return self.lexemes[self.at - 1]

    def atom(self):
        kind, value = self.next()
        if kind == "text":
            plain = value[1:-1].replace("\\n", "\n")
            return Literal(re.sub(r"\\(.)", r"\1", plain))
        if value == "(":
            inner = self.either()
            if not self.take(")"):
                raise TemplateError("bracket is not closed")
            return inner
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        fields = []
        while self.take("."):
            kind, field = self.next()
            if kind != "name" or field.startswith("_"):
                raise TemplateError(f"bad field {field!r}")
            fields.append(field)
        return Path(value, tuple(fields))


def parse_template(source: str) -> tuple:
    """The syntax tree of a template."""
    tokens: list[tuple[str, str]] = []
    at = 0
    for found in TOKEN.finditer(source):
        tokens.append(("text", source[at : found.start()]))
        tokens.append(("output", found[1]) if found[1] is not None else ("tag", found[2].strip()))
        at = found.end()
    tokens.append(("text", source[at:]))
    position = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal position
        nodes: list = []
        while position < len(tokens):
            kind, value = tokens[position]
            position += 1
            if kind == "text":
                nodes.append(Output(Literal(value)))
            elif kind == "output":
                nodes.append(Output(_Expression(value).whole()))
            elif value in ends:
                return tuple(nodes), value
            elif value == "generation":
                nodes.append(Generation(block(("endgeneration",))[0]))
            elif loop := re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", value, re.S):
                over = _Expression(loop[2]).whole()
                nodes.append(Loop(loop[1], over, block(("endfor",))[0]))
            elif value.startswith("if "):
                test = _Expression(value[3:]).whole()
                then, end = block(("else", "endif"))
                nodes.append(Branch(test, then, block(("endif",))[0] if end == "else" else ()))
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), ""

    return block(())[0]


def fold(node):
    """The same tree with constant parts worked out: expressions, branches, and runs of text joined."""
    if isinstance(node, Op):
        args = tuple(fold(arg) for arg in node.args)
        if all(isinstance(arg, Literal) for arg in args):
            apply = OPERATORS.get(node.name) or FILTERS[node.name]
            return Literal(apply(*[arg.value for arg in args]))
        return Op(node.name, args)
    if isinstance(node, Output):
        return Output(fold(node.value))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Branch):
        return Branch(fold(node.test), fold(node.then), fold(node.other))
    if not isinstance(node, tuple):
        return node
    flat: list = []
    for child in map(fold, node):
        known = isinstance(child, Branch) and isinstance(child.test, Literal)
        flat.extend((child.then if child.test.value else child.other) if known else (child,))
    joined: list = []
    for child in flat:
        constant = isinstance(child, Output) and isinstance(child.value, Literal)
        if constant and joined and isinstance(joined[-1], Output) and isinstance(joined[-1].value, Literal):
            joined[-1] = Output(Literal(joined[-1].value.value + child.value.value))
        elif not constant or child.value.value:
            joined.append(child)
    return tuple(joined)


def _expression(node) -> Callable[[Scope], object]:
    if isinstance(node, Literal):
        return lambda scope, value=node.value: value
    if isinstance(node, Path):

        def look(scope: Scope):
            value = scope[node.name]
            for field in node.fields:
                if not isinstance(value, dict):
                    raise TemplateError(f"{node.name} has no field {field!r}")
                value = value[field]
            return value

        return look
    args = [_expression(arg) for arg in node.args]
    if node.name in ("and", "or"):
        first, second = args
        if node.name == "and":
            return lambda scope: first(scope) and second(scope)
        return lambda scope: first(scope) or second(scope)
    apply = OPERATORS.get(node.name) or FILTERS[node.name]
    if len(args) == 1:
        only = args[0]
        return lambda scope: apply(only(scope))
    left, right = args
    return lambda scope: apply(left(scope), right(scope))


def _statement(node, marked: bool) -> Callable[[Scope], Iterator[Piece]]:
    if isinstance(node, tuple):
        parts = [_statement(child, marked) for child in node]

        def sequence(scope: Scope) -> Iterator[Piece]:
            for part in parts:
                yield from part(scope)

        return sequence
    if isinstance(node, Output):
        value = _expression(node.value)

        def output(scope: Scope) -> Iterator[Piece]:
            yield str(value(scope)), marked

        return output
    if isinstance(node, Generation):
        return _statement(node.body, True)
    if isinstance(node, Branch):
        test, then, other = _expression(node.test), _statement(node.then, marked), _statement(node.other, marked)
        return lambda scope: then(scope) if test(scope) else other(scope)
    over, body = _expression(node.over), _statement(node.body, marked)

    def loop(scope: Scope) -> Iterator[Piece]:
        for item in over(scope):
            yield from body({**scope, node.name: item})

    return loop


@functools.lru_cache(maxsize=16)
def compile_template(source: str) -> Callable[[Scope], Iterator[Piece]]:
    """Closures that render a scope as (text, under the generation marker) pieces, lazily: turns may be an iterator."""
    return _statement(fold(parse_template(source)), False)


# -- conversations --------------------------------------------------------------------------------------------------

BEGIN, TURN, END = "<|begin|>", "<|turn|>", "<|end|>\n"
TEMPLATE = (
    "<|begin|>{% for turn in turns %}<|turn|>{{ turn.role | escape_line }}{{ '\\n' }}"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}<|end|>{{ '\\n' }}{% endfor %}"
)
PART_CHARS = 1 << 20

FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ]
)
FORMATTED_SQL = "conv_id long, part long, text string, loss array<struct<begin: long, end: long>>"
SUMMARY = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
SUMMARY_SQL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            yield from batch.slice(begin, 500).to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row.get("text") or "")
        if len(held) >= 500 or chars >= 4 * PART_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, chars = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=schema)


def render(source: str, conv_id: int | None, turns: Iterable[dict]) -> Iterator[dict]:
    """Formatted parts of one conversation with the loss ranges of each part; a long one is never held whole."""
    texts, loss, length, part = [], [], 0, 0
    for text, marked in compile_template(source)({"turns": turns}):
        if marked and text:
            loss.append({"begin": length, "end": length + len(text)})
        texts.append(text)
        length += len(text)
        if length >= PART_CHARS:
            yield {"conv_id": conv_id, "part": part, "text": "".join(texts), "loss": loss}
            texts, loss, length, part = [], [], 0, part + 1
    if length or not part:
        yield {"conv_id": conv_id, "part": part, "text": "".join(texts), "loss": loss}


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, text, loss: the formatted text of each conversation, cut into parts when it is long.

    Rows are ordered by turn (null turns last), then role and text. Null role or text is empty; rows without conv_id form
    one conversation; repeated rows are turns of their own. An empty table gives an empty result; other columns are not
    read. A conversation is one sequence and streams through one task in bounded memory: rows are sorted, not gathered.
    """
    ship_package(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_last("turn"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_conversation = itertools.groupby(_stream(batches), key=lambda row: row["conv_id"])
        parts = (part for conv_id, turns in by_conversation for part in render(template, conv_id, turns))
        yield from _batched(parts, FORMATTED)

    return ordered.mapInArrow(run, FORMATTED_SQL)


def read_back(conv_id: int | None, parts: Iterable[dict]) -> dict:
    """Digests of a conversation, from its formatted parts alone. Only the unfinished turn is held."""
    turns, loss = hashlib.sha256(), hashlib.sha256()
    n_turns = loss_chars = formatted = 0
    rest, at_begin = "", True

    def marked(text: str) -> None:
        nonlocal loss_chars
        plain = unescape(text)
        loss_chars += len(plain)
        loss.update(plain.encode("utf-8", "surrogatepass"))

    for part in parts:
        text = part["text"]
        formatted += len(text)
        for span in part["loss"]:
            marked(text[span["begin"] : span["end"]])
        rest += text
        at = 0
        if at_begin:
            if not rest.startswith(BEGIN):
                raise ValueError(f"conversation {conv_id} does not begin with {BEGIN}")
            at, at_begin = len(BEGIN), False
        while (end := rest.find(END, at)) >= 0:
            if not rest.startswith(TURN, at):
                raise ValueError(f"conversation {conv_id} has text between turns")
            role, _, body = rest[at + len(TURN) : end].partition("\n")
            turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
            n_turns += 1
            at = end + len(END)
        rest = rest[at:]
    if rest:
        raise ValueError(f"conversation {conv_id} ends inside a turn")
    return {
        "conv_id": conv_id,
        "n_turns": n_turns,
        "turns_sha256": turns.hexdigest(),
        "loss_chars": loss_chars,
        "loss_sha256": loss.hexdigest(),
        "formatted_chars": formatted,
    }


def summarise(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``format_conversations``, whose partitions and order it keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_conversation = itertools.groupby(_stream(batches), key=lambda row: row["conv_id"])
        yield from _batched((read_back(conv_id, parts) for conv_id, parts in by_conversation), SUMMARY)

    return formatted.mapInArrow(run, SUMMARY_SQL)
