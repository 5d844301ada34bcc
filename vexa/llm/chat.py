"""Chat formatting by a template compiler (operator 12).

A template is text with ``{{ expression }}``, ``{% statement %}`` and ``{# comment #}``; a ``-`` inside the braces
trims the blanks beside it.  Statements: ``for x in e``, ``if`` / ``elif`` / ``else``, ``set x = e``, ``generation`` (marks what a
model is to learn) and their ``end...``.  Expressions: strings, integers, true, false, none, names, ``a.b`` and ``a[b]``,
``+``, ``~``, comparisons, ``in``, ``and``, ``or``, ``not``, ``a if b else c``, and ``a | filter`` with the filters of ``FILTERS``.

It is sandboxed: ``.`` and ``[]`` look up keys of mappings and positions of lists and strings, never attributes of Python
objects, and there are no calls.  ``compile_template`` parses the text into a syntax tree, folds constants (operators and
filters of constants, conditions, neighbouring text) and generates one Python closure per node; nothing is
parsed again while conversations are rendered.  Closures write pieces to an output that keeps the code-point spans of
generation blocks.

Control strings in a text are made unrecognisable and can be restored: ``escape`` doubles each backslash and puts one after
the first character of each control string, so that no control string is left in the result, whatever overlaps.

A conversation's rows come in the order of (turn, nulls last; role; md5 of the text), and are rendered by one task as one row.  A
conversation above ``long_turns`` rows or ``long_bytes`` is cut into segments of consecutive turns that different
tasks render: its rows are numbered by range partitions, and the template sees the same ``loop`` variables as in one piece.  This
needs a template that uses ``messages`` only in one outer loop (``Template.by_turn``); another one cannot be cut, and
such conversations raise an error.  The SHA-256 of a conversation is a chain over its bytes, so ``read_back`` reads the segments of a long one in
order in one task, holding one at a time; all else is spread.

Results for odd input.  A null role or text is empty; a null conv_id is a conversation of its own; repeated rows are repeated turns.
An empty table gives an empty result.  A text may be as long as a row may be.  Other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.operators.ordering import global_row_number


class TemplateError(ValueError):
    """The template does not parse, or uses what the sandbox does not offer."""


# --- escaping --------------------------------------------------------------------------------

class Escaper:
    """Reversible escaping of control strings (two characters or more, without a backslash)."""

    def __init__(self, controls: tuple[str, ...]):
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("a control string needs two characters and no backslash")
        self._controls = controls
        starts = "|".join(re.escape(c) for c in sorted(controls, key=len, reverse=True))
        self._find = re.compile(r"\\|(?=" + starts + r").", re.S) if controls else re.compile(r"\\")
        self._back = re.compile(r"\\(.)", re.S)

    def escape(self, text: str) -> str:
        if "\\" not in text and not any(c in text for c in self._controls):
            return text
        return self._find.sub(lambda m: m.group() + "\\", text)

    def unescape(self, text: str) -> str:
        return self._back.sub(r"\1", text) if "\\" in text else text


# --- syntax tree -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


FILTERS: dict[str, Callable] = {
    "trim": lambda v: text_of(v).strip(),
    "upper": lambda v: text_of(v).upper(),
    "lower": lambda v: text_of(v).lower(),
    "capitalize": lambda v: text_of(v).capitalize(),
    "length": lambda v: len(v) if isinstance(v, (str, list, tuple, dict)) else 0,
}


def text_of(v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (str, int)):
        return str(v)
    raise TemplateError(f"a {type(v).__name__} has no text")


def look_up(of, key):
    """A key of a mapping or a position of a list or string; None where there is none."""
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple, str)) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else None
    return None


def _plus(a, b):
    if isinstance(a, int) and isinstance(b, int):
        return a + b
    return text_of(a) + text_of(b)


def _ordered(compare):
    def run(a, b):
        if type(a) is not type(b) or not isinstance(a, (int, str)):
            return False
        return compare(a, b)
    return run


def _contains(a, b):
    return a in b if isinstance(b, (list, tuple, dict)) or (isinstance(b, str) and isinstance(a, str)) else False


BINARY = {
    "+": _plus,
    "~": lambda a, b: text_of(a) + text_of(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _ordered(lambda a, b: a < b),
    "<=": _ordered(lambda a, b: a <= b),
    ">": _ordered(lambda a, b: a > b),
    ">=": _ordered(lambda a, b: a >= b),
    "in": _contains,
    "not in": lambda a, b: not _contains(a, b),
}


# --- parser ----------------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|[<>+~|.\[\]()]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_RESERVED = {"and", "or", "not", "in", "if", "else"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str, filters):
        self.tokens, self.at, self.filters = [], 0, filters
        pos, source = 0, source.strip()
        while pos < len(source):
            m = _TOKEN.match(source, pos)
            if not m:
                raise TemplateError(f"cannot read {source[pos:pos + 20]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            pos = m.end()

    def parse(self):
        node = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        found = self.peek(*values)
        self.at += found
        return found

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"missing {value!r}")

    def choice(self):
        node = self.either()
        if not self.take("if"):
            return node
        test = self.either()
        other = self.choice() if self.take("else") else Const(None)
        return Op("choose", (test, node, other))

    def either(self):
        node = self.both()
        while self.take("or"):
            node = Op("or", (node, self.both()))
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = Op("and", (node, self.negated()))
        return node

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        while True:
            for op in ("==", "!=", "<=", ">=", "<", ">", "in"):
                if self.take(op):
                    node = Op(op, (node, self.joined()))
                    break
            else:
                if not self.take("not"):
                    return node
                self.need("in")
                node = Op("not in", (node, self.joined()))

    def joined(self):
        node = self.piped()
        while self.peek("+", "~"):
            op = self.tokens[self.at][1]
            self.at += 1
            node = Op(op, (node, self.piped()))
        return node

    def piped(self):
        node = self.reached()
        while self.take("|"):
            name = self.word()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            node = Filter(name, node)
        return node

    def word(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def reached(self):
        node = self.atom()
        while True:
            if self.take("."):
                node = Get(node, Const(self.word()))
            elif self.take("["):
                node = Get(node, self.choice())
                self.need("]")
            else:
                return node

    def atom(self):
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m.group(1), m.group(1)), value[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(value))
        if kind == "name" and value not in _RESERVED:
            return Const(_WORDS[value]) if value in _WORDS else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str, filters=FILTERS) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    parts, pos, trim = [], 0, False
    for m in _TAG.finditer(source):
        text = source[pos:m.start()]
        left, right = (m.group(1) or m.group(4) or m.group(7)), (m.group(3) or m.group(6) or m.group(8))
        parts.append(("text", (text.lstrip() if trim else text).rstrip() if left else text.lstrip() if trim else text))
        if m.group(2) is not None:
            parts.append(("emit", m.group(2)))
        elif m.group(5) is not None:
            parts.append(("do", m.group(5).strip()))
        pos, trim = m.end(), bool(right)
    parts.append(("text", source[pos:].lstrip() if trim else source[pos:]))
    at = 0

    def expression(text: str):
        return _Expression(text, filters).parse()

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal at
        out = []
        while at < len(parts):
            kind, body = parts[at]
            at += 1
            if kind == "text":
                out.append(Text(body))
            elif kind == "emit":
                out.append(Emit(expression(body)))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return tuple(out), body
                out.append(statement(word, rest))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(out), ""

    def branches(test):
        then, end = block(("elif", "else", "endif"))
        word, _, rest = end.partition(" ")
        if word == "elif":
            return If(test, then, (branches(expression(rest)),))
        return If(test, then, block(("endif",))[0] if word == "else" else ())

    def statement(word: str, rest: str):
        if word == "if":
            return branches(expression(rest))
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return For(m.group(1), expression(m.group(2)), block(("endfor",))[0])
        if word == "set":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read set {rest!r}")
            return Set(m.group(1), expression(m.group(2)))
        if word == "generation":
            return Generation(block(("endgeneration",))[0])
        raise TemplateError(f"no statement {word!r}")

    return block(())[0]


# --- folding ---------------------------------------------------------------------------------

def fold(node, filters=FILTERS):
    """An expression with its constant parts evaluated."""
    if isinstance(node, Get):
        of, key = fold(node.of, filters), fold(node.key, filters)
        return Const(look_up(of.value, key.value)) if isinstance(of, Const) and isinstance(key, Const) else Get(of, key)
    if isinstance(node, Filter):
        of = fold(node.of, filters)
        return Const(filters[node.name](of.value)) if isinstance(of, Const) else Filter(node.name, of)
    if not isinstance(node, Op):
        return node
    args = tuple(fold(a, filters) for a in node.args)
    first = args[0]
    if node.op == "choose" and isinstance(first, Const):
        return args[1] if first.value else args[2]
    if node.op == "not" and isinstance(first, Const):
        return Const(not first.value)
    if node.op in ("and", "or") and isinstance(first, Const):
        return args[1] if bool(first.value) == (node.op == "and") else first
    if node.op in BINARY and all(isinstance(a, Const) for a in args):
        return Const(BINARY[node.op](args[0].value, args[1].value))
    return Op(node.op, args)


def fold_block(nodes: tuple, filters=FILTERS) -> tuple:
    """Statements with constant expressions as text, decided branches taken and neighbouring text joined."""
    out: list = []

    def add(n) -> None:
        if isinstance(n, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + n.text)
        elif not isinstance(n, Text) or n.text:
            out.append(n)

    for n in nodes:
        if isinstance(n, Emit):
            e = fold(n.value, filters)
            add(Text(text_of(e.value)) if isinstance(e, Const) else Emit(e))
        elif isinstance(n, Set):
            add(Set(n.name, fold(n.value, filters)))
        elif isinstance(n, If):
            test, then, other = fold(n.test, filters), fold_block(n.then, filters), fold_block(n.other, filters)
            if isinstance(test, Const):
                for m in then if test.value else other:
                    add(m)
            else:
                add(If(test, then, other))
        elif isinstance(n, For):
            add(For(n.name, fold(n.over, filters), fold_block(n.body, filters)))
        elif isinstance(n, Generation):
            add(Generation(fold_block(n.body, filters)))
        else:
            add(n)
    return tuple(out)


# --- closures --------------------------------------------------------------------------------

@dataclass
class Output:
    """Rendered pieces and the code-point spans of generation blocks; touching spans stay apart."""

    parts: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    depth: int = 0

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def value_of(node, filters) -> Callable[[dict], object]:
    """A closure (variables) -> value."""
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Get):
        of, key = value_of(node.of, filters), value_of(node.key, filters)
        return lambda env: look_up(of(env), key(env))
    if isinstance(node, Filter):
        of, apply = value_of(node.of, filters), filters[node.name]
        return lambda env: apply(of(env))
    args = [value_of(a, filters) for a in node.args]
    if node.op == "choose":
        test, then, other = args
        return lambda env: then(env) if test(env) else other(env)
    if node.op == "not":
        return lambda env: not args[0](env)
    a, b = args
    if node.op == "and":
        return lambda env: a(env) and b(env)
    if node.op == "or":
        return lambda env: a(env) or b(env)
    op = BINARY[node.op]
    return lambda env: op(a(env), b(env))


def writer_of(nodes: tuple, filters) -> Callable[[dict, Output], None]:
    """A closure (variables, output) that renders a block."""
    steps = [_writer(n, filters) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env: dict, out: Output) -> None:
        for s in steps:
            s(env, out)
    return run


def loop_variables(index: int, total: int) -> dict:
    return {"index": index + 1, "index0": index, "first": index == 0, "last": index == total - 1, "length": total}


def _writer(node, filters) -> Callable[[dict, Output], None]:
    if isinstance(node, Text):
        text = node.text
        return lambda env, out: out.write(text)
    if isinstance(node, Emit):
        value = value_of(node.value, filters)
        return lambda env, out: out.write(text_of(value(env)))
    if isinstance(node, Set):
        name, value = node.name, value_of(node.value, filters)

        def assign(env: dict, out: Output) -> None:
            env[name] = value(env)
        return assign
    if isinstance(node, If):
        test, then, other = value_of(node.test, filters), writer_of(node.then, filters), writer_of(node.other, filters)
        return lambda env, out: then(env, out) if test(env) else other(env, out)
    if isinstance(node, For):
        over, turn = value_of(node.over, filters), turn_writer(node, filters)

        def loop(env: dict, out: Output) -> None:
            items = over(env)
            items = list(items) if isinstance(items, (list, tuple, dict, str)) else []
            for i, item in enumerate(items):
                turn(env, out, item, i, len(items))
        return loop
    body = writer_of(node.body, filters)

    def generation(env: dict, out: Output) -> None:
        start, out.depth = out.size, out.depth + 1
        body(env, out)
        out.depth -= 1
        if not out.depth:  # an inner block is part of the outer one
            out.spans.append((start, out.size))
    return generation


def turn_writer(node: For, filters):
    """A closure for one round of a loop; what it sets is forgotten after the round."""
    name, body = node.name, writer_of(node.body, filters)

    def turn(env: dict, out: Output, item, index: int, total: int) -> None:
        body({**env, name: item, "loop": loop_variables(index, total)}, out)
    return turn


def _uses(node, name: str) -> bool:
    """Whether a node or anything below it reads a variable."""
    if isinstance(node, Name):
        return node.name == name
    if isinstance(node, tuple):
        return any(_uses(n, name) for n in node)
    return any(_uses(v, name) for v in vars(node).values()) if hasattr(node, "__dataclass_fields__") else False


@dataclass
class Template:
    """A compiled template.  ``by_turn`` tells whether a conversation can be rendered in segments."""

    tree: tuple
    filters: dict

    def __post_init__(self):
        outer = [i for i, n in enumerate(self.tree) if isinstance(n, For) and n.over == Name("messages")]
        i = outer[0] if len(outer) == 1 else len(self.tree)
        around = self.tree[:i] + self.tree[i + 1:]
        sets = any(isinstance(n, Set) for n in self.tree)
        self.by_turn = len(outer) == 1 and not sets and not _uses(around, "messages") and not _uses(self.tree[i].body, "messages")
        self._whole = writer_of(self.tree, self.filters)
        if self.by_turn:
            self._before, self._after = writer_of(self.tree[:i], self.filters), writer_of(self.tree[i + 1:], self.filters)
            self._turn = turn_writer(self.tree[i], self.filters)

    def render(self, messages: list[dict], **variables) -> Output:
        out = Output()
        self._whole({**variables, "messages": messages}, out)
        return out

    def render_segment(self, messages: list[dict], start: int, total: int, **variables) -> Output:
        """Turns ``start`` and following of a conversation of ``total`` turns."""
        if not self.by_turn:
            raise TemplateError("the template needs whole conversations")
        out = Output()
        if start == 0:
            self._before(variables, out)
        for i, m in enumerate(messages, start):
            self._turn(variables, out, m, i, total)
        if start + len(messages) == total:
            self._after(variables, out)
        return out


def compile_template(source: str, controls: tuple[str, ...] = ()) -> Template:
    """Parse, fold and generate closures; ``escape`` becomes a filter that protects ``controls``."""
    filters = dict(FILTERS, escape=lambda v, e=Escaper(controls).escape: e(text_of(v)))
    return Template(fold_block(parse(source, filters), filters), filters)


# --- the default format ------------------------------------------------------------------------

#: Role header, text and end mark of a turn; assistant texts are to be learnt.
TEMPLATE = """{%- for m in messages -%}
### {{ m.role | escape }}:<text>
{%- if m.role == 'assistant' -%}
{% generation %}{{ m.text | escape }}{% endgeneration %}
{%- else -%}
{{ m.text | escape }}
{%- endif -%}
{{ '</turn>\\n' }}
{%- endfor -%}"""
CONTROLS = ("### ", ":<text>", "</turn>")


class Reader:
    """Reads formatted text of ``TEMPLATE`` back into turns.

    Escaped text holds no control string, and none of ``CONTROLS`` begins as it ends, so the next one found is a mark."""

    def __init__(self):
        self._head, self._text, self._end = CONTROLS
        self.unescape = Escaper(CONTROLS).unescape

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(formatted):
            text = formatted.find(self._text, at)
            end = formatted.find(self._end + "\n", text)
            if text < 0 or end < 0 or not formatted.startswith(self._head, at):
                raise ValueError(f"no turn at position {at}")
            yield self.unescape(formatted[at + len(self._head):text]), self.unescape(formatted[text + len(self._text):end])
            at = end + len(self._end) + 1


# --- Spark ------------------------------------------------------------------------------------

FORMATTED = "conv_id long, segment long, segments long, n_turns long, formatted string, loss array<struct<start: int, end: int>>"
SALTS = 32


def _plain(conversations: DataFrame) -> DataFrame:
    def text(c):
        return F.coalesce(F.col(c), F.lit("")).alias(c)

    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                text("role"), text("text"))


def _order():
    """A total order of the rows up to equal ones; digests keep long texts out of the keys."""
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(),
            F.md5(F.col("role").cast("binary")).asc(), F.md5(F.col("text").cast("binary")).asc()]


def _with(rows: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """Add columns known per conversation.  The key is salted: one conversation may hold any share of the rows."""
    salted = facts.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salt = F.pmod(F.xxhash64("turn", "text"), F.lit(SALTS)).cast("int")
    match = "r.conv_id <=> f.conv_id AND r.salt = f.salt"
    return (rows.withColumn("salt", salt).alias("r").join(salted.alias("f"), F.expr(match), how)
            .select("r.*", *[f"f.{c}" for c in facts.columns if c != "conv_id"]).drop("salt"))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Consecutive rows with equal keys, as dictionaries; nulls are equal."""
    held, last = [], None
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            for row in b.slice(lo, 256).to_pylist():
                key = tuple(row[k] for k in keys)
                if held and key != last:
                    yield held
                    held = []
                held.append(row)
                last = key
    if held:
        yield held


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    spans = pa.array([[{"start": a, "end": z} for a, z in s] for s in cols[5]],
                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), spans],
                                      ["conv_id", "segment", "segments", "n_turns", "formatted", "loss"])


def format_conversations(conversations: DataFrame, source: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS,
                         long_turns: int = 16_384, long_bytes: int = 16 << 20, segment_turns: int = 1024) -> DataFrame:
    """One row per conversation, or per segment of a long one, with the columns of ``FORMATTED``; ``loss`` holds the spans
    [start, end) of the formatted text, in code points, that a model is to learn."""
    template = compile_template(source, controls)  # errors show here, not in a task
    rows = _plain(conversations)
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sum(F.octet_length("text")).alias("bytes"))
    long = C.save(sizes.filter((F.col("n_turns") > long_turns) | (F.col("bytes") > long_bytes))
                  .select("conv_id", F.lit(True).alias("long")), "chat-long")
    any_long = long.limit(1).count() > 0
    if any_long:
        if not template.by_turn:
            raise TemplateError("some conversations are too long for one task, and the template needs whole ones")
        flagged = _with(rows, long, "left")
        rows = flagged.filter("long IS NULL").drop("long")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat = compile_template(source, controls)
        out, size = [], 0
        for messages in _runs(batches, ["conv_id"]):
            done = chat.render(messages)
            out.append((messages[0]["conv_id"], 0, 1, len(messages), "".join(done.parts), done.spans))
            size += done.size
            if size > C.BLOCK_BYTES:
                yield _batch(out)
                out, size = [], 0
        yield _batch(out)

    result = rows.repartition("conv_id").sortWithinPartitions(*_order()).mapInArrow(render, FORMATTED)
    if not any_long:
        return result

    tied = flagged.filter("long").drop("long").withColumn("tie", F.monotonically_increasing_id())
    numbered = global_row_number(tied, [*_order(), F.col("tie").asc()], "rn")
    placed = _with(numbered, numbered.groupBy("conv_id").agg(F.min("rn").alias("rn0"), F.count(F.lit(1)).alias("n_turns")), "inner")
    placed = placed.withColumn("index", F.col("rn") - F.col("rn0")).withColumn("segment", F.floor(F.col("index") / segment_turns).cast("long"))

    def render_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat = compile_template(source, controls)
        for messages in _runs(batches, ["conv_id", "segment"]):
            m = messages[0]
            done = chat.render_segment(messages, m["index"], m["n_turns"])
            yield _batch([(m["conv_id"], m["segment"], -(-m["n_turns"] // segment_turns), m["n_turns"], "".join(done.parts), done.spans)])

    parts = (placed.select("conv_id", "segment", "index", "n_turns", "role", "text").repartition("conv_id", "segment")
             .sortWithinPartitions("conv_id", "segment", "index"))
    return result.unionByName(parts.mapInArrow(render_segment, FORMATTED))


REPORT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose segments come one after the other, one segment held at a time."""
    reader = Reader()
    for b in batches:
        out = []
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            if row["segment"] == 0:
                turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            for role, text in reader.turns(row["formatted"]):
                turns.update(f"{role}\n{text}\n".encode())
                counts[0] += 1
            for span in row["loss"]:
                learnt = reader.unescape(row["formatted"][span["start"]:span["end"]])
                loss.update(learnt.encode())
                counts[1] += len(learnt)
            counts[2] += len(row["formatted"])
            if row["segment"] == row["segments"] - 1:
                if counts[0] != row["n_turns"]:
                    raise ValueError(f"conversation {row['conv_id']}: {counts[0]} turns read of {row['n_turns']}")
                out.append((row["conv_id"], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
        cols = list(zip(*out)) if out else [[]] * 6
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from text of the default template: its turns and the text under the loss mask, as counts and digests."""
    ordered = (formatted.filter("segments > 1").repartition("conv_id").sortWithinPartitions("conv_id", "segment"))
    return formatted.filter("segments = 1").mapInArrow(_read, REPORT).unionByName(ordered.mapInArrow(_read, REPORT))
