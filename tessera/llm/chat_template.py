"""Chat formatting with compiled templates.

A small, sandboxed template language: text, ``{{ expression }}``, ``{% if %} / {% elif %} /
{% else %} / {% endif %}``, ``{% for x in expression %} / {% endfor %}``, ``{% set x = expression %}``,
``{# comments #}`` and ``{% generation %} / {% endgeneration %}``, which marks what the model is to
generate. A ``-`` inside a tag's braces takes away the white space on its side. Expressions have
strings, integers, ``true``, ``false``, ``none``, names, ``a.b`` and ``a['b']`` on mappings, ``a[0]``,
``a[1:]`` on lists and strings, ``loop.first``, ``loop.last``, ``loop.index``, ``loop.index0`` and
``loop.length``, ``not``, ``and``, ``or``, ``== != < <= > >=``, ``in``, ``not in``, ``is [not] defined`` (or none,
string, number, mapping, true, false), ``x if y else z``, ``+ - * ~ %``, parentheses and filters
(``x | trim``). Nothing else can be reached: no calls, no attributes of Python objects, no
assignment outside the template's own names; whatever else a template holds is an error when it is
compiled.

A template is parsed into a syntax tree of tuples, constants are folded (expressions, filters and
branches of constants, and runs of text), and the tree becomes nested Python closures that append
to a list of pieces. Rendering returns the text and the character ranges of the generation blocks.

Control strings inside texts are escaped reversibly: each ``<`` that a run of backslashes (or
nothing) and a ``|`` follow gets one more backslash, so an escaped text never holds ``<|``.

Results in special cases: null texts and null roles are empty; turns sort by turn (null first),
role and text, so ties and repeated rows have an order; rows with a null conversation id are one
conversation; an empty table gives no conversations; a template error raises at compile time;
further columns are ignored. Texts may be of any length, but a conversation becomes one text and so one
row: all its turns must fit a task, and 2 GB.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import in_slices, small_batches

#: Turns between control strings; role and text escaped; the text of assistant turns is generated.
CHATML = (
    "{% for m in messages %}{{ '<|im_start|>' + (m.role | escape | one_line) + '\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>\n' }}{% endfor %}"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def one_line(text: str) -> str:
    return text.replace("%", "%25").replace("\n", "%0A")


def any_lines(text: str) -> str:
    return text.replace("%0A", "\n").replace("%25", "%")


FILTERS: dict[str, Callable[[Any], Any]] = {"trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len, "escape": escape, "one_line": one_line}


class _Undefined:
    """What a name that the template never set is."""

    def __bool__(self) -> bool:
        return False


UNDEFINED = _Undefined()
TESTS: dict[str, Callable[[Any], bool]] = {
    "defined": lambda x: x is not UNDEFINED, "undefined": lambda x: x is UNDEFINED, "none": lambda x: x is None, "true": lambda x: x is True, "false": lambda x: x is False,
    "string": lambda x: isinstance(x, str), "number": lambda x: isinstance(x, int) and not isinstance(x, bool), "mapping": lambda x: isinstance(x, dict),
}
LOOP = ("first", "last", "index", "index0", "length")

_STRING = r"'(?:[^'\\]|\\.)*+'|\"(?:[^\"\\]|\\.)*+\""
_OPEN = re.compile(r"\{(?P<kind>[{%#])(?P<left>-?)")
_INSIDE = {k: re.compile(rf"(?P<body>(?:{_STRING}|(?!-?{end})[^'\"])*+)(?P<right>-?){end}", re.S) for k, end in (("{", r"\}\}"), ("%", r"%\}"))} | {"#": re.compile(r"(?P<body>.*?)(?P<right>-?)#\}", re.S)}
_TOKEN = re.compile(rf"\s*(?:(?P<str>{_STRING})|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[().\[\]+|<>:~*%-]))", re.S)
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_KEYWORDS = ("and", "or", "not", "in", "is", "if", "else")
_COMPARE: dict[str, Callable[[Any, Any], bool]] = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


class TemplateError(ValueError):
    pass


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") else None

    def take(self, *values: str) -> bool:
        if self.peek() in values:
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def whole(self) -> tuple:
        node = self.chosen()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def chosen(self) -> tuple:
        node = self.either()
        if self.take("if"):
            test = self.either()
            other = self.chosen() if self.take("else") else ("const", "")
            return ("choose", test, node, other)
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def name(self, known: Iterable[str], what: str) -> str:
        """The next token, which must be one of these names."""
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        if kind != "name" or value not in known:
            raise TemplateError(f"unknown {what} {value!r}")
        self.at += 1
        return value

    def compared(self) -> tuple:
        node = self.summed()
        if self.take("is"):
            negated = self.take("not")
            node = ("test", self.name(TESTS, "test"), node)
            return ("not", node) if negated else node
        if self.take("not"):
            self.need("in")
            return ("not", ("in", node, self.summed()))
        for op in (*_COMPARE, "in"):
            if self.take(op):
                return (op, node, self.summed())
        return node

    def summed(self) -> tuple:
        node = self.multiplied()
        while (op := self.peek()) in ("+", "-", "~"):
            self.at += 1
            node = (op, node, self.multiplied())
        return node

    def multiplied(self) -> tuple:
        node = self.filtered()
        while (op := self.peek()) in ("*", "%"):
            self.at += 1
            node = (op, node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.reached()
        while self.take("|"):
            node = ("filter", self.name(FILTERS, "filter"), node)
        return node

    def reached(self) -> tuple:
        node = self.single()
        while True:
            if self.take("."):
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError("a name expected after '.'")
                if node == ("name", "loop"):
                    self.name(LOOP, "part of loop")
                else:
                    self.at += 1
                node = ("get", node, ("const", name))
            elif self.take("["):
                bounds = [None if self.peek() in (":", "]") else self.chosen()]
                while self.take(":"):
                    bounds.append(None if self.peek() in (":", "]") else self.chosen())
                self.need("]")
                if len(bounds) > 3 or bounds == [None]:
                    raise TemplateError("an index or a slice expected")
                none = ("const", None)
                node = ("get", node, bounds[0]) if len(bounds) == 1 else ("slice", node, *(x or none for x in [*bounds, None][:3]))
            elif self.peek() == "(":
                raise TemplateError("calls are not part of the language")
            else:
                return node

    def single(self) -> tuple:
        if self.take("("):
            node = self.chosen()
            self.need(")")
            return node
        if self.take("-"):
            return ("-", ("const", 0), self.reached())
        if self.at >= len(self.tokens):
            raise TemplateError("an expression expected")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(value))
        if kind == "name" and value not in _KEYWORDS:
            return ("const", _WORDS[value]) if value in _WORDS else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def _events(source: str) -> list[tuple[str, str]]:
    """Text, expressions and statements in their order; comments are gone, white space is taken away where a tag says so."""
    events, at, strip = [], 0, False
    while m := _OPEN.search(source, at):
        inside = _INSIDE[m["kind"]].match(source, m.end())
        if not inside:
            raise TemplateError(f"the tag at character {m.start()} does not end")
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        events.append(("text", text.rstrip() if m["left"] else text))
        if m["kind"] != "#":
            events.append(("expr" if m["kind"] == "{" else "stmt", inside["body"].strip()))
        at, strip = inside.end(), bool(inside["right"])
    events.append(("text", source[at:].lstrip() if strip else source[at:]))
    return [e for e in events if e[0] != "text" or e[1]]


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    events = _events(source)
    events.reverse()

    def block(*ends: str) -> tuple[tuple, str]:
        nodes = []
        while events:
            kind, value = events.pop()
            if kind == "text":
                nodes.append(("out", ("const", value)))
            elif kind == "expr":
                nodes.append(("out", _Expression(value).whole()))
            else:
                word = re.match(r"\w*", value)[0]
                rest = value[len(word) :].strip()
                if word in ends:
                    if rest and word != "elif":
                        raise TemplateError(f"unexpected {rest!r}")
                    return ("block", *nodes), value
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return ("block", *nodes), ""

    def statement(word: str, rest: str) -> tuple:
        if word == "if":
            test = _Expression(rest).whole()
            body, end = block("elif", "else", "endif")
            if end.startswith("elif"):
                return ("if", test, body, statement("if", end[4:].strip()))
            other = block("endif")[0] if end == "else" else ("block",)
            return ("if", test, body, other)
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m or m[1] == "loop":
                raise TemplateError(f"cannot read 'for {rest}'")
            return ("for", m[1], _Expression(m[2]).whole(), block("endfor")[0])
        if word == "set":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.S)
            if not m or m[1] == "loop":
                raise TemplateError(f"cannot read 'set {rest}'")
            return ("set", m[1], _Expression(m[2]).whole())
        if word == "generation" and not rest:
            return ("generation", block("endgeneration")[0])
        raise TemplateError(f"unknown statement {word!r}")

    return block()[0]


def fold(node: tuple) -> tuple:
    """The tree with what is constant worked out."""
    kind = node[0]
    if kind == "block":
        out: list[tuple] = []
        for child in map(fold, node[1:]):
            for c in child[1:] if child[0] == "block" else (child,):
                text = lambda x: x[0] == "out" and x[1][0] == "const"
                if text(c) and out and text(out[-1]):
                    out[-1] = ("out", ("const", _text(out[-1][1][1]) + _text(c[1][1])))
                else:
                    out.append(c)
        return ("block", *out)
    if kind in ("const", "name"):
        return node
    node = (kind, *(fold(x) if isinstance(x, tuple) else x for x in node[1:]))
    if kind == "if":
        return node if node[1][0] != "const" else node[2] if node[1][1] else node[3]
    if kind in ("and", "or") and node[1][0] == "const":
        return node[2] if bool(node[1][1]) == (kind == "and") else node[1]
    if kind == "choose" and node[1][0] == "const":
        return node[2] if node[1][1] else node[3]
    if kind in ("not", "in", "+", "-", "*", "%", "~", "filter", "test", "slice", *_COMPARE) and all(x[0] == "const" for x in node[1:] if isinstance(x, tuple)):
        return ("const", _value(node)({}))
    return node


def _text(value: Any) -> str:
    return "" if value is None or value is UNDEFINED else value if isinstance(value, str) else str(value)


def _get(of: Any, key: Any) -> Any:
    """An entry of a mapping, or of a list or string by number; nothing else has any."""
    if isinstance(of, dict):
        return of.get(key, UNDEFINED)
    if isinstance(of, (list, str)) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else UNDEFINED
    return UNDEFINED


def _number(x: Any) -> bool:
    return isinstance(x, int) and not isinstance(x, bool)


def _compare(op: str, x: Any, y: Any) -> bool:
    """Numbers and texts are in order among themselves; nothing else is before or after anything."""
    if op in ("==", "!=") or (_number(x) and _number(y)) or (isinstance(x, str) and isinstance(y, str)):
        return _COMPARE[op](x, y)
    return False


def _calculate(op: str, x: Any, y: Any) -> Any:
    """Of numbers; ``+`` and ``~`` join what else there is as text, and other signs give nothing."""
    if op == "~" or not (_number(x) and _number(y)):
        return _text(x) + _text(y) if op in "+~" else UNDEFINED
    if op == "%":
        return x % y if y else UNDEFINED
    return x + y if op == "+" else x - y if op == "-" else x * y


def _slice(of: Any, bounds: list[Any]) -> Any:
    if not isinstance(of, (list, str)) or bounds[2] == 0 or not all(x is None or _number(x) for x in bounds):
        return UNDEFINED
    return of[slice(*bounds)]


def _value(node: tuple) -> Callable[[dict], Any]:
    """The closure of an expression, from the template's names to its value."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda names: value
    if kind == "name":
        name = node[1]
        return lambda names: names.get(name, UNDEFINED)
    if kind == "filter":
        f, of = FILTERS[node[1]], _value(node[2])
        if node[1] == "length":
            return lambda names: len(x) if isinstance(x := of(names), (list, dict)) else len(_text(x))
        return lambda names: f(_text(of(names)))
    if kind == "test":
        f, of = TESTS[node[1]], _value(node[2])
        return lambda names: f(of(names))
    if kind in ("slice", "choose"):
        of, *parts = map(_value, node[1:])
        if kind == "slice":
            return lambda names: _slice(of(names), [x(names) for x in parts])
        yes, no = parts
        return lambda names: yes(names) if of(names) else no(names)
    a = _value(node[1])
    if kind == "not":
        return lambda names: not a(names)
    b = _value(node[2])
    if kind == "get":
        return lambda names: _get(a(names), b(names))
    if kind == "and":
        return lambda names: a(names) and b(names)
    if kind == "or":
        return lambda names: a(names) or b(names)
    if kind in _COMPARE:
        return lambda names: _compare(kind, a(names), b(names))
    if kind == "in":

        def within(names: dict) -> bool:
            x, y = a(names), b(names)
            return x in y if isinstance(y, (list, dict)) or (isinstance(x, str) and isinstance(y, str)) else False

        return within
    if kind in ("+", "-", "*", "%", "~"):
        return lambda names: _calculate(kind, a(names), b(names))
    raise TemplateError(f"no expression: {kind}")


class _Out:
    """Pieces of the text so far, its length, and the ranges to generate."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _run(node: tuple) -> Callable[[dict, _Out], None]:
    """The closure of a statement."""
    kind = node[0]
    if kind == "block":
        steps = [_run(x) for x in node[1:]]
        if len(steps) == 1:
            return steps[0]

        def block(names: dict, out: _Out) -> None:
            for step in steps:
                step(names, out)

        return block
    if kind == "out":
        if node[1][0] == "const":
            text = _text(node[1][1])
            return lambda names, out: out.add(text)
        value = _value(node[1])
        return lambda names, out: out.add(_text(value(names)))
    if kind == "if":
        test, yes, no = _value(node[1]), _run(node[2]), _run(node[3])
        return lambda names, out: yes(names, out) if test(names) else no(names, out)
    if kind == "set":
        name, value = node[1], _value(node[2])

        def assign(names: dict, out: _Out) -> None:
            names[name] = value(names)

        return assign
    if kind == "for":
        name, value, body = node[1], _value(node[2]), _run(node[3])

        def loop(names: dict, out: _Out) -> None:
            items = list(x) if isinstance(x := value(names), (list, dict, str)) else []
            inner = dict(names)
            for k, item in enumerate(items):
                inner[name] = item
                inner["loop"] = {"first": k == 0, "last": k == len(items) - 1, "index": k + 1, "index0": k, "length": len(items)}
                body(inner, out)

        return loop
    if kind == "generation":
        body = _run(node[1])

        def generation(names: dict, out: _Out) -> None:
            start = out.length
            body(names, out)
            out.spans.append((start, out.length))

        return generation
    raise TemplateError(f"no statement: {kind}")


def compile_template(source: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages ({"role", "text"}) to the text and the ranges of its generation blocks."""
    run = _run(fold(parse(source)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        run({"messages": messages}, out)
        return "".join(out.pieces), out.spans

    return render


def format_conversations(rows: DataFrame, template: str = CHATML, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, spans): each conversation as one text, and the ranges [start, end) under the loss mask."""
    compile_template(template)  # raises here, not in tasks
    small_batches(rows.sparkSession)
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    turns = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), *said))).alias("turns")
    whole = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(turns)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in in_slices(batches):
            out = [render(turns) for turns in batch.column("turns").to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in out]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array([t for t, _ in out], pa.string()), pa.array(spans, pa.list_(span))], ["conv_id", "formatted", "spans"])

    kind = whole.schema["conv_id"].dataType.simpleString()
    return whole.mapInArrow(run, f"conv_id {kind}, formatted string, spans array<struct<start:bigint,end:bigint>>")


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a text that CHATML made; an error if anything else is in it."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(any_lines(m[1])), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return turns


def digests(formatted: DataFrame) -> DataFrame:
    """What CHATML texts hold, read back: turns, their digest, and the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            out = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append((len(turns), _sha256(said), len(loss), _sha256(loss), len(text)))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["conv_id", *names])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
