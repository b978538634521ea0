"""Chat formatting: a small sandboxed template language, compiled to closures.

Templates know text, ``{{ expression }}``, ``{% for x in xs %}``, ``{% if %} {% elif %} {% else %}``, ``{% set x = ... %}`` and
``{% generation %} ... {% endgeneration %}``, which marks what a model is trained on. Expressions know names, members of
dictionaries, indices, string and number literals, ``+ ~ == != in and or not``, brackets and the listed filters. A
template reaches nothing but the values it is given: there are no calls, no Python attributes and no imports.

:func:`parse` gives a syntax tree, :func:`fold` evaluates its constant parts, :func:`compile_tree` turns it into closures.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm import common  # noqa: F401  (functions travel with their tasks)

#: Strings that have a meaning in :data:`TEMPLATE`; inside texts they are escaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[TEXT]")

TEMPLATE = (
    "{% set start = '<' ~ 's>' %}{% for m in messages %}{{ start }}{% if m.role == 'assistant' %}"
    "{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[INST]{{ m.role | escape }}[TEXT]{{ m.text | escape }}[/INST]{% endif %}{% endfor %}"
)

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(r"<s>(?:\[INST\](.*?)\[TEXT\](.*?)\[/INST\]|(.*?)</s>)", re.DOTALL)


def escape(text: str) -> str:
    """Backslashes are doubled, and a single one is put behind the first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


FILTERS: dict[str, Callable] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len, "string": str}


class TemplateError(ValueError):
    pass


# Syntax tree: tuples whose first member names the kind.
#   statements   ("text", s) ("out", e) ("for", name, e, body) ("if", [(e, body), ...], otherwise) ("set", name, e) ("mark", body)
#   expressions  ("const", v) ("name", n) ("item", e, e) ("filter", name, e) ("not", e) (operator, e, e)

_PARTS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)|(==|!=|[-+~.|()\[\]=]))""", re.DOTALL)
_BACKSLASHED = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in", "true", "false", "none"}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            match = _TOKEN.match(source, at)
            if not match:
                raise TemplateError(f"can't read {source[at:]!r}")
            number, text, name, sign = match.groups()
            if number:
                self.tokens.append(("const", int(number)))
            elif text:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda m: _BACKSLASHED.get(m[1], m[1]), text[1:-1], flags=re.DOTALL)))
            else:
                self.tokens.append(("word", name) if name else ("sign", sign))
            at = match.end()
        self.at = 0

    def next_is(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.next_is(value):
            raise TemplateError(f"{value!r} is missing")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "word" and self.tokens[self.at][1] not in _WORDS:
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def whole(self) -> tuple:
        tree = self.either()
        self.ended()
        return tree

    def ended(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def either(self) -> tuple:
        tree = self.both()
        while self.next_is("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.next_is("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.next_is("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.added()
        while sign := self.next_is("==", "!=", "in"):
            tree = (sign, tree, self.added())
        return tree

    def added(self) -> tuple:
        tree = self.single()
        while sign := self.next_is("+", "~"):
            tree = (sign, tree, self.single())
        return tree

    def single(self) -> tuple:
        if self.next_is("("):
            tree = self.either()
            self.need(")")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            tree = self.tokens[self.at]
            self.at += 1
        elif word := self.next_is("true", "false", "none"):
            tree = ("const", {"true": True, "false": False, "none": None}[word])
        else:
            tree = ("name", self.name())
        while sign := self.next_is(".", "[", "|"):
            if sign == ".":
                tree = ("item", tree, ("const", self.name()))
            elif sign == "[":
                tree = ("item", tree, self.either())
                self.need("]")
            else:
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"unknown filter {name!r}")
                tree = ("filter", name, tree)
        return tree


def parse(source: str) -> list[tuple]:
    """Syntax tree of a template."""
    parts = [p for p in _PARTS.split(source) if p]
    at = 0

    def body(*ends: str) -> tuple[list[tuple], str, _Expression | None]:
        nonlocal at
        tree: list[tuple] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                tree.append(("out", _Expression(part[2:-2]).whole()))
                continue
            if not part.startswith("{%"):
                tree.append(("text", part))
                continue
            tag = _Expression(part[2:-2])
            word = tag.name()
            if word in ends:
                return tree, word, tag
            if word == "for":
                name = tag.name()
                tag.need("in")
                values = tag.whole()
                tree.append(("for", name, values, body("endfor")[0]))
            elif word == "if":
                branches, otherwise, condition = [], [], tag.whole()
                while True:
                    inner, end, tag = body("elif", "else", "endif")
                    branches.append((condition, inner))
                    if end == "elif":
                        condition = tag.whole()
                        continue
                    if end == "else":
                        otherwise = body("endif")[0]
                    break
                tree.append(("if", branches, otherwise))
            elif word == "set":
                name = tag.name()
                tag.need("=")
                tree.append(("set", name, tag.whole()))
            elif word == "generation":
                tag.ended()
                tree.append(("mark", body("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tree, "", None

    return body()[0]


_OPERATIONS: dict[str, Callable] = {
    "+": lambda a, b: a + b, "~": lambda a, b: str(a) + str(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
}


def _fold_expression(tree: tuple) -> tuple:
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    if kind == "filter":
        inner = _fold_expression(tree[2])
        return ("const", FILTERS[tree[1]](inner[1])) if inner[0] == "const" else ("filter", tree[1], inner)
    parts = [_fold_expression(part) for part in tree[1:]]
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if all(part[0] == "const" for part in parts):
        return ("const", _evaluator((kind, *parts))({}))
    return (kind, *parts)


def fold(tree: list[tuple]) -> list[tuple]:
    """Evaluate what is constant, drop branches that are never taken, join neighbouring texts."""
    out: list[tuple] = []

    def text(value) -> None:
        if out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + value)
        elif value:
            out.append(("text", value))

    for node in tree:
        kind = node[0]
        if kind == "text":
            text(node[1])
        elif kind == "out":
            value = _fold_expression(node[1])
            text(str(value[1])) if value[0] == "const" else out.append(("out", value))
        elif kind == "if":
            branches, otherwise = [], fold(node[2])
            for condition, inner in node[1]:
                condition = _fold_expression(condition)
                if condition[0] == "const":
                    if condition[1]:
                        otherwise = fold(inner)
                        break
                    continue
                branches.append((condition, fold(inner)))
            if branches:
                out.append(("if", branches, otherwise))
            else:
                for inner in otherwise:
                    text(inner[1]) if inner[0] == "text" else out.append(inner)
        elif kind == "for":
            out.append(("for", node[1], _fold_expression(node[2]), fold(node[3])))
        elif kind == "set":
            out.append(("set", node[1], _fold_expression(node[2])))
        else:
            out.append(("mark", fold(node[1])))
    return out


def _item(value, key):
    if isinstance(value, dict) and key in value or isinstance(value, (list, str)) and isinstance(key, int) and -len(value) <= key < len(value):
        return value[key]
    raise TemplateError(f"no member {key!r}")


def _evaluator(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda env: value
    if kind == "name":
        name = tree[1]

        def look(env):
            if name not in env:
                raise TemplateError(f"unknown name {name!r}")
            return env[name]

        return look
    if kind == "filter":
        change, inner = FILTERS[tree[1]], _evaluator(tree[2])
        return lambda env: change(inner(env))
    if kind == "not":
        inner = _evaluator(tree[1])
        return lambda env: not inner(env)
    left, right = _evaluator(tree[1]), _evaluator(tree[2])
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    operation = _item if kind == "item" else _OPERATIONS[kind]
    return lambda env: operation(left(env), right(env))


class _Output:
    """Pieces of the formatted text, its length in code points, and the marked spans."""

    def __init__(self):
        self.pieces, self.length, self.spans = [], 0, []

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def compile_tree(tree: list[tuple]) -> Callable[[dict, _Output], None]:
    """Closures for a tree; each writes to an output."""
    steps = [_statement(node) for node in tree]

    def run(env, out):
        for step in steps:
            step(env, out)

    return run


def _statement(node: tuple) -> Callable[[dict, _Output], None]:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, out: out.add(text)
    if kind == "out":
        value = _evaluator(node[1])
        return lambda env, out: out.add(str(value(env)))
    if kind == "set":
        name, value = node[1], _evaluator(node[2])
        return lambda env, out: env.__setitem__(name, value(env))
    if kind == "mark":
        inner = compile_tree(node[1])

        def mark(env, out):
            begin = out.length
            inner(env, out)
            out.spans.append((begin, out.length))

        return mark
    if kind == "if":
        branches, otherwise = [(_evaluator(c), compile_tree(b)) for c, b in node[1]], compile_tree(node[2])

        def choose(env, out):
            for condition, inner in branches:
                if condition(env):
                    return inner(env, out)
            return otherwise(env, out)

        return choose
    name, values, inner = node[1], _evaluator(node[2]), compile_tree(node[3])

    def loop(env, out):
        items = values(env)
        for i, item in enumerate(items):
            inner(env | {name: item, "loop": {"index": i + 1, "first": i == 0, "last": i == len(items) - 1}}, out)

    return loop


def compile_template(source: str) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """A function of the template's values that gives the formatted text and its marked spans."""
    run = compile_tree(fold(parse(source)))

    def render(**values):
        out = _Output()
        run(dict(values), out)
        return "".join(out.pieces), out.spans

    return render


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Turns of a text that :data:`TEMPLATE` made: role and text."""
    turns, at = [], 0
    while at < len(formatted):
        match = _TURN.match(formatted, at)
        if not match:
            raise ValueError(f"no turn at {at}")
        role, text, said = match.groups()
        turns.append(("assistant", unescape(said)) if said is not None else (unescape(role), unescape(text)))
        at = match.end()
    return turns


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: What :func:`format_conversations` can return, from the formatted text, its spans and a function for the turns read back.
OUTPUTS = {
    "formatted": ("string", pa.string(), lambda text, spans, turns: text),
    "spans": ("array<struct<begin:long,end:long>>", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
              lambda text, spans, turns: [{"begin": a, "end": b} for a, b in spans]),
    "n_turns": ("long", pa.int64(), lambda text, spans, turns: len(turns())),
    "turns_sha256": ("string", pa.string(), lambda text, spans, turns: _hex("".join(f"{r}\n{t}\n" for r, t in turns()))),
    "loss_chars": ("long", pa.int64(), lambda text, spans, turns: sum(len(unescape(text[a:b])) for a, b in spans)),
    "loss_sha256": ("string", pa.string(), lambda text, spans, turns: _hex("".join(unescape(text[a:b]) for a, b in spans))),
    "formatted_chars": ("long", pa.int64(), lambda text, spans, turns: len(text)),
}


def format_conversations(rows: DataFrame, template: str = TEMPLATE, outputs: tuple[str, ...] = ("formatted", "spans")) -> DataFrame:
    """One row for each ``conv_id`` of ``rows`` (``conv_id, turn, role, text``): its id and the named ``outputs``.

    Turns are taken in the order of ``turn``, then role, then text; null turns come first, repeated rows are turns of their own. A
    null role or text is an empty one. Rows without ``conv_id`` form one conversation. Outputs that read turns back need
    :data:`TEMPLATE` or one with the same marks. Further columns are not read.

    Rows are sorted by conversation and streamed through the task that formats them, so a task holds one conversation at a time.
    """
    sorted_rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                              F.coalesce("text", F.lit("")).alias("text"))
    sorted_rows = sorted_rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        render, key_type = compile_template(template), None

        def finish(found):
            columns = [[] for _ in outputs]
            for _, messages in found:
                text, spans = render(messages=messages)
                memo: list = []

                def turns():
                    memo or memo.append(read_back(text))
                    return memo[0]

                for column, name in zip(columns, outputs):
                    column.append(OUTPUTS[name][2](text, spans, turns))
            arrays = [pa.array([k for k, _ in found], key_type), *(pa.array(c, OUTPUTS[n][1]) for c, n in zip(columns, outputs))]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *outputs])

        found: list[tuple[object, list[dict]]] = []
        for batch in batches:
            key_type = batch.column(0).type
            ids, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for conv, role, text in zip(ids, roles, texts):
                if not found or found[-1][0] != conv:
                    found.append((conv, []))
                found[-1][1].append({"role": role, "text": text})
            if len(found) > 1:  # the last conversation may go on in the next batch
                yield finish(found[:-1])
                found = found[-1:]
        if found:
            yield finish(found)

    return sorted_rows.mapInArrow(run, ", ".join([f"conv_id {kind}", *(f"{n} {OUTPUTS[n][0]}" for n in outputs)]))
