"""Chat formatting with compiled templates.

A template is parsed into a syntax tree, constants are folded, and the tree
becomes Python closures; rendering a conversation calls them and notes where
generated text begins and ends. Templates are sandboxed: they can read the
names they are given and keys of mappings, compare, join and filter strings,
and nothing else; there are no calls and no attributes of Python objects.

    {{ m.text|escape }}   {% if a == 'x' %} {% elif b %} {% else %} {% endif %}
    {% for m in messages %} {% endfor %} with loop.index, loop.first, loop.last
    {% generation %} {% endgeneration %} marks what a model is to learn
    {# comment #}   or and not == != in ~ ( ) 'text' 12 true false none
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import read_table, stage_path

#: Fixed values of the production format.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]")
TEMPLATE = (
    "{# one piece of a conversation; the first one opens it #}"
    "{% if first %}<s>{% endif %}{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text|escape }} [/INST]"
    "{% elif m.role == 'assistant' %}[OUT] {% generation %}{{ m.text|escape }}{% endgeneration %}</s>"
    "{% elif m.role == 'system' %}[SYS] {{ m.text|escape }} [/SYS]"
    "{% else %}[ROLE]{{ m.role|escape }}[TEXT]{{ m.text|escape }}[/ROLE]{% endif %}{% endfor %}"
)
#: A piece of a conversation is closed when it has so many characters or turns.
PIECE_CHARS, PIECE_TURNS = 1 << 18, 512
#: Turns of one span of turn numbers; the spans of a conversation are formatted apart, so a conversation of any length is spread over tasks.
SPAN_TURNS = 4096
FORMATTED = "conv_id bigint, span bigint, piece bigint, n_turns bigint, formatted string, loss array<struct<begin:bigint,end:bigint>>"

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\([\\.])")


def escape(text: str) -> str:
    """Reversible: doubles backslashes and breaks every control string by a backslash and a full stop behind its first character."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\." + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else "", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template can't be compiled, or reads a name it wasn't given."""


# Syntax tree: tuples with the kind first.
#   expressions  ("const", v) ("name", n) ("key", e, k) ("filter", n, e) ("not", e) ("op", o, a, b)
#   statements   ("text", s) ("put", e) ("if", [(e, body)], body) ("for", n, e, body) ("generation", body)

_PART = re.compile(r"\{\{(?P<put>.*?)\}\}|\{%-?(?P<do>.*?)-?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[|.()\[\]~+]))", re.S)
_WORDS = {"true": True, "false": False, "none": None}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def parse(self):
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"{kind} expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def either(self):
        left = self.both()
        while self.take("or"):
            left = ("op", "or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = ("op", "and", left, self.negated())
        return left

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        left = self.joined()
        while op := self.take("==", "!=", "in"):
            left = ("op", op, left, self.joined())
        return left

    def joined(self):
        left = self.filtered()
        while self.take("~", "+"):
            left = ("op", "~", left, self.filtered())
        return left

    def filtered(self):
        out = self.primary()
        while True:
            if self.take("|"):
                name = self.need("name")
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                out = ("filter", name, out)
            elif self.take("."):
                out = ("key", out, self.need("name"))
            elif self.take("["):
                out = ("key", out, _literal(self.need("str")))
                if not self.take("]"):
                    raise TemplateError("] expected")
            else:
                return out

    def primary(self):
        if self.take("("):
            out = self.either()
            if not self.take(")"):
                raise TemplateError(") expected")
            return out
        if self.at >= len(self.tokens):
            raise TemplateError("expression expected")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", _literal(value))
        if kind == "int":
            return ("const", int(value))
        if kind == "name":
            return ("const", _WORDS[value]) if value in _WORDS else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def _literal(quoted: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), quoted[1:-1], flags=re.S)


def parse(source: str) -> list:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in _PART.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        if m["put"] is not None:
            parts.append(("put", _Expression(m["put"]).parse()))
        elif m["do"] is not None:
            parts.append(("do", m["do"].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    place = 0

    def block(*ends: str) -> tuple[list, str]:
        nonlocal place
        out = []
        while place < len(parts):
            part = parts[place]
            place += 1
            if part[0] != "do":
                out.append(part)
                continue
            word, _, rest = part[1].partition(" ")
            if word in ends:
                return out, part[1]
            if word == "if":
                arms, test, other = [], rest, []
                while True:
                    body, end = block("elif", "else", "endif")
                    arms.append((_Expression(test).parse(), body))
                    if end.startswith("elif"):
                        test = end[4:]
                        continue
                    if end == "else":
                        other, _ = block("endif")
                    break
                out.append(("if", arms, other))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"can't read for {rest!r}")
                body, _ = block("endfor")
                out.append(("for", m[1], _Expression(m[2]).parse(), body))
            elif word == "generation":
                body, _ = block("endgeneration")
                out.append(("generation", body))
            else:
                raise TemplateError(f"unknown statement {part[1]!r}")
        if ends:
            raise TemplateError(f"{' or '.join(ends)} expected")
        return out, ""

    return block()[0]


def _apply(op: str, a, b):
    if op == "==":
        return a == b
    if op == "!=":
        return a != b
    if op == "in":
        return a in b
    return _shown(a) + _shown(b)


def _shown(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


def fold(node):
    """The same expression with constant parts computed."""
    kind = node[0]
    if kind == "op":
        _, op, a, b = node[0], node[1], fold(node[2]), fold(node[3])
        if op in ("or", "and"):
            if a[0] == "const":
                return (a if a[1] else b) if op == "or" else (b if a[1] else a)
            return ("op", op, a, b)
        return ("const", _apply(op, a[1], b[1])) if a[0] == b[0] == "const" else ("op", op, a, b)
    if kind == "not":
        a = fold(node[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if kind == "filter":
        a = fold(node[2])
        return ("const", FILTERS[node[1]](_shown(a[1]))) if a[0] == "const" else ("filter", node[1], a)
    if kind == "key":
        return ("key", fold(node[1]), node[2])
    return node


def fold_block(block: list) -> list:
    """Statements with constants folded: known branches chosen, neighbouring text joined."""
    out: list = []

    def add(node) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in block:
        if node[0] == "put":
            e = fold(node[1])
            add(("text", _shown(e[1])) if e[0] == "const" else ("put", e))
        elif node[0] == "if":
            arms, other = [], fold_block(node[2])
            for test, body in node[1]:
                test = fold(test)
                if test[0] != "const":
                    arms.append((test, fold_block(body)))
                elif test[1]:
                    other = fold_block(body)
                    break
            if arms:
                add(("if", arms, other))
            else:
                for x in other:
                    add(x)
        elif node[0] == "for":
            add(("for", node[1], fold(node[2]), fold_block(node[3])))
        elif node[0] == "generation":
            add(("generation", fold_block(node[1])))
        else:
            add(node)
    return out


class Output:
    """Rendered text, its length in code points, and the spans between generation markers."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _expression(node) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]

        def read(env: dict):
            try:
                return env[name]
            except KeyError:
                raise TemplateError(f"no name {name!r}") from None

        return read
    if kind == "key":
        of, key = _expression(node[1]), node[2]

        def item(env: dict):
            value = of(env)
            if type(value) is not dict:
                raise TemplateError(f"{key!r} of something that is no mapping")
            return value.get(key)

        return item
    if kind == "filter":
        change, of = FILTERS[node[1]], _expression(node[2])
        return lambda env: change(_shown(of(env)))
    if kind == "not":
        of = _expression(node[1])
        return lambda env: not of(env)
    op, a, b = node[1], _expression(node[2]), _expression(node[3])
    if op == "or":
        return lambda env: a(env) or b(env)
    if op == "and":
        return lambda env: a(env) and b(env)
    return lambda env: _apply(op, a(env), b(env))


def _statements(block: list) -> Callable[[dict, Output], None]:
    steps = [_statement(node) for node in block]

    def run(env: dict, out: Output) -> None:
        for step in steps:
            step(env, out)

    return run


def _statement(node) -> Callable[[dict, Output], None]:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, out: out.put(text)
    if kind == "put":
        of = _expression(node[1])
        return lambda env, out: out.put(_shown(of(env)))
    if kind == "generation":
        body = _statements(node[1])

        def generation(env: dict, out: Output) -> None:
            begin = out.length
            body(env, out)
            out.spans.append((begin, out.length))

        return generation
    if kind == "if":
        arms, other = [(_expression(t), _statements(b)) for t, b in node[1]], _statements(node[2])

        def choose(env: dict, out: Output) -> None:
            for test, body in arms:
                if test(env):
                    return body(env, out)
            return other(env, out)

        return choose
    name, of, body = node[1], _expression(node[2]), _statements(node[3])

    def repeat(env: dict, out: Output) -> None:
        items = of(env)
        if type(items) is not list:
            raise TemplateError("for needs a list")
        own = dict(env)
        for i, item in enumerate(items):
            own[name] = item
            own["loop"] = {"index": i + 1, "first": i == 0, "last": i + 1 == len(items)}
            body(own, out)

    return repeat


def compile_template(source: str) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """A function of the template's names that gives the text and the spans of generated text, in code points."""
    run = _statements(fold_block(parse(source)))

    def render(**names) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(names, out)
        return "".join(out.parts), out.spans

    return render


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Pieces of formatted conversations: conv_id, span, piece, n_turns, formatted and the spans of loss in it.

    Turns go by ``turn`` (null first), equal ones by role and text. Null text and
    null role count as empty; a null conv_id is a conversation of its own. Most
    conversations are one piece. Longer ones go on in further pieces, so a task
    streams over its sorted turns; and turns of each span of turn numbers are
    formatted apart, so a conversation that holds a third of all rows is spread
    over tasks. Its pieces in the order of (span, piece) are the conversation.
    Repeated rows are turns of their own. Other columns are not read. An empty
    table has no pieces.
    """

    def run(batches):
        render = compile_template(template)
        state = {"conv": None, "span": None, "first": False, "piece": 0, "open": False}
        turns: list[dict] = []
        chars = 0
        rows: list[tuple] = []

        def close() -> None:
            nonlocal turns, chars
            if turns:
                text, spans = render(first=state["first"] and state["piece"] == 0, messages=turns)
                rows.append((state["conv"], state["span"], state["piece"], len(turns), text, [{"begin": a, "end": b} for a, b in spans]))
                state["piece"] += 1
                turns, chars = [], 0

        def emit():
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["conv_id", "span", "piece", "n_turns", "formatted", "loss"])
            rows.clear()
            return batch

        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                for conv, span, first, role, text in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                    if not state["open"] or (conv, span) != (state["conv"], state["span"]):
                        close()
                        state.update(conv=conv, span=span, first=first, piece=0, open=True)
                    elif chars >= PIECE_CHARS or len(turns) >= PIECE_TURNS:
                        close()
                    turns.append({"role": role, "text": text})
                    chars += len(text)
                if rows:
                    yield emit()
        close()
        yield emit()

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    # A null turn comes before all others.
    span = F.coalesce(F.floor(F.col("turn").cast("long") / SPAN_TURNS), F.lit(-(2**62)).cast("long")).alias("span")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), span, empty("role"), empty("text"), F.col("turn").cast("long").alias("turn"))
    # Nearly all conversations begin at turn 0, so only the others are asked for where they begin.
    begins = rows.groupBy("conv_id").agg(F.min("span").alias("begin")).filter("begin != 0").select(F.col("conv_id").alias("of"), "begin")
    rows = rows.join(begins, F.col("conv_id").eqNullSafe(F.col("of")), "left").withColumn("first", F.col("span") == F.coalesce("begin", F.lit(0).cast("long")))
    return rows.repartition("conv_id", "span").sortWithinPartitions("conv_id", "span", "turn", "role", "text").select("conv_id", "span", "first", "role", "text").mapInArrow(run, FORMATTED)


def turns_of(piece: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted piece."""
    out, at = [], 3 if piece.startswith("<s>") else 0
    while at < len(piece):
        for mark, end, role in (("[INST] ", "[/INST]", "user"), ("[OUT] ", "</s>", "assistant"), ("[SYS] ", "[/SYS]", "system")):
            if piece.startswith(mark, at):
                stop = piece.index(end, at + len(mark))
                out.append((role, unescape(piece[at + len(mark) : stop - (end != "</s>")])))
                at = stop + len(end)
                break
        else:
            if not piece.startswith("[ROLE]", at):
                raise ValueError("no turn begins here")
            middle = piece.index("[TEXT]", at)
            stop = piece.index("[/ROLE]", middle)
            out.append((unescape(piece[at + 6 : middle]), unescape(piece[middle + 6 : stop])))
            at = stop + 7
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the conversations in formatted pieces: their turns, and the text under the loss mask.

    A digest runs over a conversation from its first turn to its last, so one task
    reads all pieces of one conversation, a batch at a time.
    """

    def run(batches):
        conv, is_open, rows = None, False, []
        turns = loss = None
        n = chars = length = 0

        def close() -> None:
            if is_open:
                rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), length))

        def emit():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            rows.clear()
            return batch

        for batch in batches:
            for own, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if not is_open or own != conv:
                    close()
                    conv, is_open, n, chars, length = own, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, said in turns_of(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for s in spans:
                    said = unescape(text[s["begin"] : s["end"]])
                    loss.update(said.encode())
                    chars += len(said)
                length += len(text)
            if rows:
                yield emit()
        close()
        yield emit()

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "span", "piece").select("conv_id", "formatted", "loss")
    return rows.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(own)
    out = stage_path(spark, "op5-formatted")
    format_conversations(rows).write.option("compression", "zstd").parquet(out)
    return read_back(spark.read.schema(FORMATTED).parquet(out))


#: Characters around the text of a turn by role, and of a piece's begin, are those of TEMPLATE; every control string and backslash grows by its escape.
OP5_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(conv_id, turn, role, text)),
n AS (SELECT *, length(text) + len(regexp_extract_all(text, '\\')) + 2 * len(regexp_extract_all(text, '\[/INST\]|\[/ROLE\]|\[INST\]|\[/SYS\]|\[ROLE\]|\[TEXT\]|\[OUT\]|\[SYS\]|</s>|<s>')) AS text_chars,
  length(role) + len(regexp_extract_all(role, '\\')) + 2 * len(regexp_extract_all(role, '\[/INST\]|\[/ROLE\]|\[INST\]|\[/SYS\]|\[ROLE\]|\[TEXT\]|\[OUT\]|\[SYS\]|</s>|<s>')) AS role_chars FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(text_chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 WHEN 'system' THEN 13 ELSE 19 + role_chars END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""

QUERIES = {"op5_chat_format": op5_chat_format}
ORACLE = {"op5_chat_format": OP5_SQL}
