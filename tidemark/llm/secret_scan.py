"""Secret scans by assignment-aware lexing.

Three base patterns are matched anywhere. Beside them, each line that holds a ``=`` or ``:`` is lexed
as source or configuration: a name (dotted, indexed or quoted) with an optional type, an assignment
sign (``=``, ``:``, ``:=``, ``=>``) and a value made of quoted literals (also prefixed or in triple
quotes), bare words, call arguments and references joined by ``+`` or ``.``. A value may stand after a
backslash or on the next line, in a block of indented lines, in several quoted pieces in brackets, or
between the tags of an element; ``a, b = x, y`` pairs each name with its own value. That gives
name-literal pairs. A value can hold
pairs of its own: a bare one that begins with a further assignment is a reference to that name, and
the insides of values are lexed as well. Names whose value is a reference (``b = a``, ``self.a``, ``${a}``, ``$a``, also inside quotes, ``{a}`` in
formatted ones) pass their own sensitivity on to what they refer to, until nothing changes, so that a literal counts for each
name it reaches. A literal's score is the sensitivity of the most telling name times how much the
literal looks like a key; those above a threshold become spans of kind ``literal``.

Defined cases: NULL and empty texts have no spans; repeated rows are scanned alike; every text is
scanned whole. Spans are code points, the end exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, strings

#: Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs of 20 and more
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

#: Words in a name, and how telling each is (the highest counts).
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6, "key": 0.5,
    "bearer": 0.8, "signature": 0.5, "salt": 0.5, "connectionstring": 0.7,
}
#: Literals that stand for a value to be filled in.
PLACEHOLDERS = {"changeme", "example", "placeholder", "none", "null", "true", "false", "undefined", "todo", "xxx"}
THRESHOLD = 0.45

# Possessive quantifiers, and names that begin where no word character stands before, keep the
# lexer linear on words and lines of any length.
_NAME = r"(?<![\w$])[A-Za-z_$][\w$]*+(?:(?:\.|->|::|-)[A-Za-z_$][\w$]*+)*+"
_LITERAL = (
    r"(?:[bBrRfFuU]{1,2}|[@$L])?(?:"
    r'"""(?P<a>(?:[^"\\]|\\[\s\S]|"(?!""))*+)"""' + r"|'''(?P<b>(?:[^'\\]|\\[\s\S]|'(?!''))*+)'''"
    r'|"(?P<c>(?:[^"\\\n]|\\.)*+)"' + r"|'(?P<d>(?:[^'\\\n]|\\.)*+)'|`(?P<e>[^`\n]*+)`)")
_REF = r"\$\{\w+\}|\$\w+"
_TYPE = r"[&*]?[A-Za-z_][\w.]*+(?:<[^<>\n=]*+>|\[[^\[\]\n=]*+\])*+\??(?:[ \t]*+\|[ \t]*+[A-Za-z_][\w.]*+)*+"
_HEAD = re.compile(
    rf"""(?P<quote>["']?)(?P<name>{_NAME})(?P=quote)(?:\[[ \t]*+(?P<index>"[^"\n]*+"|'[^'\n]*+'|\w++)[ \t]*+\])?"""
    rf"""(?:[ \t]*+\??(?P<typed>:)[ \t]*+{_TYPE}[ \t]*+(?==(?![=>])))?[ \t]*+(?::=|=>|=(?!=)|:(?!:))[ \t]*+""")
_STOP = r"\s\"'`,;+{}()\[\]"
_PART, _NESTED = (  # a bare value that lies inside another one ends at the next sign
    re.compile(rf"(?P<literal>{_LITERAL})|(?P<ref>{_REF})(?![^{_STOP}])|(?P<bare>{bare})")
    for bare in (rf"(?:\$\{{\w+\}}|[^{_STOP}])(?:\$\{{\w+\}}|[^{_STOP}]|[{{}}()\[\]]++(?=[^{_STOP}]))*+", rf"[^{_STOP}][^{_STOP}=:&|]*+"))
#: Brackets and signs before a value that are not followed by a pair of their own.
_OPEN = re.compile(rf"""(?:[({{\[+][ \t]*+)++(?!["']?{_NAME}["']?[ \t]*+[=:])""")
_PLUS = re.compile(r"[ \t]*+(?:\+\s*+|\.[ \t]*+(?=[\"'$]))")
_QUOTE = r"(?=(?:[bBrRfFuU]{1,2}|[@$L])?[\"'`])"
#: What may stand between a sign and its value, and between quoted pieces in brackets.
_BREAK = re.compile(rf"\\\r?\n[ \t]*+|\r?\n[ \t]*+{_QUOTE}")
_BRACKET = re.compile(rf"[(\[]\s*+{_QUOTE}")
_GLUE = re.compile(rf"\s*+,?\s*+{_QUOTE}")
_KEY = re.compile(r"[ \t]*+[:=]")
#: A block of indented lines, an element, names that share a sign, and the arguments of a call.
_BLOCK = re.compile(r"[|>][+-]?[ \t]*+\r?\n(?P<pad>[ \t]++)")
_TAG = re.compile(rf"<(?P<name>{_NAME})(?:[ \t][^<>\n]*+)?>\s*+(?P<value>[^<>]*+)</(?P=name)>")
_TUPLE = re.compile(rf"(?P<names>{_NAME}(?:[ \t]*+,[ \t]*+{_NAME})++)(?P<sign>[ \t]*+=(?!=)[ \t]*+)?")
_CALL = re.compile(rf"(?P<name>{_NAME})(?:(?P<open>\()|\Z)")
_COMMA = re.compile(r"[ \t]*+,[ \t]*+")
_ARGUMENT = re.compile(rf"[\s,(]*+(?:(?P<literal>{_LITERAL})|(?P<ref>{_REF})|(?P<name>{_NAME})(?P<more>[ \t]*+[=(]\s*+)?)")
#: References inside quoted text; those in braces alone count where it is marked as formatted.
_INSERTED = re.compile(r"\$\{\s*+([A-Za-z_][\w.]*+)[^{}]*+\}|%\(([\w.]++)\)s|\$([A-Za-z_]\w*+)")
_FORMATTED = re.compile(r"\{\s*+([A-Za-z_][\w.]*+)[^{}]*+\}")
_MARKED = re.compile(r"(?<!\w)(?:[fF][rR]?|[rR][fF]|\$)(?:\"{3}|'{3}|[\"'])\Z")
#: Dotted words that are a path to a value and no value themselves.
_PATH = re.compile(r"(?:self|this|cls)(?:(?:\.|->|::)\w+)+|[A-Za-z_]+(?:(?:\.|->|::)[A-Za-z_]+)+")
#: A further assignment at the start of a bare value, and whether its own value is quoted.
_INNER = re.compile(rf"(?P<name>{_NAME})[ \t]*+(?::=|=>|=(?!=))[ \t]*+(?:(?P<quoted>[bBrRfFuUL@$]{{0,2}}[\"'`])|(?=[^\s,;]))")
_SIGN = re.compile(r"[=:]")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def sensitivity(name: str) -> float:
    """How telling a name is: its words, split at case and punctuation, singly and joined in twos."""
    words = [w.lower() for w in _WORDS.findall(name)]
    joined = [a + b for a, b in zip(words, words[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in words + joined), default=0.0)


def key_like(literal: str) -> float:
    """0 to 1: length, entropy and mixture of a literal; words and placeholders are near 0."""
    n = len(literal)
    if n < 6 or literal.lower().strip("<>{}*.") in PLACEHOLDERS or len(set(literal)) < 4:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(bool(re.search(p, literal)) for p in (r"[a-z]", r"[A-Z]", r"\d", r"[^A-Za-z0-9\s]"))
    spaces = sum(map(str.isspace, literal))
    return max(0.0, min(1.0, entropy / 4) * (0.4 + 0.2 * min(kinds, 3)) - 0.2 * spaces)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns: leftmost matches of each kind that are long enough."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    return found + [(*m.span(), "hex") for m in HEX.finditer(text)]


def pairs(text: str) -> list[tuple[str, list[tuple[int, int]], list[str]]]:
    """(name, literals' spans, names referred to) of each assignment, by place; the insides of quoted
    values come after the text around them, and names that share a sign and elements last."""
    out, regions = [], [(0, len(text))]
    shared, taken = _shared(text)
    for start, end in regions:  # grows by what quoted values hold
        at, reach = start, start
        while m := _HEAD.search(text, at, end):
            at = m.end()
            if at in taken:  # its values are dealt to several names
                continue
            literals, refs, after, called = _value(text, m.end(), end, m.start() < reach, m.start())
            if after is None:
                continue
            name = m["name"] + ("." + m["index"].strip("\"'") if m["index"] else "")
            inserted = [r for a, b, quoted in literals if quoted for r in _inserted(text, a, b)]
            out.append((name, [(a, b) for a, b, _ in literals], refs + inserted))
            if m["typed"]:
                at = m.end("typed")  # what reads like a type may be a name, as in a line of a log
            elif literals and literals[0][2] and not called:
                at = after if all(quoted for _, _, quoted in literals) and not refs else literals[0][1]
                regions += [(a, b) for a, b, quoted in literals if quoted and a < at and _SIGN.search(text, a, b)]
            else:
                reach = max(reach, after)
    out += shared
    if "</" in text:
        for m in _TAG.finditer(text):
            a, b = m.start("value"), m.start("value") + len(m["value"].rstrip())
            out.append((m["name"], [(a, b)], _inserted(text, a, b)))
    return out


def _shared(text: str) -> tuple[list[tuple[str, list[tuple[int, int]], list[str]]], set[int]]:
    """The pairs of ``a, b = x, y``, and where the values of such names begin."""
    out, taken = [], set()
    for m in _TUPLE.finditer(text) if "," in text and "=" in text else ():
        if not m["sign"]:
            continue
        names, at, values = re.split(r"[ \t]*,[ \t]*", m["names"]), m.end(), []
        while len(values) < len(names) and (p := _PART.match(text, at)):
            if p["literal"]:
                span = next(p.span(k) for k in "abcde" if p[k] is not None)
                values.append(([span], _inserted(text, *span)))
            else:
                word = p["ref"].strip("${}") if p["ref"] else p["bare"]
                values.append(([], [word]))
            comma = _COMMA.match(text, p.end())
            if not comma:
                break
            at = comma.end()
        if len(values) == len(names):
            out += [(name, spans, refs) for name, (spans, refs) in zip(names, values)]
            taken.add(m.end())
    return out, taken


def _inserted(text: str, a: int, b: int) -> list[str]:
    """Names that a quoted literal refers to."""
    found = [next(filter(None, m.groups())) for m in _INSERTED.finditer(text, a, b)]
    if _MARKED.search(text[max(0, a - 6) : a]):
        found += [m[1] for m in _FORMATTED.finditer(text, a, b)]
    return found


def _own(text: str, a: int, b: int, names) -> str:
    """A literal less what is inserted into it: braced references, and ``$name`` of a known name."""
    own = _INSERTED.sub(lambda m: m[0] if m[3] and m[3] not in names else "", text[a:b])
    return _FORMATTED.sub("", own) if _MARKED.search(text[max(0, a - 6) : a]) else own


def _indented(text: str, m: re.Match, end: int, head: int) -> list[tuple[int, int, bool]] | None:
    """The lines of a block that is indented more than the line of its name."""
    begin = text.rfind("\n", 0, head) + 1
    line = text[begin:head]
    if len(m["pad"]) <= len(line) - len(line.lstrip(" \t")):
        return None
    found, at = [], m.start("pad")
    while at < end and text.startswith(m["pad"], at):
        stop = text.find("\n", at, end)
        stop = end if stop < 0 else stop
        row = text[at:stop]
        a = at + len(row) - len(row.lstrip())
        if row.strip():
            found.append((a, a + len(row.strip()), False))
        at = stop + 1
    return found


def _arguments(text: str, at: int, end: int) -> tuple[list[tuple[int, int, bool]], list[str], int]:
    """Quoted literals and names among a call's arguments from its bracket on, and where they end."""
    literals, refs = [], []
    while p := _ARGUMENT.match(text, at, end):
        at = p.end()
        if p["literal"]:
            literals.append((*next(p.span(k) for k in "abcde" if p[k] is not None), True))
        elif p["ref"]:
            refs.append(p["ref"].strip("${}"))
        elif not p["more"]:
            refs.append(p["name"])
    return literals, refs, at


def _value(text: str, at: int, end: int, inside: bool, head: int
           ) -> tuple[list[tuple[int, int, bool]], list[str], int | None, bool]:
    """(start, end, whether quoted) of the literals of the value at ``at``, the names it refers to,
    its end, None without a value, and whether pairs may lie within it. One that lies inside another
    value ends at the next sign, so that no text is read for more than two values."""
    literals, refs, after, called, glued = [], [], None, False, False
    part, begin = _NESTED if inside else _PART, at
    if not inside and (m := _BLOCK.match(text, at, end)) and (lines := _indented(text, m, end, head)):
        return lines, [], lines[-1][1], True
    if broken := _BREAK.match(text, at, end):
        at = broken.end()
    if not inside and (m := _BRACKET.match(text, at, end)):
        at, glued = m.end(), True
    elif opened := _OPEN.match(text, at, end):
        at = opened.end()
    while True:
        if inner := _INNER.match(text, at, end):
            refs.append(inner["name"])
            if inner["quoted"] or key_like(inner["name"]) < THRESHOLD:
                return literals, refs, at, called
        p = part.match(text, at, end)
        if not p:
            return literals, refs, after, called
        if p["literal"] and "\n" in text[begin:at] and _KEY.match(text, p.end(), end):
            return literals, refs, after, called  # what stands on the next line is a name itself
        after = p.end()
        if p["literal"]:
            literals.append((*next(p.span(k) for k in "abcde" if p[k] is not None), True))
        elif p["ref"]:
            refs.append(p["ref"].strip("${}"))
        elif (call := _CALL.match(p["bare"])) and text.startswith(("(", ")") if call["open"] else "(", after):
            if not inside:  # a call's own name is no value
                more, names, after = _arguments(text, p.start() + len(call["name"]), end)
                literals, refs, called = literals + more, refs + names, True
        else:
            refs.append(p["bare"])
            if not _PATH.fullmatch(p["bare"]):
                literals.append((*p.span(), False))  # a bare word is a literal too, as in configuration files
        join = None if inside else (glued and p["literal"] and _GLUE.match(text, after, end)) or _PLUS.match(text, after, end)
        if not join:
            return literals, refs, after, called
        at = join.end()


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name, directly or through constants."""
    found = pairs(text)
    worth: dict[str, float] = defaultdict(float)
    for name, _, _ in found:
        worth[name] = max(worth[name], sensitivity(name))
    # a name passes its sensitivity on to the names it is made of; each can rise a few times only
    tails = ((name, refs + [re.split(r"\.|->|::", r)[-1] for r in refs]) for name, _, refs in found)
    uses = [(name, [r for r in refs if r in worth and r != name]) for name, refs in tails]
    again = [x for x in uses if x[1] and worth[x[0]] > 0]
    by_name = defaultdict(list)
    for name, refs in uses:
        if refs:
            by_name[name] += refs
    queue = [name for name, _ in again]
    while queue:
        name = queue.pop()
        for ref in by_name.get(name, ()):
            if worth[ref] < worth[name]:
                worth[ref] = worth[name]
                queue.append(ref)
    spans = set()
    for name, literals, _ in found:
        if worth[name] > 0:
            for a, b in literals:
                if text[a:b] not in worth and worth[name] * key_like(_own(text, a, b, worth)) >= threshold:
                    spans.add((a, b, "literal"))
    return sorted(spans)


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans and all spans, each by start, then kind as listed."""
    order = {kind: i for i, kind in enumerate(KINDS)}
    base = sorted(base_spans(text), key=lambda s: (s[0], order[s[2]], s[1]))
    more = literal_spans(text) if "=" in text or ":" in text else []
    return base, sorted([*base, *more], key=lambda s: (s[0], order[s[2]], s[1])) if more else base




def with_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (array of (kind, start, end)) of each whole text."""
    span = T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [scan(x) for x in strings(batch, text)]
        return [
            pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in spans] for spans in column], kind)
            for column in (([x[0] for x in found]), ([x[1] for x in found]))
        ]

    return add_columns(docs, [T.StructField("base", span), T.StructField("spans", span)], run)


def listed(spans: str):
    """A column of spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
