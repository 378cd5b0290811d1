"""Secret scans by assignment-aware lexing.

Every text is cut into tokens of source and configuration syntax: names (dotted, hyphenated, quoted as keys), string literals with
their prefixes, values without quotes, operators and line ends. Comments are lexed like code, as commented-out secrets leak too. From the
tokens come pairs of a target name and an expression:

* ``name = expr``, ``name := expr``, ``name: expr``, ``"name": expr``, ``name => expr``, ``name["key"] = expr``, with declarations and types in front;
* ``export NAME=value``, ``--name value``, ``--name=value``, ``name="value"`` in tags and ``<name>value</name>``;
* expressions are literals and names joined by ``+``, ``.`` or by standing side by side, calls with a default (``getenv("NAME", "value")``) and
  templates with ``${NAME}`` or ``{NAME}``; a value without quotes ends at white space, a closing mark, a colon or the next assignment.

Constants are propagated: a name stands for the literals that were last assigned to it, through any number of steps, so a literal that
reaches a sensitive name by way of harmless ones is found where it is written. A literal's score is the sensitivity of the
target's words (``password`` more than ``auth``) plus its shape (length, mix of character classes, entropy) less what speaks against it:
placeholders, prose, paths, names. Literals with ``THRESHOLD`` or more are reported as kind ``literal``, besides the three base patterns, whose
spans always stay. All of the lexing is linear in the text. Texts without any sensitive stem cannot score and aren't lexed.

Defined cases: a null text counts as empty and has no spans; spans are in code points of the whole text, however long; equal literals are
reported at each place, a literal reached by several names once; repeated rows give equal rows; ids may be null; an empty table gives no rows.
``spans_of`` is the plain function; ``scan`` keeps doc_id only, so extra columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so the least length may stand in the pattern
KINDS = ("assign", "access", "hex", "literal")

#: Sensitivity of the words of a name, out of 100. Fixed values.
WEIGHTS = {
    "password": 70, "passwd": 70, "passphrase": 70, "pwd": 65, "secret": 65, "token": 55, "apikey": 65, "privatekey": 70,
    "accesskey": 65, "secretkey": 70, "signingkey": 60, "encryptionkey": 60, "credential": 55, "credentials": 55, "bearer": 50,
    "auth": 40, "authorization": 45, "authkey": 60, "masterkey": 65, "clientsecret": 70, "connectionstring": 45, "salt": 40, "pin": 35, "pass": 45,
}
#: Words that take the sensitivity from a name: it speaks of a secret and doesn't hold one. Fixed values.
HARMLESS = frozenset("""name names field file path url uri type length len size count min max limit policy hint label placeholder regex pattern
prompt reset expiry expires expiration ttl id ids title message error format header endpoint version enabled required rule rules param""".split())
#: Values that stand for a missing secret. Fixed values.
PLACEHOLDERS = re.compile(
    r"(?:x{3,}|\*{3,}|\.{3,}|change.?me|change.?this|your.|my.?(?:password|secret|token|key)\b|example|sample|dummy|placeholder|todo|none|null|nil|"
    r"true|false|undefined|redacted|removed|insert.|replace.|<|\$\{|\{\{|%\()", re.IGNORECASE)
STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "auth", "connection", "salt", "pin")
THRESHOLD = 80
LEAST = 6

NAME = r"[A-Za-z_$][A-Za-z0-9_$]*+(?:[.-][A-Za-z_$][A-Za-z0-9_$]*+)*+"
STRINGS = (
    r'(?P<long>(?<!\w)[bBrRuUfF]{0,2}(?:"""(?:[^"\\]|\\.|"(?!""))*+(?:"""|\Z)|' + r"'''(?:[^'\\]|\\.|'(?!''))*+(?:'''|\Z)))",
    r'(?P<string>(?<!\w)[bBrRuUfF@$]{0,2}(?:"(?:[^"\\\n]|\\.)*+(?:"|$)|' + r"'(?:[^'\\\n]|\\.)*+(?:'|$)|`(?:[^`\\\n]|\\.)*+(?:`|$)))")
OTHERS = (
    r"(?P<tag><(?P<open>[A-Za-z][A-Za-z0-9_.-]*+)>(?P<inner>[^<>\n]++)</(?P=open)>)",
    r"(?P<flag>(?<![\w-])--[A-Za-z][A-Za-z0-9_-]*+)",
    rf"(?P<name>{NAME})",
    r"(?P<number>\d\w*+)",
    r"(?P<assign>:=|=>|[=!<>]=+|[=:])",
    r"(?P<line>\n)",
    r"(?P<space>[^\S\n]++)",
    r"(?P<mark>.)")
TOKEN = re.compile("|".join(STRINGS + OTHERS), re.DOTALL | re.MULTILINE)
#: For the rest of a line after a quote that nothing closes.
PLAIN = re.compile("|".join(OTHERS), re.DOTALL)
#: A value without quotes: up to white space, a quote, a closing mark or the next assignment; padding belongs to it.
BARE = re.compile(r"[^\s\"'`,;()\[\]{}<>:=]++={0,2}")
TEMPLATE = re.compile(r"\{([A-Za-z_][A-Za-z0-9_.]*+)\}|\$([A-Za-z_][A-Za-z0-9_]*+)")
HUMP = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@dataclass(frozen=True)
class Token:
    kind: str
    start: int
    end: int
    text: str


@dataclass(frozen=True)
class Literal:
    start: int
    end: int
    value: str
    quoted: bool = True


@dataclass
class Pair:
    """A target name and the literals and names of its expression."""

    name: str
    literals: list[Literal] = field(default_factory=list)
    names: list[str] = field(default_factory=list)


def words_of_name(name: str) -> list[str]:
    return [w.lower() for w in HUMP.findall(name)]


def sensitivity(name: str) -> int:
    """0 to 100: how sure a name is to hold a secret."""
    words = words_of_name(name)
    if not words or HARMLESS & set(words[-1:]):
        return 0
    joined = ["".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, min(i + 3, len(words)) + 1)]
    return max((WEIGHTS.get(w, 0) for w in joined), default=0)


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def shape(value: str) -> int:
    """-100 to 50: how much a literal looks like a secret."""
    if len(value) < LEAST or PLACEHOLDERS.match(value) or "://" in value and "@" not in value:
        return -100
    if len(set(value)) < 4:
        return -100
    score = min(20, len(value))
    classes = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum() and c != " "))
    score += 8 * (classes - 1)
    score += 15 if entropy(value) >= 3.0 else 0
    score -= 30 * (" " in value.strip()) + 10 * value.count(" ")
    score -= 25 if value.startswith(("/", "./", "../", "~/")) and "." not in value[-1:] and value.count("/") > 1 else 0
    score -= 25 if classes == 1 and value.isalpha() and len(value) < 10 else 0
    return max(-100, min(50, score))


def score(name_weight: int, literal: Literal) -> int:
    """Sum of both sides; a word without quotes and digits is rather a name than a value."""
    loose = not literal.quoted and re.fullmatch(NAME, literal.value) and not any(c.isdigit() for c in literal.value)
    return name_weight + shape(literal.value) - (60 if loose else 0) if name_weight else 0


def lexed(text: str) -> list[Token]:
    """Tokens without white space, line ends included."""
    out, at, plain_to = [], 0, 0
    while at < len(text):
        m = (PLAIN if at < plain_to else TOKEN).match(text, at)
        kind, raw = m.lastgroup, m.group()
        if kind in ("string", "long"):
            quote = min(i for i in (raw.find(c) for c in "\"'`") if i >= 0)
            mark = raw[quote:quote + (3 if kind == "long" else 1)]
            if len(raw) < quote + 2 * len(mark) or not raw.endswith(mark):  # not closed: what follows is no string
                plain_to = at + len(raw)
                out.append(Token("mark", at, at + quote + len(mark), raw[:quote + len(mark)]))
                at += quote + len(mark)
                continue
        if kind != "space":
            out.append(Token(kind, at, m.end(), raw))
        at = m.end()
    return out


def inside(token: Token) -> Literal:
    """The value of a string token."""
    quote = min(i for i in (token.text.find(c) for c in "\"'`") if i >= 0)
    lo, hi = quote + (3 if token.kind == "long" else 1), len(token.text) - (3 if token.kind == "long" else 1)
    return Literal(token.start + lo, token.start + hi, token.text[lo:hi])


def target(tokens: list[Token], i: int) -> str | None:
    """The name that the assignment at token ``i`` gives a value: ``name``, ``"name"``, ``name[]``, ``name["key"]``, ``name?``."""
    closing = 0
    for token in reversed(tokens[max(0, i - 4):i]):
        if token.kind in ("name", "flag"):
            return token.text.removeprefix("--")
        if token.kind == "string" and re.fullmatch(NAME, inside(token).value):
            return inside(token).value
        if token.kind != "mark" or token.text not in "]['\"?!*)" or token.text == ")" and closing:
            return None
        closing += 1
    return None


def expression(text: str, tokens: list[Token], i: int, pair: Pair) -> int:
    """Add the literals and names of the expression at token ``i`` to ``pair``; gives the token after it."""
    depth, value = 0, False  # whether the last token was a value, so that the next one must be joined to it
    first = i
    while i < len(tokens):
        token = tokens[i]
        if token.kind in ("string", "long"):
            literal = inside(token)
            if value and (tokens[i - 1].kind not in ("string", "long") or text.count("\n", tokens[i - 1].end, token.start) and not depth):
                break
            pair.literals.append(literal)
            pair.names += [a or b for a, b in TEMPLATE.findall(literal.value)]
            value = True
        elif token.kind == "line":
            if not depth and i > first and value:
                break
            if not depth and i == first:
                break
        elif token.kind in ("name", "number", "flag", "mark") and i == first and token.text not in ("(", "[", "{"):
            bare = BARE.match(text, token.start)
            if bare is None:
                break
            call = text[bare.end():bare.end() + 1] in ("(", "[")
            if token.kind == "name":
                pair.names.append(token.text)
            if not call and text[bare.end():bare.end() + 1] not in ("\"", "'", "`"):
                pair.literals.append(Literal(bare.start(), bare.end(), bare.group().rstrip(".:!?") or bare.group(), quoted=False))
            while i + 1 < len(tokens) and tokens[i + 1].start < bare.end():
                i += 1
            value = True
        elif token.kind in ("name", "number"):
            if value:
                break
            if token.kind == "name":
                pair.names.append(token.text)
            value = True
        elif token.kind == "mark" and token.text in "([":
            depth, value = depth + 1, False
        elif token.kind == "mark" and token.text in ")]" and depth:
            depth, value = depth - 1, True
        elif token.kind == "mark" and (token.text in "+.&|?" or token.text == "," and depth):
            value = False
        elif token.kind == "mark" and token.text == "\\":
            pass
        elif token.kind == "assign" and depth:  # keyword arguments and entries are pairs of their own
            break
        else:
            break
        i += 1
    return i


def pairs(text: str) -> Iterator[Pair]:
    """Name and expression of every assignment of a text, in order."""
    tokens, i = lexed(text), 0
    while i < len(tokens):
        token = tokens[i]
        i += 1
        if token.kind == "tag":
            name, value = token.text[1:].split(">", 1)
            value = value[:value.rindex("</")]
            yield Pair(name, [Literal(token.start + len(name) + 2, token.start + len(name) + 2 + len(value), value)])
        elif token.kind == "flag" and i < len(tokens) and tokens[i].kind not in ("assign", "line", "flag") and text[token.end:token.end + 1] == " ":
            pair = Pair(token.text[2:])
            expression(text, tokens, i, pair)
            yield pair
        elif token.kind == "assign" and token.text in ("=", ":", ":=", "=>"):
            name = target(tokens, i - 1)
            if name is None:
                continue
            if token.text == ":" and i + 1 < len(tokens) and tokens[i].kind == "name" and tokens[i + 1].text == "=":
                i += 2  # a type stands between
            further = [name]
            while i + 1 < len(tokens) and tokens[i].kind == "name" and tokens[i + 1].text == "=":
                further.append(tokens[i].text)
                i += 2
            pair = Pair(name)
            expression(text, tokens, i, pair)  # looked through again afterwards: entries inside it are pairs too
            for each in further:
                yield Pair(each, pair.literals, pair.names)


def literals(text: str) -> set[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name and look like a secret."""
    known: dict[str, int] = {}
    nodes: list[tuple[list[Literal], list[int]]] = []
    roots: list[tuple[int, int]] = []
    for pair in pairs(text):
        before = [known.get(n, known.get(n.rsplit(".", 1)[-1])) for n in pair.names]
        for key in (pair.name, pair.name.rsplit(".", 1)[-1]):
            known[key] = len(nodes)
        weight = sensitivity(pair.name)
        if weight:
            roots.append((-weight, len(nodes)))
        nodes.append((pair.literals, [n for n in before if n is not None]))
    out, seen = set(), set()
    for weight, root in sorted(roots):  # the most sensitive first, so every assignment is visited once
        stack = [root]
        while stack:
            node = stack.pop()
            if node in seen:
                continue
            seen.add(node)
            own, before = nodes[node]
            out |= {(x.start, x.end) for x in own if score(-weight, x) >= THRESHOLD}
            stack += before
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three base patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def spans_of(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of a text."""
    text = text or ""
    base, lower = base_spans(text), text.lower()
    extra = [(a, 3, b) for a, b in literals(text)] if any(stem in lower for stem in STEMS) else []
    return base, sorted(base + extra)


def _report(text: str | None) -> tuple[int, int, int, str, str]:
    base, every = spans_of(text)
    counts = Counter(kind for _, kind, _ in base)
    return counts[0], counts[1], counts[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)


REPORT = T.StructType([T.StructField(name, T.LongType()) for name in ("n_assign", "n_access", "n_hex")]
                      + [T.StructField(name, T.StringType()) for name in ("base_sha256", "spans")])


@F.pandas_udf(REPORT)
def _scan(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_report(t) for t in texts], columns=REPORT.names)


def scan(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    return docs.select("doc_id", _scan("text").alias("x")).select("doc_id", "x.*")
