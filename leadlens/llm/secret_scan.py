"""Secret scans by lexing assignments: name-literal pairs, constants carried on, literals scored by their names.

Three base patterns give the kinds ``assign``, ``access`` and ``hex``. On top of them each text is lexed as source or
configuration: ``name = "literal"``, ``name: literal``, ``"name": "literal"``, ``export NAME=literal``, ``<name>literal</name>``
and ``set('name', 'literal')``. Names bound to a literal are constants of the text; ``a + b``, adjacent literals and ``${a}``
are folded with them. A literal is reported as ``literal`` (or ``constant``, where the value comes from another name's
literal) if its name says that it is sensitive and its form does not say that it is a placeholder or prose.

Spans are in code points with exclusive ends; spans added to the base ones never overlap one another, and add
characters that no base span covers. Names and literals may have any length. Values up to ``WHOLE`` characters are carried on as text;
longer ones as counts of their characters and both ends, which say the same of their form, so that ``a = a + a`` repeated doesn't
double a text each time; references in them are resolved part by part where they are written.
Null and empty texts have no spans; repeated rows are scanned alike; long texts are scanned whole, in time linear in
their length; input columns stay in ``row``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed

KINDS = ("assign", "access", "hex", "literal", "constant")

# The base patterns. A match counts if its group 2 (assign) or the whole match is long enough.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more of AKIA[A-Z0-9]+
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

#: Parts of names that make a literal sensitive, with weights.
SENSITIVE = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "token": 3, "apikey": 3, "credential": 3, "credentials": 3,
    "privatekey": 3, "accesskey": 3, "secretkey": 3, "authkey": 3, "signingkey": 3, "bearer": 3, "connectionstring": 3, "dsn": 2,
    "auth": 2, "authorization": 2, "key": 1, "pass": 2, "pin": 1, "salt": 1, "signature": 1, "session": 1, "cookie": 1, "hash": 1, "private": 1, "access": 1, "api": 1, "client": 1,
}
#: Name parts that say the literal is about a secret, not one.
HARMLESS = {"name", "file", "path", "url", "uri", "length", "size", "type", "field", "label", "id", "count", "expires", "expiry", "ttl", "limit", "policy", "prompt", "hint", "env", "header", "endpoint"}
PLACEHOLDER = re.compile(r"(?i)^(?:x{3,}|\*+|\.+|<.*>|\$\{?\w+\}?|%\w*%|changeme|example\w*|your\W?\w*|none|null|true|false|todo|test|dummy|placeholder|undefined|redacted|\[.*\])$")
#: A literal is reported from this score on.
REPORT_FROM = 4.0
#: Characters of both ends of a long value that are kept; more than any fixed form of ``PLACEHOLDER`` needs.
ENDS = 16

#: Values up to so many characters are carried on as text, longer ones as ``Long``.
WHOLE = 4000

# Runs are possessive: nothing that follows a name or a literal could begin inside it, so no character is tried twice for one.
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
_QUOTED = r"\"[^\"\\\n]*+(?:\\.[^\"\\\n]*+)*+\"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
_BARE = r"[^\s\"',;:(){}\[\]<>=+&|#]{4,}+(?![:=])"
_PART = rf"(?:{_QUOTED}|{_NAME})"
_PAIR = re.compile(
    rf"(?P<q>[\"']?)(?<![A-Za-z0-9_.\-])(?P<name>{_NAME})(?P=q)[\x20\t]*+(?::=|=>|[:=](?!=))[\x20\t]*"
    rf"(?P<value>(?:{_QUOTED})(?:[\x20\t]*+(?:\+[\x20\t]*+)?{_PART}(?![\x20\t]*[:=]))*|{_NAME}(?:[\x20\t]*\+[\x20\t]*{_PART})+|{_BARE})"
    rf"|<(?P<tag>{_NAME})>(?P<inner>[^<>\n]{{4,}}+)</(?P=tag)>"
    rf"|\(\s*(?P<set>[\"']{_NAME}[\"'])\s*,\s*(?P<given>{_QUOTED})\s*\)"
)
_PIECE = re.compile(rf"(?P<text>{_QUOTED})|(?P<name>{_NAME})")
_REFER = re.compile(r"\$\{(\w+)\}|\{\{\s*(\w+)\s*\}\}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base patterns, each leftmost and without overlaps of its kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def name_score(name: str) -> float:
    """How much a name says that its value is a secret."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]
    score = float(sum(SENSITIVE.get(p, 0) for p in parts) + sum(SENSITIVE.get(a + b, 0) for a, b in zip(parts, parts[1:])))
    if parts and parts[-1] in HARMLESS:
        score -= 3
    return score


@dataclass(frozen=True)
class Long:
    """What ``literal_score`` needs of a long value: characters by first place, both ends, and spaces in the blanks at the ends."""

    length: int
    counts: Counter
    head: str
    tail: str
    lead: int
    trail: int

    @staticmethod
    def of(value: str) -> "Long":
        spaces = value.count(" ")
        lead, trail = spaces - value.lstrip().count(" "), spaces - value.rstrip().count(" ")
        return Long(len(value), Counter(value), value[:ENDS], value[-ENDS:], lead, trail)

    @staticmethod
    def joined(parts: "list[str | Long]") -> "Long":
        """Of the parts one after the other; one step a part and distinct character of it."""
        counts, length, head, tail, lead, trail, blank = Counter(), 0, "", "", 0, 0, True
        for part in parts:
            x = Long.of(part) if isinstance(part, str) else part
            alone = not any(not c.isspace() for c in x.counts)
            head += x.head[: ENDS - len(head)]
            tail = (tail + x.tail)[-ENDS:]
            lead += x.lead if blank else 0
            trail = trail + x.trail if alone else x.trail
            blank = blank and alone
            for c, n in x.counts.items():
                counts[c] += n
            length += x.length
        return Long(length, counts, head, tail, lead, trail)

    def short(self) -> str:
        """A value with these ends and the same characters between, each once: ``PLACEHOLDER`` fits it where it fits the whole."""
        ends = Counter(self.head + self.tail)
        return self.head + "".join(c for c, n in self.counts.items() if n > ends[c]) + self.tail


def literal_score(value: "str | Long") -> float:
    """How much a value looks generated: length, mixed classes and entropy; very low for placeholders and prose."""
    if isinstance(value, Long):
        size, counts, form = value.length, value.counts, value.short()
        prose = any(not c.isspace() for c in counts) and counts[" "] > value.lead + value.trail
    else:
        size, counts, form, prose = len(value), Counter(value), value, " " in value.strip()
    if size < 6 or PLACEHOLDER.match(form) or prose:
        return -10.0
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    classes = sum(bool(re.search(c, form)) for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(size, 32) / 16 + (entropy - 2.0) / 2 + (classes - 1) * 0.75


def pairs(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(name, value expression, start, end) of each assignment; the span is the value's."""
    for m in _PAIR.finditer(text):
        for name, value in (("name", "value"), ("tag", "inner"), ("set", "given")):
            if m[name] is not None:
                yield m[name].strip("\"'"), m[value], m.start(value), m.end(value)
                break


def _joined(parts: "list[str | Long]") -> "str | Long":
    """One text where that isn't long or isn't made of parts."""
    if len(parts) == 1:
        return parts[0]
    size = sum(len(x) if isinstance(x, str) else x.length for x in parts)
    return "".join(parts) if size <= WHOLE else Long.joined(parts)


def _referred(value: str, constants: "dict[str, str | Long]") -> "tuple[list[str | Long], bool]":
    """The parts of a text with its references to constants put in, and whether there are any."""
    parts, at, carried = [], 0, False
    for m in _REFER.finditer(value) if "{" in value else ():
        known = constants.get(m[1] or m[2])
        if known is not None:
            parts += [value[at : m.start()], known]
            at, carried = m.end(), True
    return ([x for x in [*parts, value[at:]] if not isinstance(x, str) or x] or [""]) if carried else [value], carried


def _fold(value: str, constants: "dict[str, str | Long]") -> "tuple[str | Long, bool]":
    """The text of a value expression, and whether a constant went into it."""
    if value[0] not in "\"'" and "+" not in value:
        if value in constants:
            return constants[value], True
        parts, carried = [value], False
    else:
        parts, carried = [], False
        for m in _PIECE.finditer(value):
            if m["text"]:
                parts.append(m["text"][1:-1])
            elif m["name"] in constants:
                parts.append(constants[m["name"]])
                carried = True
    plain = _joined(parts or [""])
    out: list[str | Long] = []
    for part in [plain] if isinstance(plain, str) else parts:
        put, more = _referred(part, constants) if isinstance(part, str) else ([part], False)
        out += put
        carried = carried or more
    return _joined(out), carried


def lexed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of sensitive literals that assignments give, constants carried on in text order."""
    if "=" not in text and ":" not in text and "<" not in text and "(" not in text:
        return []
    constants: dict[str, str | Long] = {}
    where: dict[str, tuple[int, int]] = {}
    out: set[tuple[int, int, str]] = set()
    for name, value, start, end in pairs(text):
        plain, carried = _fold(value, constants)
        if re.fullmatch(_QUOTED, value):
            start, end = start + 1, end - 1  # without the quotes
        constants[name] = Long.of(plain) if isinstance(plain, str) and len(plain) > WHOLE else plain
        if not carried:
            where[name] = (start, end)
        by_name = name_score(name)
        if by_name >= 2 and by_name + literal_score(plain) >= REPORT_FROM:
            out.add((start, end, "constant" if carried else "literal"))
            if carried:  # the literals that the value is made of
                out.update((*where[part], "literal") for part in re.findall(_NAME, value) if part in where)
    return sorted(out)


def scan(text: str) -> list[tuple[int, int, str]]:
    """All spans of one text: the base ones, and lexed ones that the base ones don't cover."""
    base = base_spans(text)
    lexed = lexed_spans(text)
    if not lexed:
        return base
    joined: list[list[int]] = []
    for start, end in sorted((s, e) for s, e, _ in base):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    out, k, last = list(base), 0, 0
    for start, end, kind in lexed:
        while k < len(joined) and joined[k][1] <= start:
            k += 1
        covered = k < len(joined) and joined[k][0] <= start and end <= joined[k][1]
        if start >= last and not covered:
            out.append((start, end, kind))
            last = end
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def masked(text: str, spans: list[tuple[int, int, str]], mask: str = "[SECRET]") -> str:
    """The text with each stretch covered by spans replaced once."""
    out, at, stop = [], 0, -1
    for start, end, _ in spans:
        if start >= stop:
            if stop >= 0:
                out += [mask]
                at = stop
            out.append(text[at:start])
            stop = end
        else:
            stop = max(stop, end)
    if stop < 0:
        return text
    return "".join([*out, mask, text[stop:]])


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))


@F.pandas_udf(SPANS)
def _scan(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"start": s, "end": e, "kind": k} for s, e, k in scan(t)] for t in texts])


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series) -> pd.Series:
    return pd.Series([masked(t, scan(t)) if t else t for t in texts])


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` and ``spans`` (start, end, kind; by start, then kind) of each row."""
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    return packed(docs).select("row", _scan(whole).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` masked; null texts stay null."""
    return docs.select(*[(_masked(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns])
