"""Secret scans: fixed patterns, bettered by assignment-aware lexing.

The base patterns find assignments to well-known names, access keys and long hex runs.  The lexer
then reads source and configuration syntax as name-value pairs, keeps which literals a name holds,
follows names used as values, and scores every literal that reaches a sensitively named target.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import rows_of

# The base patterns and the order of their kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
MIN_ASSIGNED = 6

#: Words of a target name and how strongly they speak for a secret.
NAME_SCORES = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3,
    "credential": 3, "credentials": 3, "bearer": 3, "privatekey": 3, "secretkey": 3, "accesskey": 3,
    "authorization": 2, "auth": 2, "pass": 2, "signature": 1, "key": 1, "api": 1, "private": 1,
    "access": 1, "client": 1, "signing": 1, "encryption": 1, "login": 1,
}
#: Score of name and literal together from which a literal is reported.
MIN_SCORE = 5
MIN_LITERAL = 8
PLACEHOLDERS = re.compile(r"(?i)example|changeme|placeholder|dummy|sample|your|xxx|\*\*\*|<.*>|\$\{|%\(|\{\{")

_NAME = r"[A-Za-z_][A-Za-z0-9_]*+(?:[.\-][A-Za-z_][A-Za-z0-9_]*+)*+"
_START = r"(?<![A-Za-z0-9_])(?<![A-Za-z0-9_][.\-])"  # not within a name
# A declared type: names with paths, up to three levels of arguments, references and unions.
_ARGUMENTS = r"[<\[][^<>\[\]=;\n]*+[>\]]"
for _ in range(2):
    _ARGUMENTS = rf"[<\[](?:[^<>\[\]=;\n]++|{_ARGUMENTS})*+[>\]]"
_ATOM = (
    r"[&*]*+(?:'[A-Za-z_]++[ \t]++)?(?:(?:mut|dyn|const|readonly|unique)[ \t]++)?"
    rf"[A-Za-z_][A-Za-z0-9_]*+(?:(?:\.|::)[A-Za-z_][A-Za-z0-9_]*+)*+(?:{_ARGUMENTS})*+[?!]?"
)
_TYPE = rf"{_ATOM}(?:[ \t]*+[|&][ \t]*+{_ATOM})*+"
_PAIR = re.compile(
    rf"{_START}({_NAME})(?:[\"']?\]?[?!]?[ \t]*+:[ \t]*+({_TYPE})[ \t]*+=(?![=>])"
    r"|[\"']?\]?[ \t]*(?::=|=>|=(?!=)|:(?![:/])))[ \t]*"
)
_STRING = re.compile(r"[bruf]{0,2}(?:\"((?:[^\"\\\n]|\\.)*+)\"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`)")
_REFERENCE = re.compile(rf"\$?\{{?({_NAME})\}}?(?![A-Za-z0-9_(\"'])")
_BARE = re.compile(r"[A-Za-z0-9+/_.=@!#%^&*~-]+")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*")
#: Types that hold text; another plain name before the equals sign may be the name assigned to.
TEXT_TYPES = frozenset(
    "str string String bytes bytearray ByteArray ByteString AnyStr Text LiteralString object Object any Any unknown "
    "CharSequence NSString Substring Data Final ClassVar auto char Character SecretStr SecretBytes".split()
)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping per kind."""
    spans = [
        (m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED
    ]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def name_score(name: str) -> int:
    """How sensitive the last part of a dotted name is; words are split at case and underscores."""
    last = re.split(r"[.\-]", name)[-1]
    words = [word.lower() for word in _PARTS.findall(last)]
    pairs = [a + b for a, b in zip(words, words[1:])]
    return sum(NAME_SCORES.get(word, 0) for word in {*words, *pairs})


def literal_score(value: str) -> int:
    """How much a literal looks like a secret: length, spread of characters and their classes."""
    if len(value) < MIN_LITERAL or any(c.isspace() for c in value) or PLACEHOLDERS.search(value):
        return 0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    classes = sum(
        any(test(c) for c in value)
        for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    )
    return (entropy >= 2.5) + (entropy >= 3.2) + (classes >= 2) + (classes >= 3) + (len(value) >= 16)


def assignments(text: str) -> Iterator[tuple[str, list[Span], list[Span]]]:
    """(name, literals, names used) of every name-value pair, in text order.

    A value is a sum of string literals and names, or one bare word of configuration syntax.
    Literals are (start, end, value) without their quotes, names (start, end, name).  A declaration
    ``name: type = value`` is one pair; in ``word: name = value`` the value goes to both.
    """
    for pair in _PAIR.finditer(text):
        at, literals, used = pair.end(), [], []
        while True:
            if (string := _STRING.match(text, at)) is not None:
                group = string.lastindex
                literals.append((string.start(group), string.end(group), string[group]))
                at = string.end()
            elif (name := _REFERENCE.match(text, at)) is not None and _whole(text, at, name):
                used.append((name.start(1), name.end(1), name[1]))
                at = name.end()
            else:
                bare = _BARE.match(text, at)
                if bare is not None and not literals and not used:
                    literals.append((bare.start(), bare.end(), bare[0]))
                break
            joined = _JOIN.match(text, at)
            if joined is None:
                break
            at = joined.end()
        if literals or used:
            if pair[2] and re.fullmatch(_NAME, pair[2]) and pair[2] not in TEXT_TYPES:
                yield pair[2], literals, used
            yield pair[1], literals, used


def _whole(text: str, at: int, name: re.Match) -> bool:
    """A name, not the beginning of a bare literal such as ``abc-12/3``."""
    bare = _BARE.match(text, at)
    return bare is None or bare.end() <= name.end()


class _Held:
    """What a name holds: its own literals, and what the names in its value held then."""

    __slots__ = ("literals", "others", "score", "joined")

    def __init__(self, literals: list[Span], others: list[_Held], joined: str):
        self.literals, self.others, self.score, self.joined = literals, others, 0, joined


def _is_secret(score: int, value: str) -> bool:
    strength = literal_score(value)
    return bool(strength) and score + strength >= MIN_SCORE


def lexed_spans(text: str) -> list[Span]:
    """(start, end, "literal") of the literals that reach a sensitive target.

    A holder is visited again only for a higher score, so chains of names cost their length.
    """
    held: dict[str, _Held] = {}
    found: set[Span] = set()
    for name, literals, used in assignments(text):
        joined = "".join(literal[2] for literal in literals) if len(literals) > 1 else ""
        # A name that holds nothing so far may be a bare literal of configuration syntax.
        literals = literals or [word for word in used if word[2] not in held]
        others = [held[word[2]] for word in used if word[2] in held]
        held[name] = holder = _Held(literals, others, joined)
        score = name_score(name)
        if score < 2:
            continue
        waiting = [holder]
        while waiting:
            holder = waiting.pop()
            if holder.score >= score:
                continue
            holder.score = score
            waiting += holder.others
            secret = [literal for literal in holder.literals if _is_secret(score, literal[2])]
            # Fragments that are none by themselves may be one secret together.
            if not secret and _is_secret(score, holder.joined):
                secret = [literal for literal in holder.literals if literal[2]]
            found.update((start, end, "literal") for start, end, _ in secret)
    return list(found)


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans); the lexer adds only what no base span covers."""
    order = lambda span: (span[0], KINDS.index(span[2]), span[1])
    base = sorted(base_spans(text), key=order)
    if "=" not in text and ":" not in text:
        return base, base
    starts, reach = [], []  # ends reached by the base spans up to each start
    for start, end, _ in base:
        starts.append(start)
        reach.append(max(end, reach[-1] if reach else 0))
    added = []
    for span in lexed_spans(text):
        at = bisect_right(starts, span[0])
        if not at or reach[at - 1] < span[1]:
            added.append(span)
    return base, sorted([*base, *added], key=order) if added else base


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(batches):
    for batch in batches:
        rows = []
        for (text,) in rows_of([batch], "text"):
            base, spans = all_spans(text or "")
            kinds = Counter(kind for _, _, kind in base)
            rows.append(
                (kinds["assign"], kinds["access"], kinds["hex"], _joined(base), [s[0] for s in spans],
                 [s[1] for s in spans], [s[2] for s in spans])
            )
        columns = list(zip(*rows)) if rows else [[]] * 7
        numbers = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), numbers, numbers, pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(values, kind) for values, kind in zip(columns, kinds)],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base", "starts", "ends", "kinds"],
        )


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Secrets of every document: ``doc_id``, counts of the base kinds, ``base`` (base spans as
    ``kind:start:end``), and ``starts``, ``ends``, ``kinds`` of all spans in text order.

    Offsets are code points, ends exclusive.  A null or empty text has no spans; rows that repeat
    an id are scanned each; an empty table gives an empty result; other columns are ignored; ids
    are longs.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, base string, "
        "starts array<long>, ends array<long>, kinds array<string>"
    )
    return texts.mapInArrow(_scan, schema)


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``."""
    spans = F.array_join(
        F.zip_with(
            "kinds",
            F.zip_with("starts", "ends", lambda s, e: F.concat(s.cast("string"), F.lit(":"), e.cast("string"))),
            lambda kind, place: F.concat(kind, F.lit(":"), place),
        ),
        ",",
    )
    return scan(docs, id_column, text_column).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"),
        spans.alias("spans"),
    )


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", mark: str = "[SECRET]"):
    """``docs`` with every span replaced by ``mark`` (overlapping spans as one)."""

    @F.pandas_udf("string")
    def cut(texts):
        return texts.map(lambda text: text if text is None else _redacted(text, mark))

    return docs.withColumn(text_column, cut(F.col(text_column)))


def _redacted(text: str, mark: str) -> str:
    out, at = [], 0
    for start, end, _ in all_spans(text)[1]:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]
