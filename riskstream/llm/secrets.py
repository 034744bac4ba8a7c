"""Secret scans: patterns, and lexing of assignments with constants propagated to sensitive names."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Rows, rows_of, schema_of, whole

#: The base patterns in the order of their kinds, and the least length of what they must give: fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: How sensitive a part of a target's name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 0.9,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "private": 0.6, "key": 0.5, "access": 0.4, "signing": 0.4,
    "bearer": 0.8, "salt": 0.5,
}
LEAST_SCORE = 0.75
#: A value of fewer characters is no secret. A word of letters alone that has fewer than BARE_LENGTH is read as a name,
#: but where it is all that a line name=word assigns, as in files of settings.
LEAST_LENGTH, BARE_LENGTH = 6, 16
_STEMS = re.compile(rb"passw|pwd|passphrase|secret|token|credential|auth|private|key|bearer|salt")
_BASE_STEMS = re.compile(rb"password|passwd|secret|token|api_?key")

#: Calls that look a value up by their first argument; what follows is the value if there is none.
LOOKUPS = ("getenv", "get", "getOrDefault", "getProperty", "env", "fetch", "setdefault")

_SUBSCRIPTS = r"""(?:\[[ \t]*+(?:"[^"\n]*+"|'[^'\n]*+')[ \t]*+\])"""
_TYPE = r"""[A-Za-z_][A-Za-z0-9_.]*+(?:\[[^\]\n]*+\]|<[^>\n]*+>)?+\??+(?:[ \t]*+\|[ \t]*+[A-Za-z_][A-Za-z0-9_.]*+)*+"""
#: The target of an assignment and its operator: a name, which may be quoted, or have subscripts or a type. A name is tried
#: from the edge of its word only, so that names and blanks of any length are read in linear time.
_PAIR = re.compile(
    rf"""(?P<q>["']?)(?<![A-Za-z0-9_.-])[0-9.-]*+(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)(?P=q)(?P<at>{_SUBSCRIPTS}*+)"""
    rf"""(?:[ \t]*+:(?!:)[ \t]*+{_TYPE}(?=[ \t]++=(?![=>])))?+"""
    r"""[ \t]*+(?P<op>:=|=>|=(?!=)|:(?!:))[ \t]*+(?=["'`A-Za-z0-9+/_.$(\[|>-])"""
)
#: A literal, with the letters that may stand before its quotes, or a word.
_TERM = re.compile(
    r"""(?:[A-Za-z]{1,2}(?=["'`]))?+(?:\"""(?P<t>(?s:.*?))\"""|\'\'\'(?P<u>(?s:.*?))\'\'\'|"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)'"""
    r"""|`(?P<k>(?:[^`\\]|\\(?s:.))*+)`)|\$\{?(?P<var>[A-Za-z_]\w*)\}?|(?P<bare>[A-Za-z0-9+/_.=-]+)"""
)
_PLUS = re.compile(r"[ \t]*+(?:\+|\.\.)[ \t]*+")
_MORE_SUBSCRIPTS = re.compile(_SUBSCRIPTS + "++")
_SUBSCRIPT = re.compile(r"""["']([^"'\n]*)["']""")
_FIRST_ARGUMENT = re.compile(r"""\(\s*+(?:"[^"\n]*+"|'[^'\n]*+'|[\w.]++)\s*+,""")
_ROOM, _BLANKS = re.compile(r"\s*+"), re.compile(r"[ \t]*+")
_COMMA = re.compile(r"[ \t]*+,[ \t]*+")
_NAMES_BEFORE = re.compile(r"[ \t]*(?:[A-Za-z_][A-Za-z0-9_.]*[ \t]*,[ \t]*)+")
_BLOCK = re.compile(r"[|>][0-9+-]*+[ \t]*+\r?\n")
_LINE = re.compile(r"([ \t]*+)([^\r\n]*+)\r?\n?")
_TAG = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)(?:[ \t][^<>\n]*+)?+>(?P<value>[^<>]*+)</(?P=name)[ \t]*+>")
_SPACE = re.compile(r"\s")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, place of the kind) of the base patterns, in code points, end exclusive, by start and kind."""
    spans = []
    raw = text.encode("utf-8", "surrogatepass").lower()
    if _BASE_STEMS.search(raw):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def name_score(name: str) -> float:
    """How sensitive a target's name is, from 0 to 1: its parts' values as independent hints."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    parts += [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return 1 - math.prod(1 - SENSITIVE.get(p, 0.0) for p in set(parts))


def _character_counts(literal: str) -> Counter[int]:
    """How often characters stand in a literal; those beyond ASCII share the 128 places by code point."""
    counts: Counter[int] = Counter()
    for c, n in Counter(literal).items():
        counts[ord(c) % 128] += n
    return counts


def literal_score(counts: Counter[int], spaced: bool) -> float:
    """How much a literal looks like a secret, from 0 to 1: by length, and by entropy of its characters."""
    length = counts.total()
    if length < LEAST_LENGTH or spaced:
        return 0.0
    entropy = -sum(n / length * math.log2(n / length) for n in counts.values())
    return min(length, 16) / 16 * min(1.0, entropy / 3)


@dataclass(slots=True)
class _Value:
    """What was assigned to a name: its literals and the earlier values that it is made of."""

    spans: list[tuple[int, int]]
    parts: list[_Value]
    counts: Counter[int]
    spaced: bool
    score: float = 0.0
    fresh: bool = False


def _value(text: str, spans: list[tuple[int, int]], parts: list[_Value], fresh: bool = False) -> _Value:
    """The value joined of these literals and earlier values; a value of over 2**40 characters keeps their shares only."""
    counts: Counter[int] = Counter()
    for more in [*(_character_counts(text[s:e]) for s, e in spans), *(p.counts for p in parts)]:
        counts.update(more)
    if counts.total() > 1 << 40:
        counts = Counter({c: max(1, n >> 20) for c, n in counts.items()})
    spaced = any(_SPACE.search(text, s, e) for s, e in spans) or any(p.spaced for p in parts)
    return _Value(spans, parts, counts, spaced, fresh=fresh)


def _path(name: str, subscripts: str | None) -> str:
    """A name and its quoted subscripts as one path: cfg["k"] is cfg.k."""
    return ".".join([name, *_SUBSCRIPT.findall(subscripts or "")])


class _Reader:
    """Reads the assignments of a text, in order. `values` are made of literals and of earlier values."""

    def __init__(self, text: str, bare_length: int):
        self.text, self.bare_length = text, bare_length
        self.constants: dict[str, _Value] = {}
        self.values: list[_Value] = []

    def read(self) -> None:
        end = 0
        for pair in _PAIR.finditer(self.text):
            names = self._names_before(pair, end) if pair["op"] == "=" else []
            end = pair.end()
            if pair["op"] == ":" and (head := _BLOCK.match(self.text, end)):
                found = [([], self._lines(head.end(), pair.start()))]
            else:
                found, at = [], end
                for n in range(len(names) + 1):
                    if n:
                        if not (comma := _COMMA.match(self.text, at)):
                            break
                        at = comma.end()
                    spans, parts, at = self._value(at, pair)
                    found.append((spans, parts))
            own = pair["name"] if not pair["at"] else _SUBSCRIPT.findall(pair["at"])[-1]
            targets = [(n, n) for n in names] if len(found) == len(names) + 1 else []
            for (name, path), (spans, parts) in zip([*targets, (own, _path(pair["name"], pair["at"]))], found, strict=False):
                self._assign(name, path, spans, parts)
        for tag in _TAG.finditer(self.text):
            self._assign(tag["name"], tag["name"], *self._literal(*tag.span("value")))

    def _assign(self, name: str, path: str, spans: list[tuple[int, int]], parts: list[_Value]) -> None:
        sensitive = name_score(name)
        for value in [*(p for p in parts if p.fresh), _value(self.text, spans, parts)]:
            value.fresh = False
            value.score = max(value.score, sensitive * literal_score(value.counts, value.spaced) ** 0.5) if sensitive else value.score
            self.values.append(value)
        self.constants[path] = self.values[-1]

    def _names_before(self, pair: re.Match, end: int) -> list[str]:
        """The other targets of a, b = ...; they stand on its line, after what was read before."""
        at = pair.start()
        while at > end and self.text[at - 1] in " \t":
            at -= 1
        if at == end or self.text[at - 1] != ",":
            return []
        first = max(self.text.rfind("\n", end, at) + 1, end)
        if not _NAMES_BEFORE.fullmatch(self.text, first, pair.start()):
            return []
        return [name.strip() for name in self.text[first:at].split(",")[:-1]]

    def _literal(self, start: int, end: int) -> tuple[list[tuple[int, int]], list[_Value]]:
        """A literal that ends on its line is a span; lines of a longer one are values of their own."""
        if "\n" not in self.text[start:end]:
            return [(start, end)], []
        while start < end and self.text[start].isspace():
            start += 1
        while end > start and self.text[end - 1].isspace():
            end -= 1
        if "\n" not in self.text[start:end]:
            return [(start, end)], []
        lines, at = [], start
        while at < end:
            line = _LINE.match(self.text, at, end)
            if line[2].strip():
                lines.append(_value(self.text, [(line.start(2), line.start(2) + len(line[2].rstrip()))], [], fresh=True))
            at = max(line.end(), at + 1)
        return [], lines

    def _lines(self, at: int, target: int) -> list[_Value]:
        """The lines of a block, which are those that stand deeper than the line of their name."""
        begin = self.text.rfind("\n", 0, target) + 1
        depth = _BLANKS.match(self.text, begin).end() - begin
        lines = []
        while at < len(self.text):
            line = _LINE.match(self.text, at)
            if line[2].strip():
                if len(line[1]) <= depth:
                    break
                lines.append(_value(self.text, [(line.start(2), line.start(2) + len(line[2].rstrip()))], [], fresh=True))
            at = max(line.end(), at + 1)
        return lines

    def _value(self, at: int, pair: re.Match) -> tuple[list[tuple[int, int]], list[_Value], int]:
        """The literals and values from a place on, and where they end: terms joined by +, in brackets, or as what a
        lookup gives if it finds nothing."""
        text, start = self.text, at
        spans: list[tuple[int, int]] = []
        parts: list[_Value] = []
        depth, due = 0, True
        while True:
            if depth:
                at = _ROOM.match(text, at).end()
            c = text[at : at + 1]
            if due and c in ("(", "["):
                depth, at = depth + 1, at + 1
            elif depth and c in (")", "]"):
                depth, at, due = depth - 1, at + 1, False
            elif depth and c == ",":
                at, due = at + 1, True
            elif not due:
                if not (plus := _PLUS.match(text, at)):
                    break
                at, due = plus.end(), True
            elif term := _TERM.match(text, at):
                at, due = term.end(), False
                name = term["var"] or term["bare"]
                if name is None:
                    more, lines = self._literal(*next(term.span(g) for g in "tudsk" if term[g] is not None))
                    spans += more
                    parts += lines
                elif text.startswith("(", at) and term["bare"]:
                    if name.rsplit(".", 1)[-1] not in LOOKUPS or not (first := _FIRST_ARGUMENT.match(text, at)):
                        break
                    depth, at, due = depth + 1, first.end(), True
                else:
                    if more := _MORE_SUBSCRIPTS.match(text, at):
                        at = more.end()
                    path = _path(name, more and more[0])
                    if path in self.constants:
                        parts.append(self.constants[path])
                    elif term["bare"] and not more and (not self._is_name(name) or self._is_line(pair, start, at)):
                        spans.append(term.span("bare"))
            else:
                break
        return spans, parts, at

    def _is_name(self, word: str) -> bool:
        return bool(_NAME.match(word)) and len(word) < self.bare_length and not re.search(r"\d", word)

    def _is_line(self, pair: re.Match, start: int, end: int) -> bool:
        """Whether a line is name=word and nothing else."""
        text = self.text
        return (
            pair["op"] == "=" and pair.end("name") == start - 1
            and text[pair.start() - 1 : pair.start()] in ("", "\n") and text[end : end + 1] in ("", "\n", "\r")
        )


def literal_spans(text: str, least_score: float = LEAST_SCORE, bare_length: int = BARE_LENGTH) -> list[tuple[int, int, int]]:
    """Spans of literals that reach a sensitive name by assignment.

    The text is read as assignments of terms: quoted literals (also with
    prefixes, over several lines, or in back quotes), bare words and names,
    joined by + or in brackets, what a lookup gives if it finds nothing, blocks
    of indented lines, and what stands between tags; with any number of blanks
    between. The target is a name of any length, which may have a type, the last
    quoted subscript of one, or one of several names that get a value each. A name or path that was
    assigned before stands for its literals, so key = "..."; password = key
    finds the literal of key; other calls and names stand for none. A bare word
    of letters that is shorter than `bare_length` is a name, unless its line is name=word. A
    literal's score is that of its most sensitive name, weighted with how much
    the value that it is part of looks like a secret; lines of a longer literal
    are scored one by one. A value refers to those it is made of, and scores go back over these
    references in one pass, so the work follows the text's length and no literal is left out.
    """
    reader = _Reader(text, bare_length)
    reader.read()
    scores: dict[tuple[int, int], float] = {}
    for value in reversed(reader.values):  # a value is made of earlier ones only, so its score is final when it is passed on
        for part in value.parts:
            part.score = max(part.score, value.score)
        for span in value.spans:
            scores[span] = max(scores.get(span, 0.0), value.score)
    return sorted((s, e, 3) for (s, e), score in scores.items() if score >= least_score)


def scan_text(text: str, least_score: float = LEAST_SCORE) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and all spans."""
    base = base_spans(text)
    more = []
    if ("=" in text or ":" in text or "</" in text) and _STEMS.search(text.encode("utf-8", "surrogatepass").lower()):
        more = literal_spans(text, least_score)
    return base, sorted(base + more, key=lambda s: (s[0], s[2], s[1]))


def secret_scan(docs: DataFrame, least_score: float = LEAST_SCORE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, base and spans, arrays of (kind, start, end).

    Offsets are code points, end exclusive, sorted by start and then by kind.
    base has the spans of the base patterns, spans also those of literals whose
    target's name is sensitive. Null and empty texts have none. Rows are read
    one by one and whole, so repeated rows, ids and ties need no rule; an empty
    table gives no rows, other columns are ignored.
    """
    out = "doc_id long, base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("base", kind), ("spans", kind)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        named = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans]
        for key, body in rows_of(batches):
            base, spans = scan_text(body, least_score)
            rows.add((key, named(base), named(spans)), 48 * len(spans))
            if rows.full():
                yield rows.take()
        yield rows.take()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).mapInArrow(scan, schema_of(out))


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans from the result of secret_scan()."""
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"),
    )
