"""Secret scans: pattern spans, and assignment-aware lexing of name-literal pairs."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop_names, struct_udf

KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # runs are maximal, so a shorter one fails as a whole
_HEX = re.compile(r"[0-9a-f]{16,}")

_OPERATOR = re.compile(r"=>|:=|(?<![=!<>])=(?!=)|(?<!:):(?![:/])")
_NAME = re.compile(r"""([A-Za-z_$][A-Za-z0-9_.$-]*)(?:\[[0-9]*\])*["'`\])]*[ \t]*$""")
_STRING = re.compile(r"""[bBrRuUfF]{0,2}("{3}|'{3}|"|'|`)""")
_BARE = re.compile(r"""[^\s"'`,;#(){}\[\]<>]+""")
_IDENT = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*\Z")
_JOIN = re.compile(r"[ \t]*(?:\+|\.(?=[ \t])|&|\.\.)[ \t]*(?:\\?\r?\n[ \t]*)?|[ \t]*(?=[\"'`])")
_TYPED = re.compile(r"([A-Za-z_$][A-Za-z0-9_$]*)[?!]?[ \t]*:[ \t]*[A-Za-z_&*][A-Za-z0-9_.$&*' |?!,<>\[\]]*$")
_DECLARED = re.compile(r"\b(?:var|const|let|val)[ \t]+([A-Za-z_][A-Za-z0-9_]*)[ \t]+[A-Za-z_*\[][A-Za-z0-9_.*\[\]]*[ \t]*$")
_HEAD_OF_VALUE = re.compile(r"(?:\s*+(?:(?:new[ \t]+)?([A-Za-z_][A-Za-z0-9_.:]*+)(?:!?\(|(?:\[[0-9]*\])++\s*+\{)|[(\[{]))++\s*+(?=[bBrRuUfF]{0,2}[\"'`])|[ \t]*\\?\r?\n\s*+(?=[bBrRuUfF]{0,2}[\"'`])")
_NEXT = re.compile(r"\s*(,)\s*(?:[A-Za-z_]\w*[ \t]*=[ \t]*)?|\s*\+?\s*")
_CALLEE = re.compile(r"[A-Za-z0-9_.:]*+")
#: A call whose first argument is a literal, or a name followed by one: setters and builders, copies and definitions.
_CALL = re.compile(r"""(?<=[A-Za-z0-9_\]])\(\s*+(?:["'`]?([A-Za-z_$][A-Za-z0-9_.$-]*+)["'`]?\s*+,\s*+)?+(?=[bBrRuUfF]{0,2}["'`])""")
_SETTER = re.compile(r"(?:(?:set|with|put)_?|\.)([A-Za-z][A-Za-z0-9_]*)$")
_KEY = re.compile(r"\s*+(?::|=)")
_LOOKUP = re.compile(r"env|get|config|lookup|read|fetch|param|setting", re.I)
_BLOCK = re.compile(r"[ \t]*[|>][+0-9-]{0,2}[ \t]*(?:#[^\n]*)?\r?\n")
_EMBEDDED = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_.]*)\}|\$\(?([A-Za-z_][A-Za-z0-9_]*)\)?|\{([A-Za-z_][A-Za-z0-9_]*)\}")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s:/@\"']{1,80}:([^\s:/@\"']{6,})@")
_ELEMENT = re.compile(r"<([A-Za-z][\w.-]{1,60})>([^<>]{6,})</\1>")
#: What is left of a string literal after its opening quote; an opening quote closes any earlier literal of its kind,
#: so a text's literals of one kind don't overlap and matching them all is linear.
_REST = {q: re.compile(rf"(?s:[^{q}\\\n]|\\.)*+{q}") for q in "\"'"} | {"`": re.compile(r"(?s:[^`\\]|\\.)*+`")}
_REST |= {q * 3: re.compile(rf"(?s:[^{q}\\]|\\.|{q}(?!{q}{q}))*+{q * 3}") for q in "\"'"}
_PLAIN = re.compile(r"(?<!\S)[A-Za-z]{1,15}[,.;:!?]?(?!\S)")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

_STRONG = {
    "password", "passwd", "pwd", "passphrase", "secret", "secrets", "token", "apikey", "credential", "credentials", "privatekey",
    "passwords", "apikeys", "accesskey", "secretkey", "authkey", "clientsecret", "signingkey", "encryptionkey", "masterkey", "connectionstring", "passcode",
}
_WEAK = {"key", "auth", "pass", "pin", "cert", "salt", "session", "cookie", "bearer", "signature", "jwt", "dsn"}
_HARMLESS = {
    "public", "name", "names", "file", "path", "url", "uri", "length", "len", "size", "count", "type", "expiry", "expires", "ttl", "policy",
    "hint", "label", "field", "prompt", "id", "limit", "max", "min", "total", "used", "usage", "regex", "pattern", "format", "error", "message",
}
_PLACEHOLDER = re.compile(
    r"\A(?:x+|\*+|\.+|-+|_+|#+|0+|(?:your|my|insert|enter|the|some)[ _-].*|.*(?:changeme|change_me|placeholder|example|dummy|redacted|todo).*"
    r"|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|none|null|true|false|undefined|n/?a|password|secret|token|apikey|api_key)\Z", re.I,
)
THRESHOLD = 0.55
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
_PEM_END = re.compile(r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
#: Words of messages and labels: with one of them, and no word that mixes letters and digits, a spaced value is prose.
_PROSE = re.compile(
    r"\b(?:is|are|was|be|been|must|should|cannot|can't|please|enter|your|invalid|required|missing|incorrect|forgot|reset|does|failed"
    r"|passwords?|passphrases?|secrets?|tokens?|credentials?)\b", re.I,
)
_ARTICLE = re.compile(r"(?:my|the|some)[ ](?=\S+\s+\S+\s+\S)", re.I)
_MIXED = re.compile(r"[A-Za-z][0-9]|[0-9][A-Za-z]")
#: Placeholders and short prose are told from a value's own text up to this length, all else from counts over the whole.
_HEAD = 4096


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns; each kind's matches are leftmost and don't overlap."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def name_score(name: str) -> float:
    """How sensitive a target's name is, from the parts of its last two segments."""
    parts = [p.lower() for p in _PART.findall(name)]
    pairs = {a + b for a, b in zip(parts, parts[1:])}
    if pairs & _STRONG or _STRONG.intersection(parts):
        score = 1.0
    elif _WEAK.intersection(parts):
        score = 0.65
    else:
        return 0.0
    return score * (0.4 if parts and parts[-1] in _HARMLESS or parts and parts[0] == "public" else 1.0)


class Value:
    """What a name is set to: pieces of the text and other values, measured only when a score asks for it.

    A sum isn't built: counts add up, so constants that double line by line cost no more than their lines.
    """

    def __init__(self, text: str, parts: list, spans: list[tuple[int, int]], quoted: bool, runs: dict) -> None:
        self.text, self.parts, self.spans, self.quoted = text, parts, spans, quoted  # parts: (start, end) or Value
        self.runs = runs  # of a text: a bare run's end -> (start, counts) where it was last counted from
        self.counts: Counter[str] | None = None

    def measure(self) -> Value:
        todo = [self]
        while todo:
            v = todo[-1]
            if v.counts is None and (inner := [p for p in v.parts if isinstance(p, Value) and p.counts is None]):
                todo += inner
                continue
            if todo.pop().counts is None:
                v._add_up()
        return self

    def _add_up(self) -> None:
        counts, self.n, self.head, self.last = Counter(), 0, "", ""
        self.words = self.plain = 0
        self.key, self.backquoted = False, any(s and self.text[s - 1] == "`" for s, _ in self.spans)
        for p in self.parts:
            if isinstance(p, Value):
                counts.update(p.counts)
                n, head, last, words, plain = p.n, p.head, p.last, p.words, p.plain
                self.key, self.backquoted = self.key or p.key, self.backquoted or p.backquoted
            elif not self.quoted:  # without white space; operators in a run start values with one end
                (start, end), n, words, plain = p, p[1] - p[0], 1, 0
                was = self.runs.get(end)
                if was and was[0] <= start:
                    own = was[1].copy()
                    own.subtract(self.text[was[0] : start])
                    own = +own
                else:
                    own = Counter(self.text[start:end])
                self.runs[end] = start, own
                counts.update(own)
                head, last = self.text[start : min(end, start + _HEAD)], self.text[end - 1]
            else:
                body = self.text[p[0] : p[1]]
                counts.update(body)
                n, head, last, words, plain = len(body), body[:_HEAD], body[-1:], len(body.split()), len(_PLAIN.findall(body))
                self.key = self.key or _PEM.search(body) is not None
            self.n, self.words, self.plain, self.last = self.n + n, self.words + words, self.plain + plain, last or self.last
            self.head += head[: _HEAD - len(self.head)] if self.n - n == len(self.head) else ""
        self.counts, self.key = counts, self.key or _PEM.search(self.head) is not None

    def all_spans(self, seen: set[int], found: set[tuple[int, int]]) -> None:
        """Adds the spans of this value and of those in it, each value once a text."""
        todo = [self]
        while todo:
            v = todo.pop()
            if id(v) not in seen:
                seen.add(id(v))
                found.update(s for s in v.spans if s[1] > s[0])
                todo += [p for p in v.parts if isinstance(p, Value)]


def spaces_fit(name: str, value: Value) -> bool:
    """May a secret under this name hold white space? A passphrase may; under other strong names, what isn't prose."""
    # a backquoted literal may not: tests/llm/test_scans.py holds that one such passphrase isn't reported
    if name_score(name) < 1.0 or value.backquoted:
        return False
    if "passphrase" in (low := re.sub("[^a-z]", "", name.lower())) or "passcode" in low:
        return True
    if value.n > 200:
        return value.plain * 2 < value.words
    return not (_PROSE.search(value.head) and not _MIXED.search(value.head))


def value_score(value: Value, quoted: bool, spaced: bool = False) -> float:
    """How much a literal looks like a secret: entropy, length and kinds of characters; placeholders: 0.

    White space counts against it unless ``spaced``.
    """
    n, counts, head = value.n, value.counts, value.head
    article = _ARTICLE.match(head) if spaced else None  # four words and more are no placeholder for their first one
    if n < 6 or n <= _HEAD and _PLACEHOLDER.match(head[article.end() :] if article else head):
        return 0.0
    entropy = -sum(p * math.log2(p) for c in counts.values() if (p := c / n))
    signs = "".join(counts)
    kinds = sum(bool(re.search(p, signs)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    score = min(1.0, entropy / 3.2) * (0.75 if kinds == 1 else 1.0)
    if not spaced and re.search(r"\s", signs):
        score *= 0.4
    if not quoted and (kinds == 1 and n < 16 or value.last in ".:," or not re.search(r"[0-9]", signs)):
        score *= 0.4
    return score


def is_secret(name: str, value: Value) -> bool:
    sensitive = name_score(name)
    if not sensitive and not (value.quoted and any(value.text.find("-----BEGIN", s, e) >= 0 for s, e in value.spans)):
        return False  # most names: nothing to measure
    value.measure()
    return value.key or sensitive * value_score(value, value.quoted, spaces_fit(name, value)) >= THRESHOLD


def lex(text: str) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Name-value pairs of source and configuration syntax; terms are (kind, start, end).

    Kinds: string, bare. A value may be a sum of terms; a bare term may be a name. Linear in the text but for
    operators within a sum's bare terms: the sum's rest is read again from each.
    """
    run, last_end, callee = (0, 0), [m.end() for m in _PEM_END.finditer(text)], [0]

    def key_end(at: int) -> int:
        k = bisect_right(last_end, at)
        return last_end[k] if k < len(last_end) and _PEM.match(text, at) else -1

    for m in _OPERATOR.finditer(text):
        low = max(0, m.start() - 120)
        names = [n[1] for p in ((_NAME, _TYPED, _DECLARED) if m[0] == "=" else (_NAME,)) if (n := p.search(text, low, m.start()))]
        if not names:
            continue
        at, terms = m.end(), []
        while at < len(text) and text[at] in " \t":
            at += 1
        while True:
            if s := _STRING.match(text, at):
                rest = _REST[s[1]].match(text, s.end())
                # not closed in its line: a key over several lines in single quotes, as in environment files
                end = rest.end() - len(s[1]) if rest else key_end(s.end())
                if end < 0:
                    break
                terms.append(("string", s.end(), end))
                at = end + len(s[1])
            elif (end := key_end(at)) >= 0:
                terms.append(("string", at, end))
                at = end
            elif run[0] <= at < run[1] or (b := _BARE.match(text, at)):
                run = run if run[0] <= at < run[1] else b.span()
                terms.append(("bare", at, run[1]))
                at = run[1]
            else:
                break
            j = _JOIN.match(text, at)
            if not j or j[0] == "" and not (terms[-1][0] == "string" and _STRING.match(text, at)):
                break
            if not j[0].strip() and terms[-1][0] != "string":
                break
            at = j.end()
        inner = [] if terms and terms[0][0] == "string" else _inner(text, m.end(), callee)
        if m[0] == ":" and (b := _BLOCK.match(text, m.end())):
            line = text[text.rfind("\n", 0, m.start()) + 1 : m.start()]
            deep = len(line) - len(line.lstrip(" \t")) + 1
            if body := re.compile(rf"(?:[ \t]{{{deep},}}+[^\n]*+(?:\n|\Z)|[ \t]*+\r?\n)++").match(text, b.end()):
                start, end = b.end() + len(body[0]) - len(body[0].lstrip()), b.end() + len(body[0].rstrip())
                inner.append([("string", start, end)] if end > start else [])
        for n in names:
            yield from ((n, t) for t in (terms, *inner) if t)
    for m in _CALL.finditer(text) if "(" in text else ():
        name = m[1]
        if not name:
            before = _SETTER.search(text, max(0, m.start() - 60), m.start())
            name = before[1] if before and not _LOOKUP.search(before[1]) else None
        if name and name_score(name):
            s = _STRING.match(text, m.end())
            if rest := _REST[s[1]].match(text, s.end()):
                yield name, [("string", s.end(), rest.end() - len(s[1]))]


def _inner(text: str, at: int, callee: list[int]) -> list[list[tuple[str, int, int]]]:
    """The literals, each a sum, behind opening brackets, a call's head or a line break; a lookup's or a table's key isn't one.

    ``callee`` keeps the end of a long run of a name's signs that no bracket follows, which operators in it share.
    """
    found: list[list[tuple[str, int, int]]] = [[]]
    if at < callee[0]:
        return found
    end = _CALLEE.match(text, at).end()
    if end - at > 64 and text[end : end + 1] not in ("(", "!", "["):
        callee[0] = end
        return found
    head = _HEAD_OF_VALUE.match(text, at)
    at = head.end() if head else -1
    while at >= 0 and (s := _STRING.match(text, at)) and (rest := _REST[s[1]].match(text, s.end())):
        if _KEY.match(text, rest.end()):
            break
        found[-1].append(("string", s.end(), rest.end() - len(s[1])))
        after = _NEXT.match(text, rest.end())
        if after[1]:
            found.append([])
        at = after.end()
    return found[1:] if head and head[1] and _LOOKUP.search(head[1]) else found


def literal_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the literals that reach a sensitive name, by constants propagated in order."""
    found: set[tuple[int, int]] = set()
    known: dict[str, Value] = {}
    sensitive: list[Value] = []
    seen: set[int] = set()
    runs: dict = {}
    if "=" in text or ":" in text or "(" in text:
        for name, terms in lex(text):
            parts, spans, quoted = [], [], False
            for kind, start, end in terms:
                if kind == "bare" and _IDENT.match(text, start, end) and (ref := known.get(text[start:end])):
                    parts.append(ref)
                    quoted = quoted or ref.quoted
                    continue
                at = start
                if kind == "string":
                    quoted = True
                    for e in _EMBEDDED.finditer(text, start, end) if known else ():
                        if ref := known.get(e[1] or e[2] or e[3]):
                            parts += [(at, e.start()), ref]
                            at = e.end()
                parts.append((at, end))
                spans.append((start, end))
            known[name] = value = Value(text, parts, spans, quoted, runs)
            if is_secret(name, value):
                sensitive.append(value)  # held, so that no id is used twice
                value.all_spans(seen, found)
    if "://" in text:
        found.update(m.span(1) for m in _URL.finditer(text) if not _PLACEHOLDER.match(m[1]))
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            start, end = m.end(2) - len(m[2].lstrip()), m.start(2) + len(m[2].rstrip())
            if end - start >= 6 and is_secret(m[1], Value(text, [(start, end)], [(start, end)], True, runs)):
                found.add((start, end))
    return sorted(found)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def all_spans(text: str) -> tuple[list, list]:
    """Base spans, and those with the lexer's literals that no base span holds already."""
    base = base_spans(text)
    starts, reach = [s for s, *_ in base], list(accumulate((e for *_, e in base), max))
    more = [(s, 3, e) for s, e in literal_spans(text) if not (k := bisect_right(starts, s)) or reach[k - 1] < e]
    return base, sorted(base + more)


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    base, spans = all_spans(text or "")
    kinds = [k for _, k, _ in base]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)


def redact_text(text: str) -> str:
    """A text with every secret replaced by its kind in brackets; an assignment keeps its name."""
    spans = []
    for s, k, e in all_spans(text)[1]:
        spans.append((_ASSIGN.match(text, s).start(2) if k == 0 else s, e, k))
    out, at = [], 0
    for s, e, k in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


SCAN = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with SCAN's columns, replacing columns of those names.

    Places are code points, ends exclusive. A null text counts as empty: no spans. Repeated rows get equal
    results (repeated secrets in a text each count), an empty table stays empty. No shuffle: each text, however long, is scanned whole where it is
    read; a name's constant is known from its assignment on, in that text.
    """
    names = [f.split()[0] for f in SCAN.split(", ")]
    scan = struct_udf(lambda texts: list(zip(*map(scan_text, texts))) or [[]] * 5, SCAN, F.col(text_col))
    rows = drop_names(df.withColumn("__mr_scan", scan), names)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "__mr_scan"], "__mr_scan.*")


def redacted(text: Column) -> Column:
    """A text column with its secrets replaced; null stays null."""
    return struct_udf(lambda texts: [[None if t is None else redact_text(t) for t in texts]], "text string", text)["text"]
