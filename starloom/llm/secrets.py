"""Secret scans: patterns, and encoded candidates that are reported only if they decode to a key or token."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.key_formats import SSH_MAGIC, declared, der_key, signed_token, ssh_key, unbase64
from starloom.llm.shared import LOWER_TABLE, doc_columns, mapped, slices

#: In the order of spans that start at one place. The first three are patterns, the others are confirmed by their structure.
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
BASE = KINDS[:3]
LAYERS = 3  # base64 or hex inside base64 or hex is opened so many times

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("[0-9a-f]{16,}")
#: A line break, also as it is written inside a quoted string.
_BREAK = r"(?:\\r\\n|\\n|\r?\n)[ \t]*"
_LETTERS = "[A-Za-z0-9+/_-]"
_BASE64 = re.compile(f"{_LETTERS}{{32,}}(?:{_BREAK}{_LETTERS}+)*={{0,2}}")
_ANY_HEX = re.compile(f"[0-9A-Fa-f]{{48,}}(?:{_BREAK}[0-9A-Fa-f]+)*")
#: ``{`` is the first byte of a token's header; a token does not go on from a letter of its own alphabet.
_TOKEN = re.compile(r"e(?<![A-Za-z0-9_-]e)[w-z0-9_-][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)?")
#: Where a sequence or an OpenSSH key can begin, in base64 and in hex.
_BASE64_START = re.compile("M[A-P]|b3BlbnNzaC1rZXktdjE")
_HEX_START = re.compile(f"30|{SSH_MAGIC[:-1].hex()}")
_ARMOUR_BEGIN = re.compile(r"-----BEGIN [A-Z0-9 ]+-----(?:\\r\\n|\\n|\r?\n|[ \t])*\Z")
_ARMOUR_END = re.compile(r"(?:\\r\\n|\\n|\r?\n|[ \t])*-----END [A-Z0-9 ]+-----")

Span = tuple[str, int, int, str]  # kind, first code point, code point after the last, what it is


def base_spans(text: str) -> list[Span]:
    """Pattern matches, leftmost and without overlaps in each kind; matches that are too short are passed over."""
    found: list[Span] = []
    low = text.encode("utf-8", "surrogatepass").translate(LOWER_TABLE).decode("utf-8", "surrogatepass")
    if any(name in low for name in _ASSIGN_NAMES):
        found += [("assign", *m.span(), "") for m in _ASSIGN.finditer(low) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span(), "") for m in _ACCESS.finditer(text)]
    return found + [("hex", *m.span(), "") for m in _HEX.finditer(text)]


class _Run:
    """A candidate without its line breaks, and where each of its letters stands in the text."""

    def __init__(self, m: re.Match):
        self.start, whole = m.start(), m.group()
        self.letters, self.marks, at = "", [(0, 0)], 0
        pieces = []
        for cut in re.finditer(_BREAK, whole):
            pieces.append(whole[at: cut.start()])
            at = cut.end()
            self.marks.append((self.marks[-1][0] + len(pieces[-1]), at))
        self.letters = "".join([*pieces, whole[at:]])

    def place(self, i: int) -> int:
        """Place in the text of letter ``i``."""
        lead, at = next(mark for mark in reversed(self.marks) if mark[0] <= i)
        return self.start + at + i - lead


def _keys(run: _Run, hexadecimal: bool) -> Iterator[Span]:
    """Keys inside a run of base64 or hex, each of which ends where its own lengths say."""
    letters = run.letters if hexadecimal else run.letters.rstrip("=")
    decode = bytes.fromhex if hexadecimal else unbase64
    at = 0
    for m in (_HEX_START if hexadecimal else _BASE64_START).finditer(letters.lower() if hexadecimal else letters):
        i = m.start()
        if i < at:
            continue
        if m.group() in ("30",) or m.group()[0] == "M":
            size = declared(decode(letters[i: i + 24][: (len(letters) - i) // 4 * 4]) or b"")
            take = 2 * size if hexadecimal else size // 3 * 4 + (0, 2, 3)[size % 3]
            data = decode(letters[i: i + take]) if 0 < take <= len(letters) - i else None
            kind, form = "der", der_key(data) if data else None
        else:
            rest = (len(letters) - i) // 2 * 2 if hexadecimal else len(letters) - i - ((len(letters) - i) % 4 == 1)
            size = ssh_key(decode(letters[i: i + rest]) or b"")
            take = 2 * size if hexadecimal else size // 3 * 4 + (0, 2, 3)[size % 3]
            kind, form = "ssh", "openssh" if size else None
        if form:
            at = i + take
            padded = run.letters[at:] if not hexadecimal and at == len(letters) else ""
            yield kind, run.place(i), run.place(at - 1) + 1 + len(padded), form


def _armoured(text: str, span: Span) -> Span:
    """The span with the lines around it that call it a key, if there are any."""
    kind, start, stop, form = span
    before, after = _ARMOUR_BEGIN.search(text, max(0, start - 120), start), _ARMOUR_END.match(text, stop)
    return ("pem", before.start(), after.end(), form) if before and after else span


def _readable(data: bytes) -> bool:
    return all(32 <= b < 127 or b in (9, 10, 13) for b in data[:64]) and all(32 <= b < 127 or b in (9, 10, 13) for b in data)


def confirmed_spans(text: str, layers: int = LAYERS) -> list[Span]:
    """Keys and tokens in ``text``, decoded and read; what does not parse to its last byte is not reported."""
    found: list[Span] = []
    for m in _TOKEN.finditer(text):
        pieces = m.group().split(".")
        for n in (5, 3) if len(pieces) == 5 else (3,):
            if form := signed_token(pieces[:n]):
                found.append(("jwt", m.start(), m.start() + len(".".join(pieces[:n])), form))
                break
    taken = 0
    for m in _BASE64.finditer(text):
        run, keys = _Run(m), []
        keys += [_armoured(text, s) for s in _keys(run, False)]
        for part in _ANY_HEX.finditer(m.group()) if not keys else ():
            keys += [(k, m.start() + a, m.start() + b, f) for k, a, b, f in _keys(_Run(part), True)]
        if not keys and layers > 1:
            keys += _inner(run, m, layers)
        found += [s for s in keys if s[1] >= taken]
        taken = max([taken, *(s[2] for s in keys)])
    return found


def _inner(run: _Run, m: re.Match, layers: int) -> list[Span]:
    """The whole run, if it decodes to readable text that holds a key or token."""
    letters = run.letters.rstrip("=")
    for data in (bytes.fromhex(letters) if len(letters) % 2 == 0 and _ANY_HEX.fullmatch(letters) else None, unbase64(letters)):
        if data and len(data) >= 24 and _readable(data) and (held := confirmed_spans(data.decode(), layers - 1)):
            return [(held[0][0], m.start(), m.end(), f"inside {held[0][3]}")]
    return []


def spans_of(text: str) -> list[Span]:
    """All spans of a text by start, then kind as listed in ``KINDS``."""
    found = base_spans(text) + confirmed_spans(text)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:long,stop:long,form:string>>"


def find_secrets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Secrets in every whole text: ``doc_id`` and ``secrets``, an array of ``kind, start, stop, form``.

    ``assign``, ``access`` and ``hex`` are plain patterns. Beside them every
    run of base64 or hex is decoded: ``der`` (a private key whose nested
    lengths fill it to the last byte), ``pem`` (the same between its armour
    lines), ``ssh`` (an OpenSSH key) and ``jwt`` (a token whose header names an
    algorithm that fits the signature's length). A run that decodes to readable
    text is searched again, ``LAYERS`` times at most. ``form`` says what was
    read. Places are code points, the end exclusive.

    A row per input row; NULL text counts as empty and has no spans; repeated
    rows each get a row; an empty table gives none. Texts are searched whole,
    one at a time, in time that grows with their length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("form", pa.string())]))
        for batch in slices(batches, "text"):
            found = [[dict(zip(("kind", "start", "stop", "form"), s)) for s in spans_of(text)] for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "secrets"])

    return mapped(doc_columns(docs, text_col, id_col), work, f"doc_id long, secrets {SPANS}")


def of_kinds(secrets: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(secrets, lambda s: s["kind"].isin(*kinds))


def joined_spans(secrets: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """The spans of these kinds as ``kind:start:stop``, comma-joined."""
    return F.array_join(F.transform(of_kinds(secrets, kinds), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
