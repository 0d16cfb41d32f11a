"""Secret scan over a recursive decoding worklist.

A text is scanned as it stands; then every encoded layer in it is unwrapped
and scanned in turn, until nothing is left to unwrap:

* percent escapes and backslash-u / backslash-x escapes are decoded in place
  (the layer is the whole text with the escapes replaced);
* each base64 token (standard or URL alphabet, also over several lines that are
  indented, quoted or broken by an escape) is a layer of its own for each of the
  four places where its first group of characters can begin, since letters in
  front of it may belong to the alphabet; and so is what it holds as gzip, zlib,
  bz2, xz or zstd.

No layer is judged before it is scanned: bytes that are no UTF-8 become lone
surrogates, which no pattern contains, and stretches of ASCII in UTF-16 are
layers as well.  Noise has nothing to unwrap, so it costs one scan.

Every layer knows how its positions map into its parent, so a secret found any
number of layers down is reported at the code points of the original text
that carry it.  A layer that was seen before at the same original place is not
opened again, which ends cycles (a compressed stream can contain itself).

The work for a row is one small worklist in a task; rows are independent, so
nothing is shuffled, and a lost executor costs only its own rows.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from adfuse.llm.tables import pick, table, with_texts

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

# In "%2541" the escape of the escape is undone at once: the layers between
# differ only in characters that no pattern contains.
PERCENT = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
ONE_PERCENT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
_ONE = r"(?:\\(?:u005[cC])*(?:u([0-9A-Fa-f]{4})|u\{([0-9A-Fa-f]{1,6})\}|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))|%u([0-9A-Fa-f]{4}))"
ONE_ESCAPE = re.compile(_ONE)
ESCAPE = re.compile(f"(?:{re.sub(r'[(](?![?])', '(?:', _ONE)})+")
# A line break inside a token: quotes and signs that join lines around it, an indent, marks of quoted mail or comments.
# The break itself may be written as an escape.
BREAK = r"""(?:["']?[ \t]*[+,\\]?[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*(?:[>|#*][ \t]*|\+[ \t]+)*["']?)"""
LINE_BREAK = re.compile(BREAK)
# At least 16 characters in one line, or lines of 4 or more; the last one is of any length.
TOKENS = tuple(
    re.compile(
        rf"(?:{c}{{16,}}+|(?<!{c}){c}{{4,15}}+{BREAK}{c}{{4,}}+)(?:{BREAK}{c}{{4,}}+)*+(?:{BREAK}{c}{{1,3}}+)?={{0,2}}"
    )
    for c in ("[A-Za-z0-9+/]", "[A-Za-z0-9_-]")
)
#: Every secret, token and escape that can hide one has 16 printable ASCII characters in a row.
PLAIN = re.compile(rb"[\t\n\r -~]{16}")

#: A stream that unpacks to more bytes than this is reported as kind "bomb" (its
#: token is the span) and scanned in blocks of this size that overlap by half.
MAX_UNPACKED = 64 << 20
#: Bytes of a piece of a stream, and of what zstd is fed at once (its output cannot be bounded).
PIECE, FED = 1 << 16, 256

#: ASCII in UTF-16. Every secret and every token has 16 or more ASCII characters in a row.
WIDE = (re.compile(rb"(?:[\t\n\r -~]\0){16,}"), re.compile(rb"(?:\0[\t\n\r -~]){16,}"))

Span = tuple[int, int]


class Hit(NamedTuple):
    start: int
    rank: int  # position of the kind in KINDS; len(KINDS) for "bomb"
    end: int

    def label(self) -> str:
        kind = KINDS[self.rank] if self.rank < len(KINDS) else "bomb"
        return f"{kind}:{self.start}:{self.end}"


class Layer(NamedTuple):
    text: str
    to_root: Callable[[int, int], Span]
    block: bool = False  # of a stream that is reported as "bomb"


def base_hits(text: str) -> Iterator[Hit]:
    """Leftmost non-overlapping matches per kind; short ones are dropped, not shortened."""
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 12:
            yield Hit(m.start(), 0, m.end())
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 18:
                yield Hit(m.start(), 1, m.end())
    for m in HEX.finditer(text):
        yield Hit(m.start(), 2, m.end())


#: A decoded character and the places of the escapes that stand for it.
Piece = tuple[str, int, int]


def _in_place(layer: Layer, runs: re.Pattern, decode: Callable[[re.Match], list[Piece] | None]) -> Layer | None:
    """The layer with every run replaced by what it stands for, or None if none decodes."""
    pieces: list[str] = []
    out_at, in_at, in_end = [0], [0], [-1]  # stretches of the new text; an end of -1: copied as it was
    size = done = 0
    for m in runs.finditer(layer.text):
        chars = decode(m)
        if not chars:
            continue
        pieces.append(layer.text[done : m.start()])
        size += m.start() - done
        for char, start, end in chars:
            pieces.append(char)
            out_at.append(size)
            in_at.append(start)
            in_end.append(end)
            size += len(char)
        done = m.end()
        out_at.append(size)
        in_at.append(done)
        in_end.append(-1)
    if len(out_at) == 1:
        return None
    pieces.append(layer.text[done:])

    def to_root(start: int, end: int) -> Span:
        k, n = bisect_right(out_at, start) - 1, bisect_right(out_at, end - 1) - 1
        low = in_at[k] if in_end[k] >= 0 else in_at[k] + start - out_at[k]
        high = in_end[n] if in_end[n] >= 0 else in_at[n] + end - out_at[n]
        return layer.to_root(low, high)

    return Layer("".join(pieces), to_root)


def _as_it_was(run: re.Match, m: re.Match) -> list[Piece]:
    at = run.start() + m.start()
    return [(c, at + i, at + i + 1) for i, c in enumerate(m[0])]


def _percent(run: re.Match) -> list[Piece] | None:
    marks = list(ONE_PERCENT.finditer(run[0]))
    out, at, decoded = [], 0, False
    for c in _as_text(bytes(int(x[1], 16) for x in marks)):
        if "\ud800" <= c < "\ue000":  # a byte that belongs to no character
            out += _as_it_was(run, marks[at])
            at += 1
            continue
        n = len(c.encode())
        out.append((c, run.start() + marks[at].start(), run.start() + marks[at + n - 1].end()))
        at += n
        decoded = True
    return out if decoded else None


def _unicode(run: re.Match) -> list[Piece] | None:
    out: list[Piece] = []
    high, decoded = None, False  # a leading surrogate waits for its partner
    for m in ONE_ESCAPE.finditer(run[0]):
        code, start, end = int(next(filter(None, m.groups())), 16), run.start() + m.start(), run.start() + m.end()
        if code > 0x10FFFF:
            out += _as_it_was(run, m)
            high = None
            continue
        if high and 0xDC00 <= code < 0xE000:
            out[-1] = (chr(0x10000 + ((high - 0xD800) << 10) + code - 0xDC00), out[-1][1], end)
        else:
            out.append(("\N{REPLACEMENT CHARACTER}" if 0xD800 <= code < 0xE000 else chr(code), start, end))
        high, decoded = code if 0xD800 <= code < 0xDC00 else None, True
    return out if decoded else None


def _as_text(data: bytes) -> str:
    """The bytes as UTF-8; each byte that is none becomes one lone surrogate, so positions can be mapped back."""
    return data.decode("utf-8", "surrogateescape")


def _wide_runs(data: bytes) -> list[Span]:
    """Where ``data`` is ASCII in UTF-16 of either byte order, at any offset; runs inside another run are left out."""
    if b"\0" not in data:
        return []
    runs = sorted((m.span() for p in WIDE for m in p.finditer(data)), key=lambda r: (r[0], -r[1]))
    out: list[Span] = []
    for r in runs:
        if not out or r[1] > out[-1][1]:
            out.append(r)
    return out


def _opened(head: bytes) -> tuple | None:
    """A decompressor for the stream that begins so, and what it raises; None if it is none."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31), zlib.error
    if len(head) > 2 and head[0] & 0x0F == 8 and (head[0] * 256 + head[1]) % 31 == 0:
        return zlib.decompressobj(15), zlib.error
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor(), (OSError, EOFError)
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(), (lzma.LZMAError, EOFError)
    if head[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj(), zstandard.ZstdError
    return None


def _cut(data: bytes) -> Iterator[bytes]:
    return (data[k : k + PIECE] for k in range(0, len(data), PIECE))


def _inflate(source: Iterator[bytes | None]) -> Iterator[bytes | None]:
    """The content, in pieces, of all compressed streams in ``source``; a None ends a stream, on both sides."""
    ended = False

    def part() -> Iterator[bytes]:
        nonlocal ended
        for piece in source:
            if piece is None:
                return
            yield piece
        ended = True

    while not ended:
        one = part()
        yield from _streams(one)
        for _ in one:  # what is no stream
            pass
        yield None


def _streams(source: Iterator[bytes]) -> Iterator[bytes | None]:
    """The content of the streams that follow one another from the start; up to an error, if there is one."""
    rest = b""
    while True:
        while len(rest) < 6 and (more := next(source, b"")):
            rest = (rest + more).lstrip(b"\0")  # streams may be padded; none begins with NUL
        if (found := _opened(rest)) is None:
            return
        opened, errors = found
        zstd = rest[:4] == b"\x28\xb5\x2f\xfd"
        try:
            while not opened.eof:
                if not rest and getattr(opened, "needs_input", True) and not (rest := next(source, b"")):
                    yield from _cut(getattr(opened, "flush", bytes)())  # cut short: what there is of it
                    return
                if zstd:
                    now, rest = rest[:FED], rest[FED:]
                    out = opened.decompress(now)
                else:
                    out = opened.decompress(rest, PIECE)
                    rest = getattr(opened, "unconsumed_tail", b"")
                yield from _cut(out)
        except errors:
            return
        yield None
        rest = (opened.unused_data + rest).lstrip(b"\0")


def _blocks(pieces: Iterator[bytes | None], size: int) -> Iterator[tuple[bytes, bool]]:
    """The pieces as one block, or, beyond ``size`` bytes, as blocks of it that overlap by half; and whether there are more."""
    held, more = bytearray(), False
    for piece in pieces:
        held += piece or b""
        while len(held) > size:
            more = True
            yield bytes(held[:size]), more
            del held[: max(1, size // 2)]
    if held:
        yield bytes(held), more


def _base64(token: str) -> Iterator[tuple[Sequence[int], bytes]]:
    """The bytes of the token, and its characters' places, read from each of its first four characters.

    What stands in front of a token may belong to its alphabet, and lines can
    be tokens of their own, or the last one a word that follows: each has a
    reading in which its groups of four are whole.  A single character that is
    left over carries no byte.
    """
    joined = token.rstrip("=")
    at: Sequence[int] = range(len(joined))
    if breaks := list(LINE_BREAK.finditer(joined)):
        ends = [0, *(x for m in breaks for x in m.span()), len(joined)]
        lines = list(zip(ends[::2], ends[1::2], strict=True))
        at = [i for a, b in lines for i in range(a, b)]
        joined = "".join(joined[a:b] for a, b in lines)
    joined = joined.replace("-", "+").replace("_", "/")
    for start in range(min(4, len(joined))):
        size = len(joined) - start
        size -= size % 4 == 1
        if size > 0:
            yield at[start:], base64.b64decode(joined[start : start + size] + "=" * (-size % 4), validate=True)


def _readings(data: bytes) -> Iterator[tuple[str, Callable[[int, int], Span]]]:
    """``data`` as text, in UTF-8 and UTF-16, each with the map of its positions to bytes."""
    if PLAIN.search(data):
        text = _as_text(data)
        yield text, (lambda s, e: (s, e)) if text.isascii() else _byte_places(text)
    for low, high in _wide_runs(data):
        wide = data[low:high].replace(b"\0", b"").decode("ascii")
        yield wide, lambda s, e, low=low: (low + 2 * s, low + 2 * e)


def _byte_places(text: str) -> Callable[[int, int], Span]:
    """Positions in a text to those in its bytes, from one pass over it (when first asked)."""
    places: list[np.ndarray] = []

    def to_bytes(s: int, e: int) -> Span:
        if not places:
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
            size[(code >= 0xDC80) & (code < 0xDD00)] = 1  # a byte that is no UTF-8
            places.append(np.concatenate(([0], np.cumsum(size))))
        return int(places[0][s]), int(places[0][e])

    return to_bytes


def _base64_layers(layer: Layer) -> Iterator[Layer | Hit]:
    done: set[Span] = set()  # many tokens are of both alphabets
    for pattern in TOKENS:
        for m in pattern.finditer(layer.text):
            if m.span() in done:
                continue
            done.add(m.span())
            whole = layer.to_root(m.start(), m.end())
            for at, data in _base64(m[0]):
                for text, to_bytes in _readings(data):
                    yield Layer(text, _base64_map(layer, m.start(), at, to_bytes))
                yield from _unpacked(data, whole)


def _unpacked(data: bytes, whole: Span) -> Iterator[Layer | Hit]:
    """What ``data`` holds as compressed streams, and what that holds in turn.

    No level is held whole beyond MAX_UNPACKED bytes; for the next level the
    ones before are unpacked again.
    """
    seen: set[bytes] = set()
    depth = 1
    while True:
        level: Iterator[bytes | None] = _cut(data)
        for _ in range(depth):
            level = _inflate(level)
        content, last = hashlib.sha256(), b""
        for block, more in _blocks(level, MAX_UNPACKED):
            mark = hashlib.sha256(block).digest()
            content.update(mark)
            if more:
                yield Hit(whole[0], len(KINDS), whole[1])
            if mark != last:  # a long repetition is read once
                for text, _ in _readings(block):
                    yield Layer(text, lambda s, e: whole, more)
            last = mark
        if not last or content.digest() in seen:
            return
        seen.add(content.digest())
        depth += 1


def _base64_map(
    layer: Layer, start: int, at: Sequence[int], to_bytes: Callable[[int, int], Span]
) -> Callable[[int, int], Span]:
    """Positions in the decoded text to the token's characters (four carry three bytes)."""

    def to_root(s: int, e: int) -> Span:
        b0, b1 = to_bytes(s, e)
        c0, c1 = b0 * 4 // 3, -(-b1 * 4 // 3)
        return layer.to_root(start + at[c0], start + at[min(c1, len(at)) - 1] + 1)

    return to_root


def _children(layer: Layer) -> Iterator[Layer | Hit]:
    if "%" in layer.text and (child := _in_place(layer, PERCENT, _percent)):
        yield child
    if ("\\" in layer.text or "%u" in layer.text) and (child := _in_place(layer, ESCAPE, _unicode)):
        yield child
    yield from _base64_layers(layer)


def secret_hits(text: str) -> tuple[list[Hit], list[Hit]]:
    """(hits of the text as it stands, hits of all layers), both in report order."""
    base = sorted(base_hits(text))
    found = set(base)
    work = [_children(Layer(text, lambda s, e: (s, e)))]  # blocks of a large stream exist one at a time
    seen = {(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), 0, len(text))}
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
            continue
        if isinstance(child, Hit):
            found.add(child)
            continue
        if not child.text:
            continue
        mark = (
            hashlib.sha256(child.text.encode("utf-8", "surrogatepass")).digest(),
            *child.to_root(0, len(child.text)),
        )
        if mark in seen:
            continue
        seen.add(mark)
        for h in base_hits(child.text):
            if child.block and h.end - h.start == len(child.text):
                continue  # a run longer than a block: "bomb" has the same span
            start, end = child.to_root(h.start, h.end)
            found.add(Hit(start, h.rank, end))
        work.append(_children(child))
    return base, sorted(found)


def _joined(hits: list[Hit]) -> str:
    return ",".join(h.label() for h in hits)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every row of ``docs`` (doc_id, text).

    Returns doc_id, the counts n_assign, n_access, n_hex and base_sha256 of
    the text as it stands, and spans (kind:start:end of all layers, code
    points).  A null text counts as empty and has no spans; repeated rows and
    null ids each get a result; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, found = secret_hits(text.as_py() or "")
                kinds = [h.rank for h in base]
                rows.append(
                    (*map(kinds.count, range(3)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found))
                )
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return pick(docs, ("doc_id", "bigint"), ("text", "string")).mapInArrow(
        scan, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


MASK = "[REDACTED]"


def redact_text(text: str) -> str:
    """``text`` with every found span, of any layer, replaced by MASK until no secret is left."""
    while hits := secret_hits(text)[1]:
        out, done = [], 0
        for h in hits:
            if h.start >= done:
                out += [text[done : h.start], MASK]
            done = max(done, h.end)
        text = "".join(out) + text[done:]
    return text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all secrets masked in ``text``; same columns, same rows.

    ``n_chars``, where present, follows the new text.  Null texts stay null.
    """
    at = docs.columns.index("text")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = {}
            for row, text in enumerate(batch.column(at)):
                old = text.as_py()
                if old is not None and (clean := redact_text(old)) != old:
                    new[row] = clean
            yield with_texts(batch, new)

    return docs.mapInArrow(mask, docs.schema)


def op1_secret_scan(spark, sf_dir) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
