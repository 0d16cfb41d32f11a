"""Hierarchical multi-length packing of tokenised documents.

Every document is cut into full windows of the largest context size and a
rest; the rest is routed to the smallest tier that holds it.  The tiers are
packed from the largest to the smallest: the longest pieces of a tier open its
windows, gaps are filled with the longest pieces of the shorter tiers that
fit, and only where no whole piece fits is one cut.  So windows are exactly
one tier long.  Windows of a tier are dealt to step groups of equal tokens
and near equal attention cost (the sum of squared piece lengths).

Packing needs no order between documents, so each input partition packs its
own, block by block, and nothing is shuffled.  What is left at the end of a
block waits for the next; at the end of a partition fewer tokens than one
large window are left, and are cut at powers of two.  Sequence ids are
partition << 33 | n: a retried task makes the same ones.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from adfuse.llm.tables import pick, table

#: Context sizes, ascending powers of two.
TIERS = (256, 512, 1024, 2048)
#: Tokens of a step group.
STEP_TOKENS = 16 * 2048
#: In the largest tier, gaps under this many tokens are padded and no document is cut for them.
LEAST = 4
#: Tokens after which a task packs what it has read.
BLOCK_TOKENS = 2_000_000
#: The id that ends a document.
END = 1
#: Tokenised words, and parts of words, kept by a Python worker (about 200 bytes each); then it starts afresh.
CACHED_WORDS = 250_000
#: Marks that are neither letters nor digits to the splitter; an apostrophe may begin a contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_spelling() -> dict[int, int]:
    """Byte-level vocabularies spell a byte as its Latin-1 character, and those without a glyph from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + k for k, b in enumerate(rest)}


SPELLING = byte_spelling()


class Ids(dict):
    """Ids of the words, or parts of words, met so far, as little-endian uint32 bytes."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, key: str) -> bytes:
        found = self.learn(key)
        if len(key) <= 100:  # longer ones would fill the memory and hardly come again
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[key] = found
        return found


class Encoder:
    """Token ids of texts, as little-endian uint32 bytes.

    The tokenizer's normaliser and splitter work inside words between white
    space, so ids of a text are the ids of its words in a row; words repeat,
    and their ids are kept.  Control characters 1C-1F split words for Python
    only: a text with one of them is encoded as a whole.

    Most words are letters with some marks behind them.  The splitter parts
    the two and the normaliser lower-cases, so the tokenizer is asked once for
    the lower-case letters, whatever marks follow.  Only letters whose lower
    case and normal form are the same to Python and to the tokenizer (those
    under U+0130) take this way, straight to the tokenizer's model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words, self.parts = Ids(self._word), Ids(self._part)

    def _encode(self, text: str) -> bytes:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return pack_ids(found.ids)

    def _part(self, part: str) -> bytes:
        """Ids of what the splitter leaves whole: its bytes, spelt as the vocabulary spells them."""
        spelt = part if part.isascii() else part.encode().decode("latin-1").translate(SPELLING)
        return pack_ids([t.id for t in self.model.tokenize(spelt)])

    def _word(self, word: str) -> bytes:
        letters = word.rstrip(MARKS)
        if letters.isalpha() and max(letters) < "\u0130":
            found, marks = self.parts[letters.lower()], word[len(letters) :]
            return found + self.parts[marks] if marks else found
        return self._encode(word)

    def ids(self, text: str) -> bytes:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._encode(text)
        return b"".join(map(self.words.__getitem__, text.split()))


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


class Piece(NamedTuple):
    doc: int  # position in the packer's documents
    start: int
    length: int


class Packer:
    """Packs pieces into windows; ``windows`` holds (tier, pieces) until taken."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, least: int = LEAST):
        self.tiers, self.top, self.least = tiers, tiers[-1], least
        self.stock: dict[int, list[Piece]] = {}  # by length
        self.lengths: list[int] = []  # of the stock, ascending
        self.windows: list[tuple[int, list[Piece]]] = []

    def add(self, doc: int, length: int) -> None:
        full = length // self.top
        for k in range(full):
            self.windows.append((self.top, [Piece(doc, k * self.top, self.top)]))
        if length % self.top:
            self._put(Piece(doc, full * self.top, length % self.top))

    def _put(self, piece: Piece) -> None:
        if piece.length not in self.stock:
            self.stock[piece.length] = []
            insort(self.lengths, piece.length)
        self.stock[piece.length].append(piece)

    def _take(self, at: int) -> Piece:
        """The last piece of the ``at``-th shortest length."""
        length = self.lengths[at]
        piece = self.stock[length].pop()
        if not self.stock[length]:
            del self.stock[length], self.lengths[at]
        return piece

    def pack(self) -> None:
        """Fill windows while the stock lasts; a window that stays open goes back to the stock."""
        for tier, below in zip(self.tiers[::-1], [*self.tiers[-2::-1], 0], strict=True):
            while self.lengths and self.lengths[-1] > below:
                pieces = [self._take(len(self.lengths) - 1)]
                gap = tier - pieces[0].length
                while gap and self.lengths:
                    at = bisect_right(self.lengths, gap) - 1
                    if at >= 0:
                        piece = self._take(at)
                    elif tier == self.top and gap < self.least:
                        break
                    else:  # every piece is longer: cut the shortest of them
                        whole = self._take(0)
                        piece = Piece(whole.doc, whole.start, gap)
                        self._put(Piece(whole.doc, whole.start + gap, whole.length - gap))
                    pieces.append(piece)
                    gap -= piece.length
                if gap and not (tier == self.top and gap < self.least):
                    for piece in pieces:
                        self._put(piece)
                    return
                self.windows.append((tier, pieces))

    def finish(self) -> None:
        """Cut what is left (less than one large window) at powers of two."""
        self.pack()
        rest = [self._take(len(self.lengths) - 1) for _ in range(sum(map(len, self.stock.values())))]
        size = sum(p.length for p in rest)
        while size:
            window, room = [], 1 << (size.bit_length() - 1)
            size -= room
            tier = room
            while room:
                piece = rest.pop()
                if piece.length > room:
                    rest.append(Piece(piece.doc, piece.start + room, piece.length - room))
                    piece = Piece(piece.doc, piece.start, room)
                window.append(piece)
                room -= piece.length
            self.windows.append((tier, window))


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A step number for each window: equal tokens per step, costs balanced by dealing to and fro."""
    out, first = [0] * len(windows), 0
    by_tier: dict[int, list[int]] = {}
    for k, (tier, _) in enumerate(windows):
        by_tier.setdefault(tier, []).append(k)
    for tier, ks in sorted(by_tier.items(), reverse=True):
        steps = -(-len(ks) * tier // step_tokens)
        ks.sort(key=lambda k: -sum(p.length**2 for p in windows[k][1]))
        for n, k in enumerate(ks):
            turn, place = divmod(n, steps)
            out[k] = first + (place if turn % 2 == 0 else steps - 1 - place)
        first += steps
    return out


FIELDS = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_id bigint, ids binary"
)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    least: int = LEAST,
    with_ids: bool = True,
) -> DataFrame:
    """Pack the tokens of all rows of ``docs`` (doc_id, text); one row per piece.

    Returns doc_id, start and length (in tokens of the document), ids_crc32,
    doc_tokens, sequence_id, offset (inside the sequence), tier (its context
    size), step_id and ids (little-endian uint32, null unless ``with_ids``).
    A null or empty text is the single end id; repeated rows and rows without
    doc_id are packed like any other; an empty table gives no rows.
    """
    if list(tiers) != sorted(set(tiers)) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are ascending powers of two")
    path = tokenizer or tokenizer_path()
    end = pack_ids([END])

    def emit(packer: Packer, ids: dict, names: dict, first: int, step: int) -> tuple[pa.RecordBatch, int]:
        steps = step_groups(packer.windows, step_tokens)
        rows = []
        for n, (tier, pieces) in enumerate(packer.windows):
            offset = 0
            for p in pieces:
                data = ids[p.doc][4 * p.start : 4 * (p.start + p.length)]
                rows.append(
                    (names[p.doc], p.start, p.length, zlib.crc32(data), len(ids[p.doc]) // 4, first + n, offset,
                     tier, step + steps[n], data if with_ids else None)
                )
                offset += p.length
        columns = list(zip(*rows, strict=True)) or [()] * 10
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.binary()]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in FIELDS.split(", ")]
        )
        return batch, max(steps, default=-1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(path).ids, Packer(tiers, least)
        ids: dict[int, bytes] = {}
        names: dict[int, int | None] = {}
        at = TaskContext.get().partitionId() << 33
        sequence, step, held, n = at, at, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, step, held
            batch, steps = emit(packer, ids, names, sequence, step)
            sequence, step, held = sequence + len(packer.windows), step + steps, 0
            packer.windows = []
            kept = {p.doc for pieces in packer.stock.values() for p in pieces}
            for doc in [d for d in ids if d not in kept]:
                del ids[doc], names[doc]
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids[n], names[n] = encode(text.as_py() or "") + end, doc_id
                packer.add(n, len(ids[n]) // 4)
                held += len(ids[n]) // 4
                n += 1
                if held >= BLOCK_TOKENS:
                    packer.pack()
                    yield flush()
        packer.finish()
        yield flush()

    return pick(docs, ("doc_id", "bigint"), ("text", "string")).mapInArrow(run, FIELDS)


def op3_pack(spark, sf_dir) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")
