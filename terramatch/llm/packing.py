"""Vector bin packing of examples into training sequences by the dot-product heuristic (Panigrahy et al., 2011)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .tokenization import encoder, groups_of


class Shelf:
    """Examples still to place, by their demands; examples of equal demands stand in one stack."""

    def __init__(self, demands: np.ndarray, limits: np.ndarray) -> None:
        self.limits = limits.astype(float)
        self.kinds, self.kind_of = np.unique(demands, axis=0, return_inverse=True)
        self.kind_of = self.kind_of.reshape(-1)
        self.shares = self.kinds / self.limits
        order = np.argsort(self.kind_of, kind="stable")
        self.stacks = [list(x[::-1]) for x in np.split(order, np.cumsum(np.bincount(self.kind_of, minlength=len(self.kinds)))[:-1])] if len(demands) else []
        self.left = np.array([len(x) for x in self.stacks], dtype=np.int64)
        #: a resource that all examples together need more of counts for more
        self.weights = demands.mean(axis=0) / self.limits if len(demands) else np.zeros(len(limits))

    def take(self, room: np.ndarray) -> int | None:
        """The example with the largest weighted dot product of its demands and the room, among those that fit; None if none does."""
        fits = (self.left > 0) & (self.kinds <= room).all(axis=1)
        if not fits.any():
            return None
        score = self.shares @ (self.weights * (room / self.limits))
        return self.pop(int(np.argmax(np.where(fits, score, -1.0))))

    def pop(self, kind: int) -> int:
        self.left[kind] -= 1
        return int(self.stacks[kind].pop())

    def longest(self) -> int | None:
        alive = np.flatnonzero(self.left > 0)
        return None if not len(alive) else int(alive[np.argmax(self.kinds[alive, 0])])


def place(demands: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Bins of examples (their row numbers), one bin open at a time. An example over a limit by itself gets a bin of its own."""
    over = (demands > limits).any(axis=1)
    bins = [[int(i)] for i in np.flatnonzero(over)]
    inner = np.flatnonzero(~over)
    shelf, rest = Shelf(demands[inner], limits), len(inner)
    while rest:
        room, members = limits.astype(np.int64).copy(), []
        while (i := shelf.take(room)) is not None:
            members.append(int(inner[i]))
            room -= demands[inner[i]]
        rest -= len(members)
        bins.append(members)
    return bins


@dataclass(slots=True)
class Piece:
    doc: int
    start: int
    ids: bytes | memoryview  # four bytes an id
    doc_tokens: int

    @property
    def n(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[: 4 * n], self.doc_tokens), Piece(self.doc, self.start + n, self.ids[4 * n :], self.doc_tokens)


def halved(members: list[Piece]) -> tuple[list[Piece], list[Piece]]:
    """The front of some pieces up to the largest power of two, and what is left of them, the last one first."""
    rest = members[::-1]
    room, front = 1 << (sum(p.n for p in members).bit_length() - 1), []
    while room:
        piece = rest.pop()
        if piece.n > room:
            piece, later = piece.cut(room)
            rest.append(later)
        front.append(piece)
        room -= piece.n
    return front, rest


@dataclass
class Packer:
    """Cuts documents into pieces and packs them into sequences of at most `tokens` ids, `segments` pieces and `loss` loss-bearing ids.

    In plain documents every id bears loss, so the demands of a piece are its length, one segment, and its length again: the dot product
    then favours the longest piece that fits. pack_examples() has demands that differ. A piece is cut only to fill a sequence in which no whole piece fits any more, and only
    if `least_cut` ids or more are free. Where the segments run out first, the sequence ends at a power of two, which needs no padding, and what is over goes
    into the next one. What a run of documents leaves for its last sequence waits for the next run; at the end it
    goes into sequences whose lengths are powers of two, which need no padding.
    """

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048
    least_cut: int = 16
    first_sequence: int = 0
    waiting: list[Piece] = field(default_factory=list)

    def pack(self, docs: list[Piece]) -> Iterator[tuple[Piece, int, int]]:
        """(piece, sequence, offset) of all pieces of docs but those that wait."""
        longest, pieces = min(self.tokens, self.loss), self.waiting
        self.waiting = []
        for d in docs:
            whole = d.n // longest * longest
            for at in range(0, whole, longest):
                yield Piece(d.doc, at, d.ids[4 * at : 4 * (at + longest)], d.doc_tokens), self.first_sequence, 0
                self.first_sequence += 1
            if whole < d.n:
                pieces.append(Piece(d.doc, whole, d.ids[4 * whole :], d.doc_tokens))
        limits = np.array([self.tokens, self.segments, self.loss])
        n = np.array([p.n for p in pieces], dtype=np.int64)
        shelf, left = Shelf(np.stack([n, np.ones_like(n), n], axis=1), limits), len(pieces)
        first: list[Piece] = []  # what a sequence had to leave goes first into the next one
        while left or first:
            members, room, cut = [], limits.copy(), False
            while not cut:
                if first:
                    piece = first.pop()
                elif (i := shelf.take(room)) is not None:
                    piece, left = pieces[i], left - 1
                elif room[0] >= self.least_cut and room[1] and room[2] >= self.least_cut and left:
                    piece, rest = pieces[shelf.pop(shelf.longest())].cut(int(min(room[0], room[2])))
                    first, left, cut = [rest], left - 1, True
                else:
                    break
                members.append(piece)
                room -= np.array([piece.n, 1, piece.n])
            if not left and not first and room[0] >= self.least_cut:
                self.waiting = members
                return
            if not room[1] and room[0] >= self.least_cut:
                members, first = halved(members)
            yield from self.close(members)

    def close(self, members: list[Piece]) -> Iterator[tuple[Piece, int, int]]:
        at = 0
        for p in members:
            yield p, self.first_sequence, at
            at += p.n
        self.first_sequence += 1

    def finish(self) -> Iterator[tuple[Piece, int, int]]:
        rest, self.waiting = self.waiting, []
        while rest:
            front, left = halved(rest)
            rest = left[::-1]
            yield from self.close(front)


SCHEMA = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int, tokens: int, segments: int, loss: int) -> Iterator[pa.RecordBatch]:
    packer = Packer(tokens, segments, loss, first_sequence=TaskContext.get().partitionId() << 32)
    doc_ids: dict[int, int | None] = {}

    def out(placed: Iterator[tuple[Piece, int, int]]) -> pa.RecordBatch:
        rows = [(doc_ids[p.doc], p.start, p.n, zlib.crc32(p.ids), p.doc_tokens, s, at) for p, s, at in placed]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        for gone in set(doc_ids) - {p.doc for p in packer.waiting}:
            del doc_ids[gone]
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])

    number = 0
    for batch in batches:
        row_ids, texts = batch.column(0).to_pylist(), batch.column(1)
        for lo, hi in groups_of(texts):
            offsets, ids = encoder(path).encode(texts.slice(lo, hi - lo), end_id)
            raw, cuts, docs = memoryview(ids).cast("B"), offsets.tolist(), []
            for row_id, a, b in zip(row_ids[lo:hi], cuts, cuts[1:], strict=False):
                doc_ids[number] = row_id
                docs.append(Piece(number, 0, raw[4 * a : 4 * b], b - a))
                number += 1
            yield out(packer.pack(docs))
            for p in packer.waiting:  # these outlive the run's array
                p.ids = bytes(p.ids)
    yield out(packer.finish())


def pack_documents(docs: DataFrame, *, vocabulary: str, end_id: int = 1, tokens: int = 2048, segments: int = 64, loss: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Scale: no shuffle. Each task packs its own documents, some million characters at a time, and leaves one short sequence a task,
    which goes into power-of-two lengths. sequence_id holds the task's number in its upper bits, so ids are unique and a task that
    runs again over its file ranges gives the same ones.

    Defined results: a null text is the empty one and has the end id alone; a null id stays null; each row is a document, repeated
    or not; a long document gives many pieces; an empty table gives no pieces. Ids are whole numbers. Further columns are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(partial(_packed, path=vocabulary, end_id=end_id, tokens=tokens, segments=segments, loss=loss), SCHEMA)


def _placed(batches: Iterator[pa.RecordBatch], limits: tuple[int, ...], block_rows: int) -> Iterator[pa.RecordBatch]:
    sequence, held, rows = TaskContext.get().partitionId() << 32, [], 0

    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        nonlocal sequence
        table = pa.Table.from_batches(held).combine_chunks()
        demands = np.stack([np.asarray(table.column(i)).astype(np.int64) for i in range(1, 4)], axis=1)
        seq, at = np.zeros(len(demands), dtype=np.int64), np.zeros(len(demands), dtype=np.int64)
        for members in place(demands, np.array(limits)):
            seq[members], at[members] = sequence, np.cumsum(demands[members, 0]) - demands[members, 0]
            sequence += 1
        t = table.append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(at))
        return t.combine_chunks().to_batches()[0]

    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows >= block_rows:
            yield out(held)
            held, rows = [], 0
    if rows:
        yield out(held)


def pack_examples(examples: DataFrame, *, id_col: Column | str, tokens_col: str, segments_col: str, loss_col: str, tokens: int = 2048, segments: int = 16, loss: int = 1024, block_rows: int = 20_000) -> DataFrame:
    """Instruction data, uncut: id, tokens, segments, loss, sequence_id, offset, a row an example.

    All three limits hold in every sequence, but for an example that exceeds one by itself: it stands alone in its sequence. Each task
    packs its rows in runs of block_rows.

    Defined results: null demands count as 0, and a null id stays null; each row is an example, repeated or not; an empty table gives an
    empty one. Further columns are left out.
    """
    demand = lambda c, name: F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(name)
    rows = examples.select((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string").alias("id"), demand(tokens_col, "tokens"), demand(segments_col, "segments"), demand(loss_col, "loss"))
    return rows.mapInArrow(partial(_placed, limits=(tokens, segments, loss), block_rows=block_rows), "id string, tokens long, segments long, loss long, sequence_id long, offset long")
