"""SentencePiece encoding with seeded merge-dropout, and its lossless decoding."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.words import mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: What stands for a space in a piece.
SPACE = "▁"
#: Segments whose ids a task keeps, some 15 MB, and the longest segment that is kept.
KEPT, LONGEST = 1 << 16, 48
#: Bytes of text whose segments are looked at in one go; the arrays and strings beside them take some
#: fifty times as much.
TEXT = 1 << 20
#: A rank behind all others, and one that no pair has; more than there are symbols.
FAR, NONE, SYMBOLS = 1 << 40, (1 << 31) - 1, 1 << 22
#: Bits of the slots that pairs of symbols are looked up in.
SLOTS = 21
MASK = 2**64 - 1


class Pieces:
    """The merges of one public vocabulary."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        plain = [i for i in range(len(names)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.ids = {names[i]: i for i in plain}
        scores = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        self.ranks = {names[i]: scores[sp.get_score(i)] for i in plain if len(names[i]) > 1}
        self.bytes = {int(names[i][3:-1], 16): i for i in range(len(names)) if sp.is_byte(i)}
        self.surface = [b""] * len(names)
        for i in plain:
            self.surface[i] = names[i].replace(SPACE, " ").encode()
        for value, i in self.bytes.items():
            self.surface[i] = bytes([value])
        self.sizes = np.array([len(x) for x in self.surface], np.int64)
        self.flat, self.starts = np.frombuffer(b"".join(self.surface), np.uint8), np.cumsum(self.sizes) - self.sizes
        # No piece goes from a letter into a space, nor over a line's end if none contains one.
        ends = "" if any("\n" in x for x in self.ids) else "\n"
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{ends}]+|{SPACE}+" + (f"|{ends}" if ends else ""))
        self.whole = any(SPACE in x.lstrip(SPACE) for x in self.ids)

    def merge(self, segment: str, key: int, limit: int) -> bytes:
        """The ids of one segment, four bytes each.

        Candidate merges leave an agenda by score, leftmost first. One is skipped for good if its
        keyed hash, of segment, piece and place, is below ``limit`` of 2**32. The agenda of a
        short segment is the list of its neighbours' ranks, that of a long one a heap.
        """
        salt = xxhash.xxh64_intdigest(segment, key) | 1 if limit else 0
        return self._raw(self._short(segment, salt, limit) if len(segment) <= LONGEST else self._long(segment, salt, limit))

    def merge_without(self, segment: str, skips: Iterable[int]) -> tuple[bytes, int]:
        """The ids of one segment if the candidate merges of these numbers, in the order in which they
        leave the agenda, are skipped for good; and how many candidates left it."""
        turns = Turns(skips)
        symbols = self._short(segment, 0, 0, turns) if len(segment) <= LONGEST else self._long(segment, 0, 0, turns)
        return self._raw(symbols), turns.n

    def _raw(self, symbols: list[str]) -> bytes:
        ids = self.ids
        try:
            return array("i", [ids[x] for x in symbols]).tobytes()
        except KeyError:
            spelt = self.bytes
            return array("i", [i for x in symbols for i in ([ids[x]] if x in ids else [spelt[b] for b in x.encode()])]).tobytes()

    def _short(self, segment: str, salt: int, limit: int, turns: Turns | None = None) -> list[str]:
        symbols, rank = list(segment), self.ranks.get
        ranks = [rank(x, FAR) for x in map(str.__add__, symbols, symbols[1:])]
        places = list(range(len(symbols)))
        while ranks and (due := min(ranks)) < FAR:
            i = ranks.index(due)
            if (limit and (salt * (due * 65537 + places[i]) >> 32) & 0xFFFFFFFF < limit) or (turns and turns.skip()):
                ranks[i] = FAR
                continue
            piece = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del places[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(piece + symbols[i + 1], FAR)
            if i:
                ranks[i - 1] = rank(symbols[i - 1] + piece, FAR)
        return symbols

    def _long(self, segment: str, salt: int, limit: int, turns: Turns | None = None) -> list[str]:
        symbols: list[str | None] = list(segment)
        n, rank = len(symbols), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # One number for score and place; a merge that no longer stands has another rank by then.
        agenda = [r * n + i for i in range(n - 1) if (r := rank(symbols[i] + symbols[i + 1])) is not None]
        heapify(agenda)
        while agenda:
            due, i = divmod(heappop(agenda), n)
            j = after[i]
            if symbols[i] is None or j >= n:
                continue
            piece = symbols[i] + symbols[j]
            if rank(piece) != due or (limit and (salt * (due * 65537 + i) >> 32) & 0xFFFFFFFF < limit) or (turns and turns.skip()):
                continue
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(piece + symbols[k])) is not None:
                    heappush(agenda, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + piece)) is not None:
                heappush(agenda, r * n + h)
        return [x for x in symbols if x is not None]

    def encode(self, text: str, kept: Kept) -> bytes:
        """The ids of a text, four bytes each; an empty text has none."""
        if len(kept) >= KEPT:
            kept.clear()
        out: list[bytes] = []
        # A space sign written in the text itself is spelt in bytes, so that it isn't read as a space.
        for number, part in enumerate(text.split(SPACE)):
            if number:
                out.append(array("i", [self.bytes[b] for b in SPACE.encode()]).tobytes())
            part = (SPACE if number == 0 and text else "") + part.replace(" ", SPACE)
            out += map(kept.take, [part] if self.whole else self.cut.findall(part))
        return b"".join(out)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """What a run of ids decodes to, byte by byte, the space before the text included."""
        sizes = self.sizes[ids]
        upto = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[ids] - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)]

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids. Ids outside the vocabulary and control pieces are nothing."""
        if ids and not 0 <= min(ids) <= max(ids) < len(self.surface):
            ids = [i for i in ids if 0 <= i < len(self.surface)]
        raw = b"".join(map(self.surface.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class Turns:
    """Counts candidate merges and says which are skipped: those of the numbers that ``skips`` gives, in
    ascending order."""

    def __init__(self, skips: Iterable[int]):
        self.skips, self.n = iter(skips), 0
        self.next = next(self.skips, -1)

    def skip(self) -> bool:
        self.n += 1
        if self.n - 1 != self.next:
            return False
        self.next = next(self.skips, -1)
        return True


class Kept(dict):
    """The ids of segments met before; a new one is merged."""

    def __init__(self, pieces: Pieces, key: int = 0, limit: int = 0):
        super().__init__()
        self.pieces, self.key, self.limit = pieces, key, limit
        self.take = self.__getitem__

    def __missing__(self, segment: str) -> bytes:
        raw = self.pieces.merge(segment, self.key, self.limit)
        if len(segment) <= LONGEST:
            self[segment] = raw
        return raw


class Agendas:
    """The agendas of many short segments worked off side by side: in every step each segment's best
    candidate, the leftmost of equal ones, is merged or skipped."""

    def __init__(self, pieces: Pieces):
        self.size = size = len(pieces.surface)
        ids, found = pieces.ids, {}
        self.symbol = Symbols(ids, size)

        def known(part: str) -> int | None:
            return ids.get(part, size + ord(part) if len(part) == 1 else None)

        for piece, rank in pieces.ranks.items():
            for i in range(1, len(piece)):
                left, right = known(piece[:i]), known(piece[i:])
                if left is not None and right is not None:
                    found[left * SYMBOLS + right] = (rank, ids[piece])
        codes = np.array(sorted(found), np.int64)
        self.rank = np.array([found[c][0] for c in codes.tolist()] + [NONE], np.int32)
        self.into = np.array([found[c][1] for c in codes.tolist()] + [0], np.int32)
        self.codes = np.append(codes, -1)
        self.byte_ids = np.array([pieces.bytes.get(b, 0) for b in range(256)], np.int32)
        # Two tables by hash: what finds its place in the first taken is in the second, which has no clash.
        self.first, clashed = self._table(np.arange(len(codes)), 0)
        for self.turn in range(1, 1000):
            self.second, again = self._table(clashed, self.turn)
            if not len(again):
                return
        raise ValueError("no second table without a clash")

    def _slots(self, codes: np.ndarray, turn: int) -> np.ndarray:
        factor = np.uint64((0x9E3779B97F4A7C15 * (2 * turn + 1)) & MASK | 1)
        return (codes.view(np.uint64) * factor >> np.uint64(64 - SLOTS)).astype(np.int64)

    def _table(self, entries: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries by their slot, and those whose slot was taken."""
        table = np.full(1 << SLOTS, len(self.codes) - 1, np.int32)
        slots = self._slots(self.codes[entries], turn)
        _, one = np.unique(slots, return_index=True)
        table[slots[one]] = entries[one]
        return table, np.delete(entries, one)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair of symbols, or none, and what it merges into."""
        wanted, nothing = left.astype(np.int64) * SYMBOLS + right, len(self.codes) - 1
        at = self.first[self._slots(wanted, 0)]
        off = (at != nothing) & (self.codes[at] != wanted)
        if off.any():
            other = self.second[self._slots(wanted[off], self.turn)]
            at[off] = np.where(self.codes[other] == wanted[off], other, nothing)
        return self.rank[at], self.into[at]

    def work_off(self, symbols: np.ndarray, length: np.ndarray, skip: np.ndarray, later: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments as rows of symbols, filled up with -1, and the number of the first candidate that
        each skips (``later`` gives the distance to the next, for rows and their turns). Returns the
        symbols that are left, one row after the other, how many each row has, and its candidates."""
        rows, width = symbols.shape
        rank, into = self.pairs(symbols, np.concatenate([symbols[:, 1:], np.full((rows, 1), -1, np.int32)], axis=1))
        cells = np.stack([symbols, rank, into], axis=2)
        columns, candidates = np.arange(width), np.zeros(rows, np.int64)
        turn, skip, length = np.zeros(rows, np.int64), skip.copy(), length.copy()
        open_ = np.arange(rows)
        while len(open_):
            at = cells[open_, :, 1].argmin(axis=1)
            there = cells[open_, at, 1] < NONE
            open_, at = open_[there], at[there]
            skipped = candidates[open_] == skip[open_]
            candidates[open_] += 1
            row, i = open_, at
            if skipped.any():
                row = open_[skipped]
                cells[row, at[skipped], 1] = NONE
                turn[row] += 1
                skip[row] += 1 + later(row, turn[row])
                row, i = open_[~skipped], at[~skipped]
            made = cells[row, i, 2]
            moved = cells[row[:, None], np.minimum(columns + (columns > i[:, None]), width - 1)]
            moved[:, -1] = (-1, NONE, 0)
            here = np.arange(len(row))
            moved[here, i, 0] = made
            moved[here, i, 1], moved[here, i, 2] = self.pairs(made, np.where(i + 1 < width, moved[here, np.minimum(i + 1, width - 1), 0], -1))
            inner = np.flatnonzero(i > 0)
            moved[inner, i[inner] - 1, 1], moved[inner, i[inner] - 1, 2] = self.pairs(moved[inner, i[inner] - 1, 0], made[inner])
            cells[row] = moved
            length[row] -= 1
        return cells[columns < length[:, None], 0], length, candidates

    def spelt(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids from symbols: a character without a piece in the bytes of its UTF-8."""
        point = symbols.astype(np.int64) - self.size
        if not (point >= 0).any():
            return symbols, counts
        sizes = np.where(point < 0, 1, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
        upto = np.cumsum(sizes)
        out, point, of = np.repeat(symbols, sizes), np.repeat(point, sizes), np.repeat(sizes, sizes)
        place = np.arange(len(out)) - np.repeat(upto - sizes, sizes)
        bits = point >> 6 * (of - 1 - place)
        byte = np.where(place > 0, 0x80 | bits & 0x3F, np.where(of > 1, 0xF00 >> of & 0xFF | bits, bits))
        out = np.where(point >= 0, self.byte_ids[np.clip(byte, 0, 255)], out).astype(np.int32)
        rows = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(rows, sizes, len(counts)).astype(np.int64)


class Symbols(dict):
    """The symbol of a character: its piece, or a number beyond all pieces."""

    def __init__(self, ids: dict[str, int], size: int):
        super().__init__()
        self.ids, self.size = ids, size

    def __missing__(self, c: str) -> int:
        self[c] = out = self.ids.get(c, self.size + ord(c))
        return out


class Drawn:
    """Segments whose candidate merges are skipped by draws of their own, wherever they occur.

    The candidates of an occurrence are independent trials. Its draws, hashes of the document's key,
    the occurrence's number and their own, are distances to the next candidate that is skipped, so one
    draw tells whether it is disturbed at all. Plain segmentations are kept, with how many candidates
    they had; the disturbed occurrences of a batch go through their agendas side by side. A long
    segment has an agenda of its own, its draws are taken as its candidates leave it.
    """

    def __init__(self, pieces: Pieces, rate: float):
        self.pieces, self.rate, self.agendas = pieces, rate, Agendas(pieces)
        self.forget()

    def forget(self) -> None:
        # number 0: a space sign written in the text itself, spelt in bytes
        spelt = [self.pieces.bytes[b] for b in SPACE.encode()]
        self.plain: dict[str, int] = {}
        self.symbols, self.starts = array("i"), array("q", [0, 0])
        self.ids, self.at, self.size, self.n = array("i", spelt), array("q", [0]), array("q", [len(spelt)]), array("q", [0])
        self.plain[""] = 0

    def gaps(self, keys: np.ndarray, places: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Candidates that stand before the next one that is skipped, for occurrences and their draws' numbers."""
        if not 0 < self.rate < 1:
            return np.full(len(keys), 0 if self.rate else FAR, np.int64)
        salt = (turns.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        bits = mix(mix(keys + places.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)) ^ salt)
        return (np.log(((bits >> np.uint64(11)).astype(np.float64) + 1) / 2**53) / np.log1p(-self.rate)).astype(np.int64)

    def skips(self, key: int, place: int) -> Iterator[int]:
        """All skipped candidates of one occurrence, in order, as far as they are asked for."""
        keys, places, at, turn = np.array([key], np.uint64), np.array([place]), 0, 0
        while True:
            at += int(self.gaps(keys, places, np.array([turn]))[0])
            yield at
            at, turn = at + 1, turn + 1

    def segments(self, text: str) -> list[str]:
        """The segments of a text, a space sign of its own as itself and nothing else."""
        pieces, out = self.pieces, []
        for number, part in enumerate(text.split(SPACE)):
            out += [""] if number else []
            part = ("" if number else SPACE) + part.replace(" ", SPACE)
            out += ([part] if part else []) if pieces.whole else pieces.cut.findall(part)
        return out

    def _rows(self, number: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Kept segments as rows of symbols, those of like length together: which, rows, lengths."""
        starts, symbols = np.array(self.starts, np.int64), np.array(self.symbols, np.int32)
        length = starts[number + 1] - starts[number]
        lo = 0
        for width in (4, 6, 8, 10, 12, 16, 24, LONGEST):
            here = np.flatnonzero((length > lo) & (length <= width))
            for i in range(0, len(here), most // width):
                part = here[i : i + most // width]
                columns = np.arange(width)
                at = starts[number[part], None] + np.minimum(columns, length[part, None] - 1)
                yield part, np.where(columns < length[part, None], symbols[at], -1).astype(np.int32), length[part]
            lo = width

    def _learn(self, new: list[str]) -> None:
        """Segment plainly what hasn't been met."""
        first, symbol = len(self.n), self.agendas.symbol.__getitem__
        self.symbols.extend(map(symbol, chain.from_iterable(new)))
        self.starts.frombytes((self.starts[-1] + np.cumsum([len(x) for x in new])).astype(np.int64).tobytes())
        self.plain.update(zip(new, range(first, first + len(new)), strict=True))
        at, size, n = (np.zeros(len(new), np.int64) for _ in range(3))
        for part, rows, length in self._rows(np.arange(first, first + len(new))):
            left, counts, n[part] = self.agendas.work_off(rows, length, np.full(len(part), -1))
            left, size[part] = self.agendas.spelt(left, counts)
            at[part] = len(self.ids) + np.cumsum(size[part]) - size[part]
            self.ids.frombytes(left.astype(np.int32).tobytes())
        for kept, found in ((self.at, at), (self.size, size), (self.n, n)):
            kept.frombytes(found.tobytes())

    def encode(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if len(self.n) >= KEPT:
            self.forget()
        found = [self.segments(t) if t else [] for t in texts]
        known = self.plain
        new = [x for x in dict.fromkeys(chain.from_iterable(found)) if x not in known]
        longs = {x: -1 for x in new if len(x) > LONGEST}
        new = [x for x in new if x not in longs] if longs else new
        if new:
            self._learn(new)
        known.update(longs)  # for this batch only
        counts = np.array([len(f) for f in found], np.int64)
        number = np.fromiter(map(known.__getitem__, chain.from_iterable(found)), np.int64, int(counts.sum()))
        for x in longs:
            del known[x]
        row = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
        key = np.array(keys, np.uint64)[row]
        pool = [np.array(self.ids, np.int32)]
        starts, sizes, total = np.array(self.at, np.int64)[number], np.array(self.size, np.int64)[number], len(pool[0])

        def put(which: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
            nonlocal total
            starts[which], sizes[which] = total + np.cumsum(counts) - counts, counts
            pool.append(ids)
            total += len(ids)

        for i in np.flatnonzero(number < 0).tolist():
            segment = found[row[i]][place[i]]
            ids = np.frombuffer(self.pieces.merge_without(segment, self.skips(int(key[i]), int(place[i])))[0], np.int32)
            put(np.array([i]), ids, np.array([len(ids)]))
        first = self.gaps(key, place, np.zeros(len(number), np.int64))
        hit = np.flatnonzero((number >= 0) & (first < np.array(self.n, np.int64)[number]))
        for part, rows, length in self._rows(number[hit]):
            which = hit[part]

            def later(some, turns, which=which):
                return self.gaps(key[which[some]], place[which[some]], turns)

            put(which, *self.agendas.spelt(*self.agendas.work_off(rows, length, first[which], later)[:2]))
        upto = np.cumsum(sizes)
        flat = np.concatenate(pool)[np.repeat(starts - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)]
        return flat, np.bincount(row, sizes, len(texts)).astype(np.int64)


def _encode(proto, rate: float, seed: int, streams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(proto.value)
        kept = [Kept(pieces, (seed * 0x9E3779B97F4A7C15 + i) & MASK, int(rate * 2**32)) for i in range(streams)]
        drawn = Drawn(pieces, rate)
        for batch in (part for whole in batches for part in slices(whole, "text", TEXT)):
            texts, dealt = [t or "" for t in batch["text"].to_pylist()], batch["stream"].to_pylist()
            if streams:
                found = [np.frombuffer(pieces.encode(t, kept[s]), np.int32) for t, s in zip(texts, dealt, strict=True)]
                flat, sizes = (np.concatenate(found) if found else np.zeros(0, np.int32)), [len(x) for x in found]
            else:
                flat, sizes = drawn.encode(texts, [xxhash.xxh64_intdigest(t, (seed * 0x9E3779B97F4A7C15 + s) & MASK) for t, s in zip(texts, dealt, strict=True)])
            ends = np.cumsum([0, *sizes])
            raw, cuts = pieces.bytes_of(flat), np.concatenate([[0], np.cumsum(pieces.sizes[flat])])[ends]
            same = [raw[lo:hi].tobytes() == (b" " + t.encode() if t else b"") for t, lo, hi in zip(texts, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            others = [batch[i] for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*others, lists, pa.array(same, pa.bool_())], names=[*batch.schema.names[:-2], "ids", "restored"])

    return run


def _decode(proto):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(proto.value)
        for batch in batches:
            texts = [pieces.decode([i for i in x if i is not None]) if x is not None else None for x in batch["ids"].to_pylist()]
            others = [batch[i] for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*others, pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])

    return run


def _shared(spark, model: str):
    """The model's bytes, half a megabyte, sent once to each executor, which need not have the file."""
    with open(model, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_texts(
    docs: DataFrame, dropout: float = 0.1, seed: int = 0, streams: int = 1, model: str = MODEL, doc_id: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``carry`` of each row, its ``ids`` and ``restored``: whether they decode to the text.

    Pieces are built by merging from single characters, best score first; each candidate merge is
    skipped with probability ``dropout`` by a hash of the seed, the segment, the piece and the place,
    so a rerun agrees and another seed segments anew. With ``streams`` above 1 documents are
    dealt by their id to as many independent segmentations. With ``streams`` 0 every occurrence is
    segmented by draws of its own, a hash of the seed, the row's id and text, the occurrence's and the
    draw's number.
    A ``dropout`` of 0 gives the model's own encoding, 1 single
    characters. Characters without a piece are spelt in bytes. A null text counts as
    empty and has no ids. Rows are independent: nothing is shuffled, repeated rows give equal ids.
    """
    proto = _shared(docs.sparkSession, model)
    stream: Column = F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    if streams:
        stream = F.pmod(stream, F.lit(streams))
    kinds = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carry))
    rows = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)), F.col(text).alias("text"), stream.alias("stream"))
    out = rows.mapInArrow(_encode(proto, dropout, seed, streams), f"{kinds}ids array<int>, restored boolean")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "ids", "restored")


def decode_ids(rows: DataFrame, model: str = MODEL, ids: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of each row and the ``text`` of its ids; null ids give a null text."""
    kinds = "".join(f"c{i} {rows.schema[c].dataType.simpleString()}, " for i, c in enumerate(carry))
    picked = rows.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)), F.col(ids).cast("array<int>").alias("ids"))
    out = picked.mapInArrow(_decode(_shared(rows.sparkSession, model)), f"{kinds}text string")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "text")


def op7_pieces(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_texts(docs, dropout=0.1, seed=7, streams=0).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "restored")
