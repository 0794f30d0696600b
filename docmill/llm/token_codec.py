"""Token ids in compressed files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

A block of `BLOCK` ids starts from an empty model and numbers its distinct ids by first appearance. Three orders predict the next
number: what last followed the two ids before (order 2), what last followed the one before (order 1), each with a confidence, and
the frequencies of all ids of the block so far (order 0), with an escape for new ones. An id's probability is the weighted sum of
what the three give it, so a guess that two orders share, or that is frequent anyway, gets all of it. The weights stand under both
confidences and move, after each id, towards the share that each order had in its probability. A new id follows its escape: its bit
length by adaptive frequencies, the lower bits evenly. A carry-less range coder turns the shares into 16-bit words. Blocks share
nothing, so a task codes many in step, one numpy lane a block, and a damaged block (wrong checksum) harms no other.

Format: Parquet files as containers, in ascending id order; a row is a block: file and block number, number of ids, crc32 of
them, the documents that begin in it (number in the file, id, place) and the code words. Vocabularies are limited to 65,536 ids.

Defined cases: a null or empty text is its end id alone; null document ids sort first; rows with equal ids are written in the
order of their texts' hashes, each with its own place; an empty table gives no file and no row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.subwords import Encoder, default_vocabulary
from docmill.session import work_dir, written

BLOCK = 4096
LANES = 1024
END_ID = 2
#: Bits of the code range that the mixed shares divide, and of the one that lengths of new ids divide.
MIXED_BITS, LENGTH_BITS = 24, 16
SLOTS2, LEVELS, LENGTHS = 4096, 8, 17
STEP, RATE = 32, 5
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
U16, U48 = np.uint64(16), np.uint64(48)
WHOLE, ROOM = 1 << MIXED_BITS, (1 << LENGTH_BITS) - LENGTHS
#: A number's two digits; row d: 1 for the digits after d, added to running sums where a number with digit d came.
DIGIT = 64
AFTER = np.triu(np.ones((DIGIT, DIGIT), np.int16), 1)
ONES = np.ones(DIGIT, np.float32)
BIT_LENGTH = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)
FILES = "file_no int, block_no long, n_ids int, ids_crc32 long, doc_nos array<long>, doc_ids array<long>, places array<int>, code binary"
_NAMES = [x.split()[0] for x in FILES.split(", ")]


def _last(sums: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Of each row of ascending sums, the last one that is not above its limit."""
    return ((sums <= most[:, None]).astype(np.float32) @ ONES).astype(np.int64) - 1


class Model:
    """The adaptive state of n blocks, one lane each. Ids are numbered by first appearance in their block."""

    def __init__(self, n: int):
        # A guess and its confidence (the lower three bits) in one entry: one look into memory for both. Confidence 0: none.
        self.slots2, self.slots1 = np.zeros(n * SLOTS2, np.int32), np.zeros(n * BLOCK, np.int32)
        level = np.arange(LEVELS)
        sure = np.where(level > 0, 4000 + 7000 * (level - 1), 0)
        weight2 = np.repeat(sure, LEVELS)  # by confidence of order 2, then of order 1
        self.weight2, self.weight1 = np.tile(weight2, n), np.tile((65536 - weight2) * np.tile(sure, LEVELS) >> 16, n)
        # How often each number came, and running sums over its first digit and, for each of those, over its second.
        self.count = np.zeros(n * BLOCK, np.int16)
        self.high, self.low = np.zeros((n, DIGIT), np.int16), np.zeros((n * DIGIT, DIGIT), np.int16)
        self.highs, self.lows = self.high.reshape(-1), self.low.reshape(-1)
        self.lengths = np.ones((n, LENGTHS), np.int64)
        self.kinds, self.last, self.last2 = (np.zeros(n, np.int64) for _ in range(3))
        self.lane = np.arange(n, dtype=np.int64)
        self.base2, self.base, self.mixed = self.lane * SLOTS2, self.lane * BLOCK, self.lane * LEVELS**2

    def predict(self, n: int, seen: int) -> None:
        """Guesses of the first n lanes after so many ids, and what each order weighs of the code range."""
        last = self.last[:n]
        self.at2 = self.base2[:n] + ((last * 40503 + self.last2[:n] * 30011) >> 4 & (SLOTS2 - 1))
        self.at1 = self.base[:n] + last
        held2, held1 = self.slots2.take(self.at2), self.slots1.take(self.at1)
        self.guess2, self.guess1 = held2 >> 3, held1 >> 3
        self.level2, self.level1 = held2 & 7, held1 & 7
        self.at = self.mixed[:n] + self.level2 * LEVELS + self.level1
        self.old2, self.old1 = self.weight2.take(self.at), self.weight1.take(self.at)
        # Order 0 keeps a 64th of the range, so every share is wider than nothing.
        self.share2 = np.where(self.level2 > 0, self.old2 * 63 >> 6, 0) << MIXED_BITS - 16
        self.share1 = np.where(self.level1 > 0, self.old1 * 63 >> 6, 0) << MIXED_BITS - 16
        self.guesses = self.share2 + self.share1
        self.share0 = (WHOLE - self.guesses).astype(float)
        self.seen, self.total = seen, (self.kinds[:n] + (seen + 1)).astype(float)  # one for each kind and one more: the escape

    def interval(self, number: np.ndarray, lane: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of a known number's mixed share, in the lanes given.

        Quotients are of whole numbers below 2 ** 37 by some below 2 ** 14, so their whole parts are exact in double precision.
        """
        at = self.base[lane] + number
        low = self.highs.take(at >> 6) + self.lows.take(at)
        share0, total = self.share0[lane], self.total[lane]
        start = (share0 * low / total).astype(np.int64)
        end = (share0 * (low + self.count.take(at)) / total).astype(np.int64)
        for guess, share in ((self.guess2[lane], self.share2[lane]), (self.guess1[lane], self.share1[lane])):
            start += share * (guess < number)
            end += share * (guess <= number)
        return start, end

    def escape(self) -> np.ndarray:
        """Where the share of new ids begins; it reaches to the end."""
        return (self.share0 * self.seen / self.total).astype(np.int64) + self.guesses

    def find(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What stands at a place of the code range: the number (the next one: a new id), whether it is new, start and end of its share."""
        n = len(slot)
        start, end = self.escape(), np.full(n, WHOLE, np.int64)
        number, new = self.kinds[:n].copy(), slot >= start
        rest, own = slot, np.flatnonzero(~new)
        for guess, share, level, lane in ((self.guess2, self.share2, self.level2, slice(0, n)), (self.guess1, self.share1, self.level1, None)):
            lane = own if lane is None else lane
            asked = guess[lane].astype(np.int64)
            begin, stop = self.interval(asked, lane)
            beyond = slot[lane] >= stop
            hit = (slot[lane] >= begin) & ~beyond & (level[lane] > 0)
            rest = rest - share[lane] * beyond  # an order without a guess has no share
            if lane is own:
                got, rest, own = own[hit], rest[~hit], own[~hit]
            else:
                hit &= ~new
                got, own = np.flatnonzero(hit), np.flatnonzero(~(hit | new))
                rest = rest[own]
            number[got], start[got], end[got] = asked[hit], begin[hit], stop[hit]
        if len(own):
            # The last count that begins at or before the place; then its digits, each the last whose sum is not above the rest.
            left = np.ceil((rest + 1) * self.total[own] / self.share0[own]).astype(np.int16) - np.int16(1)
            first = _last(self.high.take(own, axis=0), left)
            row = own * DIGIT + first
            left -= self.highs.take(row)
            got = first * DIGIT + _last(self.low.take(row, axis=0), left)
            number[own] = got
            start[own], end[own] = self.interval(got, own)
        return number, new, start, end

    def length_interval(self, length: np.ndarray, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the share of new ids of this bit length."""
        sums = np.cumsum(self.lengths[lane], axis=1)
        every, high = sums[:, -1], sums[np.arange(len(lane)), length]
        low = high - self.lengths[lane, length]
        start = ROOM * low // every + length
        return start, ROOM * high // every + length + 1 - start

    def find_length(self, slot: np.ndarray, lane: np.ndarray) -> np.ndarray:
        sums = np.cumsum(self.lengths[lane], axis=1)
        starts = ROOM * sums[:, :-1] // sums[:, -1:] + np.arange(1, LENGTHS)
        return (starts <= slot[:, None]).sum(axis=1)

    def learn_length(self, length: np.ndarray, lane: np.ndarray) -> None:
        self.lengths[lane, length] += STEP

    def learn(self, number: np.ndarray, new: np.ndarray, width: np.ndarray) -> None:
        """Adapt to the numbers that came, each with its share's width."""
        n = len(number)
        hit2, hit1 = (self.guess2 == number) & ~new, (self.guess1 == number) & ~new
        # Each order's part of the probability, of 65,536; the weights move towards it.
        for weight, old, share, hit in ((self.weight2, self.old2, self.share2, hit2), (self.weight1, self.old1, self.share1, hit1)):
            weight[self.at] = old + (((share * hit << 16) / width).astype(np.int64) - old >> RATE)
        self.slots2[self.at2] = self._entry(number, hit2, self.guess2, self.level2)
        self.slots1[self.at1] = self._entry(number, hit1, self.guess1, self.level1)
        at = self.base[:n] + number
        self.high[:n] += AFTER.take(number >> 6, axis=0)
        row = at >> 6
        self.low[row] = self.low.take(row, axis=0) + AFTER.take(number & 63, axis=0)
        self.count[at] = self.count.take(at) + np.int16(1)
        self.kinds[:n] += new
        self.last2[:n] = self.last[:n]
        self.last[:n] = number

    @staticmethod
    def _entry(number, hit, guess, level):
        """A right guess grows surer, a wrong one is halved, and an unsure wrong one gives way."""
        weak = (level <= 1) & ~hit
        return np.where(weak, number << 3 | 1, guess << 3 | np.where(hit, np.minimum(level + 1, LEVELS - 1), level >> 1))


class _Range:
    """The code range of n lanes: where it begins and how wide it is."""

    def __init__(self, n: int):
        self.low, self.width = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64)

    def narrow(self, lane: np.ndarray | slice, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        """To a share of 2 ** bits."""
        unit = self.width[lane] >> np.uint64(bits)
        self.low[lane] += unit * start.view(np.uint64)
        self.width[lane] = unit * size.view(np.uint64)

    def lower_bits(self, lane: np.ndarray, value: np.ndarray, bits: np.ndarray) -> None:
        unit = self.width[lane] >> bits.view(np.uint64)
        self.low[lane] += unit * value.view(np.uint64)
        self.width[lane] = unit

    def full(self, lane: np.ndarray | slice) -> np.ndarray:
        """Those of the lanes (a slice: from the first) whose first word is settled; it is shifted out by `shift`."""
        a, b = self.low[lane], self.width[lane]
        own = np.flatnonzero(((a ^ (a + b)) < TOP) | (b < BOTTOM))
        return own if isinstance(lane, slice) else lane[own]

    def shift(self, lane: np.ndarray) -> None:
        a, b = self.low[lane], self.width[lane]
        b = np.where((a ^ (a + b)) < TOP, b, (~a + np.uint64(1)) & (BOTTOM - np.uint64(1)))
        self.low[lane], self.width[lane] = a << U16, b << U16


def _numbered(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a block's ids by first appearance, and which of them are new."""
    _, first, back = np.unique(block, return_index=True, return_inverse=True)
    order = np.argsort(first)
    number = np.empty(len(first), np.int64)
    number[order] = np.arange(len(first))
    new = np.zeros(len(block), bool)
    new[first] = True
    return number[back], new


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code words of each block of ids."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    n, longest = len(blocks), len(blocks[order[0]]) if blocks else 0
    ids, numbers, news = (np.zeros((longest, n), kind) for kind in (np.uint16, np.int16, bool))
    lengths = np.array([len(blocks[i]) for i in order], np.int64)
    for lane, i in enumerate(order):
        size = lengths[lane]
        ids[:size, lane] = blocks[i]
        numbers[:size, lane], news[:size, lane] = _numbered(blocks[i])
    model, code = Model(n), _Range(n)
    out, at = np.zeros((n, 3 * longest + 8), np.uint16), np.zeros(n, np.int64)

    def settle(lane: np.ndarray | slice) -> None:
        while len(lane := code.full(lane)):
            out[lane, at[lane]] = code.low[lane] >> U48
            at[lane] += 1
            code.shift(lane)

    live = np.searchsorted(-lengths, -np.arange(longest), side="left")
    for t in range(longest):
        k = int(live[t])
        lane, number, new = slice(0, k), numbers[t, :k].astype(np.int64), news[t, :k]
        model.predict(k, t)
        start, end = model.interval(number, lane)
        start, end = np.where(new, model.escape(), start), np.where(new, WHOLE, end)
        code.narrow(lane, start, end - start, MIXED_BITS)
        settle(lane)
        fresh = np.flatnonzero(new)
        if len(fresh):
            own = ids[t, fresh].astype(np.int64)
            length = BIT_LENGTH[own].astype(np.int64)
            code.narrow(fresh, *model.length_interval(length, fresh), LENGTH_BITS)
            bits = np.maximum(length - 1, 0)
            code.lower_bits(fresh, own & ((np.int64(1) << bits) - 1), bits)
            settle(fresh)
            model.learn_length(length, fresh)
        model.learn(number, new, end - start)
    codes: list[bytes] = [b""] * n
    for lane, i in enumerate(order):
        codes[i] = out[lane, : at[lane]].astype(">u2").tobytes() + int(code.low[lane]).to_bytes(8, "big")
    return codes


def decode_blocks(codes: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block."""
    order = sorted(range(len(codes)), key=lambda i: -sizes[i])
    n, longest = len(codes), sizes[order[0]] if codes else 0
    lengths = np.array([sizes[i] for i in order], np.int64)
    widest = max((len(c) // 2 for c in codes), default=0) + 4
    words = np.zeros((n, widest), np.uint64)
    for lane, i in enumerate(order):
        words[lane, : len(codes[i]) // 2] = np.frombuffer(codes[i], ">u2")
    words, at = words.reshape(-1), np.arange(n, dtype=np.int64) * widest
    model, code, value = Model(n), _Range(n), np.zeros(n, np.uint64)
    for _ in range(4):
        value = (value << U16) | words[at]
        at += 1

    def place(lane: np.ndarray | slice, bits: int) -> np.ndarray:
        unit = code.width[lane] >> np.uint64(bits)
        return np.minimum((value[lane] - code.low[lane]) // unit, np.uint64((1 << bits) - 1)).astype(np.int64)

    def settle(lane: np.ndarray | slice) -> None:
        while len(lane := code.full(lane)):
            value[lane] = (value[lane] << U16) | words[at[lane]]
            at[lane] += 1
            code.shift(lane)

    ids, known = np.zeros((longest, n), np.uint16), np.zeros(n * BLOCK, np.uint16)
    live = np.searchsorted(-lengths, -np.arange(longest), side="left")
    for t in range(longest):
        k = int(live[t])
        lane = slice(0, k)
        model.predict(k, t)
        number, new, start, end = model.find(place(lane, MIXED_BITS))
        code.narrow(lane, start, end - start, MIXED_BITS)
        settle(lane)
        fresh = np.flatnonzero(new)
        if len(fresh):
            length = model.find_length(place(fresh, LENGTH_BITS), fresh)
            code.narrow(fresh, *model.length_interval(length, fresh), LENGTH_BITS)
            bits = np.maximum(length - 1, 0)
            lower = (value[fresh] - code.low[fresh]) // (code.width[fresh] >> bits.view(np.uint64))
            code.lower_bits(fresh, lower.view(np.int64), bits)
            settle(fresh)
            model.learn_length(length, fresh)
            known[model.base[fresh] + number[fresh]] = np.where(length > 0, np.int64(1) << bits, 0) | lower.view(np.int64)
        ids[t, :k] = known[model.base[:k] + number]
        model.learn(number, new, end - start)
    back: list[np.ndarray] = [np.zeros(0, "<u4")] * n
    for lane, i in enumerate(order):
        back[i] = ids[: lengths[lane], lane].astype("<u4")
    return back


class _Writer:
    """Gathers one file's documents into blocks and codes them many at a time."""

    def __init__(self, file_no: int):
        self.file_no, self.block_no, self.n_docs, self.held, self.size = file_no, 0, 0, [], 0
        self.starts: list[tuple[int, int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.starts.append((self.n_docs, doc_id, self.size))
        self.n_docs += 1
        self.held.append(ids)
        self.size += len(ids)

    def batch(self, last: bool = False) -> pa.RecordBatch | None:
        stream = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        end = len(stream) if last else len(stream) // BLOCK * BLOCK
        blocks = [stream[lo : min(lo + BLOCK, end)] for lo in range(0, end, BLOCK)]
        if not blocks:
            return None
        codes, begins = [c for lo in range(0, len(blocks), LANES) for c in encode_blocks(blocks[lo : lo + LANES])], [[] for _ in blocks]
        ahead = []
        for no, doc_id, at in self.starts:
            if at < end:
                begins[at // BLOCK].append((no, doc_id, at % BLOCK))
            else:
                ahead.append((no, doc_id, at - end))
        first = self.block_no
        self.held, self.size, self.starts, self.block_no = [stream[end:]], len(stream) - end, ahead, first + len(blocks)
        column = lambda j, kind: pa.array([[x[j] for x in b] for b in begins], pa.list_(kind))
        return pa.RecordBatch.from_arrays([
            pa.array([self.file_no] * len(blocks), pa.int32()), pa.array(range(first, first + len(blocks)), pa.int64()), pa.array([len(b) for b in blocks], pa.int32()),
            pa.array([zlib.crc32(b.astype("<u4").tobytes()) for b in blocks], pa.int64()), column(0, pa.int64()), column(1, pa.int64()), column(2, pa.int32()), pa.array(codes, pa.binary()),
        ], _NAMES)


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Tokenise the documents and write their ids, in ascending doc_id order over files and blocks."""
    file = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer = Encoder.of(file), _Writer(TaskContext.get().partitionId())
        if encode.size > 1 << 16:
            raise ValueError(f"the format holds ids below 65536; the vocabulary has {encode.size}")
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                writer.add(doc_id, np.append(encode(text.as_py()), np.uint32(end_id)))
                if writer.size >= LANES * BLOCK and (done := writer.batch()):
                    yield done
        if done := writer.batch(last=True):
            yield done

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(parts, "doc_id", "row").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.select("doc_id", "text").mapInArrow(run, FILES).write.parquet(path)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block holds of each document, decoded and held against its checksum."""
    names = ["file_no", "block_no", "doc_no", "doc_id", "place", "n", "crc"]
    for batch in batches:
        for lo in range(0, batch.num_rows, LANES):
            rows = batch.slice(lo, LANES).to_pylist()
            out = []
            for r, ids in zip(rows, decode_blocks([r["code"] for r in rows], [r["n_ids"] for r in rows]), strict=True):
                if zlib.crc32(ids.tobytes()) != r["ids_crc32"]:
                    raise ValueError(f"file {r['file_no']}, block {r['block_no']}: wrong checksum")
                places = [*r["places"], len(ids)]
                head = places[0]
                if head:  # the end of a document that began before
                    out.append((r["file_no"], r["block_no"], None, None, 0, head, zlib.crc32(ids[:head].tobytes())))
                for no, doc_id, a, b in zip(r["doc_nos"], r["doc_ids"], places[:-1], places[1:], strict=True):
                    out.append((r["file_no"], r["block_no"], no, doc_id, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


#: The polynomial of crc32, lowest bit first.
CRC_POLYNOMIAL = 0xEDB88320


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo crc32's, bit-reversed as the checksum is."""
    out, b = np.zeros_like(a), b.copy()
    for k in range(31, -1, -1):
        out ^= np.where(a >> np.uint64(k) & np.uint64(1), b, np.uint64(0))
        b = (b >> np.uint64(1)) ^ np.where(b & np.uint64(1), np.uint64(CRC_POLYNOMIAL), np.uint64(0))
    return out


def _shifts() -> np.ndarray:
    """By a number of ids: the polynomial that moves a checksum on by so many 4-byte ids."""
    table = np.array([1 << 31, 1 << 31], np.uint64)
    table[1] = np.uint64(0x80000000) >> np.uint64(1)
    step = table[1:2]
    for _ in range(5):  # x, then x ** 32
        step = _times(step, step)
    table = table[:1]
    while len(table) <= BLOCK:
        table = np.concatenate([table, _times(table, np.repeat(step, len(table)))])
        step = _times(step, step)
    return table[: BLOCK + 1]


def joined_checksums(crc: list[list[int]], n: list[list[int]]) -> list[int]:
    """crc32 of pieces put one after another, from their checksums and lengths in ids; no piece is longer than a block."""
    shift = _shifts()
    total = np.zeros(len(crc), np.uint64)
    for j in range(max(map(len, crc), default=0)):
        own = np.array([i for i, c in enumerate(crc) if len(c) > j], np.int64)
        by = shift[np.array([n[i][j] for i in own], np.int64)]
        total[own] = _times(total[own], by) ^ np.array([crc[i][j] for i in own], np.uint64)
    return total.tolist()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = batch.column("parts").to_pylist()
        crc = joined_checksums([[p["crc"] for p in x] for x in parts], [[p["n"] for p in x] for x in parts])
        keep = batch.select(["file_no", "doc_id", "at", "n_tokens"])
        yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(crc, pa.int64())], [*keep.schema.names, "ids_crc32"])


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    files = spark.read.schema(FILES).parquet(path)
    # Stored, so that every block is decoded once.
    pieces = written(files.mapInArrow(_pieces, "file_no long, block_no long, doc_no long, doc_id long, place long, n long, crc long"), "pieces")
    # A piece without a number belongs to the last document of a block before it; whole runs of such blocks are looked up.
    starts = files.select("file_no", "block_no", F.array_max("doc_nos").alias("last_no"))
    before = starts.withColumn("open_no", F.max("last_no").over(Window.partitionBy("file_no").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)))
    tails = pieces.where("doc_no IS NULL").drop("doc_no").join(before.select(F.col("file_no").cast("long").alias("file_no"), "block_no", F.col("open_no").alias("doc_no")), ["file_no", "block_no"])
    every = pieces.where("doc_no IS NOT NULL").unionByName(tails)
    docs = every.groupBy("file_no", "doc_no").agg(
        F.max("doc_id").alias("doc_id"), F.min(F.col("block_no") * BLOCK + F.col("place")).alias("at"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("block_no", "n", "crc"))).alias("parts"),
    ).mapInArrow(_fold, "file_no long, doc_id long, at long, n_tokens long, ids_crc32 long")
    sizes = files.groupBy(F.col("file_no").cast("long").alias("file_no")).agg(F.sum("n_ids").alias("n"))
    bases = sizes.select("file_no", (F.sum("n").over(Window.orderBy("file_no")) - F.col("n")).alias("base"))
    return docs.join(bases, "file_no").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the documents' ids to the shared folder and report them as read back."""
    path = work_dir(docs.sparkSession, "tokens")
    write(docs, path, vocabulary, end_id)
    return read(docs.sparkSession, path)
