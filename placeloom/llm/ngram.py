"""LM scoring: a smoothed n-gram model kept in Elias-Fano n-gram tries, one trie for each order and shard of contexts.

Texts become chunks of about ``CHUNK`` tokens. Each chunk sends its distinct words, with their counts in training texts, to the shards
that own them, and gets back their counts and ranks (a word's number in the whole corpus, small for frequent words). Then, order by
order, it sends its distinct n-grams with their counts to the shards that own their contexts. A shard adds up the counts, builds its
trie, answers every n-gram of every chunk from it, and returns codes; in the end each chunk sums its documents. What moves are
sorted distinct n-grams, coded by gaps and compressed, and 16-bit answers: no chunk sends an n-gram twice and none sends an empty message, so
bytes and messages are at most proportional to the distinct n-grams of the chunks. No part of the model goes to the driver but the sizes
N and V and the few contexts that hold a shard's worth of tokens, whose successors are spread over shards.

The trie: level 1 has context keys, level 2 the successors of each context, ascending relative to their context, both with
Elias-Fano coding; monotone pointers (Elias-Fano too) delimit the successors of a context; probabilities are quantised
logarithms. High bits are searched through one 32-bit count for each 64 of them. Levels are parts of one block of memory that may be a
file mapped into memory. A lookup finds the context, then searches its successor range.

P_n(w|c) = max(n(c,w) - D, 0) / n(c) + D * types(c) / n(c) * P_{n-1}(w|c'), where c' is c without its first word, and
P_1(w) = (n(w) + 0.5) / (N + 0.5 (V + 1)); an unseen context leaves P_{n-1}. Each text starts from order - 1 start marks and ends with an
end token. Words are told apart by 64-bit hashes; contexts of one or two words are exact pairs of ranks, longer ones 64-bit hashes of
them.

Defined results: null and empty texts have one token, the end; without training texts every word is unknown and N = V = 0;
a null in ``training`` is false; null and repeated keys are scored each, repeated rows are counted each; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import U, Words, mix, slices, text_bytes
from placeloom.plans.scratch import Scratch

ORDER = 3
DISCOUNT = 0.75
_END = U(0x0E0D0E0D0E0D0E0D)
_STEP = 1 / 4096  # of quantised log10 probabilities
_SPREAD = 64  # shards of a hot context
_NONE = np.uint16(0)
CHUNK = 1_500_000
LOOKUPS = 200_000  # pairs that are looked up together


_L8, _H8 = U(0x0101010101010101), U(0x8080808080808080)
#: Place of the set bit number r of a byte, by r and byte.
_IN_BYTE = np.array([[next((i for i in range(8) if (b >> i) & 1 and (b & ((1 << i) - 1)).bit_count() == r), 8) for b in range(256)] for r in range(8)], np.uint8)


def _select(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``r`` (from 0) of each 64-bit word: counts of all bytes at once, then a table."""
    r = r.astype(np.uint64)
    s = x - ((x >> U(1)) & U(0x5555555555555555))
    s = (s & U(0x3333333333333333)) + ((s >> U(2)) & U(0x3333333333333333))
    s = ((s + (s >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * _L8  # byte i: set bits of bytes 0 to i
    place = ((((((r * _L8) | _H8) - s) & _H8) >> U(7)) * _L8 >> U(56)) * U(8)  # whole bytes with r set bits at most
    rest = r - ((s << U(8)) >> place & U(255))
    return (place + _IN_BYTE[rest, x >> place & U(255)]).astype(np.int64)


class EliasFano:
    """An ascending sequence of unsigned integers: low bits packed, high bits unary.

    Each word of 64 high bits has the count of set bits before it; the word of every 64th set and every 64th clear bit is sampled.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        kind = np.uint32 if len(high) < 1 << 26 else np.uint64
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)]).astype(kind)
        ones, zeros = self.ones.astype(np.int64), 64 * np.arange(len(high) + 1) - self.ones
        self.samples = [np.searchsorted(x, np.arange(0, int(x[-1]) + 1, 64), "right").astype(kind) - kind(1) for x in (zeros, ones)]
        self.last = int(zeros[-1])  # zeros in all

    def _place(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Places of the clear (0) or set (1) bits of these numbers."""
        word = np.minimum(self.samples[bit][k >> 6].astype(np.int64), len(self.high) - 1)
        before = lambda w: self.ones[w].astype(np.int64) if bit else 64 * w - self.ones[w]
        on = np.arange(len(k))
        for _ in range(16):
            on = on[before(word[on] + 1) <= k[on]]
            if not len(on):
                break
            word[on] += 1
        else:  # a long run of the other bit
            every = self.ones.astype(np.int64) if bit else 64 * np.arange(len(self.ones)) - self.ones
            word[on] = np.searchsorted(every, k[on], "right") - 1
        return 64 * word + _select(self.high[word] if bit else ~self.high[word], k - before(word))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        words = np.zeros((n * low_bits + 63) // 64 + 1, np.uint64)
        if low_bits and n:
            low = values & U((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.int64) * low_bits
            shift = (at & 63).astype(np.uint64)
            cls._or_into(words, at >> 6, low << shift)
            over = np.flatnonzero(shift > U(64 - low_bits))
            words[(at[over] >> 6) + 1] |= low[over] >> (U(64) - shift[over])  # one for each border
        place = (values >> U(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(place[-1]) if n else 0) >> 6) + 2, np.uint64)
        cls._or_into(bits, place >> 6, U(1) << (place & 63).astype(np.uint64))
        return cls(n, low_bits, words, bits)

    @staticmethod
    def _or_into(words: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        """ORs values into words at ascending places."""
        if len(at):
            start = np.flatnonzero(np.diff(at, prepend=-1))
            words[at[start]] |= np.bitwise_or.reduceat(value, start)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        got = self.low[word] >> shift
        over = shift > U(64 - self.low_bits)
        got[over] |= self.low[word[over] + 1] << (U(64) - shift[over])
        return got & U((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self._place(i, 1) - i).astype(np.uint64) << U(self.low_bits) | self._low(i)

    def _range(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 place of the elements with this high part, which stand between two clear bits."""
        start = np.zeros(len(high), np.int64)
        on = np.flatnonzero(high > 0)
        start[on] = self._place(high[on] - 1, 0) + 1
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        ahead = self.high[word] >> shift
        over = np.flatnonzero(shift)
        ahead[over] |= self.high[np.minimum(word[over] + 1, len(self.high) - 1)] << (U(64) - shift[over])
        clear = ~ahead
        run = np.bitwise_count((clear & (~clear + U(1))) - U(1)).astype(np.int64)  # set bits up to the next clear one
        long = np.flatnonzero(run >= 64)
        run[long] = self._place(high[long], 0) - start[long]
        return start - high, start - high + run

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first element not below each value (the successor; n if there is none), and whether it is the value."""
        high = values >> U(self.low_bits)
        beyond = high >= U(self.last)
        a, end = self._range(np.where(beyond, U(0), high).astype(np.int64))
        a[beyond] = end[beyond] = self.n
        b, want = end.copy(), values & U((1 << self.low_bits) - 1)
        on = np.flatnonzero(a < b)
        while len(on):
            mid = (a[on] + b[on]) // 2
            less = self._low(mid) < want[on]
            a[on[less]] = mid[less] + 1
            b[on[~less]] = mid[~less]
            on = on[a[on] < b[on]]
        same = a < end
        same[same] = self._low(a[same]) == want[same]
        return a, same


class NgramTrie:
    """Contexts, their successors and quantised probabilities; ``levels`` are arrays over one block of memory."""

    def __init__(self, levels: list[np.ndarray]):
        head = levels[0]
        self.levels, self.width = levels, int(head[6])
        self.context = EliasFano(int(head[0]), int(head[1]), levels[1], levels[2])
        self.pointer = EliasFano(int(head[2]), int(head[3]), levels[3], levels[4])
        self.successor = EliasFano(int(head[4]), int(head[5]), levels[5], levels[6])
        self.code, self.backoff = levels[7], levels[8]

    @classmethod
    def build(cls, context: np.ndarray, successor: np.ndarray, count: np.ndarray, known: dict[int, int], width: int) -> NgramTrie:
        """From distinct (context, successor of ``width`` bits) pairs sorted by both; ``known`` has totals of contexts that are spread over tries."""
        start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        keys = context[start]
        types = np.diff(np.append(start, len(context)))
        total = np.add.reduceat(count, start) if len(start) else np.zeros(0, np.int64)
        spread = np.isin(keys, np.array(list(known), np.uint64))
        total[spread] = [known[int(k)] for k in keys[spread]]
        rank = np.repeat(np.arange(len(keys), dtype=np.uint64), types)
        code = quantise((count - DISCOUNT) / np.repeat(total, types))
        backoff = np.where(spread, _NONE, quantise(DISCOUNT * types / np.maximum(total, 1)))
        c, p, s = EliasFano.of(keys), EliasFano.of(np.append(start, len(context)).astype(np.uint64)), EliasFano.of(rank << U(width) | successor.astype(np.uint64))
        head = np.array([c.n, c.low_bits, p.n, p.low_bits, s.n, s.low_bits, width], np.int64)
        return cls([head, c.low, c.high, p.low, p.high, s.low, s.high, code, backoff.astype(np.uint16)])

    def to_bytes(self) -> bytes:
        size = np.array([len(self.levels), *[x.nbytes for x in self.levels]], np.int64)
        return size.tobytes() + b"".join(x.tobytes() + b"\0" * (-x.nbytes % 8) for x in self.levels)

    @classmethod
    def open(cls, block: bytes | mmap.mmap | memoryview) -> NgramTrie:
        """Over bytes or a file mapped into memory; nothing is copied, and only the counts of high bits are made."""
        n = int(np.frombuffer(block, np.int64, 1)[0])
        size, at, levels = np.frombuffer(block, np.int64, n, 8), 8 * (n + 1), []
        kinds = [np.int64, np.uint64, np.uint64, np.uint64, np.uint64, np.uint64, np.uint64, np.uint16, np.uint16]
        for kind, s in zip(kinds, size.tolist(), strict=True):
            levels.append(np.frombuffer(block, kind, s // np.dtype(kind).itemsize, at))
            at += s + (-s % 8)
        return cls(levels)

    def contexts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, found) of context keys."""
        return self.context.find(keys)

    def lookup(self, rank: np.ndarray, found: np.ndarray, size: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Codes of successors, ``size`` of them for each context in turn, searched relative to its rank; 0 where the trie has none."""
        end = np.zeros(len(rank), np.int64)
        end[found] = self.pointer.get(rank[found] + 1).astype(np.int64)
        out = np.zeros(len(successor), np.uint16)
        on = np.flatnonzero(np.repeat(found, size))
        value = np.repeat(rank, size)[on].astype(np.uint64) << U(self.width) | successor[on].astype(np.uint64)
        i, same = self.successor.find(value)
        same &= i < np.repeat(end, size)[on]
        out[on[same]] = self.code[i[same]]
        return out


def quantise(p: np.ndarray) -> np.ndarray:
    """16-bit codes of probabilities; 0 stands for none."""
    return (65535 - np.clip(np.rint(-np.log10(np.maximum(p, 1e-15)) / _STEP), 0, 65533)).astype(np.uint16)


def probability(code: np.ndarray) -> np.ndarray:
    return np.where(code == 0, 0.0, 10.0 ** (-(65535.0 - code) * _STEP))


_zstd = pa.Codec("zstd", 1)


def pack(x: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned integers, or their gaps if they ascend, by planes of bytes, compressed."""
    x = np.ascontiguousarray(np.diff(x, prepend=x.dtype.type(0)) if ascending else x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(x).to_bytes(8, "little") + (_zstd.compress(planes, asbytes=True) if planes else b"")


def unpack(data: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    n, wide = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = _zstd.decompress(memoryview(data)[8:], n * wide, asbytes=True)
    x = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(wide, n).T).view(kind).reshape(n)
    return np.cumsum(x, dtype=kind) if ascending else x


def _chunk_rows(docs: DataFrame, key: str, text: str, training: Column) -> DataFrame:
    """(chunk, keys, train, lens, vocab, tokens, n_words, n_tokens): about CHUNK tokens each; a token is its word's place in ``vocab``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held = TaskContext.get().partitionId() << 32, 0, []

        def close() -> pa.RecordBatch:
            vocab, tokens = np.unique(np.concatenate([x[3] for x in held]), return_inverse=True)
            lens = np.concatenate([x[2] for x in held]).astype(np.uint32)
            row = [task + n, pa.concat_arrays([x[0] for x in held]), pack(np.concatenate([x[1] for x in held])), pack(lens), pack(vocab, True), pack(tokens.astype(np.uint32))]
            held.clear()
            keys = pa.ListArray.from_arrays(pa.array([0, len(row[1])], pa.int32()), row[1])
            sizes = [pa.array([len(x)], pa.int64()) for x in (vocab, tokens)]
            return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), keys, *[pa.array([x], pa.binary()) for x in row[2:]], *sizes], ["chunk", "keys", "train", "lens", "vocab", "tokens", "n_words", "n_tokens"])

        for b in slices(batches, "t"):
            w = Words(*text_bytes(b.column(2)))
            h = w.hashes()
            out = np.full(len(h) + b.num_rows, _END, np.uint64)
            out[np.arange(len(h)) + w.doc] = h
            held.append((b.column(0), b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8), w.count + 1, out))
            if sum(len(x[3]) for x in held) >= CHUNK:
                yield close()
                n += 1
        if held:
            yield close()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.coalesce(training, F.lit(False)).alias("train"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"chunk long, keys array<{kind}>, train binary, lens binary, vocab binary, tokens binary, n_words long, n_tokens long")


def _train_mask(train: np.ndarray, lens: np.ndarray) -> np.ndarray:
    return np.repeat(train, lens).astype(bool)


def _pack_rows(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema, strict=True)], [n for n, _ in schema])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of each value of the first column in turn; they come sorted by it."""
    now, held = None, []
    for b in batches:
        for i in range(b.num_rows):
            s, *row = (c[i] if pa.types.is_list(c.type) else c[i].as_py() for c in b.columns)
            if s != now and held:
                yield now, held
                held = []
            now = s
            held.append(tuple(row))
    if held:
        yield now, held


def _send_words(chunks: DataFrame, bits: int) -> DataFrame:
    """(shard, chunk, w, c): the distinct words of each chunk by range of hashes, with their counts in training texts."""
    schema = [("shard", pa.int32()), ("chunk", pa.int64()), ("w", pa.binary()), ("c", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, train, lens, vocab, tokens in zip(*(x.to_pylist() for x in b.columns), strict=True):
                v = unpack(vocab, np.uint64, True)
                mask = _train_mask(unpack(train, np.uint8), unpack(lens, np.uint32))
                c = np.bincount(unpack(tokens, np.uint32)[mask], minlength=len(v)).astype(np.uint32)
                cut = [0, *np.searchsorted(v, np.arange(1, 1 << bits, dtype=np.uint64) << U(64 - bits)).tolist(), len(v)]
                yield _pack_rows([(s, chunk, pack(v[x:y], True), pack(c[x:y])) for s, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x], schema)

    return chunks.select("chunk", "train", "lens", "vocab", "tokens").mapInArrow(run, "shard int, chunk long, w binary, c binary")


def _count_words(sent: DataFrame, bits: int, most: int) -> DataFrame:
    """(shard, chunk, c, rank, n, v, size, most): counts over all chunks and ranks for each chunk's words; a row of chunk null has the shard's sums.

    Ranks start at 1 and go round the shards, each of which numbers its words from the most frequent down.
    """
    schema = [("shard", pa.int32()), ("chunk", pa.int64()), ("c", pa.binary()), ("rank", pa.binary()), ("n", pa.int64()), ("v", pa.int64()), ("size", pa.int64()), ("most", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, rows in _groups(batches):
            each = [(unpack(w, np.uint64, True), unpack(c, np.uint32)) for _, w, c in rows]
            words, place = np.unique(np.concatenate([w for w, _ in each]), return_inverse=True)
            total = np.bincount(place, np.concatenate([c for _, c in each]), len(words)).astype(np.int64)
            order = np.argsort(-total, kind="stable")
            rank = np.empty(len(words), np.uint64)
            rank[order] = np.arange(len(words), dtype=np.uint64) * U(1 << bits) + U(s + 1)
            # as many frequent words as can be hot at all; whether they are shows once N is known
            top = order[:most]
            told = np.stack([words[top].view(np.int64), rank[top].view(np.int64), total[top]]).tobytes()
            yield _pack_rows([(s, None, None, None, int(total.sum()), int((total > 0).sum()), len(words), told)], schema)
            at = 0
            for (chunk, _, _), (w, _) in zip(rows, each, strict=True):
                own = place[at : at + len(w)]
                yield _pack_rows([(s, chunk, pack(np.minimum(total[own], 2**32 - 1).astype(np.uint32)), pack(rank[own]), None, None, None, None)], schema)
                at += len(w)

    dealt = sent.repartition(1 << bits, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "shard int, chunk long, c binary, rank binary, n long, v long, size long, most binary")


def _ranked_chunks(chunks: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """(chunk, keys, train, lens, tokens, rank, c): chunks with the ranks and counts of their words instead of hashes, in the order of ranks."""
    none = F.lit(None).cast("binary")
    keys = chunks.schema["keys"].dataType.simpleString()
    every = chunks.select("chunk", F.lit(-1).alias("shard"), "keys", "train", "lens", F.col("tokens").alias("x"))
    every = every.unionAll(words.where("chunk is not null").select("chunk", "shard", F.lit(None).cast(keys), "c", "rank", none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in _groups(batches):
            own, *told = rows
            c, rank = (np.concatenate([unpack(x[i], kind) for x in told]) for i, kind in ((2, np.uint32), (3, np.uint64)))
            by = np.argsort(rank)
            place = np.empty(len(by), np.uint32)
            place[by] = np.arange(len(by), dtype=np.uint32)
            tokens = pack(place[unpack(own[4], np.uint32)])
            list_ = pa.ListArray.from_arrays(pa.array([0, len(own[1].values)], pa.int32()), own[1].values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), list_, *[pa.array([x], pa.binary()) for x in (own[2], own[3], tokens, pack(rank[by], True), pack(c[by]))]], ["chunk", "keys", "train", "lens", "tokens", "rank", "c"]
            )

    dealt = every.repartition(parts, "chunk").sortWithinPartitions("chunk", "shard")
    return dealt.mapInArrow(run, f"chunk long, keys {keys}, train binary, lens binary, tokens binary, rank binary, c binary")


def next_context(context: np.ndarray, word: np.ndarray, order: int) -> np.ndarray:
    """Keys of the contexts of ``order`` that are those of the order below followed by a word; 0 for the start marks alone."""
    if order == 2:
        return word
    if order == 3:
        return context << U(32) | word
    key = mix(mix(context) + word)
    return np.where((context == 0) & (word == 0), U(0), np.maximum(key, U(1)))


class _Grams:
    """Distinct (context, successor) pairs of a chunk, of one order; ``below`` are those of the order below."""

    def __init__(self, lens: np.ndarray, rank: np.ndarray, tokens: np.ndarray, below: _Grams | None = None):
        n, t = len(rank), tokens.astype(np.int64)
        self.order = below.order + 1 if below else 2
        # contexts are numbered by what they end in, from 1; 0 is the start
        last = below.place if below else t
        before = np.empty(len(t), np.int64)
        before[1:] = last[:-1] + 1
        before[(np.cumsum(lens) - lens).astype(np.int64)] = 0
        keys = next_context(below.context, below.word, self.order) if below else rank
        pair, self.place = np.unique(before * n + t, return_inverse=True)
        self.context, self.word = np.concatenate([[U(0)], keys])[pair // n], rank[pair % n]

    @classmethod
    def of(cls, lens: np.ndarray, rank: np.ndarray, tokens: np.ndarray, order: int) -> _Grams:
        out = cls(lens, rank, tokens)
        for _ in range(3, order + 1):
            out = cls(lens, rank, tokens, out)
        return out

    def dealt(self, shards: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The order in which pairs are sent (by shard, context, successor), contexts, and first pairs and shards of the contexts."""
        shard = (mix(self.context) >> U(8)) % U(shards)
        if len(hot):
            on = np.flatnonzero(np.isin(self.context, hot))
            shard[on] = (shard[on] + self.word[on] % U(_SPREAD) * U(0x9E3779B1)) % U(shards)
        if self.order > 3:
            by = np.lexsort((self.word, self.context, shard))
        else:  # pairs stand in the order of contexts and ranks
            by = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
        context, shard = self.context[by], shard[by].astype(np.int64)
        new = np.ones(len(by), bool)
        new[1:] = (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])
        start = np.flatnonzero(new)
        return by, context[start], start, shard[start]


def _send_grams(chunks: DataFrame, order: int, shards: int, hot: np.ndarray, width: int) -> DataFrame:
    schema = [("shard", pa.int32()), ("chunk", pa.int64()), ("context", pa.binary()), ("n", pa.binary()), ("word", pa.binary()), ("c", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, train, lens, tokens, rank in zip(*(x.to_pylist() for x in b.columns), strict=True):
                lens = unpack(lens, np.uint32)
                g = _Grams.of(lens, unpack(rank, np.uint64, True), unpack(tokens, np.uint32), order)
                by, context, start, of = g.dealt(shards, hot)
                count = np.bincount(g.place[_train_mask(unpack(train, np.uint8), lens)], minlength=len(by)).astype(np.uint32)[by]
                word, ends = g.word.astype(_word_kind(width))[by], np.append(start, len(by))
                size = np.diff(ends).astype(np.uint32)
                for s in np.unique(of).tolist():
                    x, y = np.searchsorted(of, [s, s + 1])
                    own = slice(ends[x], ends[y])
                    yield _pack_rows([(s, chunk, pack(context[x:y], True), pack(size[x:y]), pack(word[own]), pack(count[own]))], schema)

    return chunks.select("chunk", "train", "lens", "tokens", "rank").mapInArrow(run, "shard int, chunk long, context binary, n binary, word binary, c binary")


def _word_kind(width: int) -> type:
    """What ranks of ``width`` bits are sent as."""
    return np.uint32 if width <= 32 else np.uint64


def _by_both(context: np.ndarray, word: np.ndarray, order: int, width: int) -> np.ndarray:
    """The order of pairs by context, then word; as one key where ranks of ``width`` bits leave room."""
    if order == 2 and 2 * width <= 64:
        return np.argsort(context << U(width) | word)
    if order == 3 and 3 * width <= 64:
        return np.argsort((context >> U(32)) << U(2 * width) | (context & U(0xFFFFFFFF)) << U(width) | word)
    return np.lexsort((word, context))


def _answer_grams(sent: DataFrame, order: int, shards: int, known: dict[int, int], width: int, least: int) -> DataFrame:
    """(shard, chunk, code, backoff, types, most): codes of a chunk's pairs and contexts.

    A row of chunk null has (hot context, types) and, as contexts of the next order, the n-grams counted ``least`` times or more.
    """
    schema = [("shard", pa.int32()), ("chunk", pa.int64()), ("code", pa.binary()), ("backoff", pa.binary()), ("types", pa.binary()), ("most", pa.binary())]
    hot = np.array(sorted(known), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, rows in _groups(batches):
            held, sizes = [[], [], []], []
            for _, context, n, word, count in rows:
                sizes.append(unpack(n, np.uint32))
                for x, y in zip(held, (np.repeat(unpack(context, np.uint64, True), sizes[-1]), unpack(word, _word_kind(width)), unpack(count, np.uint32)), strict=True):
                    x.append(y)
            c, w, n = (np.concatenate(x) for x in held)
            del held
            by = _by_both(c, w, order, width)
            c, w, n = c[by], w[by], n[by].astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])]))
            c, w, n = c[at], w[at], np.add.reduceat(n, at)
            on = n > 0
            built = NgramTrie.build(c[on], w[on], n[on], known, width).to_bytes()
            block = mmap.mmap(-1, len(built))  # the levels lie in mapped memory, outside the heap
            block.write(built)
            trie = NgramTrie.open(block)
            often = n >= least
            most = np.stack([next_context(c[often], w[often], order + 1), n[often].astype(np.uint64)])
            del built, n, on
            i, found = trie.contexts(hot)
            types = trie.pointer.get(i[found] + 1) - trie.pointer.get(i[found])
            yield _pack_rows([(s, None, None, None, np.stack([hot[found], types]).tobytes(), most.tobytes())], schema)
            # the trie is asked once for each distinct pair, in its own order; all chunks that have the pair get that answer
            told = np.empty((2, len(c)), np.uint16)
            for x in range(0, len(c), LOOKUPS):
                context = c[x : x + LOOKUPS]
                first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
                size = np.diff(np.append(first, len(context)))
                i, found = trie.contexts(context[first])
                told[0, x : x + LOOKUPS] = trie.lookup(i, found, size, w[x : x + LOOKUPS])
                backoff = np.full(len(i), 65535, np.uint16)  # an unseen context leaves everything to the order below
                backoff[found] = trie.backoff[i[found]]
                told[1, x : x + LOOKUPS] = np.repeat(backoff, size)
            del c, w
            answer = np.empty((2, len(by)), np.uint16)
            answer[:, by] = np.repeat(told, np.diff(np.append(at, len(by))), axis=1)
            del told, by, at
            x = 0
            for row, size in zip(rows, sizes, strict=True):
                ends = x + np.cumsum(size, dtype=np.int64)
                yield _pack_rows([(s, row[0], pack(answer[0, x : ends[-1]]), pack(answer[1, ends - size]), None, None)], schema)
                x = int(ends[-1])

    dealt = sent.repartition(shards, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "shard int, chunk long, code binary, backoff binary, types binary, most binary")


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, shard_tokens: int = 2_500_000) -> DataFrame:
    """(``key``, training, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``training`` tells the rows to learn from. base_score is the sum of log10 P_1; score that of log10 P_n for n = ``order``.
    """
    scratch = Scratch(docs.sparkSession, "ngram")
    chunks = scratch.put(_chunk_rows(docs, key, text, training))
    size = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("chunks")).first()
    bits = max(3, (size["words"] // shard_tokens).bit_length())
    shards = max(8, size["tokens"] // shard_tokens + 1)
    parts = max(8, size["chunks"] // 4)  # a task takes its chunks one after another
    words = scratch.put(_count_words(_send_words(chunks, bits), bits, 4 * shards), 1_000_000 << bits)
    told = words.where("chunk is null").agg(*[F.coalesce(f(c), F.lit(0)).alias(c) for f, c in ((F.sum, "n"), (F.sum, "v"), (F.max, "size"))]).first()
    total, distinct, width = int(told.n), int(told.v), ((int(told.size) + 1) << bits).bit_length()
    ranked = scratch.put(_ranked_chunks(chunks, words, parts), 1_000_000 * parts)
    # hot contexts have over a quarter of a shard's tokens: 4 * shards of them at most
    least = max(1, total // (4 * shards))
    known: dict[int, int] = {}
    begin = 0
    for r in words.where("chunk is null").select("most").toLocalIterator():
        h, rank, c = np.frombuffer(bytes(r.most), np.int64).reshape(3, -1)
        end = h.view(np.uint64) == _END
        begin += int(c[end].sum())  # as many texts start as end
        known |= {int(x): int(y) for x, y in zip(rank[(c >= least) & ~end], c[(c >= least) & ~end], strict=True)}
    scratch.drop(chunks, words)
    answers, hot_rest = [], []
    for n in range(2, order + 1):
        if begin >= least:
            known[0] = begin
        hot = np.array(sorted(known), np.uint64)
        got = scratch.put(_answer_grams(_send_grams(ranked, n, shards, hot, width), n, shards, known, width, least), 1_000_000 * shards)
        rest, following = dict.fromkeys(known, 0.0), {}
        for r in got.where("chunk is null").select("types", "most").toLocalIterator():  # 4 * shards * _SPREAD pairs at most
            for k, types in np.frombuffer(bytes(r.types), np.uint64).reshape(2, -1).T.tolist():
                rest[k] += DISCOUNT * types / known[k]
            following |= dict(np.frombuffer(bytes(r.most), np.uint64).reshape(2, -1).T.tolist())
        answers.append(got)
        hot_rest.append((hot, np.array([rest[int(x)] for x in hot])))
        known = following
    space = total + 0.5 * (distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (own, *told) in _groups(batches):
            _, _, keys, train, lens, tokens, rank, c = own
            lens, tokens, rank, g = unpack(lens, np.uint32), unpack(tokens, np.uint32), unpack(rank, np.uint64, True), None
            count = unpack(c, np.uint32).astype(float)
            base = ((count + 0.5) / space)[tokens]
            each = base
            for n, (hot, hot_backoff) in enumerate(hot_rest, 2):
                g = _Grams(lens, rank, tokens, g)
                by, context, start, _ = g.dealt(shards, hot)
                mine = [x for x in told if x[0] == n]  # sorted by shard
                code, rest = np.empty(len(by)), probability(np.concatenate([unpack(x[4], np.uint16) for x in mine]))
                code[by] = probability(np.concatenate([unpack(x[3], np.uint16) for x in mine]))
                if len(hot):
                    i = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
                    rest = np.where(hot[i] == context, hot_backoff[i], rest)
                left = np.empty(len(by))
                left[by] = np.repeat(rest, np.diff(np.append(start, len(by))))
                each = code[g.place] + left[g.place] * each
            doc = np.repeat(np.arange(len(lens)), lens)
            known_words = np.bincount(doc, count[tokens] > 0, len(lens)).astype(np.int64)
            sums = [np.bincount(doc, np.log10(x), len(lens)) for x in (base, each)]
            trained = pa.array(unpack(train, np.uint8).astype(bool))
            yield pa.RecordBatch.from_arrays([keys.values, trained, pa.array(lens.astype(np.int64)), pa.array(known_words), *map(pa.array, sums)], ["k", "training", "n_tokens", "n_known", "base", "score"])

    none = F.lit(None).cast("binary")
    keys = ranked.schema["keys"].dataType.simpleString()
    every = ranked.select("chunk", F.lit(0).alias("kind"), F.lit(-1).alias("shard"), "keys", F.col("train").alias("a"), F.col("lens").alias("b"), F.col("tokens").alias("d"), F.col("rank").alias("e"), F.col("c").alias("f"))
    for n, got in enumerate(answers, 2):
        every = every.unionAll(got.where("chunk is not null").select("chunk", F.lit(n), "shard", F.lit(None).cast(keys), "code", "backoff", none, none, none))
    dealt = every.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "shard")
    kind = docs.schema[key].dataType.simpleString()
    out = dealt.mapInArrow(run, f"k {kind}, training boolean, n_tokens long, n_known long, base double, score double")
    return out.select(F.col("k").alias(key), "training", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
