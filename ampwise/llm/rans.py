"""Token ids in a binary file format, compressed with a static range asymmetric numeral system.

Ids of all documents, in ascending order of the document's id, are cut into
blocks of whole documents. All blocks share one table of symbol frequencies,
counted over the whole corpus and scaled to a power of two. A block is coded by
interleaved lanes (symbol i belongs to lane i mod lanes), each with a state of 64 bits
that gives out words of 32 bits, and can be decoded by itself. It holds
checkpoints: the lanes' states and the place in the words after every so many
steps, from each of which decoding can start, and checksums of its header and ids.

Files are written by Spark as Parquet parts, one row for a block (its bytes, the
number of its range of ids and its place there), so a lost executor's part is
written anew and no half-written file is ever seen. The frequency table lies
beside them. Reading takes any subset of blocks.

Block, little-endian: magic, version, lanes, steps between checkpoints, symbols,
documents, words, checkpoints (uint32 each); crc32 of the ids as uint32 (uint32); document
ids (int64), lengths (uint32); final states (uint64 x lanes); checkpoints (each: place
uint32, states); words (uint32); crc32 of all before (uint32).

Defined cases: null text counts as empty; each document has at least the end id;
rows with equal ids keep the order of their ids' bytes; null ids are written
first; an empty table writes no block and reads back as no rows; columns beyond
those named are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampwise.llm.common import n_buckets, own_path, range_bounds, slices
from ampwise.llm.pretokens import AT_ONCE, encoded

MAGIC = b"RANSTOK1"
#: Bits of the frequency scale (shared tables), least state, most lanes, steps between checkpoints.
SCALE_BITS, LOW, LANES, CHECK_STEPS = 18, 1 << 31, 2048, 64
#: Symbols after which a block is closed at the next document's end.
BLOCK_SYMBOLS = 262_144
#: Pieces in each generation of a worker's table.
REMEMBERED = 350_000


class Table:
    """Shared frequencies: every symbol that occurs has at least 1, they sum to 2 ** SCALE_BITS."""

    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self._symbol = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    @staticmethod
    def of(counts: np.ndarray) -> "Table":
        """Scale counts; what rounding leaves over is taken from or given to the largest."""
        total, whole = int(counts.sum()), 1 << SCALE_BITS
        if not total:
            return Table(np.zeros(len(counts), np.uint64))
        if int((counts > 0).sum()) > whole:
            raise ValueError("more symbols than the scale has places")
        f = np.where(counts > 0, np.maximum(1, (counts.astype(np.float64) * whole / total).astype(np.int64)), 0)
        order = np.lexsort((np.arange(len(f)), -f))
        rest, i = whole - int(f.sum()), 0
        while rest:
            k = order[i % len(order)]
            if rest > 0:
                f[k] += rest if i == 0 else 0
                rest = 0
            elif f[k] > 1:
                take = min(int(f[k]) - 1, max(1, int(f[k]) // 8), -rest)
                f[k] -= take
                rest += take
            i += 1
        return Table(f)


def encode_block(ids: np.ndarray, keys: list[int], lengths: list[int], table: Table) -> bytes:
    n = len(ids)
    lanes = 1
    while lanes < LANES and lanes * 32 < n:
        lanes *= 2
    steps = -(-n // lanes)
    freq, start = table.freq, table.start
    shift = np.uint64(SCALE_BITS)
    x = np.full(lanes, LOW, np.uint64)
    f_all, s_all = freq[ids], start[ids]
    out, given, marks = [], 0, []
    top = np.uint64((LOW >> SCALE_BITS) << 32)
    for t in range(steps - 1, -1, -1):
        lo, hi = t * lanes, min((t + 1) * lanes, n)
        f, s, y = f_all[lo:hi], s_all[lo:hi], x[:hi - lo]
        full = y >= top * f
        if full.any():
            out.append((y[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            given += len(out[-1])
            y[full] >>= np.uint64(32)
        q = y // f
        y[:] = (q << shift) + (y - q * f) + s
        if t and t % CHECK_STEPS == 0:
            marks.append((given, x.copy()))
    words = np.concatenate(out[::-1]) if out else np.empty(0, "<u4")
    body = bytearray(MAGIC)
    body += struct.pack("<8I", 1, lanes, CHECK_STEPS, n, len(keys), len(words), len(marks), zlib.crc32(ids.astype("<u4").tobytes()))
    body += np.array(keys, "<i8").tobytes() + np.array(lengths, "<u4").tobytes() + x.astype("<u8").tobytes()
    for before, states in marks[::-1]:
        body += struct.pack("<I", len(words) - before) + states.astype("<u8").tobytes()
    body += words.tobytes()
    return bytes(body + struct.pack("<I", zlib.crc32(bytes(body))))


class Block:
    """A block read back; raises ValueError where a checksum doesn't hold."""

    def __init__(self, raw: bytes) -> None:
        if raw[:8] != MAGIC:
            raise ValueError("not a block")
        if zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("block checksum")
        _, self.lanes, self.every, self.n, docs, words, marks, self.crc = struct.unpack("<8I", raw[8:40])
        at = 40
        self.keys = np.frombuffer(raw, "<i8", docs, at)
        at += 8 * docs
        self.lengths = np.frombuffer(raw, "<u4", docs, at)
        at += 4 * docs
        self.states = np.frombuffer(raw, "<u8", self.lanes, at)
        at += 8 * self.lanes
        self.marks = []
        for _ in range(marks):
            self.marks.append((struct.unpack_from("<I", raw, at)[0], np.frombuffer(raw, "<u8", self.lanes, at + 4)))
            at += 4 + 8 * self.lanes
        self.words = np.frombuffer(raw, "<u4", words, at)

    def sections(self) -> int:
        """Parts that can be decoded apart from each other: one more than checkpoints."""
        return len(self.marks) + 1

    def section(self, k: int, table: Table) -> np.ndarray:
        """Symbols from checkpoint k - 1 (0: the start) to the next one."""
        place, states = (0, self.states) if k == 0 else self.marks[k - 1]
        x, lanes = states.copy(), self.lanes
        first = k * self.every
        last = min(first + self.every, -(-self.n // lanes)) if k < len(self.marks) else -(-self.n // lanes)
        freq, start, symbol = table.freq, table.start, table.symbol
        mask, shift, low = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(LOW)
        out = np.empty(min(last * lanes, self.n) - first * lanes, np.uint32)
        for t in range(first, last):
            lo, hi = t * lanes, min((t + 1) * lanes, self.n)
            y = x[:hi - lo]
            slot = y & mask
            s = symbol[slot]
            out[lo - first * lanes:hi - first * lanes] = s
            y[:] = freq[s] * (y >> shift) + slot - start[s]
            need = y < low
            k_words = int(np.count_nonzero(need))
            if k_words:
                y[need] = (y[need] << np.uint64(32)) | self.words[place:place + k_words].astype(np.uint64)
                place += k_words
        return out

    def ids(self, table: Table) -> np.ndarray:
        got = np.concatenate([self.section(k, table) for k in range(self.sections())]) if self.n else np.empty(0, np.uint32)
        if zlib.crc32(got.astype("<u4").tobytes()) != self.crc:
            raise ValueError("ids checksum")
        return got


# ---- jobs ----------------------------------------------------------------

class Encoder:
    """Ids by the tokenizers library. White space always parts pre-tokens, so a text is cut
    there; a piece not met lately is split into the tokenizer's pre-tokens, and the library's
    model gives the ids of those not met lately."""

    def __init__(self, spec: str, end: int) -> None:
        from tokenizers import Tokenizer

        from ampwise.llm.pretokens import SPECIALS, Splitter, byte_chars, piece_table
        tok = Tokenizer.from_str(spec)
        chars, special, model, number = byte_chars(), SPECIALS.fullmatch, tok.model.tokenize, tok.token_to_id

        def word(w: str) -> bytes:
            if w == "\n":
                return b""
            ids = [number(w)] if special(w) else [t.id for t in model("".join([chars[b] for b in w.encode("utf-8")]))]
            return array("I", ids).tobytes()

        self.pieces = piece_table(Splitter(tok), lambda words: list(map(word, words)), REMEMBERED)
        self.end = np.array([end], np.uint32)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Each text's ids with the end id."""
        ids, begin = encoded(texts, self.pieces)
        return [np.concatenate((ids[a:b], self.end)) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


_WORKER: dict = {}


def _encoder(spec: str, end: int) -> Encoder:
    if _WORKER.get("of") != (len(spec), zlib.crc32(spec.encode()), end):
        _WORKER.update(of=(len(spec), zlib.crc32(spec.encode()), end), encoder=Encoder(spec, end))
    return _WORKER["encoder"]


@cache
def _press():
    import zstandard
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(ids: np.ndarray, wide: bool) -> bytes:
    return _press()[0].compress(ids.astype("<u4" if wide else "<u2").tobytes())


def _unpack(raw: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(_press()[1].decompress(raw), "<u4" if wide else "<u2").astype(np.uint32)


def write(docs: DataFrame, spec: str, path: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all texts and write ``path``/blocks (Parquet parts of blocks) and ``path``/table."""
    spark = docs.sparkSession
    wide = max([*json.loads(spec)["model"]["vocab"].values(), *(t["id"] for t in json.loads(spec).get("added_tokens", []))], default=0) > 0xFFFF
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    bounds = range_bounds(rows, "id", 4 * n_buckets(spark))
    shared = spark.sparkContext.broadcast((spec, np.array(bounds, np.int64)))

    def tokenize(batches):
        spec_, lows = shared.value
        enc = _encoder(spec_, end)
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE):
                ids = enc.ids(part.column(1))
                keys = part.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
                bucket = np.maximum(0, np.searchsorted(lows, keys, side="right") - 1)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), part.column(0), pa.array([_pack(i, wide) for i in ids], pa.binary())], names=["bucket", "id", "z"])

    def gather(batches):
        """Whole documents in order into rows of ids: the later blocks."""
        held, keys, lengths, size_, now, no, before = [], [], [], 0, None, 0, 0

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([now], pa.int32()), pa.array([no], pa.int32()), pa.array([before], pa.int64()), pa.array([size_], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())), pa.array([_pack(np.concatenate(held), wide)], pa.binary())],
                names=["bucket", "block", "inside", "n", "ids", "lengths", "z"])

        for batch in batches:
            for bucket, key, z in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket != now or size_ >= BLOCK_SYMBOLS:
                    if held:
                        yield row()
                    no, before = (no + 1, before + size_) if bucket == now else (0, 0)
                    now, held, keys, lengths, size_ = bucket, [], [], [], 0
                held.append(_unpack(z, wide))
                keys.append(key)
                lengths.append(len(held[-1]))
                size_ += len(held[-1])
        if held:
            yield row()

    dealt = rows.mapInArrow(tokenize, "bucket int, id bigint, z binary").repartition(n_buckets(spark), "bucket")
    ordered = dealt.sortWithinPartitions("bucket", F.col("id").asc_nulls_first(), "z")
    staged = f"{path}/staged"
    ordered.mapInArrow(gather, "bucket int, block int, inside bigint, n bigint, ids array<bigint>, lengths array<bigint>, z binary").write.option("compression", "none").parquet(staged)
    blocks = spark.read.parquet(staged)

    size = 1 + max([end, *json.loads(spec)["model"]["vocab"].values(), *(t["id"] for t in json.loads(spec).get("added_tokens", []))])

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for z in batch.column(0):
                total += np.bincount(_unpack(z.as_py(), wide), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["symbol", "n"])

    counts = np.zeros(size, np.int64)
    for r in blocks.select("z").mapInArrow(count, "symbol int, n bigint").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        counts[r["symbol"]] = r["n"]  # one entry per symbol of the vocabulary
    table = Table.of(counts)
    spark.createDataFrame([(SCALE_BITS, table.freq.astype("<u4").tobytes())], "scale_bits int, freq binary").coalesce(1).write.parquet(f"{path}/table")

    # ids before a block: those of earlier ranges here, of earlier blocks of its range in the row
    sizes = blocks.groupBy("bucket").agg(F.sum("n").alias("n"))
    before, upto = {}, 0
    for r in sizes.orderBy("bucket").collect():  # one row per range
        before[r["bucket"]], upto = upto, upto + r["n"]
    offsets = spark.sparkContext.broadcast((table.freq, before))

    def code(batches):
        freq, base = offsets.value
        t = Table(freq)
        for batch in batches:
            cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            for bucket, block, inside, ids, lengths, z in zip(*(cols[n] for n in ("bucket", "block", "inside", "ids", "lengths", "z"))):
                keys = [-(1 << 63) if k is None else k for k in ids]
                raw = encode_block(_unpack(z, wide), keys, lengths, t)
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([block], pa.int32()), pa.array([base[bucket] + inside], pa.int64()), pa.array([raw], pa.binary())],
                                                 names=["bucket", "block", "start", "bytes"])

    coded = blocks.select("bucket", "block", "inside", "ids", "lengths", "z").mapInArrow(code, "bucket int, block int, start bigint, bytes binary")
    coded.write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The documents of the files at ``path``: id, start (ids of all documents before), ids
    (binary, little-endian unsigned 32-bit). Blocks are decoded and checked independently."""
    row = spark.read.parquet(f"{path}/table").first()
    freq = spark.sparkContext.broadcast(np.frombuffer(row["freq"], "<u4"))

    def decode(batches):
        t = Table(freq.value)
        for batch in batches:
            for start, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = Block(raw)
                ids = b.ids(t)
                ends = np.cumsum(b.lengths.astype(np.int64))
                starts = ends - b.lengths
                raw_ids = ids.astype("<u4").tobytes()
                keys = [None if k == -(1 << 63) else k for k in b.keys.tolist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.int64()), pa.array(starts + start, pa.int64()),
                    pa.array([raw_ids[4 * a:4 * e] for a, e in zip(starts.tolist(), ends.tolist())], pa.binary())], names=[id_col, "start", "ids"])

    return spark.read.parquet(f"{path}/blocks").select("start", "bytes").mapInArrow(decode, f"{id_col} bigint, start bigint, ids binary")


def new_path(spark: SparkSession) -> str:
    return own_path(spark, "token-files")
