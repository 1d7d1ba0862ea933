"""Token files: ids in id order, compressed by an interleaved static range asymmetric coder.

Documents are dealt out and sorted by id, tokenised, and packed into segments of about
``SEGMENT_TOKENS`` ids. A segment has one frequency table, shared by its blocks; each block is
coded independently by ``LANES`` interleaved coders and carries a checksum and checkpoints, the
coders' states at fixed steps, from which decoding can begin. Files are Parquet with a row per
segment, so Spark's commit makes a lost executor's output disappear.

* NULL or empty text: only the end id.
* NULL ids come first; rows of equal id are ordered by their text, equal rows are alike.
* Whole texts of any length; a text larger than a segment makes a larger one.
* An empty table gives no segment and an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscape.llm import arrow as A
from lendscape.llm.wordbpe import CUT_BYTES, cut_pieces, encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SEGMENT_TOKENS = 1 << 22
BLOCK_TOKENS = 1 << 20
LANES = 2048
CHECKPOINT_STEPS = 256
SCALE_BITS = 18

# States stay in [2**31, 2**63) and give off 32 bits at a time.
_LOW = np.uint64(1 << 31)
_HALF = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)

SEGMENT = (
    "part int, segment int, doc_ids array<{kind}>, lengths array<long>, n_tokens long, "
    "symbols binary, freqs binary, blocks array<struct<n: long, lanes: int, crc: long, "
    "words: binary, steps: array<long>, at: array<long>, states: array<binary>>>"
)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies adding to 2**SCALE_BITS, at least one each."""
    room = (1 << SCALE_BITS) - len(counts)
    if room < 0:
        raise ValueError(f"more than 2**{SCALE_BITS} different ids in a segment")
    out = 1 + counts * room // counts.sum()
    out[out.argmax()] += (1 << SCALE_BITS) - out.sum()
    return out


def encode_block(symbols: np.ndarray, freq: np.ndarray, cum: np.ndarray, lanes: int) -> dict:
    """Code symbol numbers with interleaved lanes; symbol t belongs to lane t mod lanes."""
    n = len(symbols)
    steps = -(-n // lanes)
    f, c = freq[symbols].astype(np.uint64), cum[symbols].astype(np.uint64)
    full = f << np.uint64(63 - SCALE_BITS)
    x = np.full(lanes, _LOW)
    words: list[np.ndarray] = []
    marks, states, written = [], [], 0
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        live = x[: at.stop - at.start]
        over = live >= full[at]
        out = live[over]
        words.append(out.astype(np.uint32))
        written += len(out)
        live[over] = out >> _HALF
        q = live // f[at]
        live[:] = (q << _SCALE) + (live - q * f[at]) + c[at]
        if step % CHECKPOINT_STEPS == 0:
            marks.append((step, written))
            states.append(x.astype("<u8").tobytes())
    words.reverse()
    flat = np.concatenate(words) if words else np.zeros(0, np.uint32)
    return {
        "n": n,
        "lanes": lanes,
        "words": flat.astype("<u4").tobytes(),
        "steps": [s for s, _ in reversed(marks)],
        "at": [written - w for _, w in reversed(marks)],
        "states": states[::-1],
    }


def decode_block(
    block: dict, freq: np.ndarray, cum: np.ndarray, slots: np.ndarray, first: int = 0, last: int | None = None
) -> np.ndarray:
    """Symbol numbers from checkpoint ``first`` up to checkpoint ``last`` (default: the end)."""
    if not block["n"]:
        return np.zeros(0, np.int64)
    lanes, n = block["lanes"], block["n"]
    words = np.frombuffer(block["words"], "<u4").astype(np.uint64)
    begin = block["steps"][first]
    stop = -(-n // lanes) if last is None or last >= len(block["steps"]) else block["steps"][last]
    at = block["at"][first]
    x = np.frombuffer(block["states"][first], "<u8").astype(np.uint64)
    mask = np.uint64((1 << SCALE_BITS) - 1)
    f64, c64 = freq.astype(np.uint64), cum.astype(np.uint64)
    out = []
    for step in range(begin, stop):
        live = x[: min(n, (step + 1) * lanes) - step * lanes]
        slot = live & mask
        s = slots[slot]
        out.append(s)
        live[:] = f64[s] * (live >> _SCALE) + slot - c64[s]
        need = np.flatnonzero(live < _LOW)
        live[need] = (live[need] << _HALF) | words[at : at + len(need)]
        at += len(need)
    return np.concatenate(out)


def pack(ids: np.ndarray) -> dict:
    """A segment's table and blocks from its ids."""
    if not len(ids):
        return {"symbols": b"", "freqs": b"", "blocks": []}
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    number_of = np.zeros(len(counts), np.int32)
    number_of[symbols] = np.arange(len(symbols))
    numbers, counts = number_of[ids], counts[symbols]
    freq = scaled(counts)
    cum = np.cumsum(freq) - freq
    blocks = []
    for at in range(0, len(ids), BLOCK_TOKENS):
        part = numbers[at : at + BLOCK_TOKENS]
        block = encode_block(part, freq, cum, min(LANES, -(-len(part) // 64)))
        block["crc"] = crc32(ids[at : at + BLOCK_TOKENS].astype("<u4").tobytes())
        blocks.append(block)
    return {
        "symbols": symbols.astype("<u4").tobytes(),
        "freqs": freq.astype("<u4").tobytes(),
        "blocks": blocks,
    }


def unpack(segment: dict) -> np.ndarray:
    """Ids of a segment; a block whose checksum differs raises."""
    symbols = np.frombuffer(segment["symbols"], "<u4")
    freq = np.frombuffer(segment["freqs"], "<u4").astype(np.int64)
    cum = np.cumsum(freq) - freq
    slots = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
    out = []
    for block in segment["blocks"]:
        ids = symbols[decode_block(block, freq, cum, slots)]
        if crc32(ids.astype("<u4").tobytes()) != block["crc"]:
            raise ValueError("a token block does not match its checksum")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def token_ids(array: pa.Array, tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts one after the other, and their number in each text."""
    codes, first, pieces = cut_pieces(array)
    parts = encoder(tokenizer).encode(pieces)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    starts = np.cumsum(lengths) - lengths
    per_piece = lengths[codes]
    flat = np.frombuffer(b"".join(parts), "<u4")
    return A.gather(per_piece, starts[codes], flat), A.per_text(per_piece, first)


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to every document."""
    ends = np.cumsum(lengths + 1) - 1
    out = np.empty(len(ids) + len(lengths), np.uint32)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = ids
    out[ends] = end_id
    return out, lengths + 1


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the files of all documents in ascending id order; one shuffle, of the texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    needed = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    order = [F.col("_id").asc_nulls_first(), F.xxhash64("_text"), F.col("_text")]
    placed = needed.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    schema = SEGMENT.format(kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x, _ in held])
            row = {
                "part": part,
                "segment": number,
                "doc_ids": [i for x, _, _ in held for i in x],
                "lengths": np.concatenate([x for _, _, x in held]).tolist(),
                "n_tokens": len(ids),
                **pack(ids),
            }
            return pa.RecordBatch.from_pylist([row], schema=target)

        target = None
        for batch in batches:
            if target is None:
                target = _arrow_schema(batch.schema.field("_id").type)
            array = A.texts(batch.column("_text"))
            doc_ids = batch.column("_id").to_pylist()
            for a, b in A.slices(array, CUT_BYTES):
                ids, lengths = with_end(*token_ids(array.slice(a, b - a), tokenizer), end_id)
                held.append((doc_ids[a:b], ids, lengths))
                size += len(ids)
                if size >= SEGMENT_TOKENS:
                    yield segment()
                    number += 1
                    held, size = [], 0
        if held:
            yield segment()

    A.reachable(placed).mapInArrow(run, schema).write.parquet(path)


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    block = pa.struct(
        {
            "n": pa.int64(),
            "lanes": pa.int32(),
            "crc": pa.int64(),
            "words": pa.binary(),
            "steps": pa.list_(pa.int64()),
            "at": pa.list_(pa.int64()),
            "states": pa.list_(pa.binary()),
        }
    )
    return pa.schema(
        {
            "part": pa.int32(),
            "segment": pa.int32(),
            "doc_ids": pa.list_(id_type),
            "lengths": pa.list_(pa.int64()),
            "n_tokens": pa.int64(),
            "symbols": pa.binary(),
            "freqs": pa.binary(),
            "blocks": pa.list_(block),
        }
    )


def segment_starts(files: DataFrame) -> DataFrame:
    """Ids before each segment. Segments are added up within their part, and only one total per
    part is added up over the parts."""
    sizes = files.select("part", "segment", "n_tokens")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_part_start"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("_start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inner.join(parts, "part").select(
        "part", "segment", (F.col("_part_start") + F.col("_start")).alias("segment_start")
    )


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """Documents decoded from the files: id, where its ids start among all, their number and
    checksum, and on request the ids themselves (little-endian unsigned 32-bit numbers)."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment = batch.slice(i, 1).to_pylist()[0]
                ids = unpack(segment).astype("<u4")
                lengths = np.array(segment["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = ids.tobytes()
                parts = [raw[4 * a : 4 * b] for a, b in zip(ends - lengths, ends)]
                columns = {
                    "part": pa.array([segment["part"]] * len(parts), pa.int32()),
                    "segment": pa.array([segment["segment"]] * len(parts), pa.int32()),
                    id_col: batch.column("doc_ids")[i].values,
                    "_offset": pa.array(ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([crc32(x) for x in parts], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(parts, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"part int, segment int, `{id_col}` {kind}, _offset long, n_tokens long, ids_crc32 long"
    docs = A.reachable(files).mapInArrow(run, schema + ", ids binary" * with_ids)
    out = docs.join(segment_starts(files), ["part", "segment"])
    return out.select(
        id_col,
        (F.col("segment_start") + F.col("_offset")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *["ids"] * with_ids,
    )


def token_files(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the files and read them back."""
    write_token_files(docs, path, **options)
    return read_token_files(docs.sparkSession, path, id_col=options.get("id_col", "doc_id"))
