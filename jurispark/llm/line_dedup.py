"""Line dedup: two Bloom filters find lines that may recur, and only these are shuffled, counted and decided."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import LOWER, cut, lean, lean_batches, numbered_columns, raw, scratch

#: White space that is no part of a line's key.
BLANK = b" \t\n\x0b\x0c\r"
#: Bits of a block of the filters; a hash picks one block and two bits in it.
BLOCK_BITS = 1 << 16
#: Hashes that a part of the filters is made from.
PART = 1 << 21


def line_keys(text: bytes | None, least_chars: int) -> list[bytes | None]:
    """The key of each line, None for lines that are too short to count."""

    def long_enough(key: bytes) -> bool:
        if len(key) < least_chars or len(key) >= 4 * least_chars or key.isascii():
            return len(key) >= least_chars
        return len(key.decode()) >= least_chars

    keys = (line.strip(BLANK) for line in (text or b"").translate(LOWER).split(b"\n"))
    return [k if long_enough(k) else None for k in keys]


def filter_bits(docs: DataFrame, text_col: str, least_chars: int, bits_per_line: int, most_bits: int) -> int:
    """Bits of a filter, a power of two, by the greatest number of lines that texts of this length can have."""
    lines = docs.agg(F.sum(F.floor(F.length(text_col) / (least_chars + 1)) + 1)).first()[0] or 1
    wanted = max(BLOCK_BITS, min(most_bits, int(lines) * bits_per_line))
    return 1 << (wanted - 1).bit_length()


def _places(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Two bits for each hash, as block * BLOCK_BITS + bit."""
    h = hashes[:, None]
    return ((h & np.uint64(blocks - 1)) << np.uint64(16)) | ((h >> np.array([32, 48], np.uint64)) & np.uint64(BLOCK_BITS - 1))


def _hashes(keys: list[bytes | None]) -> list[int]:
    """Hashes of a document's keys, each once."""
    return [xxhash.xxh3_64_intdigest(k) for k in {k for k in keys if k is not None}]


def repeat_filter(docs: DataFrame, text_col: str, least_chars: int, bits: int) -> np.ndarray:
    """Bits of hashes that were seen twice, packed; ``bits / 8`` bytes.

    Each task makes two filters of up to PART hashes of its rows: one of all of them, one of those that more than one row
    has. Parts travel as the bits that are set, two bytes each (or as bitmaps where these are smaller), block by block.
    Where they meet, a bit is set in the filter of repeats if any part has it there, or two parts have it among all; so no
    hash that two rows have is missed. A block's parts are merged one after another, with two bitmaps in hand.
    """
    blocks = bits // BLOCK_BITS

    def part(held: list[int]):
        values, counts = np.unique(np.array(held, np.uint64), return_counts=True)
        once, twice = np.unique(_places(values, blocks)), np.unique(_places(values[counts > 1], blocks))
        at = np.unique(once >> np.uint64(16))
        edges = [np.searchsorted(x, np.append(at, at[-1:] + np.uint64(1)) << np.uint64(16)) for x in (once, twice)]

        def said(places: np.ndarray) -> bytes:
            if 2 * len(places) <= BLOCK_BITS // 8:
                return places.astype(np.uint16).tobytes()
            bitmap = np.zeros(BLOCK_BITS, bool)
            bitmap[places & np.uint64(BLOCK_BITS - 1)] = True
            return np.packbits(bitmap).tobytes() + b"."  # an odd length tells bitmaps

        for i in range(0, len(at), 1000):
            span = range(i, min(i + 1000, len(at)))
            columns = [[said(x[e[j] : e[j + 1]]) for j in span] for x, e in zip((once, twice), edges, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at[span.start : span.stop].astype(np.int64)), pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary())], names=["block", "once", "twice"])

    def build(batches):
        held: list[int] = []
        for batch in batches:
            for text in raw(batch.column(0)):
                held += _hashes(line_keys(text, least_chars))
                if len(held) >= PART:
                    yield from part(held)
                    held = []
        if held:
            yield from part(held)

    def places(said: bytes) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(np.frombuffer(said[:-1], np.uint8))) if len(said) % 2 else np.frombuffer(said, np.uint16)

    def merge(batches):
        now, once, twice = None, None, None

        def ended():
            if now is not None and twice.any():
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for block, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if block != now:
                    yield from ended()
                    now, once, twice = block, np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
                a = places(a)
                twice[a] |= once[a]
                once[a] = True
                twice[places(b)] = True
        yield from ended()

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(lean(build), "block long, once binary, twice binary")
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, bits binary")
    out = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for row in merged.toLocalIterator():
        out[row.block] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def suspects(docs: DataFrame, id_col: str, text_col: str, least_chars: int, repeats: np.ndarray) -> DataFrame:
    """(id, key) for each key of a row whose hash may have been seen twice, each once a row."""
    spark = docs.sparkSession
    shared, blocks = spark.sparkContext.broadcast(repeats.tobytes()), len(repeats) * 8 // BLOCK_BITS

    def run(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            keys, rows = [], []
            for i, text in enumerate(raw(batch.column(1))):
                own = {k for k in line_keys(text, least_chars) if k is not None}
                keys += own
                rows += [i] * len(own)
            if not keys:
                continue
            at = _places(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64), blocks)
            maybe = ((bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)
            kept = np.flatnonzero(maybe)
            text = pa.array([keys[j] for j in kept], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([rows[j] for j in kept], pa.int64())), text], names=["id", "key"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(lean(run), f"id {kind}, key string")


def lost_lines(docs: DataFrame, id_col: str, text_col: str, *, least_chars: int, least_docs: int, bits_per_line: int, most_bits: int) -> DataFrame:
    """(id, lost): SHA-256 digests of the keys that a document loses; documents that lose none are missing."""
    bits = filter_bits(docs, text_col, least_chars, bits_per_line, most_bits)
    repeats = repeat_filter(docs, text_col, least_chars, bits)
    with scratch(docs.sparkSession) as keep:
        found = keep(suspects(docs, id_col, text_col, least_chars, repeats))
        # whole keys are compared, so neither the filter nor a hash decides; ids are wrapped as null is an id as well
        counted = found.groupBy("key").agg(F.count_distinct(F.struct("id")).alias("n"), F.max("id").alias("holder"))
        common = keep(counted.where(F.col("n") >= least_docs).select("key", "holder"))
        gone = found.join(common, "key").where(F.col("id").isNull() | (F.col("id") < F.col("holder")))
        return cut(gone.select("id", F.unhex(F.sha2("key", 256)).alias("key")).groupBy("id").agg(F.collect_set("key").alias("lost")))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, least_docs: int = 5, bits_per_line: int = 8, most_bits: int = 1 << 30) -> DataFrame:
    """docs without lines that many documents share, and n_lines (before) and n_dropped.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of ``least_chars`` code points or more
    that ``least_docs`` documents hold lose all their lines but those in the document with the largest id. Other lines
    stay as they are, in their order.

    Two passes over the texts and a third that drops lines: filters of fixed size (at most ``most_bits``; fewer bits a line
    let more lines through to the exact count, and change no result), exact counts of the suspects, then a join of the
    texts with what each document loses. The repeated key of a third of all documents is counted by (key, id) first,
    and skewed parts of the join are split.

    Null texts count as empty and become empty: one empty line. Rows with one id are one document, and each loses its
    lines; a null id is the smallest. Other columns stay, but for n_lines and n_dropped, which are replaced.
    """
    lean_batches(docs.sparkSession)
    docs, new, old = numbered_columns(docs)
    id_col, text_col = new[id_col], new[text_col]
    lost = lost_lines(docs, id_col, text_col, least_chars=least_chars, least_docs=least_docs, bits_per_line=bits_per_line, most_bits=most_bits)
    kind = docs.schema[text_col].dataType.simpleString()
    rest = [c for c in docs.columns if c != text_col]

    def run(batches):
        for batch in batches:
            kept, lines, dropped = [], [], []
            for text, gone in zip(raw(batch.column("__text")), batch.column("lost").to_pylist(), strict=True):
                text = text or b""
                if gone:
                    gone = set(gone)
                    keys = line_keys(text, least_chars)
                    stay = [line for line, k in zip(text.split(b"\n"), keys, strict=True) if k is None or hashlib.sha256(k).digest() not in gone]
                    kept.append(b"\n".join(stay))
                    lines.append(len(keys))
                    dropped.append(len(keys) - len(stay))
                else:
                    kept.append(text)
                    lines.append(text.count(b"\n") + 1)
                    dropped.append(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*rest, text_col, "n_lines", "n_dropped"])

    met = docs.join(lost, docs[id_col].eqNullSafe(lost["id"]), "left").select(*rest, F.col(text_col).cast("string").alias("__text"), "lost")
    schema = ", ".join([*(f"{c} {docs.schema[c].dataType.simpleString()}" for c in rest), f"{text_col} {kind}", "n_lines long, n_dropped long"])
    back = {n: c for c, n in new.items()}
    names = [F.col(n).alias(back[n]) for n in docs.columns if back[n] not in ("n_lines", "n_dropped")]
    return met.mapInArrow(lean(run), schema).select(*names, "n_lines", "n_dropped")
