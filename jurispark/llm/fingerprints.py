"""Exact document fingerprints: canonical text, 128-bit xxhash, bytes compared inside equal buckets."""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import by_number, cut, lean, partitions, raw


def canonical(text: str) -> bytes:
    """NFKC, case folding, NFKC again, runs of white space as one space, no space at the ends."""
    if text.isascii():
        folded = text.lower()
    else:
        folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "surrogatepass")


def digest(canon: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(canon)


def _colliding(rows: DataFrame) -> DataFrame:
    """Digests whose bucket holds different bytes. rows: digest, canon (compressed by one compressor; null: not compared).

    The least and the greatest byte string of a bucket are equal only if all are. Both are combined before the
    shuffle, so a bucket with a third of all rows comes as one row from each task.
    """
    return rows.where("canon IS NOT NULL").groupBy("digest").agg(F.min("canon").alias("a"), F.max("canon").alias("b")).where("a <> b").select("digest")


def _named(rows: DataFrame, colliding: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Fingerprint columns {out: (digest, second digest)}: the digest, and in colliding buckets the second one behind it."""
    if colliding.isEmpty():
        return rows.withColumns({out: F.col(d) for out, (d, _) in columns.items()})
    for out, (d, second) in columns.items():
        hit = colliding.select(F.col("digest").alias("__hit"))
        rows = rows.join(hit, rows[d] == hit["__hit"], "left").withColumn(out, F.when(F.col("__hit").isNull(), F.col(d)).otherwise(F.concat_ws("-", d, second))).drop("__hit")
    return rows


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars (code points), fingerprint of each row; equal canonical texts have equal fingerprints, others not.

    Buckets of equal digests are compared byte by byte; should one hold different texts, their fingerprints get
    their SHA-256 as well. A null text is an empty one; null ids, repeated rows and an empty table are kept as
    they are; other columns are not read.
    """

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in raw(batch.column(1))]
            canon = [canonical(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(digest, canon)), pa.array([hashlib.sha256(c).hexdigest() for c in canon]), pa.array(map(pack.compress, canon), pa.binary())], names=[id_col, "n_chars", "digest", "second", "canon"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, n_chars long, digest string, second string, canon binary")
    shared = rows.groupBy("digest").count().where("count > 1").select("digest")
    colliding = _colliding(rows.join(shared, "digest", "left_semi"))
    return _named(rows.drop("canon"), colliding, {"fingerprint": ("digest", "second")}).select(id_col, "n_chars", "fingerprint")


THIN = "id long, h binary, n_chars long, digest string, block int"
UNIT = "block int, tail int, id long, h binary, kind int, body binary"
EDITED = "id long, n_chars long, edited_sha256 string, digest string, second string, edited_digest string, edited_second string, near_edited double, near_next double, canon binary"


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", share: int = 4) -> DataFrame:
    """Each text's fingerprint beside that of the text with its end replaced by the next document's start.

    The last 1/share of the code points (rounded down) give way to as many of the next document, by ascending
    id; after the last comes the first. Rows with one id follow one another by a hash of their text; rows equal
    in id and text are one document, returned as often as it occurs. Null ids come first, null texts are empty,
    other columns are not read. Fingerprints are exact, so likeness is 1 for equal canonical texts, else 0.

    A thin pass gives digests and cuts the ids into blocks at quantiles. Texts are then shuffled once, packed,
    by block; each block also gets the first document of the block behind it. Documents whose digest occurs
    more than once return their canonical bytes for the comparison inside buckets.
    """
    return by_number(docs, id_col, lambda d: _edited_fingerprints(d, id_col, text_col, share), id_col)


def _edited_fingerprints(docs: DataFrame, id_col: str, text_col: str, share: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def scan(batches):
        for batch in batches:
            texts = [t or b"" for t in raw(batch.column(1))]
            plain = [t.decode("utf-8", "replace") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(xxhash.xxh3_128_digest, texts), pa.binary()), pa.array([len(t) for t in plain], pa.int64()), pa.array([digest(canonical(t)) for t in plain])], names=["id", "h", "n_chars", "digest"])

    thin = cut(docs.mapInArrow(lean(scan), "id long, h binary, n_chars long, digest string"))
    blocks = 4 * partitions(spark)
    splits = np.unique(np.array(thin.stat.approxQuantile("id", [i / blocks for i in range(1, blocks)], 0.25 / blocks), float))

    def block_of(ids: pa.Array) -> pa.Array:
        known = np.asarray(ids.fill_null(0), float)
        at = np.searchsorted(splits, known, side="right")
        return pa.array(np.where(np.asarray(ids.is_null()), 0, at), pa.int32())

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, block_of(batch.column(0))], names=["id", "h", "n_chars", "digest", "block"])

    thin = thin.mapInArrow(lean(place), THIN)
    firsts = sorted((r.block, r.first.id, bytes(r.first.h)) for r in thin.groupBy("block").agg(F.min(F.struct("id", "h")).alias("first")).collect())  # one row for each block
    tails: dict = {}
    for i, (_, key, h) in enumerate(firsts):
        tails.setdefault((key, h), []).append(firsts[i - 1][0])

    def units(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [t or b"" for t in raw(batch.column(1))]
            ids, at = batch.column(0).to_pylist(), block_of(batch.column(0)).to_pylist()
            rows = [(b, 0, i, xxhash.xxh3_128_digest(t), 1, pack.compress(t)) for b, i, t in zip(at, ids, texts, strict=True)]
            rows += [(b, 1, *row[2:]) for row in rows for b in tails.get(row[2:4], ())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)], names=["block", "tail", "id", "h", "kind", "body"])

    shared = thin.groupBy("digest").count().where("count > 1").select("digest")
    marks = thin.join(shared, "digest", "left_semi").select("block", F.lit(0).alias("tail"), "id", "h", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("body"))
    stream = docs.mapInArrow(lean(units), UNIT).unionByName(marks).repartition(partitions(spark), "block").sortWithinPartitions("block", "tail", "id", "h", "kind")
    rows = cut(stream.mapInArrow(lean(lambda batches: _edit(batches, share)), EDITED))
    # buckets of texts are compared by their bytes; an edited text was compared with its own text in _edit, and with
    # the other members of the bucket it falls into by the second digest, as its bytes are nowhere together with theirs
    both = rows.select("digest", "second").unionByName(rows.select(F.col("edited_digest").alias("digest"), F.col("edited_second").alias("second")))
    unlike = both.groupBy("digest").agg(F.min("second").alias("a"), F.max("second").alias("b")).where("a <> b").select("digest")
    rows = _named(rows.drop("canon"), _colliding(rows).union(unlike).distinct(), {"fingerprint": ("digest", "second"), "edited_fingerprint": ("edited_digest", "edited_second")})
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _edit(batches, share: int):
    """Walks a partition's blocks in order and holds one document back until the next one is there."""
    unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    out: list[tuple] = []
    held = None  # [block, id, times, dup, text, canonical]

    def finish(text: str, canon: bytes) -> None:
        _, key, times, dup, own, own_canon = held
        cut_at = len(own) // share
        edited = own[: len(own) - cut_at] + text[:cut_at]
        e = canonical(edited)
        row = (key, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), digest(own_canon), hashlib.sha256(own_canon).hexdigest(), digest(e), hashlib.sha256(e).hexdigest(), float(e == own_canon), float(canon == own_canon), pack.compress(own_canon) if dup else None)
        out.extend([row] * times)

    def flush():
        kinds = (pa.int64(), pa.int64(), *[pa.string()] * 5, pa.float64(), pa.float64(), pa.binary())
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in EDITED.split(", ")])

    last, dup = None, False
    for batch in batches:
        for block, tail, key, h, kind, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            unit = (block, tail, key, h)
            if unit == last and kind == 1 and held and not tail and held[2]:
                held[2] += 1
                continue
            if kind == 0:
                dup, marked = True, unit
                continue
            text = unpack.decompress(body).decode("utf-8", "replace")
            canon = canonical(text)
            if held and held[0] == block:
                finish(text, canon)
            held = None if tail else [block, key, 1, dup and marked == unit, text, canon]
            last, dup = unit, False
        if len(out) >= 2000:
            yield flush()
    if out:
        yield flush()
