"""Substring dedup: recurring passages are confirmed, compiled into sharded Aho-Corasick automata, and located."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import by_number, cut, lean, partitions, raw

#: Words of a window, and of an anchor inside it.
WINDOW, ANCHOR = 50, 16
#: Windows that one task holds at a time: anchors with more are told apart further, and what is still more is dealt
#: out in parts. Windows compiled into one automaton.
HELD, PATTERNS = 8192, 8192
_MIX, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(31)


class Grams:
    """Hashes of runs of words, by doubling."""

    def __init__(self):
        class Words(dict):
            def __missing__(self, word):
                value = self[word] = xxhash.xxh3_64_intdigest(word)
                return value

        self.words = Words()

    def __call__(self, words: list[bytes]) -> dict[int, np.ndarray]:
        """Hashes of all runs of 16 and of 32 words."""
        if len(self.words) > 500_000:
            self.words.clear()
        g = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        out, size = {}, 1
        while size < 32:
            g = join(g[:-size], g[size:])
            size *= 2
            out[size] = g
        return out


def join(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of two hashes, elementwise; order matters."""
    c = (a * _MIX + np.uint64(seed)) ^ ((b << _TURN) | (b >> np.uint64(33)))
    c = (c ^ (c >> _TURN)) * np.uint64(0xD6E8FEB86659FD93)
    return c ^ (c >> np.uint64(32))


def least_anchor(grams: dict[int, np.ndarray], words: int = ANCHOR) -> np.ndarray:
    """For each window, the least hash of its runs of words: equal windows have equal ones, wherever they stand."""
    m, size = grams[words], 1
    span = WINDOW - words + 1
    while size * 2 <= span:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(m) - (span - size)], m[span - size :]) if span > size else m


def second_anchor(grams: dict[int, np.ndarray]) -> np.ndarray:
    """Tells windows with one anchor apart: the anchor, and the least hash of the window's runs of 32 words."""
    return join(least_anchor(grams), least_anchor(grams, 32))


ROWS = "id long, key binary, cls long, n_words long, whole string, anchors array<long>, windows array<int>"


def _scan(docs: DataFrame) -> DataFrame:
    """A thin row for each document: its word sequence's key, number of words, digest, and anchors with the number of
    windows that have each."""

    def run(batches):
        grams = Grams()
        for batch in batches:
            keys, cls, sizes, wholes, anchors, windows = [], [], [], [], [], []
            for t in raw(batch.column(1)):
                words = (t or b"").split()
                text = b" ".join(words)
                key = xxhash.xxh3_128_digest(text)
                keys.append(key)
                cls.append(int.from_bytes(key[:8], "big", signed=True))
                sizes.append(len(words))
                wholes.append(hashlib.sha256(text).hexdigest())
                some, n = np.unique(least_anchor(grams(words)), return_counts=True) if len(words) >= WINDOW else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                anchors.append(some.view(np.int64))
                windows.append(n.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(cls, pa.int64()), pa.array(sizes, pa.int64()), pa.array(wholes), pa.array(anchors, pa.list_(pa.int64())), pa.array(windows, pa.list_(pa.int32()))], names=[c.split()[0] for c in ROWS.split(", ")])

    return cut(docs.mapInArrow(lean(run), ROWS))


ZONES = "doc long, cls long, z binary, cold array<long>, hot array<long>"


def _zones(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of documents that have recurring anchors, packed."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed, stay = [], []
            for t, cls in zip(raw(batch.column(0)), batch.column(2).to_pylist(), strict=True):
                text = b" ".join((t or b"").split())
                stay.append(int.from_bytes(xxhash.xxh3_128_digest(text)[:8], "big", signed=True) == cls)  # ids may repeat
                packed.append(pack(text) if stay[-1] else None)
            out = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(packed, pa.binary()), batch.column(3), batch.column(4)], names=["doc", "cls", "z", "cold", "hot"])
            yield out.filter(pa.array(stay, pa.bool_()))

    joined = docs.join(wanted, docs["id"] == wanted["doc"]).select("text", "doc", "cls", "cold", "hot")
    return cut(joined.mapInArrow(lean(run), ZONES))


def _second(zones: DataFrame) -> DataFrame:
    """(doc, cls, key, n): the second anchors of windows whose anchor very many windows have."""

    def run(batches):
        grams, unpack = Grams(), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            docs, classes, keys, counts = [], [], [], []
            for doc, cls, z, hot in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if hot:
                    g = grams(unpack(z).split())
                    some, n = np.unique(second_anchor(g)[np.isin(least_anchor(g).view(np.int64), np.array(hot, np.int64))].view(np.int64), return_counts=True)
                    docs.append(np.full(len(some), doc))
                    classes.append(np.full(len(some), cls))
                    keys.append(some)
                    counts.append(n)
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (docs, classes, keys, counts)], names=["doc", "cls", "key", "n"])

    return zones.mapInArrow(lean(run), "doc long, cls long, key long, n long")


def _runs(least: np.ndarray, wanted: np.ndarray):
    """[first, last] of windows in a row with one and the same wanted anchor."""
    at = np.flatnonzero(np.isin(least, wanted))
    if len(at):
        split = np.flatnonzero((np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]]))
        for a, b in zip(np.r_[0, split + 1], np.r_[split, len(at) - 1], strict=True):
            yield int(at[a]), int(at[b])


SEGMENTS = "key long, part int, parts int, doc long, cls long, start long, words binary"


def _segments(zones: DataFrame, anchors) -> DataFrame:
    """The stretches of words around wanted anchors. zones: doc, cls, z, keys, parts (an array beside keys, or null for
    1 each). A key's stretches are dealt out to its parts by document."""

    def run(batches):
        grams, unpack = Grams(), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows, size = [], 0
            for doc, cls, z, keys, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not keys:
                    continue
                words = unpack(z).split()
                least = anchors(grams(words)).view(np.int64)
                dealt = dict(zip(keys, parts, strict=True)) if parts else {}
                turn = xxhash.xxh3_64_intdigest(str(doc).encode())
                for a, b in _runs(least, np.array(keys, np.int64)):
                    n = dealt.get(int(least[a]), 1)
                    rows.append((int(least[a]), turn % n, n, doc, cls, a, b" ".join(words[a : b + WINDOW])))
                    size += len(rows[-1][-1])
                if len(rows) >= 5000 or size > 1 << 24:
                    yield _arrow(rows, SEGMENTS)
                    rows, size = [], 0
            yield _arrow(rows, SEGMENTS)

    return zones.mapInArrow(lean(run), SEGMENTS)


def _arrow(rows: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def confirm(held: list[tuple]):
    """held: (doc, cls, start, words) of one shard. Its texts as word numbers, and each distinct window, word for word,
    with its smallest and largest document."""
    number: dict[bytes, int] = {}
    texts, seen = [], {}
    for doc, _, _, words in held:
        words = words.split(b" ")
        text = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
        texts.append(text)
        data = text.tobytes()
        for i in range(0, 4 * (len(text) - WINDOW + 1), 4):
            w = data[i : i + 4 * WINDOW]
            got = seen.get(w)
            if got is None:
                seen[w] = (doc, doc)
            elif not got[0] <= doc <= got[1]:
                seen[w] = (min(doc, got[0]), max(doc, got[1]))
    return number, texts, seen


def automaton_of(patterns):
    """An automaton of (string, first document); a word is one character."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for text, first in patterns:
        out.add_word(text, first)
    out.make_automaton()
    return out


def covered(automaton, text: str, doc: int, start: int) -> list[int]:
    """Stretches of a text, whose first word is word ``start`` of its document, that windows of smaller documents cover."""
    found: list[int] = []
    for end, first in automaton.iter(text):
        if first < doc:
            a = start + end + 1 - WINDOW
            if found and a <= found[-1]:
                found[-1] = a + WINDOW
            else:
                found += (a, a + WINDOW)
    return found


def _letter(n):
    """The n-th character that is no surrogate; 0 stands for words that no pattern has."""
    return n + 0x800 * (n >= 0xD800)


SPANS = "doc long, cls long, spans array<long>"


def search(held: list[tuple], size: int = PATTERNS) -> list[tuple]:
    """The spans of a shard that one task holds: its windows of two documents, ``size`` in an automaton."""
    number, texts, seen = confirm(held)
    recurring = [(w, first) for w, (first, final) in seen.items() if first < final]
    rows = []
    for i in range(0, len(recurring), size):
        windows = np.frombuffer(b"".join(w for w, _ in recurring[i : i + size]), np.int32)
        some = np.unique(windows)
        letter = np.zeros(len(number), np.uint32)
        letter[some] = _letter(np.arange(1, len(some) + 1, dtype=np.uint32))
        said = lambda text, letter=letter: letter[text].astype("<u4").tobytes().decode("utf-32-le")
        automaton = automaton_of(zip(map(said, windows.reshape(-1, WINDOW)), (first for _, first in recurring[i : i + size]), strict=True))
        for (doc, cls, start, _), text in zip(held, texts, strict=True):
            if found := covered(automaton, said(text), doc, start):
                rows.append((doc, cls, found))
    return rows


def _locate(segments: DataFrame, limit: int, size: int) -> DataFrame:
    """Shards by key: windows of two documents are confirmed, compiled, and every segment is streamed through.

    Equal windows have one key, so all their places are in one shard, which holds ``limit`` windows or one
    key's at a time.
    """
    segments = segments.repartition(partitions(segments.sparkSession), "key").sortWithinPartitions("key")

    def run(batches):
        held, windows, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last and windows >= limit:
                    yield _arrow(search(held, size), SPANS)
                    held, windows = [], 0
                last = row[0]
                held.append(row[1:])
                windows += row[4].count(b" ") + 2 - WINDOW
        yield _arrow(search(held, size), SPANS)

    return segments.select("key", "doc", "cls", "start", "words").mapInArrow(lean(run), SPANS)


WINDOWS = "key long, parts int, words binary, first long, final long"


def _locate_parts(segments: DataFrame, size: int) -> DataFrame:
    """The same for keys that more windows have than a task should hold: their segments lie in parts.

    Each part gives its distinct windows, word for word, with its smallest and largest document; from all parts,
    those of two documents are a key's patterns. They are compiled into automata of about ``size`` windows,
    and every part of the key is streamed through each of them.
    """
    n = partitions(segments.sparkSession)
    dealt = segments.repartition(n, "key", "part").sortWithinPartitions("key", "part")

    def distinct(batches):
        held, at = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != at:
                    if held:
                        yield from tell(at, held)
                    at, held = row[:3], []
                held.append(row[3:])
        if held:
            yield from tell(at, held)

    def tell(at, held):
        number, _, seen = confirm(held)
        words, rows = [*number], []
        for w, (first, final) in seen.items():
            rows.append((at[0], at[2], b" ".join([words[i] for i in np.frombuffer(w, np.int32).tolist()]), first, final))
            if len(rows) >= 5000:
                yield _arrow(rows, WINDOWS)
                rows = []
        yield _arrow(rows, WINDOWS)

    found = dealt.mapInArrow(lean(distinct), WINDOWS)
    patterns = cut(found.groupBy("key", "words").agg(F.first("parts").alias("parts"), F.min("first").alias("first"), F.max("final").alias("final")).where("first < final").drop("final"))
    chunks = patterns.groupBy("key").agg(F.first("parts").alias("parts"), F.ceil(F.count(F.lit(1)) / size).cast("int").alias("chunks"))
    none = F.lit(None).cast("long")
    words = patterns.join(chunks.select("key", "chunks"), "key").select("key", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.expr("cast(pmod(xxhash64(words), chunks) AS int)").alias("chunk"), F.lit(0).alias("role"), F.col("first").alias("doc"), none.alias("cls"), none.alias("start"), "words")
    each = chunks.select("key", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "chunks")
    texts = segments.join(each, ["key", "part"]).select("key", "part", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"), F.lit(1).alias("role"), "doc", "cls", "start", "words")
    rows = words.unionByName(texts).repartition(n, "key", "part", "chunk").sortWithinPartitions("key", "part", "chunk", "role")

    def locate(batches):
        at, patterns, automaton, letters = None, [], None, {}
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != at:
                    at, patterns, automaton, letters = row[:3], [], None, {}
                _, _, _, role, doc, cls, start, words = row
                words = words.split(b" ")
                if role == 0:
                    patterns.append(("".join([letters.setdefault(w, chr(_letter(len(letters) + 1))) for w in words]), doc))
                    continue
                if automaton is None and patterns:
                    automaton, patterns = automaton_of(patterns), []
                if automaton is not None and (found := covered(automaton, "".join([letters.get(w, "\0") for w in words]), doc, start)):
                    out.append((doc, cls, found))
            yield _arrow(out, SPANS)

    return rows.mapInArrow(lean(locate), SPANS)


def _recurring(places: DataFrame) -> DataFrame:
    """Keys that two texts have, with the number of windows that have them. places: doc, cls, key, n."""
    return places.groupBy("key").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("windows")).where("texts > 1").drop("texts")


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held: int = HELD, patterns: int = PATTERNS) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of each row.

    Words are runs of characters other than ASCII white space. Every word goes that is covered by a window of
    50 words whose words also start, in the same order, in a document with a smaller id; windows are judged on
    the input. kept_sha256 is the digest of the words left, joined by one space.

    1. A window's anchor is the least hash among its runs of 16 words. About one position in 18 is an anchor;
       those that two different texts have lead to everything that can recur. Texts equal in all words are one
       class: only its smallest document is looked at, the others go as a whole if they have 50 words.
    2. Stretches around recurring anchors are dealt out by anchor. In each shard, windows of two documents are
       confirmed word for word and compiled into Aho-Corasick automata, which locate all their places.
       Anchors of more than ``held`` windows are told apart by a second one; what more windows share even then
       is dealt out in parts, which are confirmed together and located each (see ``_locate_parts``).
    3. Words covered are removed.

    ``held`` windows are in one task's memory at a time, ``patterns`` windows in one automaton.

    Null and empty texts have no words. Null ids are no smaller than others and others are not smaller than
    them: such rows stay whole. Rows with one id don't remove one another's words. Other columns are not read.
    """
    return by_number(docs, id_col, lambda d: _dedup_substrings(d, id_col, text_col, held, patterns), id_col)


def _dedup_substrings(docs: DataFrame, id_col: str, text_col: str, held: int, patterns: int) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = _scan(docs)
    classes = rows.groupBy("key").agg(F.min("id").alias("doc"), F.first("cls").alias("cls"), F.first("anchors").alias("anchors"), F.first("windows").alias("windows"))
    places = classes.where("doc IS NOT NULL").select("doc", "cls", F.explode(F.arrays_zip("anchors", "windows")).alias("a")).select("doc", "cls", "a.anchors", "a.windows").toDF("doc", "cls", "anchor", "n")
    recurring = _recurring(places.withColumnRenamed("anchor", "key"))
    hot = F.col("windows") > held
    wanted = places.join(recurring.withColumnRenamed("key", "anchor"), "anchor").groupBy("doc", "cls").agg(F.collect_list(F.when(~hot, F.col("anchor"))).alias("cold"), F.collect_list(F.when(hot, F.col("anchor"))).alias("hot"))
    zones = _zones(docs, wanted)
    spans = _locate(_segments(zones.where(F.size("cold") > 0).select("doc", "cls", "z", "cold", F.lit(None).cast("array<int>").alias("parts")), least_anchor), held, patterns)
    many = zones.where(F.size("hot") > 0)
    if not many.isEmpty():
        second = cut(_second(many))
        parts = F.ceil(F.col("windows") / held).cast("int")
        wanted = second.join(_recurring(second).withColumn("parts", parts), "key").groupBy("doc", "cls").agg(F.collect_list(F.struct("key", "parts")).alias("keys"))
        split = many.join(wanted, ["doc", "cls"]).select("doc", "cls", "z", F.col("keys.key").alias("keys"), F.col("keys.parts").alias("parts"))
        split = _segments(split, second_anchor)
        spans = spans.unionByName(_locate(split.where("parts = 1"), held, patterns)).unionByName(_locate_parts(split.where("parts > 1"), patterns))
    spans = cut(spans.groupBy("doc", "cls").agg(F.flatten(F.collect_list("spans")).alias("spans")))

    def strip(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            gone, digests = [], []
            for z, pairs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = unpack(z).split()
                edge = np.zeros(len(words) + 1, np.int64)
                pairs = np.array(pairs, np.int64)
                np.add.at(edge, pairs[::2], 1)
                np.add.at(edge, pairs[1::2], -1)
                keep = np.cumsum(edge)[:-1] == 0
                gone.append(int(len(words) - keep.sum()))
                text = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(digests, pa.string())], names=["doc", "cls", "gone", "sha"])

    changed = zones.join(spans, ["doc", "cls"]).select("doc", "cls", "z", "spans").mapInArrow(lean(strip), "doc long, cls long, gone long, sha string")
    out = rows.drop("anchors", "windows", "cls").join(classes.select("key", "doc", "cls"), "key")
    out = out.join(changed.withColumnRenamed("doc", "id"), ["id", "cls"], "left")
    copy = F.col("id").isNotNull() & (F.col("id") > F.col("doc")) & (F.col("n_words") >= WINDOW)
    out = out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
    )
    return out
