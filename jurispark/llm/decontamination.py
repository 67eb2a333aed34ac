"""Benchmark decontamination: suffix arrays over shards of the training text, searched for every test suffix."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import alnum_words, cut, lean, numbered_columns, partitions, raw

#: Words of a window; words of text in one suffix array; bytes of test text that are sent to the executors, or held by
#: one task, at a time; texts that one task holds against a block of them; bits of the filter of windows.
WINDOW, SHARD_WORDS, BLOCK_BYTES, BLOCK_TEXTS, FILTER_BITS = 10, 2_000_000, 1_000_000, 20_000, 26
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Tests:
    """Test items as word numbers, their different windows, and their suffixes in order."""

    def __init__(self, items: list[tuple]):
        self.vocabulary: dict[bytes, int] = {}
        self.items, flat, starts, lengths, owners = [], [], [], [], []
        self.depth = 0
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in alnum_words(text)]
            if not words:
                continue
            size = min(WINDOW, len(words))
            n = len(words) - size + 1
            starts += range(len(flat), len(flat) + n)
            lengths += [size] * n
            owners += [len(self.items)] * n
            flat += [*words, 0]
            self.items.append(str(item) if item is not None else "null")
            self.depth = max(self.depth, len(words))
        self.flat = np.array([*flat, *[0] * WINDOW], np.int64)  # items behind one another, a break after each
        starts, lengths, owners = (np.array(x, np.int64) for x in (starts, lengths, owners))
        within = np.arange(WINDOW) < lengths[:, None]
        # a window that many items have is searched for once, so a place in a text is found at most once a length
        self.windows, which = np.unique(np.where(within, self.flat[starts[:, None] + np.arange(WINDOW)], 0), axis=0, return_inverse=True) if len(starts) else (np.zeros((0, WINDOW), np.int64), np.zeros(0, np.int64))
        self.lengths = (self.windows > 0).sum(1)
        self.least = int(self.lengths.min()) if len(starts) else 0
        order = np.lexsort((owners, which))
        self.owners, self.owner_at = owners[order], np.searchsorted(which[order], np.arange(len(self.windows) + 1))
        # suffixes of full windows in order: those of one window stand together
        order = suffix_array(self.flat, self.depth)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        full = np.flatnonzero(lengths == WINDOW)
        full = full[np.argsort(place[starts[full]])]
        self.suffixes = starts[full]
        group = which[full]
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
        self.low, self.high = np.zeros(len(self.windows), np.int64), np.zeros(len(self.windows), np.int64)
        self.low[group[edge]], self.high[group[edge]] = edge, np.r_[edge[1:], len(group)]

    def items_of(self, windows: np.ndarray) -> list[str]:
        """The items that have any of some windows."""
        windows = np.unique(windows)
        n = self.owner_at[windows + 1] - self.owner_at[windows]
        at = np.repeat(self.owner_at[windows] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
        return sorted({self.items[i] for i in np.unique(self.owners[at]).tolist()})

    def longest(self, seq: np.ndarray, spot: np.ndarray, window: np.ndarray) -> np.ndarray:
        """The longest stretch at each place of a text that is also in an item: among the suffixes of its window, those
        that go on alike are kept, word by word."""
        match = self.lengths[window].copy()
        low, high = self.low[window], self.high[window]
        live = np.flatnonzero(high > low)
        k = WINDOW
        while len(live):
            live = live[spot[live] + k < len(seq)]
            wanted = seq[spot[live] + k]
            live, wanted = live[wanted > 0], wanted[wanted > 0]
            bounds = []
            for upper in (False, True):
                a, b = low[live], high[live]
                while (open_ := a < b).any():
                    mid = (a + b) // 2
                    found = self.flat[self.suffixes[np.minimum(mid, len(self.suffixes) - 1)] + k]
                    right = open_ & ((found < wanted) | ((found == wanted) & upper))
                    a, b = np.where(right, mid + 1, a), np.where(open_ & ~right, mid, b)
                bounds.append(a)
            low[live], high[live] = bounds
            live = live[bounds[1] > bounds[0]]
            k += 1
            match[live] = k
        return match


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, ordered by at least their first ``depth`` numbers, by doubling of ranks."""
    rank, k = np.unique(seq, return_inverse=True)[1].astype(np.int64), 1
    while k < depth and rank.max(initial=0) + 1 < len(seq):
        behind = np.zeros(len(seq), np.int64)
        behind[:-k or None] = rank[k:] + 1 if k < len(seq) else 0
        rank = np.unique(rank * (len(seq) + 2) + behind, return_inverse=True)[1].astype(np.int64)
        k *= 2
    return np.argsort(rank, kind="stable")


def _bound(seq, order, tests: Tests, upper: bool) -> np.ndarray:
    """For every window at once, the first suffix that is not below (or is above) its window, by binary search."""
    low, high = np.zeros(len(tests.lengths), np.int64), np.full(len(tests.lengths), len(order), np.int64)
    width = int(tests.lengths.max())
    within = np.arange(width) < tests.lengths[:, None]
    wanted = tests.windows[:, :width]
    while (open_ := low < high).any():
        mid = (low + high) // 2
        found = np.where(within, seq[np.minimum(order[np.minimum(mid, len(order) - 1)][:, None] + np.arange(width), len(seq) - 1)], 0)
        differs = found != wanted
        at = differs.argmax(1)
        rows = np.arange(len(at))
        equal = ~differs[rows, at]
        below = found[rows, at] < wanted[rows, at]
        right = open_ & (below | (equal if upper else False))
        low, high = np.where(right, mid + 1, low), np.where(open_ & ~right, mid, high)
    return low


def occurrences(texts: list[list[bytes]], tests: Tests):
    """(window, document, word) of each place where a window stands, and the length of the verbatim match there.

    Words that no test has are breaks. Only stretches without a break that are as long as the shortest window
    enter the suffix array; a break ends each of them.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    get = tests.vocabulary.get
    ids = np.zeros(int(sizes.sum()) + len(texts) + 1, np.int64)
    starts = np.r_[0, np.cumsum(sizes + 1)]
    for t, at in zip(texts, starts, strict=False):
        ids[at : at + len(t)] = np.fromiter((get(w, 0) for w in t), np.int64, len(t))
    edge = np.flatnonzero(np.diff(np.r_[False, ids > 0, False]))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= max(tests.least, 1)
    begin, end = begin[long], end[long]
    none = np.zeros(0, np.int64)
    if not len(begin) or not len(tests.lengths):
        return none, none, none, none
    runs = end - begin + 1  # with the break behind
    place = np.repeat(begin - np.r_[0, np.cumsum(runs)[:-1]], runs) + np.arange(int(runs.sum()))
    seq = np.r_[ids[place], 0]
    order = suffix_array(seq[:-1], tests.depth)
    first, last = _bound(seq, order, tests, False), _bound(seq, order, tests, True)
    n = last - first
    window = np.repeat(np.arange(len(n)), n)
    spot = order[np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))]
    match = tests.longest(seq, spot, window)
    word = place[spot]
    doc = np.searchsorted(starts, word, side="right") - 1
    return window, doc, word - starts[doc], match


def _shards(texts: list[bytes | None]):
    """Word lists of a batch in shards of about SHARD_WORDS words."""
    part, held, at = [], 0, 0
    for i, t in enumerate(texts):
        part.append(alnum_words(t))
        held += len(part[-1])
        if held >= SHARD_WORDS:
            yield at, part
            part, held, at = [], 0, i + 1
    if part:
        yield at, part


def _hits(texts: list[bytes | None], tests: Tests):
    """For each text: number of words, hit words as [start, end) pairs, items, longest match."""
    for _, part in _shards(texts):
        query, doc, word, match = occurrences(part, tests)
        order = np.lexsort((word, doc))
        query, doc, word, match = query[order], doc[order], word[order], match[order]
        edges = np.searchsorted(doc, np.arange(len(part) + 1))
        for i, words in enumerate(part):
            a, b = edges[i], edges[i + 1]
            if a == b:
                yield len(words), [], [], 0
                continue
            spans: list[list[int]] = []
            for s, q in zip(word[a:b].tolist(), query[a:b].tolist(), strict=True):
                e = s + int(tests.lengths[q])
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
            yield len(words), [x for s in spans for x in s], tests.items_of(query[a:b]), int(match[a:b].max())


def window_hashes(words: list[bytes], lengths: list[int]) -> np.ndarray:
    """64-bit hashes of all runs of the given numbers of words."""
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out, run = [], one
    for n in range(1, max(lengths, default=0) + 1):
        if n > len(words):
            break
        if n > 1:
            run = (run[:-1] ^ one[n - 1 :]) * _MIX
            run ^= run >> np.uint64(29)
        if n in lengths:
            out.append((run + np.uint64(n)) * _MIX)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _packed(docs: DataFrame, items: DataFrame, text_col: str, block_bytes: int, total: int) -> DataFrame:
    """Hits of the different texts of docs with items in any number of blocks: __key, n_words, spans, items, longest.

    Texts are read twice, however many blocks there are. First, a filter of the items' windows (a bitmap of at most
    2**FILTER_BITS bits, all that reaches the driver) picks windows of texts; these are joined with the items' windows and
    tell which texts go to which blocks. Then each block's texts are dealt out, at most ``BLOCK_TEXTS`` or so to a
    task, with the block's items ahead of them, and searched there.
    """
    spark = docs.sparkSession
    blocks = max(1, -(-2 * total // block_bytes))
    items = cut(items.distinct().withColumn("block", F.expr(f"cast(pmod(xxhash64(item, text), {blocks}) AS int)")))

    def windows(batches):
        for batch in batches:
            hashes, where, sizes = [], [], []
            for text, block in zip(raw(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = alnum_words(text)
                if words:
                    size = min(WINDOW, len(words))
                    hashes.append(np.unique(window_hashes(words, [size])).view(np.int64))
                    where.append(np.full(len(hashes[-1]), block))
                    sizes.append(np.full(len(hashes[-1]), size))
            if hashes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), k) for x, k in ((hashes, pa.int64()), (where, pa.int32()), (sizes, pa.int32()))], names=["h", "block", "size"])

    tests = cut(items.mapInArrow(lean(windows), "h long, block int, size int").distinct())
    bits = min(FILTER_BITS, max(12, (4 * total).bit_length()))
    lengths = sorted(r.size for r in tests.select("size").distinct().collect())  # 10 at most
    filter_ = np.zeros(1 << bits, bool)
    cells = tests.select(F.shiftrightunsigned("h", 64 - bits).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("mask"))
    for r in cells.toLocalIterator():
        filter_[64 * r.word : 64 * r.word + 64] = np.unpackbits(np.array([r["mask"]], np.int64).view(np.uint8), bitorder="little").astype(bool)
    filter_ = np.packbits(filter_)

    def seen(batches):
        known = np.unpackbits(filter_).astype(bool)
        for batch in batches:
            keys, hashes = [], []
            for text in raw(batch.column(0)):
                h = np.unique(window_hashes(alnum_words(text), lengths))
                h = h[known[(h >> np.uint64(64 - bits)).astype(np.int64)]]
                hashes.append(h.view(np.int64))
                keys += [hashlib.sha256(text or b"").digest()] * len(h)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(np.concatenate(hashes) if hashes else [], pa.int64())], names=["__key", "h"])

    pairs = cut(docs.select(text_col).mapInArrow(lean(seen), "__key binary, h long").join(tests.select("h", "block"), "h").select("__key", "block").distinct())
    salts = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("salts"))
    body = docs.select(F.unhex(F.sha2(F.coalesce(text_col, F.lit("")), 256)).alias("__key"), F.coalesce(text_col, F.lit("")).alias("text")).join(pairs.select("__key").distinct(), "__key", "left_semi").dropDuplicates(["__key"])
    role = lambda r, row: row.select("block", "salt", F.lit(r).alias("role"), "__key", "text", "item")
    texts = body.join(pairs.join(salts, "block").withColumn("salt", F.expr("cast(pmod(xxhash64(__key), salts) AS int)")), "__key").withColumn("item", F.lit(None).cast("string"))
    ahead = items.join(salts, "block").withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).withColumn("__key", F.lit(None).cast("binary"))
    rows = role(0, ahead).unionByName(role(1, texts)).repartition(partitions(spark), "block", "salt").sortWithinPartitions("block", "salt", "role")

    def run(batches):
        at, items, tests, held, words = None, [], None, [], 0
        for batch in batches:
            columns = [*(batch.column(i).to_pylist() for i in range(4)), raw(batch.column(4)), batch.column(5).to_pylist()]
            for block, salt, role, key, text, item in zip(*columns, strict=True):
                if (block, salt) != at:
                    yield _found(held, tests)
                    at, items, tests, held, words = (block, salt), [], None, [], 0
                if role == 0:
                    items.append((item, text))
                    continue
                tests = tests or Tests(items)
                held.append((key, text))
                words += len(text) // 4
                if words >= SHARD_WORDS:
                    yield _found(held, tests)
                    held, words = [], 0
        yield _found(held, tests)

    found = rows.mapInArrow(lean(run), f"__key binary, {HITS}").where("size(spans) > 0")
    pairs = F.expr("transform(sequence(0, int(size(spans) / 2) - 1), i -> struct(spans[2 * i] AS s, spans[2 * i + 1] AS e))")
    merged = found.withColumn("pairs", pairs).groupBy("__key").agg(F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("pairs"))).alias("pairs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("longest").alias("longest"))
    merged = merged.withColumn("spans", F.expr("aggregate(pairs, cast(array() AS array<bigint>), (a, p) -> CASE WHEN size(a) > 0 AND p.s <= a[size(a) - 1] THEN concat(slice(a, 1, size(a) - 1), array(greatest(a[size(a) - 1], p.e))) ELSE concat(a, array(p.s, p.e)) END)"))
    return merged.drop("pairs")


def _found(held: list[tuple], tests: Tests | None) -> pa.RecordBatch:
    found = list(_hits([text for _, text in held], tests)) if held else []
    columns = list(zip(*found, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.binary()), *(pa.array(c, k) for c, k in zip(columns, KINDS, strict=True))], names=["__key", "n_words", "spans", "items", "longest"])


KINDS = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64())
#: Words in Java's pattern syntax, capitals included.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
HITS = "n_words long, spans array<long>, items array<string>, longest long"


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds n_words, spans (hit words as start, end, start, ...), items (ids as sorted strings), longest to every row.

    A window is 10 consecutive words of an item, or a shorter item's every word. Tasks build suffix arrays over
    shards of text and search them for the items' suffixes. Items of at most ``block_bytes`` in all are sent to
    the executors, and texts are searched where they are read, without a shuffle. More items lie in blocks of about
    half as many bytes; texts are read a fixed number of times, and each goes to the blocks that have a window of its own
    (see ``_packed``).

    Null and empty texts have no words and no hits; an item without words has no windows; a null item id is the
    string null; repeated rows are judged alike. Columns of docs that clash with the four are replaced.
    """
    docs = docs.drop("n_words", "spans", "items", "longest")
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where(F.col("text").rlike(WORDS))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= block_bytes:
        return _search(docs, Tests([(r.item, r.text.encode()) for r in items.collect()]), text_col)
    merged = _packed(docs, items, text_col, block_bytes, total)
    keyed = docs.withColumn("__key", F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)))
    none = [F.coalesce("n_words", F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORDS)).cast("long")).alias("n_words"), F.coalesce("spans", F.array().cast("array<long>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("longest", F.lit(0).cast("long")).alias("longest")]
    return keyed.join(merged, "__key", "left").select(*docs.columns, *none)


def _search(docs: DataFrame, tests: Tests, text_col: str) -> DataFrame:
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = list(_hits(raw(batch.column(at)), tests))
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, KINDS, strict=True))], names=[*batch.schema.names, "n_words", "spans", "items", "longest"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{fields}, {HITS}")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """Rows of docs without any hit, with the columns of docs as they are; options as for ``find_contamination``."""
    own, new, back = numbered_columns(docs)
    return find_contamination(own, benchmark, text_col=new[text_col], **options).where(F.size("spans") == 0).select(back)


def summarise(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    n_hit = F.expr("aggregate(sequence(0, greatest(size(spans) - 1, 0)), 0L, (a, i) -> a + CASE WHEN size(spans) = 0 THEN 0L WHEN i % 2 = 0 THEN -spans[i] ELSE spans[i] END)")
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "longest")
