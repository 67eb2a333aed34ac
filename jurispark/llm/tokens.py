"""Token counts of byte-level BPE vocabularies: whole batches of pre-tokens are merged as ragged numpy arrays."""

from __future__ import annotations

import json
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from jurispark.llm.common import lean, raw

#: The pre-tokenizer's pattern, and bytes as the characters that stand for them in the vocabulary. Fixed values.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose counts a worker remembers; beyond it the memory starts anew.
REMEMBERED, REMEMBERED_BYTES = 400_000, 64
#: Pre-tokens that are held at a time, and characters of a text that is split in one go.
HELD, WHOLE = 200_000, 1 << 20


def byte_characters() -> list[str]:
    """The character of each byte: itself where it prints, else the next free one from U+0100."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in printing:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


class Merges:
    """Merge ranks as sorted keys left * 2**20 + right; a merge's rank leads to the symbol that it makes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.of_byte = np.array([ids[c] for c in byte_characters()], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([(ids[a] << 20) | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys))

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Surviving symbols of each pre-token.

        All pre-tokens lie behind one another in one array with their owner beside each symbol. In a round,
        each sequence's lowest-ranked pair is merged at all its places, from the left where they overlap;
        sequences without a pair left leave the array.
        """
        out = np.array([len(t) for t in tokens], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), out)
        none = len(self.keys)
        rank = None
        while len(symbols) > 1:
            if rank is None:
                rank = self.rank(symbols[:-1], symbols[1:])
                rank[owner[:-1] != owner[1:]] = none
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(np.r_[rank, none], first)
            sizes = np.diff(np.r_[first, len(owner)])
            live = least < none
            if not live.all():
                stay = np.repeat(live, sizes)
                symbols, owner, rank = symbols[stay], owner[stay], np.r_[rank, none][stay][:-1]
                least, sizes = least[live], sizes[live]
                if not len(symbols):
                    break
            low = np.repeat(least, sizes)
            hit = rank == low[:-1]
            at = np.flatnonzero(hit)
            run = np.r_[True, np.diff(at) != 1]  # of hits in a row, every second one overlaps the one before
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            np.subtract.at(out, owner[at], 1)
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            symbols, owner, changed = symbols[keep], owner[keep], changed[keep]
            rank = np.r_[rank, none][keep][:-1]
            renew = np.flatnonzero(changed[:-1] | changed[1:])
            if len(renew):
                fresh = self.rank(symbols[renew], symbols[renew + 1])
                fresh[owner[renew] != owner[renew + 1]] = none
                rank[renew] = fresh
        return out


class Counter:
    """Token counts of texts; remembers the counts of short pre-tokens."""

    def __init__(self, path: str):
        import regex

        self.merges, self.seen = Merges(path), {}
        self.split = regex.compile(PATTERN)
        self.at_special = regex.compile("|".join(map(regex.escape, self.merges.special))).split if self.merges.special else None

    def _pretokens(self, texts: list[str], extra: list[int]):
        """(text, some of its pre-tokens) of all texts; special tokens' strings are counted in ``extra``."""
        for i, text in enumerate(texts):
            pieces = self.at_special(text) if self.at_special else [text]
            extra[i] += len(pieces) - 1
            for piece in pieces:
                if len(piece) <= WHOLE:
                    yield i, self.split.findall(piece)
                else:
                    found = (m[0] for m in self.split.finditer(piece))
                    while part := list(islice(found, HELD)):
                        yield i, part

    def __call__(self, texts: list[str]) -> list[int]:
        """A special token's string in a text is that one token; what lies between is counted by itself. Some
        ``HELD`` pre-tokens are in memory at a time, however long a text is."""
        out = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, part in self._pretokens(texts, out):
            held.append((i, part))
            size += len(part)
            if size >= HELD:
                self._add(held, out)
                held, size = [], 0
        self._add(held, out)
        return out

    def _add(self, held: list[tuple[int, list[str]]], out: list[int]) -> None:
        if len(self.seen) > REMEMBERED:
            self.seen = {}
        known = self.seen
        new = list({t for _, part in held for t in part} - known.keys())
        if new:
            known.update(zip(new, self.merges.count([t.encode() for t in new]).tolist(), strict=True))
        for i, part in held:
            out[i] += sum(map(known.__getitem__, part))
        for t in new:
            if len(t) > REMEMBERED_BYTES:
                del known[t]


def count_tokens(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Adds nothing to the texts and returns id, n_bytes, n_tokens, over_limit for each row.

    ``vocabulary`` is the path of a byte-level BPE file on every executor. Null and empty texts have 0 bytes
    and 0 tokens; a null id stays null; repeated rows are counted each; other columns are not read. One pass
    without a shuffle: lost tasks rerun by themselves.
    """

    def run(batches):
        counter = Counter(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0), raw(batch.column(1))
            n = [len(t or b"") for t in texts]
            tokens = counter([(t or b"").decode("utf-8", "replace") for t in texts])
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(tokens, pa.int64()), pa.array([t > limit for t in tokens], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
