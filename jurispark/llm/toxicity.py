"""Toxicity: obfuscated words are decoded by a noisy channel, then the restored text is scored."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurispark.llm.common import cut, lean, raw

#: What a character may stand for besides itself. Fixed values.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "abcdefghijklmnopqrstuvwxyz"}
#: Letters of the language model; everything else is an edge of a word.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
#: Labelled rows of each class that the classifier is fitted on, at most.
SAMPLE = 4000
#: Lengths of word starts that are features, and letters of the shortest known word that is looked for inside a run.
STARTS, INSIDE = (4, 5, 6), 4
#: Twice the log-likelihood that a feature must gain: rare ones that fit by chance stay out.
GAIN = 16.0
#: Look-alikes and invisible characters. Fixed values.
FOLD = {**dict(zip(map(ord, "авеіјкмнорстухѕԁԛԝ"), "abeijkmhopctyxsdqw", strict=True)), **dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])}

_S = "".join(map(re.escape, LEET))
_L = r"[^\W\d_]"
_SYMBOLS, _LETTERS = frozenset(LEET), frozenset(LETTERS)
#: Stretches of the model's letters and of symbols, stretches of letters, a letter three times. Each is found in one go
#: over a text: no pattern here can try a stretch from more than one place.
MIXED = re.compile(rf"[{LETTERS}{_S}]+")
PLAIN = re.compile(rf"[{LETTERS}]+")
TRIPLE = re.compile(r"(.)\1\1", re.S)
RUNS = re.compile(r"(.)\1*", re.S)
SPACED = re.compile(rf"(?<![^\W_])(?:(?:{_L}|[{_S}])[ ._*-]){{2,}}(?:{_L}|[{_S}])(?![^\W_])")
SUSPECT = re.compile(rf"{_L}[{_S}]|[{_S}]{_L}|({_L})\1\1|(?<![^\W_])\w[ ._*-]\w[ ._*-]\w(?![^\W_])")
WORD = re.compile(rf"{_L}+")
APART = re.compile(rb"(?<!\S)(?:[\x21-\x7e]|[\xc3-\xd1][\x80-\xbf]) (?:[\x21-\x7e]|[\xc3-\xd1][\x80-\xbf]) (?:[\x21-\x7e]|[\xc3-\xd1][\x80-\xbf])(?!\S)")
SYMBOLS = len(LETTERS) + 1
#: The score of what can't be.
NEVER = -(1 << 60)
_CODES = np.zeros(0x250, np.uint8)
_CODES[[ord(c) for c in LETTERS]] = np.arange(1, SYMBOLS)


def count_trigrams(docs: DataFrame, text_col: str) -> np.ndarray:
    """Counts of letter trigrams over every text; as many rows as trigrams exist reach the driver."""

    def run(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            texts, size = [], 0
            for t in [*raw(batch.column(0)), None]:
                texts.append(t or b"")
                size += len(texts[-1])
                if size > 1_000_000 or t is None:
                    code = np.frombuffer(b"\n".join(texts).decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), np.uint32)
                    s = np.where(code < len(_CODES), _CODES[np.minimum(code, len(_CODES) - 1)], 0).astype(np.int32)
                    if len(s) > 2:
                        total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
                    texts, size = [], 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["gram", "n"])

    out = np.zeros(SYMBOLS**3, np.int64)
    for r in docs.select(text_col).mapInArrow(lean(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r.gram] = r.n
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


class Decoder:
    """Viterbi decoding of a word's lattice under the trigram model."""

    def __init__(self, counts: np.ndarray):
        smooth = counts + 0.5
        self.log = np.log(smooth / smooth.sum(2, keepdims=True)).astype(np.float32)
        share = counts / max(1, counts.sum())
        self.reward = -float((share * self.log).sum()) if counts.sum() else 3.0  # mean cost of a letter: long readings are not punished
        self.code = {c: i + 1 for i, c in enumerate(LETTERS)}
        self.read: dict = {}
        self.costs = (self.log + self.reward).tolist()
        self.whole = np.rint((self.log + self.reward) * 4096).astype(np.int64)
        self.behind = 2 * int(self.whole.max() - self.whole.min()) + 1

    def __call__(self, word: str, apart: bool = False) -> str:
        """The likeliest reading. Each run of one character is a stage: a symbol stands for its letters, a run
        of two or more for the letter once or twice. Two stars are a vowel here, more are noise; ``masked`` reads
        them star by star. With ``apart`` a word may end between any two stages, and the reading has spaces there.

        Where all paths have met, what lies before is settled, so a long word takes time in proportion.
        """
        done: list[str] = []
        paths: dict = {(0, 0): (0.0, None)}
        for place, run in enumerate(RUNS.finditer(word)):
            c, n = run[1], len(run[0])
            letters = LEET.get(c, "") if c in LEET else c
            options = [a * k for a in letters for k in ((1,) if n == 1 else (1, 2))]
            if c == "*" and n > 1:
                options = [*"aeiou"] if n == 2 else [""]
            if apart and place:
                options += [" " + o for o in options]
            ahead: dict = {}
            for (a, b), (score, node) in paths.items():
                for option in options:
                    x, y, s = a, b, score
                    for letter in option:
                        z = self.code.get(letter, 0)
                        s += self.costs[x][y][z]
                        x, y = y, z
                    if (x, y) not in ahead or ahead[x, y][0] < s:
                        ahead[x, y] = (s, (node, option))
            paths = ahead
            if len(paths) == 1:
                ((state, (score, node)),) = paths.items()
                done += self._text(node)
                paths = {state: (0.0, None)}
        best = max(paths.items(), key=lambda p: p[1][0] + self.costs[p[0][0]][p[0][1]][0])
        return "".join([*done, *self._text(best[1][1])])

    @staticmethod
    def _text(node) -> list[str]:
        out = []
        while node:
            node, option = node
            out.append(option)
        return out[::-1]

    def likelihood(self, word: str) -> float:
        s = [0, 0, *(self.code.get(c, 0) for c in word), 0]
        return sum(float(self.log[x, y, z]) + self.reward for x, y, z in zip(s, s[1:], s[2:], strict=False))

    def _step(self, score: np.ndarray, letters: dict[int, str], optional: bool) -> np.ndarray:
        """The best score of each pair of last letters after a stage."""
        ahead = score.copy() if optional else np.full_like(score, NEVER)
        some = score > NEVER
        a, b, at = np.flatnonzero(some.any(1)), np.flatnonzero(some.any(0)), [*letters]
        if len(at) == 26 and at == [*range(at[0], at[0] + 26)]:  # any letter
            a, b, at = (slice(x.min(), x.max() + 1) for x in (a, b, np.array(at)))
            ahead[b, at] = np.maximum(ahead[b, at], (score[a, b][:, :, None] + self.whole[a, b, at]).max(0))
        else:
            here = np.ix_(b, at)
            ahead[here] = np.maximum(ahead[here], (score[np.ix_(a, b)][:, :, None] + self.whole[np.ix_(a, b, at)]).max(0))
        # a cost depends on two letters, so what is behind by two costs' range can never come first
        return np.where(ahead >= ahead.max() - self.behind, ahead, NEVER)

    def _back(self, scores, t: int, stage, a: int, b: int):
        """The letter that a stage gave on the best way to (a, b), and where that way came from."""
        letters, optional = stage
        if optional and scores[t][a, b] == scores[t + 1][a, b]:
            return "", a, b
        return letters[b], int((scores[t][:, a] + self.whole[:, a, b]).argmax()), a

    def masked(self, word: str, gaps: bool) -> str:
        """The likeliest reading in which each star is a stage of its own: one letter, or with ``gaps`` a letter or
        nothing.

        Costs depend on two letters, so behind two plain ones nothing of what came before counts. What lies
        between such places is read by itself, and short stretches are remembered.
        """
        runs = [(m[1], len(m[0])) for m in RUNS.finditer(word)]
        plain = [n == 1 and c not in LEET for c, n in runs]
        out, a, b, i = [], 0, 0, 0
        while i < len(runs):
            if plain[i]:
                out.append(runs[i][0])
                a, b, i = b, self.code.get(runs[i][0], 0), i + 1
                continue
            j = i + 3
            while j < len(runs) and not (plain[j - 2] and plain[j - 1]):
                j += 1
            part = "".join(c * n for c, n in runs[i:j])
            key = (a, b, part, gaps, j >= len(runs))
            reading = self.read.get(key)
            if reading is None:
                reading = self._stretch(part, gaps, a, b, j >= len(runs))
                if len(part) <= 32:
                    if len(self.read) > 100_000:
                        self.read.clear()
                    self.read[key] = reading
            out.append(reading)
            if j < len(runs):
                a, b = self.code.get(runs[j - 2][0], 0), self.code.get(runs[j - 1][0], 0)
            i = j
        return "".join(out)

    def _stretch(self, word: str, gaps: bool, a: int, b: int, ends: bool) -> str:
        """The best way on from the letters a, b, to a word's end if it ends here.

        Costs are whole numbers of 1/4096, so in a long run of stars the scores, taken from the best one, come round
        again, and the way through is that of one round, over and over. Scores are kept for every 256th stage and
        worked out again on the way back.
        """
        score = np.full((SYMBOLS, SYMBOLS), NEVER, np.int64)
        score[a, b] = 0
        stages, kept, last, rounds = [], [], [], {}

        def add(stage):
            nonlocal score, last
            if len(stages) % 256 == 0:
                kept.append(score)
                last = [score]
            stages.append(stage)
            score = self._step(score, *stage)
            last.append(score)

        for run in RUNS.finditer(word):
            c, n = run[1], len(run[0])
            letters = {self.code.get(a, 0): a for a in LEET.get(c, c)}
            if c != "*":
                for stage in [(letters, False), (letters, True)][: min(n, 2)]:
                    add(stage)
                continue
            # Brent's search for a round: scores are held against those of a mark, which moves on in doubling steps
            mark, since, limit, left = None, 0, 1, n
            while left:
                add((letters, gaps))
                left -= 1
                if n < 64 or limit == 0:
                    continue
                since += 1
                form = np.where(score > NEVER, score - score.max(), 1)
                if mark is not None and np.array_equal(form, mark[0]):
                    way = [mark[1]]
                    for _ in range(since):
                        way.append(self._step(way[-1], letters, gaps))
                    rounds[len(stages)] = (way, left // since)
                    left, limit = left % since, 0
                elif mark is None or since == limit:
                    mark, since, limit = (form, score), 0, 2 * limit
        final = np.where(score > NEVER, score + self.whole[:, :, 0] * ends, NEVER)
        a, b = map(int, np.unravel_index(int(final.argmax()), score.shape))
        out = []
        for block in range(len(kept) - 1, -1, -1):
            here = stages[block * 256 : block * 256 + 256]
            scores = last if block == len(kept) - 1 else [kept[block]]
            for stage in here[len(scores) - 1 :]:
                scores.append(self._step(scores[-1], *stage))
            for t in range(len(here) - 1, -1, -1):
                if (at := block * 256 + t + 1) in rounds:
                    way, times = rounds[at]
                    known: dict = {}
                    for u in [*range(len(way) - 2, -1, -1)] * times:
                        if (u, a, b) not in known:
                            known[u, a, b] = self._back(way, u, here[t], a, b)
                        letter, a, b = known[u, a, b]
                        out.append(letter)
                letter, a, b = self._back(scores, t, here[t], a, b)
                out.append(letter)
        return "".join(reversed(out))


class Reader:
    """Restored words of a text: its plain words, and readings of those that look obfuscated.

    Words are read one by one and by kind, so that each is decoded once; only letters apart need the whole text.
    """

    def __init__(self, counts: np.ndarray, known=()):
        self.decode = Decoder(counts)
        self.known = sorted(n for n in known if not n.endswith("-"))
        self.words, self.starts = frozenset(self.known), frozenset(n[:-1] for n in known if n.endswith("-"))
        self.lengths = sorted({len(n) for n in self.known if len(n) >= INSIDE})
        self.longest = max(map(len, self.known), default=0)

    def fitting(self, word: str) -> set[str]:
        """Of the classifier's words that fit a word with stars, the likeliest: one with a letter for each star or,
        if there is none, with fewer."""
        runs = [(m[1], len(m[0])) for m in RUNS.finditer(word)]
        if sum(c != "*" for c, _ in runs) > self.longest:
            return set()
        start = "".join(c for c, _ in takewhile(lambda run: run[1] == 1 and run[0] not in LEET, runs))
        words = self.known[bisect_left(self.known, start) : bisect_left(self.known, start + chr(0x10FFFF))]
        for least in ("", "0,") if words else ():
            parts = (f"[a-z]{{{least}{n}}}" if c == "*" else f"[{re.escape(c + LEET.get(c, ''))}]{{1,{min(n, 2)}}}" for c, n in runs)
            fit = [*filter(re.compile("".join(parts)).fullmatch, words)]
            if fit:
                return {max(fit, key=lambda w: (self.decode.likelihood(w), w))}
        return set()

    def readings(self, word: str) -> set[str]:
        """The likeliest reading, and the same with every letter once. Runs of stars beside other characters may be
        noise, a letter for each star, or fewer letters; all three are read, and what the classifier knows."""
        found = {self.decode(word)}
        if "*" in word and word.strip("*"):
            found |= self.fitting(word)
        if "**" in word and word.strip("*"):
            found |= {self.decode(word.replace("*", "")), self.decode.masked(word, False), self.decode.masked(word, True)}
        return found | {re.sub(r"(.)\1+", r"\1", best) for best in found}

    def inside(self, letters: str) -> set[str]:
        """All of the classifier's words, and starts of words, that stand anywhere in a run of letters."""
        out = set()
        for i in range(len(letters)):
            out.update(w for n in self.lengths if (w := letters[i : i + n]) in self.words)
            out.update(letters[i : i + n + 1] for n in STARTS if letters[i : i + n] in self.starts)
        return out

    def spaced(self, text: str) -> set[str]:
        """Readings of letters apart: the whole run, its likeliest words, and what the classifier knows in it."""
        out = set()
        for m in SPACED.finditer(text):
            letters = m[0][::2]
            out.update(self.decode(letters, True).split())
            for reading in self.readings(letters):
                out.add(reading)
                out |= self.inside(reading)
        return out

    def piece(self, piece: bytes) -> set[str]:
        """Words of a stretch without white space."""
        text = piece.decode("utf-8", "replace")
        if not text.isascii():
            text = fold(text)
        words = set(WORD.findall(text))
        if SUSPECT.search(text):
            for m in MIXED.finditer(text):
                found = m[0].strip("!")
                if found not in words and not _SYMBOLS.isdisjoint(found) and not _LETTERS.isdisjoint(found):
                    words |= self.readings(found)
            for m in PLAIN.finditer(text):
                if TRIPLE.search(m[0]):
                    words |= self.readings(m[0])
            words |= self.spaced(text)
        return words

    def apart(self, text: bytes) -> set[str]:
        """Words of letters that spaces keep apart."""
        return self.spaced(fold(text.decode("utf-8", "replace"))) if APART.search(text) else set()

    def __call__(self, text: bytes | None) -> set[str]:
        text = (text or b"").lower()
        return self.apart(text).union(*map(self.piece, set(text.split())))


def fold(text: str) -> str:
    """Compatible forms, small letters, then look-alikes as Latin letters."""
    return unicodedata.normalize("NFKC", text).lower().translate(FOLD)


def features(word: str) -> tuple[str, ...]:
    return (word, *(f"{word[:n]}-" for n in STARTS if len(word) > n))


class Model:
    """Logistic regression on the presence of words and word starts."""

    def __init__(self, names: list[str]):
        self.names, self.weights, self.bias = {n: i for i, n in enumerate(names)}, np.zeros(len(names)), 0.0
        self.known: dict[str, tuple[int, ...]] = {}

    def ids(self, words) -> tuple[int, ...]:
        return tuple({self.names[f] for w in words for f in features(w) if f in self.names})

    def found(self, text: bytes | None, read: Reader) -> set[int]:
        """The features of a text. What a stretch of it holds is remembered, within bounds."""
        if len(self.known) > 250_000:
            self.known.clear()
        text = (text or b"").lower()
        known, out = self.known, set(self.ids(read.apart(text)))
        for piece in set(text.split()):
            ids = known.get(piece)
            if ids is None:
                ids = self.ids(read.piece(piece))
                if len(piece) <= 64:
                    known[piece] = ids
            if ids:
                out.update(ids)
        return out

    def fit(self, rows: list[list[int]], labels: np.ndarray, prior: float, steps: int = 400, decay: float = 1e-4) -> None:
        """Full-batch Adam; afterwards the bias moves from the sample's share of toxic rows to ``prior``."""
        at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        of = np.array([i for r in rows for i in r], np.int64)
        w = np.zeros(len(self.names) + 1)
        mean, square = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1):
            z = w[-1] + np.bincount(at, w[of], len(rows))
            error = (1 / (1 + np.exp(-z)) - labels) / len(rows)
            grad = np.r_[np.bincount(of, error[at], len(self.names)) + decay * w[:-1], error.sum()]
            mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
            w -= 0.05 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
        share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        odds = lambda p: math.log(p / (1 - p))
        self.weights, self.bias = w[:-1], float(w[-1]) + odds(min(max(prior, 1e-3), 1 - 1e-3)) - odds(share)

    def score(self, text: bytes | None, read: Reader) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.bias + float(sum(self.weights[i] for i in sorted(self.found(text, read))))))))


def held_out(id_col):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, Model]:
    """The language model's counts, over all of docs, and the classifier.

    The classifier sees at most ``sample`` rows of each class, those with the least hash of their id; a document
    with several labels counts as toxic if one is 1. Only these rows' ids are broadcast. Without both
    classes all scores are the share of toxic rows, or 0 without labels.
    """
    counts = count_trigrams(docs, text_col)
    usable = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("__label"))
    totals = {r["__label"]: r["count"] for r in usable.groupBy("__label").count().collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    classes = [usable.where(F.col("__label") == k).orderBy(F.xxhash64(id_col), id_col).limit(sample) for k in (0, 1)]
    rows = cut(docs.select(id_col, text_col).join(F.broadcast(classes[0].unionByName(classes[1])), id_col).select(text_col, "__label"))

    def tally(batches):
        read, seen = Reader(counts), (Counter(), Counter())
        for batch in batches:
            for t, y in zip(raw(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                seen[y].update({f for w in read(t) for f in features(w)})
        names = [*(seen[0] | seen[1])]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([seen[k][n] for n in names], pa.int64()) for k in (0, 1))], names=["name", "n0", "n1"])

    sizes = {r["__label"]: r["count"] for r in rows.groupBy("__label").count().collect()}
    total = [sizes.get(k, 0) for k in (0, 1)]
    # gain: how much likelier the counts are with a rate for each class than with one rate
    rate = (F.col("n0") + F.col("n1")) / max(1, sum(total))
    gain = sum((2 * F.when(seen > 0, seen * F.log(seen / (n * share))).otherwise(0.0) for n, c in zip(total, ("n0", "n1"), strict=True) if n for seen, share in ((F.col(c), rate), (F.lit(n) - F.col(c), 1 - rate))), F.lit(0.0))
    best = rows.mapInArrow(lean(tally), "name string, n0 long, n1 long").groupBy("name").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).withColumn("gain", gain).where(F.col("gain") >= GAIN)
    model = Model(sorted(r.name for r in best.select("name").collect()))  # words of the sample that gain enough

    def present(batches):
        read = Reader(counts, model.names)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(model.found(t, read)) for t in raw(batch.column(0))], pa.list_(pa.int64())), batch.column(1).cast(pa.int64())], names=["found", "label"])

    seen = sorted(((r.found, r.label) for r in rows.mapInArrow(lean(present), "found array<long>, label long").collect()), key=lambda r: (r[1], r[0]))  # at most 2 * sample rows
    model.known = {}
    y = np.array([label for _, label in seen], float)
    if 0 < y.sum() < len(y):
        model.fit([f for f, _ in seen], y, prior)
    else:
        model.bias = math.log(max(prior, 1e-9) / max(1 - prior, 1e-9))
    return counts, model


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from 0.5) to every row.

    Words with leetspeak, letters spaced out or repeated, look-alike and invisible characters are decoded by
    Viterbi search under a letter-trigram model of all texts, with any letter for each star, and
    by the classifier's own words that fit the stars; restored words and word starts are then scored by
    a logistic regression learnt from labels outside the held-out fifth. Only the text enters a score.

    Every pattern takes time in proportion to a text, also where it has no spaces. Null and empty texts get the score of a text without words; null ids are scored like others; repeated rows
    get equal scores; columns that clash with the added ones are replaced.
    """
    docs = docs.drop("score", "predicted")
    counts, model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, sample=sample)
    at = docs.columns.index(text_col)

    def run(batches):
        read = Reader(counts, model.names)
        for batch in batches:
            scores = [model.score(t, read) for t in raw(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=[*batch.schema.names, "score", "predicted"])
        model.known.clear()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{fields}, score double, predicted int")
