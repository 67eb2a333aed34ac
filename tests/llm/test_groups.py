"""Fingerprints, substring dedup, near duplicates, components: against brute force, with odd rows."""

import hashlib
import random
import re
from collections import defaultdict
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from jurispark.llm import fingerprints as P
from jurispark.llm import ngram_join as N
from jurispark.llm import substrings as S
from jurispark.llm.components import components


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(160)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 90)))) for i in range(40)]
    for k in range(320):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(words)
        a = rng.randint(0, 20)
        docs.append((1000 + k, " ".join(w[a : a + rng.randint(45, 140)])))
    docs += [(-1, None), (-2, ""), (-3, " \n"), (-4, "a " * 49), (-5, "a " * 50), (-6, "A\n" * 51), (-7, "b a " * 40), (3000, "b a " * 40), (3001, docs[7][1]), (-8, "a b"), (3002, "A B"), (-9, "É x  Y"), (3003, "é X y")]
    return docs + [docs[5], docs[5], (docs[6][0], docs[7][1])]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns({c: F.lit("own") for c in ("id", "doc", "key", "n", "block", "h", "digest", "spans")})


def test_edited_fingerprints(spark):
    docs = corpus()
    found = P.edited_fingerprints(frame(spark, docs)).collect()
    assert len(found) == len(docs)
    order = sorted({(i, P.xxhash.xxh3_128_digest((t or "").encode()), t or "") for i, t in docs})
    after = {(i, h): order[(k + 1) % len(order)][2] for k, (i, h, _) in enumerate(order)}
    texts = defaultdict(list)
    for i, h, t in order:
        nxt = after[i, h]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        texts[i].append((len(t), hashlib.sha256(edited.encode()).hexdigest(), P.digest(P.canonical(t)), P.digest(P.canonical(edited)), float(P.canonical(t) == P.canonical(edited)), float(P.canonical(t) == P.canonical(nxt))))
    for r in found:
        assert tuple(r)[1:] in texts[r.doc_id]


def test_fingerprints_compare_bytes(spark, monkeypatch):
    df = frame(spark, [(1, "Ａ  b"), (2, "a B"), (None, None), (4, ""), (5, "c")])
    found = {r.doc_id: r.fingerprint for r in P.fingerprint(df).collect()}
    assert found[1] == found[2] and found[None] == found[4] != found[5]
    one = [{"digest": "x", "second": "1", "canon": b"a"}, {"digest": "x", "second": "2", "canon": b"b"}, {"digest": "y", "second": "3", "canon": b"c"}]
    rows = spark.createDataFrame(one, "digest string, second string, canon binary")
    named = P._named(rows, P._colliding(rows), {"fingerprint": ("digest", "second")})
    assert sorted(r.fingerprint for r in named.collect()) == ["x-1", "x-2", "y"]
    assert P.fingerprint(df.limit(0)).count() == 0 and P.edited_fingerprints(df.limit(0)).count() == 0
    assert P.edited_fingerprints(df.limit(1)).count() == 1


@pytest.mark.parametrize(("held", "patterns"), [(8192, 100), (300, 7), (1, 8192)])
def test_substrings(spark, held, patterns):
    """All anchors in one shard, some in parts, every one in parts: the same result."""
    docs = corpus()
    docs += [(5000 + i, "a " * (60 + i) + "b " * 55) for i in range(12)]  # one anchor all along
    check_substrings(spark, docs, held=held, patterns=patterns)


def test_substrings_with_an_anchor_in_thousands_of_texts(spark):
    """A passage that more than 4096 texts have, in two contexts, and a long repetitive text."""
    passage = [f"p{i}" for i in range(70)]
    docs = [(i, " ".join([f"a{i}", *passage, *([f"b{i}"] if i % 3 else ["tail", "x"] * 10)])) for i in range(4500)]
    docs += [(9000, "z " * 30_000), (9001, "y " + "z " * 20_000)]
    check_substrings(spark, docs)


def check_substrings(spark, docs, **options):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    first = {}
    for i, t in docs:
        w = words(t)
        for j in range(len(w) - 49):
            k = tuple(w[j : j + 50])
            first[k] = min(first.get(k, i), i)
    wanted = defaultdict(list)
    for i, t in docs:
        w = words(t)
        gone = {p for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i for p in range(j, j + 50)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        wanted[i].append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = S.dedup_substrings(frame(spark, [*docs, (None, docs[50][1])]), **options).collect()
    assert len(found) == len(docs) + 1
    for r in found:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256) in wanted[r.doc_id]
    assert sum(r.n_removed for r in found) > 10_000
    assert S.dedup_substrings(frame(spark, docs).limit(0)).count() == 0


def groups_of(docs):
    sets = defaultdict(set)
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i].add(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if any(s and t and 100 * len(s & t) >= 75 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("crowd,block,sparse", [(256, 128, 8), (10, 8, 64)])
def test_near_groups(spark, monkeypatch, crowd, block, sparse):
    monkeypatch.setattr(N, "CROWD", crowd)
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "SPARSE", sparse)
    docs = [d for d in corpus() if d[0] != 6]
    wanted = groups_of(docs)
    found = N.near_groups(frame(spark, docs)).collect()
    assert len(found) == len(docs)
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert len(set(wanted.values())) < len(wanted) - 50
    kept = N.keep_one(frame(spark, [*docs, (None, "a b")]))
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(set(wanted.values()))
    assert kept.where("doc_id IS NULL").count() == 1


@pytest.mark.parametrize("unique", [(14, 24), (10, 40)])
def test_near_groups_of_mostly_one_text(spark, monkeypatch, unique):
    """Documents that share most of their words, around the threshold: tokens that all have don't hide links."""
    monkeypatch.setattr(N, "CROWD", 10)
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "PARTNERS", 1)
    monkeypatch.setattr(N, "noise_of", lambda estimate: 4.0)
    rng = random.Random(unique[0])
    common = [f"c{i}" for i in range(90)]
    docs = []
    for i in range(150):
        k, cut = rng.randint(*unique), rng.randint(0, 25)
        docs.append((i, " ".join([*common[cut:], *(f"u{i}-{j}" for j in range(k))])))
    docs += [(1000 + i, " ".join([*t.split()[:-2], "x"])) for i, t in docs[:20]]
    wanted = groups_of(docs)
    assert {r.doc_id: r.component_id for r in N.near_groups(frame(spark, docs)).collect()} == wanted
    assert 1 < len(set(wanted.values())) < len(docs)


def test_sketch_of_much_text():
    """Frequent tokens stand out although all counters are crowded, and rare ones don't."""
    import numpy as np

    rng = np.random.default_rng(5)
    total = np.zeros(N.COUNTERS, np.int32)
    for _ in range(20):
        np.add.at(total, *N._cells(rng.integers(0, 1 << 63, 2_000_000).astype(np.uint64)))
    often = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    cell, sign = N._cells(often)
    np.add.at(total, cell, sign * 400)
    noise = N.noise_of(total.astype(np.float32))
    assert noise < 120 and (total[cell] * sign > noise).all()


def test_near_groups_of_nothing(spark):
    assert N.near_groups(frame(spark, corpus()).limit(0)).count() == 0
    alone = N.near_groups(frame(spark, [(1, None), (2, ""), (None, "x"), (3, "x")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in alone} == {(1, 0, 1), (2, 0, 2), (None, 1, 3), (3, 1, 3)}


def test_prefix_bound():
    import numpy as np

    rng = random.Random(1)
    estimate = np.array([rng.choice([0, 0, 5000]) for _ in range(N.COUNTERS)], np.uint32)
    for _ in range(300):
        a = {rng.randrange(1 << 63) for _ in range(rng.randint(4, 60))}
        b = set(rng.sample(sorted(a), max(1, int(len(a) * rng.uniform(0.75, 1))))) | {rng.randrange(1 << 63) for _ in range(rng.randint(0, 5))}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        if N.similar(x, y):
            (p, dp, _), (q, dq, _) = N.prefix(x, estimate, 100.0), N.prefix(y, estimate, 100.0)
            assert len(set(p.tolist()) & set(q.tolist())) >= min(dp, dq)


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(((F.col("id") * 37) % 61).alias("a"), (((F.col("id") + 1) * 37) % 61).alias("b"))
    assert {r.component for r in components(links).collect()} == {0}
    assert components(links.limit(0)).count() == 0


def test_ids_of_any_type(spark):
    """Ids that are texts stand in their order; results are those of numbers in the same order."""
    docs = [d for d in corpus() if d[0] is not None and d[0] != 6][:120] + [(None, "a b c")]
    name = lambda i: None if i is None else f"id{i + 5000:06d}"
    texts = spark.createDataFrame([(name(i), t) for i, t in docs], "doc_id string, text string")
    for work, ids in ((S.dedup_substrings, ["doc_id"]), (N.near_groups, ["doc_id", "component_id"]), (P.edited_fingerprints, ["doc_id"])):
        found, wanted = work(texts), work(frame(spark, docs))
        assert found.columns == wanted.columns
        said = lambda r, f: str({k: f(v) if k in ids else v for k, v in r.asDict().items()})
        assert sorted(said(r, str) for r in found.collect()) == sorted(said(r, lambda v: str(name(v))) for r in wanted.collect())


def test_scratch_tables_go_early(spark, monkeypatch):
    live, most, whole = set(), [], N.scratch

    @contextmanager
    def counted(session):
        with whole(session) as keep:

            def one(df):
                out = keep(df)
                live.add(id(out))
                most.append(len(live))
                return out

            def drop(*tables):
                live.difference_update(map(id, tables))
                keep.drop(*tables)

            one.drop = drop
            yield one

    monkeypatch.setattr(N, "scratch", counted)
    N.near_groups(frame(spark, corpus())).collect()
    assert len(most) > 10 and max(most) <= 8


def test_only_rows_in_question_move(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 9 + str(i)) for i in range(200)] + [(500, "a b c d e f g"), (501, "a b c d e f g"), (502, "x y z"), (502, "v w"), (None, "n"), (1, "a b c d e f g")], "doc_id long, text string")
    kept = N.keep_one(docs)
    rows = {(r.doc_id, r.text) for r in kept.collect()}
    assert (502, "v w") in rows and (502, "x y z") not in rows and (None, "n") in rows
    assert {d for d, _ in rows} == {*range(200), 502, None} and kept.count() == 202
    maybe = N._maybe(docs, F.col("doc_id"), N._filter(docs.where("doc_id IN (3, 502)"))).where("__maybe").collect()
    assert {3, 502} <= {r.doc_id for r in maybe} and len(maybe) < 50
