"""Line dedup, centroid clustering and phrase mining against brute force, and on odd input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from scripts_compare import normalise
from townpull.llm import centroids, line_dedup, phrases

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ("t1", "place", "gone", "line_gone", "line_text", "h", "h1", "n", "lines", "x", "cluster", "seen", "shard", "words", "a")


def docs_of(spark, rows, extra=False):
    """rows: (doc_id, text, lang)."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for c in CLASH if extra else ():
        df = df.withColumn(c, F.lit("q"))
    return df


@pytest.mark.parametrize("name,folder", [("op11_centroid_clustering", SF_SMALL), ("op11_centroid_clustering", SF_MID),
                                         ("op12_phrase_mining", SF_MID), ("op13_line_dedup", SF_SMALL), ("op13_line_dedup", SF_MID)])
def test_queries_equal_their_sql(spark, name, folder):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    got = normalise(E.queries()[name](spark, folder).toPandas())
    want = normalise(con.execute(E.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0 and (got.values == want.values).all()


# 13 line dedup

def slow_lines(rows, chars=1, documents=10):
    keys = [[x.strip(BLANK).translate(UP) for x in (t or "").split("\n")] for _, t, *_ in rows]
    held = defaultdict(set)
    for (d, *_), ks in zip(rows, keys):
        for k in ks:
            held[k].add(d)
    out = []
    for (d, t, *_), ks in zip(rows, keys):
        lines = (t or "").split("\n")
        rest = [x for x, k in zip(lines, ks) if len(k) < chars or len(held[k]) < documents]
        out.append((d, len(lines), len(lines) - len(rest), "\n".join(rest)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(5)
    pool = ["Accept all Cookies", "\tshare this\x0b", "é", "É", "a", "", "   ", "\x00", "x" * 3000, "漢字 😀", " menu"]
    rows = [(i, "\n".join(rng.choice([*pool, f"line {rng.randrange(400)}"]) + rng.choice(["", " ", "\r"])
                          for _ in range(rng.randint(1, 12))), "en") for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "\n\n", "en"), (103, "a\n" * 20000, "en"), (None, "a\nown", "en"),
             (None, "a\nown", "en"), (None, "share this", "en"), (5, "a\nunlike", "en"), (7, rows[7][1], "en")]
    return rows


@pytest.mark.parametrize("chars,documents", [(1, 10), (2, 3), (0, 10), (4, 1)])
def test_line_dedup(spark, chars, documents):
    rows = line_rows()
    got = line_dedup.line_dedup(docs_of(spark, rows, True), chars, documents).collect()
    want = [(d, n, gone, hashlib.sha256(rest.encode()).hexdigest()) for d, n, gone, rest in slow_lines(rows, chars, documents)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_line_dedup_by_shuffles(spark, monkeypatch):
    """What is too large to broadcast gives the same rows."""
    rows = line_rows()
    want = sorted(map(tuple, line_dedup.line_dedup(docs_of(spark, rows)).collect()), key=str)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, line_dedup.line_dedup(docs_of(spark, rows)).collect()), key=str) == want


def test_lines_are_taken_out(spark):
    rows = line_rows()
    df = docs_of(spark, rows, True)
    got = line_dedup.without_common_lines(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == \
        sorted((str(d), rest) for d, _, _, rest in slow_lines(rows))
    assert got.where("doc_id = 100 and text is null").count() == 1


def test_line_dedup_of_nothing(spark):
    assert line_dedup.line_dedup(docs_of(spark, [])).collect() == []
    assert line_dedup.line_dedup(docs_of(spark, [(1, None, None)])).collect()[0][1:3] == (1, 0)


# 11 centroid clustering

def slow_kmeans(rows, k=16, rounds=3, seed=1, dim=64, scale=64):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) and abs(x) <= (1 << 27) / scale for x in v):
            kept.append((vec_id, [int(np.floor(scale * float(x))) for x in v]))
    x = np.array([v for _, v in kept], np.int64)
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = np.array([v for _, v in first], np.int64)
    for t in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        if t < rounds:
            c = np.array([x[own == j].sum(axis=0) // (own == j).sum() if (own == j).any() else c[j] for j in range(len(c))])
    d = d[np.arange(len(x)), own]
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c.tolist()]
    return sorted(((i, int(j), int(s), int(d[own == j].sum()), int(d.sum()), digest[j]) for (i, _), j, s in zip(kept, own, d)), key=str)


def vectors_of(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    for c in CLASH:
        df = df.withColumn(c, F.lit("q"))
    return df


def odd_vectors():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(9, 64)) * 3
    rows = [(i, [float(np.float32(x)) for x in centre[i % 9] + rng.normal(size=64) * 0.3]) for i in range(700)]
    same = [0.5] * 64
    rows += [(1000 + i, same) for i in range(300)] + [(3, rows[3][1]), (3, same), (None, same), (None, rows[0][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 63 + [None]), (2004, [1.0] * 63 + [float("nan")]),
             (2005, [1.0] * 63 + [float("inf")]), (2006, [0.0] * 64), (2007, [-0.001] * 64), (2008, [3e30] + [0.0] * 63),
             (2009, [float(1 << 21)] * 64), (2010, [-float(1 << 21)] * 64)]
    return rows


@pytest.mark.parametrize("rounds,k,seed", [(3, 16, 1), (8, 12, 2), (0, 5, 1), (1, 3, 7)])
def test_centroid_clustering(spark, rounds, k, seed):
    rows = odd_vectors()
    got = centroids.clusters(vectors_of(spark, rows), k, rounds, seed)
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == slow_kmeans(rows, k, rounds, seed)


def test_bounds_spare_evaluations(spark):
    """With separated groups most vectors keep their centroid without any evaluation after the first round."""
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(8, 64)) * 20
    rows = [(i, (centre[i % 8] + rng.normal(size=64) * 0.2).tolist()) for i in range(800)]
    got = centroids.clusters(vectors_of(spark, rows, "double"), 8, 6)
    assert got.agg(F.sum("evaluated")).first()[0] < 0.5 * 800 * 8 * 7


def test_bounds_hold_against_the_full_scan():
    """Displacements since the last evaluation, over many rounds of wandering centroids."""
    rng = np.random.default_rng(3)
    x = rng.integers(-40, 40, (500, 6))
    own, seen, when = np.zeros(500, np.int32), np.zeros((500, 7)), np.full((500, 7), -1, np.int8)
    history = [rng.integers(-40, 40, (7, 6))]
    spared = 0
    for _ in range(40):
        own, seen, when, count = centroids.reassign(x, own, seen, when, history)
        d = ((x[:, None] - history[-1][None]) ** 2).sum(axis=2)
        assert (own == d.argmin(axis=1)).all()
        spared += int((count < 7).sum())
        history.append(history[-1] + rng.integers(-2, 3, (7, 6)))
    assert spared > 5000
    # there and back again: the displacement is nothing, though the drifts are not
    assert centroids.displacements([history[0], history[0] + 50, history[0]])[0].max() == 0


def test_fewer_vectors_than_centroids(spark):
    rows = [(i, [float(i)] * 64) for i in range(5)] + [(None, [2.2] * 64)]
    got = centroids.clusters(vectors_of(spark, rows))
    assert sorted(map(tuple, got.drop("evaluated").collect()), key=str) == slow_kmeans(rows)
    for none in ([], [(None, [1.0] * 64)], [(1, [1.0] * 3)]):
        assert centroids.clusters(vectors_of(spark, none)).collect() == []


# 12 phrase mining

def slow_phrases(rows, least, longest=4, keep=2000, cover=80):
    f, n, lang_of = Counter(), Counter(), {}
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UP)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    f = {k: v for k, v in f.items() if v >= least}
    gone = set()
    for (lang, p), a in f.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                if 100 * a >= cover * f[lang, p[i:i + size]]:
                    gone.add((lang, p[i:i + size]))
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) > 1 and (lang, p) not in gone:
            score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                 for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:keep], 1))


def phrase_rows(seed=2):
    rng = random.Random(seed)
    words = ["New", "york", "city", "the", "of", "é", "É", "漢", "a", "b c", "x\x1cy"]
    fixed = ["new York City hall", "of the", "a b a b a b", "the the the the the the"]
    rows = []
    for i in range(150):
        t = "".join(rng.choice([rng.choice(fixed), rng.choice(words), rng.choice(words)]) + rng.choice([" ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "! "])
                    for _ in range(rng.randint(0, 30)))
        rows.append((i, t, rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [(500, None, "en"), (501, "", None), (502, " \t ", "xx"), (None, "of the of the", "en"), (None, "of the of the", "en"),
                   (503, "z " * 20000, "long"), (7, "of the", "en"), (7, "of the", "en")]


@pytest.mark.parametrize("shards,bits,least", [(3, 25, 12), (2, 9, 4), (4, 25, 1000)])
def test_phrase_mining(spark, shards, bits, least):
    rows = phrase_rows()
    got = phrases.collocations(docs_of(spark, rows, True), least=least, shards=shards, bits=bits).collect()
    assert sorted(map(tuple, got)) == slow_phrases(rows, least)


def test_phrase_mining_by_shuffles_and_top(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BROADCAST_ROWS", 0)
    rows = phrase_rows(3)
    got = phrases.collocations(docs_of(spark, rows), least=5, keep=7, longest=3).collect()
    assert sorted(map(tuple, got)) == slow_phrases(rows, 5, longest=3, keep=7)


def test_phrase_scores_pass_64_bits(spark):
    """Counts as of a corpus far larger than any test."""
    from pyspark.sql.types import Row
    df = spark.createDataFrame([Row(a=1 << 58, l=1 << 59, r=1 << 60)])
    got = df.select(F.expr(phrases.SCORE).alias("s")).first()[0]
    assert got == 2000000 * (1 << 58) // ((1 << 59) + (1 << 60))


def test_lengths_are_counted_in_the_same_scans(spark):
    """Longer phrases are counted before the words' first cycle is over, each for one cycle."""
    dealt = phrases.deal_words(docs_of(spark, phrase_rows()), 4)
    log = []
    phrases.frequent(dealt, 4, least=5, log=log)
    assert any(step < 4 and 1 in n and 2 in n for step, _, n in log)
    assert any({2, 3} <= set(n) for _, _, n in log)
    assert [shard for _, shard, _ in log] == [i % 4 for i in range(len(log))] and len(log) <= 16


def test_phrases_of_nothing(spark):
    assert phrases.collocations(docs_of(spark, [])).collect() == []
    assert phrases.collocations(docs_of(spark, [(1, "a b c", "en")])).collect() == []
