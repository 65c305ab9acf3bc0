"""Whitening, divergence and piece encoding against brute force, on odd rows,
empty tables and the small test tables."""

import math
import os
import random
import re
import sys
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from ledgermatch.llm import divergence, pieces, registry, whitening  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(brute.rows(), brute.SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


# ------------------------------------------------------------------ 11 whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
                       + [T.StructField(c, T.StringType()) for c in ("x", "v", "id", "n", "i", "component")])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v) + tuple("zzzzzz") for i, v in rows], VECTORS)


def whitened(rows, top=16):
    """{(id, component)} values by exact fractions and one eigendecomposition."""
    rows = [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in rows]
    fit = [list(x) for x in {tuple(x) for _, x in rows}]
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    z = [[n * x[k] - s[k] for k in range(d)] for x in fit]
    cov = np.array([[float(Fraction(sum(a[i] * a[j] for a in z), n ** 3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:top], u[:, ::-1][:, :top]
    out = []
    for i, x in rows:
        c = [n * x[k] - s[k] for k in range(d)]
        w = (np.array(c, float) / n) @ u / np.sqrt(e)
        out.append((i, n, sum(t * t for t in c), w, e / np.trace(cov)))
    return out


def compare(got, want):
    found = defaultdict(list)
    for r in got:
        found[r["vec_id"], r["deviation"]].append(r)
    assert len(got) == sum(len(w[3]) for w in want)
    signs = {}
    for i, n, deviation, w, explained in want:
        rows = sorted((r for r in found[i, deviation]), key=lambda r: r["component"])
        rows = rows[::max(1, len(rows) // len(w))][:len(w)] if len(rows) != len(w) else rows
        for k, r in enumerate(rows):
            assert (r["component"], r["n"]) == (k + 1, n) and abs(r["explained"] - explained[k]) <= 1e-9 * explained[k]
            assert r["identity_error"] <= 1e-9
            signs.setdefault(k, math.copysign(1, r["whitened"]) * math.copysign(1, w[k]) if abs(w[k]) > 1e-6 else None)
            assert abs(r["whitened"] - (signs[k] or 1) * w[k]) <= 1e-6 * max(1, abs(w[k])) or signs[k] is None
            if signs[k] is None:
                del signs[k]


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in registry.table(spark, SF, "embeddings").collect()]
    compare(registry.op11_embedding_whitening(spark, SF).collect(), whitened(rows))


def test_whitening_of_odd_rows(spark):
    rnd = random.Random(4)
    good = [(k, [rnd.gauss(0, 1), rnd.gauss(0, 3), rnd.gauss(5, 0.1)]) for k in range(40)]
    good += [(100, good[0][1]), (None, good[1][1]), (7, [1e4, -4.0, 2.0])]
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 0.0, 0.0]), (204, []),
           (205, [1.0, 2.0]), (206, [1e300, 0.0, 0.0])]
    got = whitening.whiten(vectors(spark, good + bad)).collect()
    compare(got, whitened(good))
    assert len({r["identity_error"] for r in got}) == 1 and max(r["component"] for r in got) == 3


def test_deviation_beyond_a_long_is_null(spark):
    got = whitening.whiten(vectors(spark, [(1, [1e9, 1.0]), (2, [-1e9, 2.0]), (3, [0.0, 4.0]), (4, [0.0, 4.5])])).collect()
    want = {i: sum((4 * x - s) ** 2 for x, s in zip(v, (4 * 10**6, 736 + 4 * 10**6))) for i, v in
            ((i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in [(1, [1e9, 1.0]), (2, [-1e9, 2.0]), (3, [0.0, 4.0]), (4, [0.0, 4.5])])}
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: d if d < 1 << 63 else None for i, d in want.items()}


def test_whitening_without_components(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0     # one distinct vector
    got = whitening.whiten(vectors(spark, [(k, [float(k), 3.0, 2.0 * k]) for k in range(5)])).collect()
    assert {r["component"] for r in got} == {1} and all(abs(r["explained"] - 1) < 1e-9 for r in got)


@pytest.mark.parametrize("top", [100, 1 << 31, 1 << 45, 1 << 58, 1 << 80])
def test_square_sums_are_exact(top):
    rnd = random.Random(top)
    z = [[rnd.randrange(-top, top) for _ in range(5)] for _ in range(300)]
    a = np.array(z, np.int64 if top < 1 << 60 else object)
    assert list(whitening.square_sums(a, 0)) == [sum(r[k] ** 2 for r in z) for k in range(5)]
    assert list(whitening.square_sums(a, 1)) == [sum(x * x for x in r) for r in z]


# ------------------------------------------------------------------ 12 divergence

def divergences(docs, least=10, top=10):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows."""
    n, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for la, s, t in docs:
        la, s = la or "", s or ""
        words = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(t))
        groups[la].add(s)
        n[la, s].update(words)
        df[la].update(set(words))
    weight = lambda c, total, v: 1 + 10 ** 9 * (c + 2) // (total + 2 * v)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for la, sources in groups.items():
        kept = [t for t, c in df[la].items() if c >= least]
        v, total = len(kept), {s: sum(n[la, s][t] for t in kept) for s in sources}
        p = {s: {t: weight(n[la, s][t], total[s], v) for t in kept} for s in sources}
        q = {t: weight(sum(n[la, s][t] for s in sources), sum(total.values()), v) for t in kept}
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if n[la, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(la, s, part, i, x, k + 1) for k, (i, x) in enumerate(items)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence_of_odd_rows(odd, none):
    docs = [(r[2], r[3], r[1]) for r in brute.rows()]
    assert result(divergence.divergence(odd)) == divergences(docs)
    assert divergence.divergence(none).count() == 0


def test_divergence_query(spark):
    docs = [(r["lang"], r["source"], r["text"]) for r in registry.table(spark, SF, "documents").collect()]
    assert result(registry.op12_source_divergence(spark, SF)) == divergences(docs)


@pytest.mark.parametrize("tile, stripe, rows, cols", [(4, 16, 2, 4), (3, 1000, 1, 8), (256, 5, 8, 32)])
def test_divergence_with_small_quadrants(spark, monkeypatch, tile, stripe, rows, cols):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "STRIPE", stripe)
    monkeypatch.setattr(divergence, "LEAF_ROWS", rows)
    monkeypatch.setattr(divergence, "LEAF_COLS", cols)
    monkeypatch.setattr(divergence, "PIECE", 40)
    monkeypatch.setattr(divergence, "FLUSH", 30)
    monkeypatch.setattr(divergence, "LEAST_DOCS", 2)
    rnd = random.Random(stripe)
    docs = [(rnd.choice(["en", "de", None]), f"s{rnd.randrange(11)}", " ".join(f"T{chr(97 + int(rnd.paretovariate(0.7)) % 26)}é{chr(97 + rnd.randrange(3))}x"
                                                                            for _ in range(rnd.randrange(30)))) for _ in range(120)]
    docs += [("xx", "only", "word"), ("yy", "one", "aa bb"), ("yy", "two", None), ("yy", "three", "aa aa"), ("en", "s0", "q" * 200 + " " + "r" * 90)]
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert result(divergence.divergence(df)) == divergences(docs, least=2)


# ------------------------------------------------------------------ 13 pieces

def library():
    import public_tokenizers as P
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def model():
    import public_tokenizers as P

    return P.path("piece_bpe_32k.model")


def trips(docs):
    sp, out = library(), []
    for i, t in docs:
        ids = sp.encode(t or "", num_threads=1)
        out.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(sp.decode(ids))))
    return sorted(out, key=str)


def test_pieces_of_odd_rows(odd, none):
    got = pieces.digests(odd, model())
    assert sorted(map(tuple, got.collect()), key=str) == trips([(r[0], r[1]) for r in brute.rows()])
    assert pieces.digests(none, model()).count() == 0


def test_pieces_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in registry.table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, registry.op13_piece_round_trip(spark, SF).collect()), key=str) == trips(docs)


def test_pieces_equal_the_library_on_any_text():
    rnd, v, sp = random.Random(13), pieces.Vocabulary(model()), library()
    texts = ["", " ", "  ", "a", " a", "a ", "▁", "▁▁ x", "\0\r\n\t", "ab" * 3000, "a" * 4000, " " * 999, " " * 500 + "x", "x" + " " * 77 + "y  z", "-" * 999,
             "<s></s><unk><0x0A>", "中文字符测试" * 20, "한국어 العربية हिन्दी", "😀" * 9, "ﬁ①é é", "the" * 500, "=" * 64 + " " * 64 + "=" * 65]
    alphabets = ["ab ", "aeiou stn", "   ▁a", "abcdefghijklmnopqrstuvwxyz", "ABab01 .,-=", "\n\t a=-*#", " *=-/", "éàüß ①", "ssß sS"]
    texts += ["".join(rnd.choices(rnd.choice(alphabets), k=rnd.randrange(80))) for _ in range(1500)]
    ids, at = pieces.encode_texts(v, texts)
    for k, t in enumerate(texts):
        mine = ids[at[k]:at[k + 1]].tolist()
        assert mine == sp.encode(t, num_threads=1), t[:80]
        assert pieces.decode_ids(v, mine) == sp.decode(mine), t[:80]


def test_pieces_decode_any_ids(spark):
    rnd, v, sp = random.Random(5), pieces.Vocabulary(model()), library()
    for _ in range(500):
        ids = [rnd.choice([rnd.randrange(3, 259), rnd.randrange(259, 32000)]) for _ in range(rnd.randrange(12))]
        assert pieces.decode_ids(v, ids) == sp.decode(ids), ids
    coded = spark.createDataFrame([(1, None), (2, bytearray(b""))], "doc_id long, ids binary")
    assert [tuple(r) for r in pieces.decode(coded, model()).select("decoded", "ids_text").collect()] == [("", ""), ("", "")]


def test_pieces_columns_and_other_models(spark, odd, tmp_path):
    assert pieces.encode(odd, model()).columns == ["doc_id", "n_tokens", "ids"]
    from sentencepiece import sentencepiece_model_pb2 as f
    m = f.ModelProto()
    with open(model(), "rb") as x:
        m.ParseFromString(x.read())
    m.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        pieces.encode(odd.select(F.col("doc_id"), "text"), str(tmp_path / "other.model"))
