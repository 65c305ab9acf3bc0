"""The ten operators against brute force on odd rows, empty tables and the small test tables."""

import os
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from ledgermatch.llm import (bpe, chat, class_lm, exact_dedup, fingerprint, langid, mixing, near_dedup, registry,  # noqa: E402
                             secrets, substring_dedup)

SF = "/root/testdata/sf0.001"
by_text = lambda rows: sorted(rows, key=str)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(brute.rows(), brute.SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="module")
def pairs():
    return [(r[0], r[1]) for r in brute.rows()]


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"]) for r in registry.table(spark, SF, "documents").collect()]


# ------------------------------------------------------------------ 1 BPE

@pytest.mark.parametrize("chunk, overlap", [(32768, 1024), (64, 32), (400, 20)])
def test_bpe_matches_the_library_with_any_chunks(odd, pairs, chunk, overlap):
    ranks, pattern = registry.public_bpe()
    got = bpe.decode(bpe.encode(odd, ranks, pattern, chunk=chunk, overlap=overlap), ranks)
    got = got.select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("decoded", 256)).collect()
    assert by_text(map(tuple, got)) == by_text(brute.bpe(pairs))


def test_bpe_query_and_empty_table(spark, none, small):
    assert by_text(map(tuple, registry.op1_bpe_round_trip(spark, SF).collect())) == by_text(brute.bpe(small))
    assert bpe.digests(none, *registry.public_bpe()).count() == 0


# ------------------------------------------------------------------ 2 exact dedup

@pytest.mark.parametrize("hot", [100, 1])
def test_exact_groups(odd, none, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT_LEAST", hot)
    got = exact_dedup.exact_groups(odd).collect()
    groups = {}
    for r in brute.rows():
        groups.setdefault(brute.lower(r[1]), []).append(r[0])
    low = lambda x: -1 if x is None else x
    want = [(i, max(g, key=low), len(g), brute.sha(t)) for t, g in groups.items() for i in g]
    assert by_text((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == by_text(want)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and {r["text_sha256"] for r in kept} == {brute.sha(t) for t in groups}
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_dedup.exact_groups(none).count() == 0
    left = exact_dedup.exact_dedup(odd)
    assert left.columns == odd.columns and left.count() == len(groups)


# ------------------------------------------------------------------ 3 repeated substrings

@pytest.mark.parametrize("crowd", [100_000, 1])
def test_remove_repeats(odd, none, pairs, crowd):
    got = substring_dedup.remove_repeats(odd, crowd=crowd).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert by_text(map(tuple, got.collect())) == by_text(brute.removed(pairs))
    assert substring_dedup.remove_repeats(none).count() == 0


def test_remove_repeats_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup.Ranker.__init__, "__defaults__", (256, 50, 20))
    text = "".join(chr(97 + (i * i * 7 + i // 5) % 26) for i in range(3000))
    docs = [(1, text), (2, "zz" + text[40:900] + "!" + text[1000:2900]), (3, text[10:59]), (4, text[10:60]), (5, "ab" * 500), (6, "ba" * 300)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert by_text(map(tuple, got)) == by_text(brute.removed(docs))


def test_remove_repeats_query(spark, small):
    assert by_text(map(tuple, registry.op3_suffix_dedup(spark, SF).collect())) == by_text(brute.removed(small))


# ------------------------------------------------------------------ 4 chat

CHATS = [(1, 0, "user", "hi </s> there"), (1, 1, "assistant", "<s>[\\INST] a\\\\ [/INST]"), (2, 0, "assistant", None), (2, 0, "assistant", None),
         (3, None, "user", "b"), (3, 1, None, "c"), (3, 1, "tool x/1\n", "d"), (None, 0, "user", "é😀"), (4, 0, "user", ""),
         (5, 2, "assistant", "second"), (5, 1, "assistant", "first [\\\\\\INST]"), (6, 0, "user", "x" * 200000)]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    text = chat.render(df)
    back = {r["conv_id"]: r for r in chat.read_back(text).collect()}
    for c in {r[0] for r in CHATS}:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for i, t, r, x in CHATS if i == c))
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == [(r, x) for _, r, x in turns]
        for t in back[c]["turns"]:   # the spans lie where they are said to
            body = back[c]["formatted"][t["start"]: t["start"] + t["length"]]
            assert (body == t["text"]) or "\\" in body
    for d in chat.digests(df).collect():
        turns = sorted(((-1 if t is None else t, r or "", x or "") for i, t, r, x in CHATS if i == d["conv_id"]))
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (d["n_turns"], d["turns_sha256"], d["loss_chars"], d["loss_sha256"]) == (len(turns), brute.sha(said), len(loss), brute.sha(loss))
    assert chat.digests(df.limit(0)).count() == 0


def test_chat_escape_is_exact(spark):
    texts = ["", "<s>", "<\\s>", "<\\\\/s>", "[/INST]", "[\\/INST] [INST", "< s>", "a\\b", "<<s>>", "[[INST]]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.withColumn("u", chat.unescape(F.col("e"))).collect():
        assert r["u"] == r["t"] and "<s>" not in r["e"] and "[INST]" not in r["e"]


# ------------------------------------------------------------------ 5 mixing

def test_fit_budget_is_exact_where_it_can_be():
    import itertools

    for sizes, counts in (([2, 5, 9], [3, 2, 2]), ([7, 11], [2, 3]), ([1], [9]), ([0, 4], [5, 3])):
        sums = {sum(s * k for s, k in zip(sizes, ks)) for ks in itertools.product(*(range(c + 1) for c in counts))}
        for budget in range(sum(s * c for s, c in zip(sizes, counts)) + 3):
            take = mixing.fit_budget(sizes, counts, budget)
            got = sum(s * k for s, k in zip(sizes, take))
            assert all(0 <= k <= c for k, c in zip(take, counts))
            assert abs(got - budget) == min(abs(x - budget) for x in sums if x <= 2 * budget)
    # Many documents: the budget is met to the word.
    sizes, counts = list(range(20, 400, 7)), [5] * 55
    for budget in (1000, 12345, 33333):
        assert sum(s * k for s, k in zip(sizes, mixing.fit_budget(sizes, counts, budget))) == budget


def test_fit_budget_takes_very_long_documents():
    import itertools

    assert mixing.fit_budget([1000000], [1], 900000) == [1]
    assert mixing.fit_budget([1000000], [1], 400000) == [0]
    assert mixing.fit_budget([1000000], [3], 2900000) == [3]
    for sizes, counts in (([1000000], [3]), ([300000, 1000000], [1, 2]), ([2, 50000], [1, 2]), ([9000, 21000, 5000000], [2, 1, 1]), ([70000, 90000, 110000], [1, 1, 1])):
        sums = {sum(s * k for s, k in zip(sizes, ks)) for ks in itertools.product(*(range(c + 1) for c in counts))}
        for budget in range(1, max(sums), max(sums) // 37):
            take = mixing.fit_budget(sizes, counts, budget)
            got = sum(s * k for s, k in zip(sizes, take))
            assert all(0 <= k <= c for k, c in zip(take, counts))
            assert abs(got - budget) <= min(abs(x - budget) for x in sums), (sizes, counts, budget, take)


def _targets(sizes, cap=3):
    names = sorted((k for k in sizes if k is not None)) + [None] * (None in sizes)
    weight = {k: (1, 2, 3)[i % 3] for i, k in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        share = (total - sum(cap * sizes[k] for k in full)) / (sum(weight[k] for k in names if k not in full) or 1)
        above = {k for k in names if k not in full and share * weight[k] > cap * sizes[k]}
        if not above:
            return {k: cap * sizes[k] if k in full else share * weight[k] for k in names}
        full |= above


@pytest.mark.parametrize("block", [20000, 2])
def test_mix(odd, none, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    got = mixing.mix(odd).collect()
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for r in brute.rows():
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want = _targets(sizes)
    assert by_text((r["doc_id"], r["size"]) for r in got) == by_text((r[0], size(r[1])) for r in brute.rows())
    assert {round(r["target"], 6) for r in got} == {round(v, 6) for v in want.values()}
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"] for r in got)
    assert by_text(map(tuple, got)) == by_text(map(tuple, mixing.mix(odd).collect()))
    assert mixing.mix(none).count() == 0
    mixed = mixing.mixed(odd)
    want_rows = {}
    for r in got:
        want_rows[r["doc_id"], r["size"]] = want_rows.get((r["doc_id"], r["size"]), 0) + r["copies"]
    have = {}
    for r in mixed.collect():
        k = (r["doc_id"], size(r["text"]))
        have[k] = have.get(k, 0) + 1
    assert mixed.columns == odd.columns and have == {k: c for k, c in want_rows.items() if c}


def test_repeated_rows_share_their_copies_exactly(spark):
    rows = [(1, "a b c d", "s")] * 7 + [(None, "e f", "s")] * 5 + [(2, "g h i", "t"), (3, "k", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, have = {}, {}
    for r in mixing.mix(docs).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    for r in mixing.mixed(docs).collect():
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + 1
    assert have == {k: c for k, c in want.items() if c}


def test_mix_query_is_near_its_targets(spark):
    rows = registry.op5_source_mix(spark, SF).join(registry.table(spark, SF, "documents").select("doc_id", "source"), "doc_id")
    for r in rows.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k"), F.collect_list("size").alias("s")).collect():
        sums = {0}
        for s in r["s"]:
            sums |= {s + x for x in sums}
        rest = r["t"] - r["t"] // sum(r["s"]) * sum(r["s"])
        assert abs(r["t"] - r["k"]) <= 1 + min(abs(x - rest) for x in sums)


# ------------------------------------------------------------------ 6 LM scoring

def test_class_lm_base_is_exact(odd, none, pairs):
    got = class_lm.score(odd, vocab_size=20, core=8, n_classes=3).collect()
    want = by_text((i, h, n, k, total, round(b, 6)) for i, h, n, k, total, b in brute.base_scores(pairs))
    assert by_text((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert class_lm.score(none).count() == 0


def test_class_lm_beats_single_words(spark, small):
    got = registry.op6_class_lm(spark, SF).collect()
    want = {i: b for i, _, _, _, _, b in brute.base_scores(small)}
    assert all(abs(r["base_score"] - want[r["doc_id"]]) < 1e-6 * abs(want[r["doc_id"]]) for r in got)
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_exchange_finds_planted_classes():
    import numpy as np

    rng = np.random.default_rng(1)
    group = np.arange(30) % 3
    n = rng.poisson(20, (30, 30)) * (group[:, None] + 1 == (group[None, :] + 3 - 1) % 3 + 1) + rng.poisson(40, (30, 30)) * ((group[:, None] + 1) % 3 == group[None, :])
    classes = class_lm.exchange(n.astype(float), 3, sweeps=20)
    assert all(len(set(classes[group == g])) == 1 for g in range(3)) and len(set(classes)) == 3


def test_best_class_is_the_one_of_a_full_recount():
    import numpy as np

    rng = np.random.default_rng(4)
    k, words = 4, 25
    total = k + class_lm.SHAPES + 1
    cls = np.append(rng.integers(0, k, words), np.arange(k, total))
    n = rng.poisson(0.8, (len(cls), len(cls))).astype(float)

    def pair(c):
        out = np.zeros((total, total))
        np.add.at(out, (c[:, None], c[None, :]), n)
        return out

    for w in range(words):
        before, after = (np.bincount(cls, weights=x, minlength=total) for x in (n[:, w], n[w, :]))
        best = class_lm.best_class(pair(cls), k, int(cls[w]), before, after, n[w, w])
        tried = []
        for c in range(k):
            moved = cls.copy()
            moved[w] = c
            tried.append(class_lm.likelihood(pair(moved)))
        assert tried[best] >= max(tried) - 1e-6


def test_batch_sweeps_use_all_bigrams_and_raise_the_likelihood(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    groups = [[f"{g}{i}" for i in range(25)] for g in "abc"]
    # Each group follows the one before it; the most frequent words stand anywhere and tell nothing of it.
    texts = [" ".join(" ".join(["x", "y", "z"][i] for i in rng.integers(0, 3, rng.integers(0, 2))) + " " + groups[(s + j) % 3][int(rng.zipf(1.3)) % 25]
                      for j in range(40)) for s in rng.integers(0, 3, 150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def fitted(sweeps):
        model, encoded, _ = class_lm.fit_and_encode(docs, vocab_size=60, core=3, n_classes=3, sweeps=sweeps)
        learned = [r["text"] for r in docs.join(encoded.where("learned").select("id"), docs["doc_id"] == F.col("id")).collect()]
        return model, learned

    def value(model, learned):
        place = {int(h): p for h, p in zip(model.vocab.hashes.view(np.int64), model.vocab.place)}
        hasher = class_lm.WordHasher(spelled=True)
        total = model.n_classes + class_lm.SHAPES + 1
        pair = np.zeros((total, total))
        for t in learned:
            raw = np.frombuffer(t.encode(), np.uint8)
            h = hasher.words(raw, np.zeros(1, np.int64))[0]
            c = [model.classes[place[int(x)]] if int(x) in place else model.n_classes + int(y) for x, y in zip(h.view(np.int64), class_lm.rare_shape(h))]
            for a, b in zip([total - 1, *c], [*c, total - 1]):
                pair[a, b] += 1
        return class_lm.likelihood(pair)

    before, after = (value(*fitted(s)) for s in (0, 4))
    assert after > before + 50
    model, _ = fitted(4)
    assert len(model.classes) == 60 and set(model.classes) <= {0, 1, 2}


def test_enter_class_is_the_one_of_a_full_recount():
    import numpy as np

    rng = np.random.default_rng(5)
    k, words = 4, 30
    total = k + class_lm.SHAPES + 1
    shape = rng.integers(0, class_lm.SHAPES, words)
    now = np.where(rng.random(words) < 0.5, rng.integers(0, k, words), k + shape)
    x = rng.poisson(0.6, (words, total)).astype(float)
    x[:, 0] += 1
    fixed = rng.poisson(3, (total, total)).astype(float)

    def pair(c):
        out = fixed.copy()
        np.add.at(out.T, c, x)
        return out

    row, g = np.nonzero(x)
    got = class_lm.enter_class(pair(now), k, shape, now, x.sum(1), row, g, x[row, g])
    for w in range(words):
        tried = {}
        for c in [*range(k), k + int(shape[w])]:
            moved = now.copy()
            moved[w] = c
            tried[c] = class_lm.enter_likelihood(pair(moved))
        assert tried[int(got[w])] >= max(tried.values()) - 1e-6


def test_words_beyond_the_vocabulary_are_clustered_and_scores_follow_from_the_classes(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    groups = [[f"{g}{i}" for i in range(40)] for g in "abc"]
    # Each group follows the one before it; a few words of each are frequent, and only these are in the vocabulary.
    texts = [" ".join(groups[(s + j) % 3][int(40 * rng.random() ** 3)] for j in range(40)) for s in rng.integers(0, 3, 120)]
    texts += ["a0 Unseen1 unseen2 b0", "", None, "once", texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = dict(vocab_size=24, core=24, n_classes=3)
    model, _, rare = class_lm.fit_and_encode(docs, **sizes)
    k, end = model.n_classes, model.n_classes + class_lm.SHAPES
    rare = {r["h"]: (r["n"], r["c"]) for r in rare.collect()}
    hasher = class_lm.WordHasher(spelled=True)
    place = {int(h): p for h, p in zip(model.vocab.hashes.view(np.int64), model.vocab.place)}

    def hashes(t):
        return hasher.words(np.frombuffer((t or "").encode(), np.uint8), np.zeros(1, np.int64))[0] if t else np.zeros(0, np.uint64)

    import zlib
    learned = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    count = Counter(int(x) for t in learned for x in hashes(t).view(np.int64))
    assert {h: n for h, (n, _) in rare.items()} == {h: n for h, n in count.items() if h not in place}
    assert all(c == k + h % class_lm.SHAPES for h, (n, c) in rare.items() if n == 1)

    def tokens(t):
        """(class before, class, emission) of a text's tokens."""
        before, out = end, []
        for x in hashes(t).view(np.int64):
            x, s = int(x), int(x) % class_lm.SHAPES
            if x in place:
                c = before_next = int(model.classes[place[x]])
                p = count[x]
            else:
                p, c = rare.get(x, (0, k + s))
                p, before_next = p + class_lm.ADD_WORD, k + s
            out.append((before, c, p))
            before = before_next
        return [*out, (before, end, None)]

    pair, mass = np.full((end + 1, end + 1), class_lm.ADD_CLASS), np.zeros(end)
    for t in learned:
        for a, b, _ in tokens(t):
            pair[a, b] += 1
    for h, n in count.items():
        mass[int(model.classes[place[h]]) if h in place else rare[h][1]] += n + (0 if h in place else class_lm.ADD_WORD)
    mass[k:] += class_lm.ADD_WORD
    step = np.log10(pair / pair.sum(1, keepdims=True))
    got = {r["doc_id"]: r["score"] for r in class_lm.score(docs, **sizes).collect()}
    for i, t in enumerate(texts):
        want = sum(step[a, b] + (0 if p is None else np.log10(p / mass[b])) for a, b, p in tokens(t))
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want))

    # Most words of a group share a class, each group another one.
    of = [Counter(rare[int(h)][1] for h in hashes(" ".join(g)).view(np.int64) if int(h) in rare) for g in groups]
    assert all(max(c.values()) >= 0.9 * sum(c.values()) for c in of) and len({c.most_common(1)[0][0] for c in of}) == 3
    still = class_lm.score(docs, rare_turns=0, **sizes).agg(F.sum("score")).first()[0]
    assert sum(got.values()) > still + 100


# ------------------------------------------------------------------ 7 near dedup

@pytest.mark.parametrize("reach", [8, 1])
def test_near_groups(odd, none, pairs, monkeypatch, reach):
    monkeypatch.setattr(near_dedup, "REACH", reach)
    got = near_dedup.near_groups(odd).collect()
    want = brute.near(pairs)
    assert by_text((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_text(want)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert near_dedup.near_groups(none).count() == 0
    assert near_dedup.near_dedup(odd).columns == odd.columns


def test_near_groups_chain_and_crowd(spark):
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(400)]
    docs = [(i, " ".join(base[:i] + [word()] + base[i + 1:])) for i in range(60)]          # a crowd around one text
    chain = [word() for _ in range(300)]
    for k in range(12):                                                                    # each like the next only
        docs.append((1000 - k, " ".join(chain)))
        chain = chain[24:] + [word() for _ in range(24)]
    docs += [(2000 + k, " ".join(word() for _ in range(200))) for k in range(30)]          # clean ones
    got = near_dedup.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert by_text((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_text(brute.near(docs))


@pytest.mark.parametrize("block, shingles", [(1000, 1 << 20), (100, 1 << 20), (1000, 20000)])
def test_near_groups_in_a_template_crowd(spark, monkeypatch, block, shingles):
    import random

    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", shingles)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    template = [word() for _ in range(175)]
    docs = []
    for k in range(300):                          # all share the template: 0.77 alike
        text = template + [word() for _ in range(28)]
        docs.append((2 * k, " ".join(text)))
        if k < 40:                                # a planted partner, just above 0.8
            docs.append((2 * k + 1, " ".join(text[:182] + [word() for _ in range(21)])))
    want = brute.near(docs)
    assert sum(i != c for i, _, c in want) == 40
    got = near_dedup.near_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert by_text((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_text(want)


def test_near_groups_with_repeated_and_null_identifiers(spark):
    import random

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    a, b, c, d = ([word() for _ in range(200)] for _ in range(4))
    near = lambda t, k: " ".join(t[:k] + [word()] + t[k + 1:])
    docs = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a, 50)), (3, near(b, 70)), (3, near(b, 70)), (4, None), (4, ""), (None, " "),
            (None, " ".join(c)), (None, near(c, 20)), (None, near(c, 90)), (None, near(c, 90)), (None, near(d, 30)), (9, " ".join(d)), (None, near(a, 120))]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, place int").repartition(3)
    got = near_dedup.near_groups(df).collect()
    assert by_text((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_text(brute.near(docs))
    kept = near_dedup.near_dedup(df)
    assert kept.columns == df.columns
    left = {r["place"] for r in kept.collect()}
    assert {5, 6, 7} <= left and {0, 1, 13} <= left and len(left) == 7 and len(left & {8, 9, 10, 11}) == 1


def test_joined_blocks_count_exactly():
    import numpy as np

    rng = np.random.default_rng(3)
    one = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 500, 4000, 7000)]
    other = [np.unique(rng.integers(5000, 14000, n).astype(np.uint64)) for n in (3, 6000, 20)]
    want = [[len(np.intersect1d(x, y)) for y in other] for x in one]
    assert near_dedup.intersections(one, other).tolist() == want
    assert near_dedup.intersections(one[:1], [np.array([99999], np.uint64)]).tolist() == [[0]]


def test_near_query(spark, small):
    got = registry.op7_near_dedup(spark, SF).collect()
    assert by_text((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_text(brute.near(small))


# ------------------------------------------------------------------ 8 secrets

def test_secret_scan(odd, none, pairs):
    ranks, pattern = registry.public_bpe()
    got = secrets.scan(odd, ranks, pattern).collect()
    assert by_text((r["doc_id"], r["base"]) for r in got) == by_text((i, brute.secrets(t)) for i, t in pairs)
    assert secrets.scan(none, ranks, pattern).count() == 0


def test_secret_scan_cases(spark):
    ranks, pattern = registry.public_bpe()
    cases = {1: "secret:token:abcdefgh", 2: "Api_Key='abcdefghi' x", 3: "id 9f8e7d6c-1234-4abc-9def-0123456789ab ok",
             4: "key dGhpc0lzUmFuZG9tK2Jhc2U2NC9zdHJpbmc9Zz9qWx here", 5: "a_very_long_snake_case_name_here.of_words",
             6: "D41D8CD98F00B204E9800998ECF8427E", 7: "PASSWORD=" + "q" * 50000, 8: "A.A.A." * 2000 + "!"}
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.scan(docs, ranks, pattern).collect()}
    assert {i: r["base"] for i, r in got.items()} == {i: brute.secrets(t) for i, t in cases.items()}
    assert got[4]["n_random"] == 1 and got[4]["spans"].startswith("random:4:")
    assert all(got[i]["n_random"] == 0 for i in (1, 2, 3, 5, 6, 7, 8))


def test_secrets_inside_readable_runs(spark):
    import random

    rng = random.Random(3)
    ranks, pattern = registry.public_bpe()
    fronts = ("", "/home/service/config/production/credentials/", "//files.example.com/download/", "//storage.internal.example.com/backups/monthly/archive/",
              "production.database.connection.", "session_identifier_for_customer=", "customer-account-reference-")
    docs, want = [], {}
    for n in (24, 32, 40):
        for front in fronts:
            for back in ("", "/readme/contents.html"):
                for _ in range(10):
                    secret = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
                    want[len(docs)] = (4 + len(front), 4 + len(front) + n)
                    docs.append((len(docs), f"see {front}{secret}{back} there"))
    plain = ["https://files.example.com/download/documents/annual-report/contents.html", "/home/service/config/production/credentials/readme.txt",
             "//example.com/commit/D41D8CD98F00B204E9800998ECF8427E/readme", "//files.example.com/download/documents/objects/9f8e7d6c-1234-4abc-9def-0123456789ab/contents.html"]
    docs += [(len(docs) + k, t) for k, t in enumerate(plain)]
    got = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(docs, "doc_id long, text string"), ranks, pattern).collect()}
    hit = 0
    for i, (lo, hi) in want.items():
        spans = [tuple(map(int, x.split(":")[1:])) for x in got[i]["spans"].split(",") if x.startswith("random")]
        hit += any(s <= lo + 2 and e >= hi - 2 for s, e in spans)
    assert hit >= 0.99 * len(want), (hit, len(want))
    assert not any(got[i]["n_random"] for i, _ in docs[len(want):])


def test_secret_query(spark, small):
    got = registry.op8_secret_scan(spark, SF).collect()
    assert by_text((r["doc_id"], r["base_sha256"]) for r in got) == by_text((i, brute.sha(brute.secrets(t))) for i, t in small)


# ------------------------------------------------------------------ 9 fingerprints

def _edited(docs):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        yield i, t, t[: len(t) - cut] + nxt[:cut], nxt


def test_fingerprints(odd, none, pairs):
    got = fingerprint.edited_likeness(odd).collect()
    want = [(i, len(t), brute.sha(e), round(brute.likeness(t, e), 9), round(brute.likeness(t, n), 9)) for i, t, e, n in _edited(pairs)]
    assert by_text((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == by_text(want)
    same = [r["fingerprint"] for r in got if r["doc_id"] in (6, 8)]
    assert len(same) == 3 and len(set(same)) == 1
    assert fingerprint.edited_likeness(none).count() == 0
    assert fingerprint.edited_likeness(odd.where("doc_id = 17")).first()["near_next"] == 1.0


def test_fingerprints_of_long_texts_in_runs(spark):
    long_text = "\n".join(f"line {i} of the text" for i in range(3000))
    docs = [(2, long_text), (1, long_text[:40000] + "\nchanged\n" + long_text[40010:]), (0, "short")]
    got = {r["doc_id"]: r for r in fingerprint.edited_likeness(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert 0.5 < got[2]["near_next"] < 1.0 and got[1]["near_next"] == 0.0


def test_fingerprints_count_paragraphs_of_any_number(spark):
    docs = []
    for n in (31, 32, 33, 34, 64, 65, 100, 236, 3000):
        text = [f"line {i} of text {n}" for i in range(n)]
        docs += [(10 * n + 1, "\n".join(text)), (10 * n, "\n".join("changed" + x if i % 20 == 7 else x for i, x in enumerate(text)))]
    got = fingerprint.edited_likeness(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = [(i, round(brute.likeness(t, e), 9), round(brute.likeness(t, n), 9)) for i, t, e, n in _edited(docs)]
    assert by_text((r["doc_id"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == by_text(want)


def test_fingerprint_query(spark, small):
    got = {r["doc_id"]: r for r in registry.op9_fingerprint(spark, SF).collect()}
    for i, t, e, n in _edited(small):
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), brute.sha(e))
        assert abs(got[i]["near_edited"] - brute.likeness(t, e)) < 1e-9 and abs(got[i]["near_next"] - brute.likeness(t, n)) < 1e-9


# ------------------------------------------------------------------ 10 language ID

def test_language_id_held_out_accuracy(spark):
    rows = registry.op10_language_id(spark, "/root/testdata/sf0.01").join(
        registry.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_odd_rows(odd, none):
    got = langid.predict(odd, langid.fit(odd)).collect()
    unknown = {3, 4, 5, 13}
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in unknown) for r in got if r["doc_id"] is not None)
    assert {r["lang_pred"] for r in got} <= {"en", "fr", "de", "und"} and len(got) == len(brute.rows())
    assert langid.fit(none).labels == [] and langid.predict(none, langid.fit(none)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(none)).collect()} == {"und"}


def test_language_id_hashes_blocks_alike(monkeypatch):
    text = "Some text, with Ünicode 😀 and more of it. " * 20
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (langid.ngram_counts(text) == whole).all() and whole.sum() == 3 * len(text) - 3
