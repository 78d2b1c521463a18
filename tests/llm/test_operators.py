"""Each operator against a brute-force version, on odd rows and on the small given tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import (
    bpe, chat, exact_dedup, lm_scoring, minhash_dedup, quality_rules, queries, sharding, source_mixing, suffix_dedup,
    token_counts,
)
from footfall.llm.tables import table, tokenizer_path
from tests.conftest import SF
from tests.llm.conftest import PROSE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def given(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["odd", "given"])
def source(request, spark, odd):
    return odd if request.param == "odd" else table(spark, SF, "documents")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# -- 1 -------------------------------------------------------------------------


def test_exact_dedup(spark, source):
    groups = defaultdict(list)
    for i, t in given(source):
        groups[t].append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, sha(t)) for i in ids]
    got = rows(exact_dedup.dedup(source, exact_dedup.open_index(spark)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=repr)


def test_index_remembers_earlier_batches(spark, docs, tmp_path):
    path = f"{tmp_path}/index"
    exact_dedup.dedup(docs((1, "a"), (2, "b")), exact_dedup.DigestIndex(spark, path, 4))
    again = exact_dedup.DigestIndex(spark, path, 4)  # as another session opens it
    for _ in range(2):  # a batch that runs twice gives the same
        got = rows(exact_dedup.dedup(docs((7, "a"), (8, "c"), (9, "c")), again), "doc_id", "keep_id", "kept")
        assert got == [(7, 1, False), (8, 9, False), (9, 9, True)]
    assert again.rows().count() == 3


def test_index_join_reads_buckets(spark, docs, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"{tmp_path}/plan", 4)
    fresh = docs((1, "a")).selectExpr("unhex(sha2(text, 256)) AS digest", "doc_id AS keep_id")
    plan = fresh.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan


# -- 2 -------------------------------------------------------------------------


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(pairs, percent):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(sets)):
        members[find(i)].append(pairs[i][0])
    out = []
    for i, (doc, _) in enumerate(pairs):
        label = min((x for x in members[find(i)] if x is not None), default=None)
        out.append((doc, len(sets[i]), label, label is None or doc == label))
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(source, percent):
    got = rows(minhash_dedup.near_duplicates(source, percent), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_components(given(source), percent)


@pytest.mark.parametrize("nodes, edges", [(30, 20), (400, 380), (0, 0)])
def test_components_of_random_graphs(spark, nodes, edges):
    import random

    from footfall.llm.components import components

    rng, parent = random.Random(nodes), {}
    pairs = [(rng.randrange(-nodes, nodes), rng.randrange(-nodes, nodes)) for _ in range(edges)]
    pairs += [(i, i + 1) for i in range(1000, 1000 + edges // 10)]  # a chain

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(pairs, "u BIGINT, v BIGINT")).collect()
    assert sorted((r.node, r.label) for r in got) == sorted((x, find(x)) for x in parent)


def test_repeated_and_very_large_ids(docs):
    tail = PROSE + " tail"
    unique = " ".join(f"u{i}" for i in range(30))
    big = 1 << 62
    given_rows = [(3, tail), (5, unique), (5, PROSE), (big + 5, "q " * 9 + unique[:40]), (big + 6, "q " * 9 + unique[:40]), (None, PROSE), (None, "z y x w v u"), (None, "z y x w v u")]
    got = rows(minhash_dedup.near_duplicates(docs(*given_rows), 80), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_components(given_rows, 80)
    kept = rows(minhash_dedup.keep_one_of_each(docs(*given_rows)), "doc_id", "text")
    assert kept == sorted([(3, tail), (5, unique), (big + 5, given_rows[3][1]), (None, "z y x w v u")], key=repr)


def test_one_of_equal_rows_stays(spark, docs):
    given_rows = [(5, "same text"), (5, "same text"), (None, "q"), (None, "q"), (6, "other"), (4, "same text"), (None, None), (7, "")]
    kept = rows(exact_dedup.keep_first_copies(docs(*given_rows), exact_dedup.open_index(spark)), "doc_id", "text")
    assert kept == sorted([(5, "same text"), (None, "q"), (6, "other"), (7, "")], key=repr)


def test_chain_of_near_duplicates_is_one_component(docs):
    words = [f"w{i}" for i in range(300)]
    chain = []
    for k in range(12):  # neighbours differ in few words, the ends in many
        changed = words.copy()
        for j in range(k * 4):
            changed[(j * 37) % 300] = f"z{j}"
        chain.append((100 - k, " ".join(changed)))
    df = docs(*chain, (500, " ".join(f"other{i}" for i in range(300))))
    got = rows(minhash_dedup.near_duplicates(df, 85), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_components(chain + [(500, " ".join(f"other{i}" for i in range(300)))], 85)


def test_links_that_bypass_the_first_centre(docs):
    base = [f"w{i}" for i in range(300)]

    def changed(words, places, mark):
        out = words.copy()
        for k in places:
            out[k] = f"{mark}{k}"
        return out

    some = [(1, " ".join(base))]
    for g in range(6):  # each pair is close to itself, and only fairly close to the first
        own = changed(base, [(g * 5 + k * 37) % 300 for k in range(8)], f"g{g}x")
        some += [(10 + g, " ".join(own)), (20 + g, " ".join(changed(own, [3 + g], "y")))]
    want = brute_components(some, 85)
    assert len({r[2] for r in want}) == 7
    assert rows(minhash_dedup.near_duplicates(docs(*some), 85), "doc_id", "n_shingles", "component_id", "kept") == want


def test_bands_that_need_several_rounds_of_centres(docs):
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    some = [(1, " ".join(base))]
    for g in range(40):  # alike enough to share bands, too different to link; the copies do link
        own = base.copy()
        for k in rng.sample(range(200), 5):
            own[k] = f"g{g}x{k}"
        some.append((100 + g, " ".join(own)))
        own[rng.randrange(200)] = "y"
        some.append((200 + g, " ".join(own)))
    want = brute_components(some, 85)
    assert len({r[2] for r in want}) > minhash_dedup.FIRST
    assert rows(minhash_dedup.near_duplicates(docs(*some), 85), "doc_id", "n_shingles", "component_id", "kept") == want


def test_bitmaps_rule_out_no_link():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 40, 128, 3000):
        common = rng.integers(0, 2**64, n, dtype=np.uint64)
        a = np.unique(np.concatenate([common, rng.integers(0, 2**64, n // 8, dtype=np.uint64)]))
        b = np.unique(common[n // 10 :])
        x, y = minhash_dedup._bitmaps([a, b])
        apart = sum((int(i) ^ int(j) & (1 << 64) - 1).bit_count() for i, j in zip(x.view(np.uint64), y.view(np.uint64)))
        differ = len(np.setxor1d(a, b))
        assert apart <= differ and (n > 128 or 2 * apart >= differ)


def test_near_dedup_of_an_unlinked_group_takes_few_jobs(spark, docs):
    import random

    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    some = []
    for g in range(150):  # share bands, but no two are linked
        own = base.copy()
        for k in rng.sample(range(200), 5):
            own[k] = f"g{g}x{k}"
        some.append((g, " ".join(own)))
    runs, write = [], minhash_dedup.hand_over
    try:
        minhash_dedup.hand_over = lambda df, label, by=None: (runs.append(label), write(df, label, by))[1]
        got = rows(minhash_dedup.near_duplicates(docs(*some), 85), "doc_id", "n_shingles", "component_id", "kept")
    finally:
        minhash_dedup.hand_over = write
    assert got == brute_components(some, 85)
    assert len(runs) <= 18  # 21 with centres by 8, 64, 512


def test_near_dedup_compares_small_bands_at_once(spark, docs):
    import random

    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    some = []
    for g in range(90):  # most pairs are nearly but not quite alike, each has a link
        own = base.copy()
        for k in rng.sample(range(200), 4):
            own[k] = f"g{g}x{k}"
        some += [(g, " ".join(own)), (200 + g, " ".join(own[1:]))]
    runs, write = [], minhash_dedup.hand_over
    try:
        minhash_dedup.hand_over = lambda df, label, by=None: (runs.append(label), write(df, label, by))[1]
        got = rows(minhash_dedup.near_duplicates(docs(*some), 85), "doc_id", "n_shingles", "component_id", "kept")
    finally:
        minhash_dedup.hand_over = write
    assert got == brute_components(some, 85)
    assert len(runs) <= 12  # 17 without


@pytest.mark.parametrize("words, changed", [(200, 5), (60, 2)])
def test_rounds_of_centres_find_the_same_components(docs, monkeypatch, words, changed):
    import random

    rng = random.Random(words)
    base = [f"w{i}" for i in range(words)]
    some = [(1, " ".join(base)), (2, " ".join(base))]
    for g in range(45):
        own = base.copy()
        for k in rng.sample(range(words), changed):
            own[k] = f"g{g % 9}x{k}"
        some += [(100 + g, " ".join(own)), (200 + g, " ".join([*own[:-1], "y"]))]
    for name in ("AT_ONCE", "EACH"):
        monkeypatch.setattr(minhash_dedup, name, 0)
    monkeypatch.setattr(minhash_dedup, "FIRST", 4)
    got = rows(minhash_dedup.near_duplicates(docs(*some), 85), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_components(some, 85)


def test_lone_shingles_rule_out_no_link(spark):
    import random

    rng = random.Random(2)
    sets = {k: sorted({rng.randrange(40) if rng.random() < 0.8 else rng.randrange(10**6) for _ in range(rng.randrange(1, 30))}) for k in range(60)}
    sets[60], sets[61] = list(range(100, 120)), list(range(101, 121))
    able = minhash_dedup._linkable(spark.createDataFrame(list(sets.items()), "node BIGINT, shingles ARRAY<BIGINT>"), 85).collect()
    able = {r.node: (r.n, r.own) for r in able}
    counts = Counter(x for s in sets.values() for x in s)
    for k, s in sets.items():
        own = sum(counts[x] == 1 for x in s)
        assert able.get(k) == ((len(s), own) if 100 * (len(s) - own) >= 85 * len(s) else None)
    assert able[60] == (20, 1) and 0 < len(able) < len(sets)


# -- 3, 8 ----------------------------------------------------------------------


def test_token_counts(spark, source):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    cache = token_counts.open_cache(spark)
    want = []
    for i, t in given(source):
        n = len(library.encode(t, add_special_tokens=False).ids)
        want.append((i, len(t.encode()), n, n > 1024))
    for _ in range(2):  # the second time from the cache
        got = rows(token_counts.count_tokens(source, cache), "doc_id", "n_bytes", "n_tokens", "over_limit")
        assert got == sorted(want, key=repr)
    version = token_counts.tokenizer_digest(tokenizer_path("byte_bpe_50k.json"))
    assert cache.rows(version).count() == len({t for _, t in given(source)})
    assert cache.rows("another").count() == 0


def test_bpe_round_trip(source):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = []
    for i, t in given(source):
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert rows(bpe.round_trip(source), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_bpe_forgets_words_without_harm(monkeypatch):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    for text in ["a few words here", "other words, a few more of them", "<|endoftext|>a few<|endoftext|>", "", "x" * 900] * 3:
        want = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == want
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False)
        assert len(codec.known.older) <= 40


def test_bpe_holds_few_words_however_long_the_text(monkeypatch):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    text = " ".join(f"word{i}" for i in range(2_000))
    want = library.encode(text, add_special_tokens=False).ids
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    assert codec.encode(text) == want
    codes = list(codec.known.values())
    assert all(type(code) is str for code in codes)  # not several objects for each word
    for name, most in (("KNOWN_WORDS", 50), ("KNOWN_CHARS", 300)):
        monkeypatch.setattr(bpe, name, most)
        codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
        assert codec.encode(text) == want
        assert len(codec.known) + len(codec.known.older) <= 100
        monkeypatch.undo()


def test_bpe_takes_ids_apart_some_at_a_time(monkeypatch):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    monkeypatch.setattr(bpe, "AT_ONCE", 2)
    for text in ["", "a", "<|endoftext|>", "ä\U0001f600 some more words\n\n here<|endoftext|><|endoftext|>end "]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.text(codec.pieces(text)) == library.decode(ids, skip_special_tokens=False)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_ids_come_back_as_text(odd):
    back = bpe.decode(bpe.encode(odd))
    assert rows(back, "doc_id", "text") == sorted(given(odd), key=repr)


# -- 4 -------------------------------------------------------------------------


def test_scores_by_hand():
    import numpy as np

    rng = np.random.default_rng(1)
    net = lm_scoring.unpack(lm_scoring.initial(rng.integers(0, 50, lm_scoring.SIZE).astype(float)))
    ids = rng.integers(0, lm_scoring.SIZE, 40)
    flat, place = lm_scoring.padded(ids, np.array([0, 25, 25, 40]))
    got = lm_scoring.log_probs(net, flat, place)
    for text in (range(25), range(25, 40)):
        for i in text:
            h = net["hidden"].copy()
            for k, off in enumerate(lm_scoring.PLACES):
                j = i + off
                h = h + net["embed"][ids[j] if j in text else lm_scoring.SIZE] * net["place"][k]
            h = np.tanh(h)
            c, w = divmod(int(ids[i]), lm_scoring.IN_CLASS)
            a = h @ net["class_w"] + net["class_b"]
            b = h @ net["word_w"][c] + net["word_b"][c]
            want = a[c] - np.log(np.exp(a).sum()) + b[w] - np.log(np.exp(b).sum())
            assert abs(got[i] - want) < 1e-4


def test_gradients_by_differences():
    import numpy as np

    rng = np.random.default_rng(2)
    flat_net = lm_scoring.initial(rng.integers(0, 50, lm_scoring.SIZE).astype(float)).astype(np.float64)
    net = lm_scoring.unpack(flat_net)
    flat, place = lm_scoring.padded(rng.integers(0, lm_scoring.SIZE, 30), np.array([0, 30]))
    g = lm_scoring.gradients(net, flat, place)
    for name in lm_scoring.SHAPES:
        at = np.unravel_index(int(np.abs(g[name]).argmax()), g[name].shape)
        value, step = net[name][at], 1e-5
        loss = []
        for d in (step, -step):
            net[name][at] = value + d
            loss.append(-lm_scoring.log_probs(net, flat, place).mean())
        net[name][at] = value
        assert abs((loss[0] - loss[1]) / (2 * step) - g[name][at]) < 1e-4, name


def test_training_learns_from_both_sides(spark, docs):
    # the middle word follows from its neighbours only
    import numpy as np

    rng = np.random.default_rng(3)
    texts = []
    for i in range(300):
        words = []
        for _ in range(40):
            a, b = rng.integers(0, 2, 2)
            words += [f"l{a}", f"m{a}{b}", f"r{b}", "."]
        texts.append((i, " ".join(words)))
    scored = lm_scoring.score(docs(*texts), rounds=2).agg({"mean_log_prob": "avg"}).first()[0]
    unigram = -(2 * 0.25 * np.log(8) + 0.25 * np.log(16) + 0.25 * np.log(4))
    assert scored > unigram * 0.8


def test_numbers_of_one_row_repeated_are_gapless_and_spread(spark):
    from footfall.llm.tables import numbered

    same = spark.range(100_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'x' AS g", "id % 3 AS h")
    plain = numbered(same, "n", ["doc_id", "g"])
    assert plain.agg({"n": "min"}).first()[0] == 0 and plain.agg({"n": "max"}).first()[0] == 99_999
    assert plain.select("n").distinct().count() == 100_000
    assert "SinglePartition" not in plain._jdf.queryExecution().executedPlan().toString()
    inner = numbered(same.withColumn("h", F.when(F.col("h") > 0, F.col("h"))), "n", ["doc_id", "g"], ["h"])
    found = inner.groupBy("h").agg(F.max("n").alias("top"), F.countDistinct("n").alias("n")).collect()
    assert len(found) == 3 and all(r.top + 1 == r.n for r in found)


def test_scores_do_not_hang_on_partitions(spark):
    docs = table(spark, SF, "documents")
    one, many = (rows(lm_scoring.score(docs.repartition(n)), "doc_id", "log_likelihood") for n in (1, 16))
    assert [r[0] for r in one] == [r[0] for r in many]
    assert max(abs(a[1] - b[1]) / max(1, abs(a[1])) for a, b in zip(one, many)) < 1e-4


def test_scores_of_odd_rows(odd):
    got = {(r.doc_id, r.n_tokens): r for r in lm_scoring.score(odd).collect()}
    assert got[1, 0].log_likelihood == 0 and got[1, 0].mean_log_prob is None
    assert lm_scoring.score(odd).count() == odd.count()


def test_words_of_one_bucket_have_their_own_probability(docs):
    import numpy as np

    from footfall.llm.shingles import words

    names = [f"rare{i}" for i in range(200)]
    data = " ".join(names).encode()
    digests, _ = words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    buckets = digests % np.uint64(lm_scoring.BUCKETS)
    common, once = np.array(names)[buckets == buckets[0]][:2]
    frequent = [(i, " ".join(f"w{i * 32 + k}" for k in range(32) for _ in range(60))) for i in range(30)]
    # the same bucket in the same surroundings: the words' counts alone tell the texts apart
    asked = [(100, f"w1 w2 {common} w3 w4"), (101, f"w1 w2 {once} w3 w4"), (102, " ".join([common] * 39))]
    got = {r.doc_id: r for r in lm_scoring.score(docs(*frequent, *asked)).collect()}
    assert abs(got[100].log_likelihood - got[101].log_likelihood - np.log(40)) < 1e-3
    assert abs(got[100].mean_log_prob * 5 - got[100].log_likelihood) < 1e-4


# -- 5 -------------------------------------------------------------------------


def test_mixing_meets_targets(spark):
    weights = {"clean": 0.8, "low_quality": 0.15, "toxic": 0.05}
    plan = source_mixing.mix(table(spark, SF, "documents"), table(spark, SF, "labels"), weights).collect()
    assert len(plan) == table(spark, SF, "documents").count()
    tokens = sum(r.n_tokens for r in plan)
    for k, share in weights.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{k}"] for r in plan) / tokens - share) < 5e-3
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in plan)
    assert all(abs(r.p_clean + r.p_low_quality + r.p_toxic - 1) < 1e-6 for r in plan)


def test_classifier_on_held_out_labels(spark):
    where = "/root/testdata/sf0.01"
    docs, labels = table(spark, where, "documents"), table(spark, where, "labels")
    model = source_mixing.fit(docs, labels.where("doc_id % 4 <> 0"))
    scored = {r.doc_id: r for r in source_mixing.posteriors(docs, model).collect()}
    held = labels.where("doc_id % 4 = 0").collect()
    right = 0
    for r in held:
        domain = "toxic" if r.toxic else "clean" if r.quality else "low_quality"
        right += max(source_mixing.DOMAINS, key=lambda k: scored[r.doc_id][f"p_{k}"]) == domain
    assert right / len(held) > 0.9


def test_mixing_odd_rows_and_no_labels(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (5, None, 1)], "doc_id BIGINT, quality INT, toxic INT")
    for some in (labels, labels.limit(0)):
        plan = source_mixing.mix(odd, some).collect()
        assert len(plan) == odd.count()
        assert all(abs(r.p_clean - 1) < 1e-6 for r in plan)


def test_missed_share_of_the_softmax():
    import numpy as np

    x = np.random.default_rng(5).normal(0, 3, (7, 5)).astype(np.float32)
    at = np.arange(7) % 5
    soft = np.exp(x) / np.exp(x).sum(1, keepdims=True)
    want = (soft - np.eye(5)[at]) / 7
    assert np.allclose(lm_scoring._missed(x.copy(), at, np.float32(1 / 7)), want, atol=1e-6)
    assert np.allclose(lm_scoring._log_softmax(x, at), np.log(soft[np.arange(7), at]), atol=1e-5)


# -- 6 -------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [3, 8])
def test_sharding(source, shards):
    pairs = given(source)
    got = sharding.assign(source, shards).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(pairs)
    assert max(sizes.values()) - min(sizes.get(t, 0) for t in range(shards)) <= 1
    for t in range(shards):
        assert sorted(r.slot for r in got if r.shard == t) == list(range(sizes.get(t, 0)))
    want = sorted((repr(i), len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in pairs)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == want


def test_groups_stay_together_and_large_ones_fill_shards(docs):
    groups = [(g * 10 + i, f"text {g}") for g in range(12) for i in range(5)]
    got = sharding.assign(docs(*groups, *[(1000 + i, f"single {i}") for i in range(60)])).collect()
    shards = defaultdict(set)
    for r in got:
        if r.doc_id < 1000:
            shards[r.doc_id // 10].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 2
    hot = sharding.assign(docs(*[(i, "same") for i in range(50)], *[(100 + i, f"x{i}") for i in range(30)])).collect()
    cells = Counter(r.shard for r in hot if r.doc_id < 100)
    assert sorted(cells.values(), reverse=True)[:5] == [10] * 5


def test_full_shards_swap_members(docs):
    import numpy as np

    def cut(rows):
        shards = defaultdict(set)
        got = sharding.assign(docs(*rows)).collect()
        sizes = Counter(r.shard for r in got)
        assert max(sizes.values()) - min(sizes.values()) <= 1
        for r in got:
            shards[r.doc_id // 2].add(r.shard)
        return sum(len(s) > 1 for s in shards.values())

    pairs = [(i, f"text {i // 2}") for i in range(800)]
    assert cut(pairs) <= 8  # no row without a copy, so no place is ever free
    assert cut([*pairs, *[(1000 + 2 * i, f"single {i}") for i in range(24)]]) <= 8
    # a cycle of three and a free place; the wish back to the full shard stays
    wished = np.array([[0, 5, 0], [0, 0, 4], [3, 0, 0]])
    assert sharding._admitted(wished, [0, 0, 0]).tolist() == [[0, 3, 0], [0, 0, 3], [3, 0, 0]]
    assert sharding._admitted(wished, [0, 0, 9]).tolist() == [[0, 4, 0], [0, 0, 4], [3, 0, 0]]


# -- 7 -------------------------------------------------------------------------


def brute_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts(source):
    want = [(i, *brute_counts(t)) for i, t in given(source)]
    got = quality_rules.judge(source, min_rows=20)
    assert rows(got, "doc_id", *quality_rules.STATISTICS, "base_failed") == sorted(want, key=repr)
    assert got.where("base_failed AND kept").count() == 0


def test_estimate_withstands_outliers(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    good = rng.multivariate_normal(np.arange(5.0), np.diag([4.0, 1, 1, 2, 1]) + 0.5, 900)
    bad = rng.normal(40, 1, (200, 5))
    data = [("a", *map(float, x)) for x in np.concatenate([good, bad])] + [("b", *map(float, x)) for x in good[:50]]
    vectors = spark.createDataFrame(data, ["stratum", *quality_rules.NAMES])
    found = {r.stratum: r for r in quality_rules.mcd(vectors, 0.75, 10, 1e-3).collect()}
    assert set(found) == {"a", "b"}
    assert max(abs(found["a"][f"mu_{i}"] - good[:, i].mean()) for i in range(5)) < 0.3
    # the distance agrees with a solved system
    mu = np.array([found["a"][f"mu_{i}"] for i in range(5)])
    factor = np.zeros((5, 5))
    for i in range(5):
        for j in range(i + 1):
            factor[i, j] = found["a"][f"f_{i}_{j}"]
    one = spark.createDataFrame([data[0]], ["stratum", *quality_rules.NAMES])
    estimate = quality_rules.mcd(vectors, 0.75, 10, 1e-3)
    got = quality_rules._distance(one, estimate).first().d2
    d = np.array(data[0][1:]) - mu
    assert abs(got - d @ np.linalg.solve(factor @ factor.T, d)) < 1e-6


def _mcd_by_numpy(x):
    """Distances by the same starts and steps, with exact order statistics in place of histograms."""
    import numpy as np

    n, p = x.shape
    h = min(n, (n + p + 1) // 2)
    floors = np.array(list(quality_rules.FLOORS.values()))
    low, middle, high = (np.quantile(x, q, axis=0, method="inverted_cdf") for q in (0.25, 0.5, 0.75))
    spread = np.maximum((high - low) / 1.349, floors)

    def estimate(some, share):
        cov = np.cov(some.T, bias=True) * quality_rules.consistency(share) + np.diag(floors**2)
        return some.mean(axis=0), cov, np.linalg.slogdet(cov)[1]

    def squared(mu, cov):
        return np.einsum("ij,ij->i", x - mu, np.linalg.solve(cov, (x - mu).T).T)

    def step(d2):
        return estimate(x[np.argsort(d2, kind="stable")[:h]], 0.5)

    found = []
    for centre, scale in ((middle, floors), (middle, spread), (low, spread), (high, spread)):
        now = step((((x - centre) / scale) ** 2).sum(axis=1))
        while (after := step(squared(*now[:2])))[2] < now[2] - 1e-9:
            now = after
        found.append(now)
    best = min(found, key=lambda e: e[2])
    near = x[squared(*best[:2]) <= quality_rules.NEAR]
    return squared(*estimate(near, quality_rules.NEAR_SHARE)[:2])


def test_estimate_equals_numpy_with_nearly_half_of_junk(spark):
    import numpy as np

    rng = np.random.default_rng(11)
    groups = {}
    for name, good, bad, at in (("clean", 1000, 0, 6), ("third", 700, 300, 6), ("half", 550, 450, 6), ("below", 550, 450, -6), ("few", 40, 3, 9)):
        mix = rng.normal(0, 1, (5, 5)) * 0.3 + np.eye(5)
        junk = rng.normal(at, 0.5, (bad, 5)) * 1.5
        groups[name] = np.concatenate([rng.normal(0, 1, (good, 5)) @ mix, junk]), good
    data = [(k, i, *map(float, row)) for k, (x, _) in groups.items() for i, row in enumerate(x)]
    vectors = spark.createDataFrame(data, ["stratum", "i", *quality_rules.NAMES])
    got = {k: {} for k in groups}
    for r in quality_rules._distance(vectors, quality_rules.mcd(vectors)).collect():
        got[r.stratum][r.i] = r.d2
    for k, (x, good) in groups.items():
        d2, want = np.array([got[k][i] for i in range(len(x))]), _mcd_by_numpy(x)
        assert (d2[good:] > quality_rules.CUTOFF).all(), k  # all junk goes
        assert (d2[:good] > quality_rules.CUTOFF).sum() <= max(1, 0.02 * good), k
        clear = np.abs(want / quality_rules.CUTOFF - 1) > 0.15  # histogram cells move distances a little
        assert ((d2 > quality_rules.CUTOFF) == (want > quality_rules.CUTOFF))[clear].all(), k


def test_a_source_with_much_junk_loses_it(docs):
    import random

    rng = random.Random(8)
    word = lambda k: "".join(rng.choices("abcdefghijklmnop", k=k))
    good = [(2 * i, "\n".join(" ".join(word(5) for _ in range(6)) for _ in range(20))) for i in range(165)]
    junk = [(2 * i, " ".join(word(12) + " # %" for _ in range(60))) for i in range(1000, 1135)]
    kept = {r.doc_id for r in quality_rules.judge(docs(*good, *junk)).where("kept").collect()}
    assert kept == {i for i, _ in good}


def test_junk_goes_and_clean_stays(spark):
    where = "/root/testdata/sf0.01"
    got = quality_rules.judge(table(spark, where, "documents")).join(table(spark, where, "labels"), "doc_id").collect()
    clean = [r for r in got if r.quality == 1 and not r.base_failed]
    junk = [r for r in got if r.quality == 0]
    assert all(r.kept for r in clean) and not any(r.kept for r in junk)


def test_duplicate_lines_repeats_and_symbols_reject(docs):
    import random

    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    line = lambda n: " ".join(word() for _ in range(n))
    clean = [(2 * i, "\n".join(line(6) for _ in range(20))) for i in range(150)]
    # 19 of 20 lines are one word again, so no three words repeat often; a half of the words repeats
    same = (1000, line(101) + "\nfoo" * 19)
    passage = line(29)
    half = (1002, f"{passage}\n{line(62)}\n{passage}")
    symbols = (1004, "\n".join(line(6) for _ in range(20)) + " #" * 10)
    got = {r.doc_id: r for r in quality_rules.judge(docs(*clean, same, half, symbols)).collect()}
    assert not any(got[i].base_failed or got[i].kept for i in (1000, 1002, 1004))
    assert all(got[i].kept for i, _ in clean)
    # where a group has none, either share alone goes past the cutoff
    for name, reach in (("x_lines", 1), ("x_repeats", 0.5)):
        assert reach / quality_rules.FLOORS[name] ** 2 > quality_rules.CUTOFF
    assert abs(quality_rules.CUTOFF - 20.515) < 1e-3 and abs(quality_rules.consistency(0.75) - 1.4) < 0.05


def test_no_labelled_clean_row_is_lost(spark):
    where = "/root/testdata/sf0.1"
    got = quality_rules.judge(table(spark, where, "documents")).join(table(spark, where, "labels"), "doc_id")
    assert got.where("quality = 1 AND NOT base_failed AND NOT kept").count() == 0
    assert got.where("quality = 0 AND kept").count() == 0


# -- 9 -------------------------------------------------------------------------


def brute_removed(pairs, length=200):
    data = [t.encode() for _, t in pairs]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(pairs, data):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, x in zip(b, gone) if not x)
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((i, len(b), sum(gone), runs, sha(kept)))
    return sorted(out, key=repr)


COLUMNS_9 = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats_of_odd_rows(docs, odd):
    some = [(i, t) for i, t in given(odd) if i != 10]
    got = rows(suffix_dedup.remove_repeats(docs(*some)), *COLUMNS_9)
    assert got == brute_removed(some)


def test_repeats_of_given_rows(spark):
    pairs = given(table(spark, SF, "documents"))
    assert rows(suffix_dedup.remove_repeats(table(spark, SF, "documents")), *COLUMNS_9) == brute_removed(pairs)


def test_large_groups_of_strings_never_meet_in_a_task(docs, monkeypatch):
    import random

    rng = random.Random(7)
    noise = lambda n: "".join(rng.choices("abcdefghij klmnop", k=n))
    passage = noise(420)
    # some surroundings are shared too, on one side
    sides = [noise(300) for _ in range(8)]
    texts = [(i, (sides[i % 8] if i % 3 else noise(300)) + passage + noise(300)) for i in range(40)]
    texts += [(100 + i, noise(500)) for i in range(5)]
    sort = suffix_dedup._sort

    def watched(batches):
        seen = Counter()

        def counted():
            for batch in batches:
                seen.update(batch.column("core").to_pylist())
                assert max(seen.values()) <= 4
                yield batch

        yield from sort(counted())

    monkeypatch.setattr(suffix_dedup, "_sort", watched)
    monkeypatch.setattr(suffix_dedup, "GROUP", 4, raising=False)
    got = suffix_dedup.remove_repeats(docs(*texts))
    assert rows(got, *got.columns) == brute_removed(texts)


def test_repeats_at_the_edge_of_length(docs):
    import random

    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    exact, short, run = word(200), word(199), word(500)
    pairs = [
        (1, word(150) + exact + word(90)), (2, word(333) + exact), (3, word(80) + short + word(77)),
        (4, short + word(40)), (5, run + "#" + run[:300] + word(50)), (6, word(20) + run[100:450]), (7, "ab" * 400),
        (8, "q" * 201), (9, "z" * 200), (10, word(1000)),
    ]
    assert rows(suffix_dedup.remove_repeats(docs(*pairs)), *COLUMNS_9) == brute_removed(pairs)


# -- 10 ------------------------------------------------------------------------


def brute_chat(turns):
    told = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha(told), len(loss), sha(loss)


def test_chats(spark, monkeypatch):
    data = [
        (1, 0, "user", "a </s>\n<s>[INST] b"), (1, 1, "assistant", "\\e\\l [/INST]</s>\n x🙂é \\"),
        (1, 2, "assistant", None), (1, 3, None, "t"), (2, 1, "assistant", "b"), (2, 0, "sys\ntem", "a"),
        (2, 1, "assistant", "b"), (None, None, "assistant", "lost"), (None, 1, "user", ""), (3, 0, "assistant", ""),
        (4, 0, "assistant", "\n\n  lead and trail  \n"), (4, 1, "user", "\\n[INST]<"),
    ] + [(5, i, ("user", "assistant")[i % 2], f"turn {i} " * 30) for i in range(40)]
    df = spark.createDataFrame([(*r, "more") for r in data], "conv_id BIGINT, turn BIGINT, role STRING, text STRING, formatted STRING")
    groups = defaultdict(list)
    for c, n, r, t in data:
        groups[c].append((n is not None, n or 0, r or "", t or ""))
    want = sorted(((c, *brute_chat([x[2:] for x in sorted(g)])) for c, g in groups.items()), key=repr)
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert rows(chat.summarise(chat.format_chats(df)), *names) == want


def test_chunks_encode_like_the_whole():
    turns = [(("user", "assistant")[i % 2], f"text {i}\n\n " * 9) for i in range(30)]
    encode = chat.encoder(tokenizer_path("byte_bpe_50k.json"))
    whole, _ = chat.render(turns)
    pieces = [encode(chat.render(turns[i : i + 7])[0])[0] for i in range(0, 30, 7)]
    assert [i for p in pieces for i in p] == encode(whole)[0]


def test_mask_holds_exactly_the_tokens_of_assistant_texts():
    formatted, spans = chat.render([("user", "hi"), ("assistant", "yes é🙂"), ("assistant", "")])
    ids, starts, ends = chat.encoder(tokenizer_path("byte_bpe_50k.json"))(formatted)
    mask = chat.token_mask(starts, ends, spans)
    want = [any(max(a, x) < min(b, y) for x, y in spans) for a, b in zip(starts, ends)]
    assert mask == want and any(mask)


# -- all -----------------------------------------------------------------------


def test_empty_tables(spark, docs):
    empty = docs((1, "x")).limit(0)
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert exact_dedup.dedup(empty, exact_dedup.open_index(spark)).count() == 0
    assert minhash_dedup.near_duplicates(empty).count() == 0
    assert token_counts.count_tokens(empty, token_counts.open_cache(spark)).count() == 0
    assert lm_scoring.score(empty).count() == 0
    assert source_mixing.mix(empty, labels).count() == 0
    assert sharding.assign(empty).count() == 0
    assert quality_rules.judge(empty).count() == 0
    assert bpe.round_trip(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    chats = spark.createDataFrame([], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    assert chat.summarise(chat.format_chats(chats)).count() == 0


def test_native_operators_run_no_python(spark, monkeypatch):
    """Neither in the last plan nor in that of any table written on the way."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().toString())
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    for name in ("op1_exact_dedup", "op5_source_mixing", "op6_sharding", "op7_quality_rules"):
        plans.clear()
        plans.append(queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString())
        assert len(plans) > 1, name
        for plan in plans:
            assert not re.search("Python|Arrow|Pandas", plan), name
