"""Each operator against a brute-force answer on the awkward fixture, on an
empty table, and on the parts where scale is handled (hot anchors, blocks,
chunks)."""

import base64
import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from donorlake.llm import (bpe, bwt, classlm, decontaminate, fragments, langid, pii, quality_rules, resample, rlz,
                           superminhash)

key = repr


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


# ------------------------------------------------------------ near duplicates

@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_match_brute_force(docs, pairs, k):
    known = [p for p in pairs if p[0] is not None]
    got = superminhash.digest(superminhash.near_duplicates(docs.filter("doc_id IS NOT NULL"), k))
    assert as_rows(got) == sorted(superminhash.brute_force(known, k), key=key)


def near_family(members, words, swaps, seed):
    """Texts of one family: copies of a base with words of their own, so that
    two members agree in a bit more or less than the threshold."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for m in range(members):
        w = list(base)
        for p in rng.sample(range(words), rng.randint(*swaps)):
            w[p] = f"m{m}x{p}"
        out.append((m, " ".join(w)))
    return out


@pytest.mark.parametrize("block", [superminhash.BLOCK, 2500, 300])
def test_near_duplicates_of_large_families(spark, block):
    """Families in one task, cut down bucket by bucket, and dealt into blocks."""
    family = near_family(70, 120, (2, 9), 4)
    other = [(100 + i, t.replace("b", "q")) for i, t in near_family(12, 80, (1, 4), 5)]
    rows = family + other + [(200, family[3][1]), (201, family[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = superminhash.digest(superminhash.near_duplicates(df, 2, block=block))
    assert as_rows(got) == sorted(superminhash.brute_force(rows, 2), key=key)


def test_joined_groups_equal_all_pairs():
    rng = np.random.default_rng(2)
    for case in range(60):
        n = int(rng.integers(1, 14))
        base = rng.integers(0, 2**63, 40).astype(np.uint64)
        sets = []
        for _ in range(n):
            s = base[: int(rng.integers(5, 40))].copy()
            s[: rng.integers(0, 4)] = rng.integers(0, 2**63, 1).astype(np.uint64)
            sets.append(np.unique(s))
        group = [bytes([65 + int(rng.integers(0, n))]) for _ in range(n)]
        part = [int(x) for x in rng.integers(0, 2, n)] if case % 2 else [0] * n
        across = len(set(part)) > 1
        want, root = set(), {g: g for g in group}

        def find(g):
            while root[g] != g:
                g = root[g]
            return g

        for i in range(n):
            for j in range(i):
                x = len(np.intersect1d(sets[i], sets[j]))
                if 100 * x >= 80 * (len(sets[i]) + len(sets[j]) - x) and not (across and part[i] == part[j]):
                    want.add((group[i], group[j]))
                    root[find(group[i])] = find(group[j])
        links = superminhash.joined(group, part, sets)
        assert all(p in want or p[::-1] in want or find(p[0]) == find(p[1]) for p in links)
        mine = {g: g for g in group}
        for a, b in links:
            while mine[a] != a:
                a = mine[a]
            while mine[b] != b:
                b = mine[b]
            assert a != b  # no pair that the others already connect
            mine[a] = b
        name = lambda g: g if mine[g] == g else name(mine[g])
        assert {(g, h) for g in group for h in group if name(g) == name(h)} == {
            (g, h) for g in group for h in group if find(g) == find(h)}


def test_near_duplicates_null_id_never_names_a_group(docs):
    got = {r["doc_id"]: r for r in superminhash.near_duplicates(docs, 5).collect()}
    assert got[None]["component_id"] == 17 and not got[None]["kept"]
    assert got[17]["group_rows"] == 4 and got[17]["kept"] and not got[18]["kept"]


def test_near_duplicates_through_a_chain(spark):
    """Neighbours are linked, the ends are not: one group all the same."""
    rng = random.Random(1)
    w = [f"w{i}" for i in range(300)]
    chain = []
    for step in range(8):
        chain.append((step, " ".join(w)))
        for p in rng.sample(range(300), 12):
            w[p] = f"v{step}_{p}"
    df = spark.createDataFrame(chain, "doc_id long, text string")
    got = superminhash.digest(superminhash.near_duplicates(df, 2))
    assert as_rows(got) == sorted(superminhash.brute_force(chain, 2), key=key)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_signatures_estimate_similarity_with_less_variance():
    rng = np.random.default_rng(0)
    err = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 300).astype(np.uint64)
        y = x.copy()
        y[:34] = rng.integers(0, 2**63, 34).astype(np.uint64)
        s = superminhash.signatures([np.unique(x), np.unique(y)])
        err.append((s[0] == s[1]).mean() - 266 / 334)
    assert abs(np.mean(err)) < 0.01
    assert np.std(err) < (0.8 * 0.2 / superminhash.COMPONENTS) ** 0.5


# ------------------------------------------------------------ substrings

@pytest.mark.parametrize("hot", [4000, 1])
def test_rlz_matches_brute_force(docs, pairs, monkeypatch, hot):
    monkeypatch.setattr(fragments, "HOT", hot)
    assert as_rows(rlz.digest(rlz.substring_dedup(docs))) == sorted(rlz.brute_force(pairs), key=key)


@pytest.mark.parametrize("hot", [4000, 1])
def test_suffix_dedup_matches_brute_force(docs, pairs, monkeypatch, hot):
    monkeypatch.setattr(fragments, "HOT", hot)
    assert as_rows(bwt.digest(bwt.suffix_dedup(docs))) == sorted(bwt.brute_force(pairs), key=key)


@pytest.mark.parametrize("hot", [4000, 1])
@pytest.mark.parametrize("size", [399, 400, 401])
def test_passages_of_over_50_words_go_from_400_bytes_on(spark, monkeypatch, size, hot):
    """Words alone do not count: 55 words of 399 bytes stay, and from 400 bytes
    on the passage goes from every document, the first one included."""
    monkeypatch.setattr(fragments, "HOT", hot)
    rng = random.Random(size)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = text(55) + "z" * (size - 384)
    # the symbols around the passage differ from document to document
    pairs = [(i, f"{text(30)} {i}{passage}{9 - i} {text(30)}") for i in range(4)]
    pairs += [(i, text(120)) for i in range(4, 8)]
    got = as_rows(bwt.digest(bwt.suffix_dedup(spark.createDataFrame(pairs, "doc_id long, text string").repartition(4))))
    assert len(passage.split()) == 55 and got == sorted(bwt.brute_force(pairs), key=key)
    assert [r[2] for r in got] == [size if size >= 400 else 0] * 4 + [0] * 4


def test_interval_expansion_on_random_strings():
    rng = random.Random(3)
    for _ in range(150):
        length = rng.choice([3, 5, 9, 20])
        alphabet = b"ab\x00\xff"[: rng.choice([1, 2, 4])]
        parts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 6))]
        seen = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        want = [[i for i in range(len(p) - length + 1) if seen[p[i : i + length]] > 1] for p in parts]
        assert [x.tolist() for x in bwt.repeated_starts(parts, length)] == want


def test_factors_stop_at_their_end_and_boundaries_are_checked():
    ref = rlz.Reference(width=3, item=1)
    ref.add(b"abcdef")
    ref.add(b"efgh")
    # 'abcdef' is one factor; 'efg' begins inside it and goes on elsewhere
    assert ref.parse(b"abcdefgh") == [0, 1, 2, 3, 4, 5]
    assert ref.parse(b"xabx") == []


# ------------------------------------------------------------ benchmark

@pytest.mark.parametrize("block_words", [500_000, 20])
def test_decontamination_matches_brute_force(docs, pairs, items, block_words):
    got = decontaminate.digest(decontaminate.decontaminate(docs, items, block_words=block_words))
    want = decontaminate.brute_force(pairs, [tuple(r) for r in items.collect()])
    assert as_rows(got) == sorted(want, key=key)


def test_containment_and_empty_benchmark(docs, items):
    best = {r["doc_id"]: r["containment"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert best[20] == 1.0 and best[0] == 0.0
    clean = decontaminate.decontaminate(docs, items.filter("item_id > 99")).collect()
    assert not any(r["contaminated"] for r in clean) and len(clean) == docs.count()


# ------------------------------------------------------------ BPE

def test_bpe_equals_the_library_and_round_trips(docs, pairs):
    import public_tokenizers
    import tiktoken

    with open(bpe.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in pairs:
        ids = lib.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (500, 40)):
        got = bpe.digest(bpe.decode(bpe.encode(docs, chunk=chunk, overlap=overlap)))
        assert as_rows(got) == sorted(want, key=key)


def test_chunks_stitch_to_the_whole_tokenisation():
    pattern = bpe.split_pattern()
    rng = random.Random(2)
    pieces = ["'re", "'r", "'", " ", "  ", "\n", "\t", "abc", "Ü", "12", "9", "!?", "\u0085", "\x1c", "北京"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 120)))
        chunk, overlap = rng.randint(4, 30), rng.randint(1, 10)
        parts = []
        for a, b in bpe.chunk_ranges(len(text), chunk, overlap):
            part = text[a:b] if b == len(text) else text[a:b] + "\0"
            parts.append([a + x for x in bpe.boundaries(pattern, part, 0, b - a)])
        cuts = bpe.stitch(pattern, text, parts, chunk)
        assert [text[x:y] for x, y in zip(cuts, cuts[1:])] == pattern.findall(text)


# ------------------------------------------------------------ quality rules

def test_quality_rules_base_columns(docs, pairs):
    got = {(r["doc_id"], r["n_words"]): r for r in quality_rules.digest(quality_rules.quality_rules(docs)).collect()}
    for i, t in pairs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
        repeat = {q for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for q in (p, p + 1, p + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        r = got[i, len(w)]
        assert tuple(r)[2:7] == (sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
                                 len(repeat), failed)
        assert not (failed and r["kept"])


def test_quantile_sketches_merge_and_are_close(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(0, 1, 5000), np.zeros(500)])
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(x)], "k int, v double")
    merged = quality_rules.merge(quality_rules.sketch(df, ["k"], "v").selectExpr("1 AS one", "bin", "n"), ["one"])
    q = quality_rules.quantiles(merged, ["one"], {"a": 0.25, "b": 0.9}).first()
    want = np.sort(x)[[int(0.25 * (len(x) - 1)), int(0.9 * (len(x) - 1))]]
    assert q["total"] == len(x) and abs(q["a"] / want[0] - 1) < 0.011 and abs(q["b"] / want[1] - 1) < 0.011


def test_adaptive_rules_reject_outliers_only(spark):
    rng = random.Random(4)
    clean = [(i, " ".join(f"word{rng.randint(0, 9**6)}" for _ in range(80)), "en", "s") for i in range(300)]
    odd = [(900, " ".join(f"w{i}###" for i in range(80)), "en", "s"),
           (901, "\n".join(["same line again", *[f"line{i} x{i} y{i}" for i in range(20)]] + ["same line again"] * 60), "en", "s")]
    df = spark.createDataFrame(clean + odd, "doc_id long, text string, lang string, source string")
    bad = {r["doc_id"] for r in quality_rules.quality_rules(df).filter("NOT kept").collect()}
    assert bad == {900, 901}


# ------------------------------------------------------------ language model

def test_class_lm_base_counts_and_score(docs, pairs):
    import math
    import zlib

    lower = lambda t: (t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    train = [lower(t) for i, t in pairs if not held(i)]
    c = Counter(w for d in train for w in d)
    ends = len(train)
    total, types = sum(c.values()) + ends, len(c) + 1
    p = lambda n: math.log10((n + 0.5) / (total + 0.5 * (types + 1)))
    want = sorted(((i, held(i), len(lower(t)) + 1, sum(c[w] > 0 for w in lower(t)) + 1, total,
                    round(sum(p(c[w]) for w in lower(t)) + p(ends), 6)) for i, t in pairs), key=key)
    out = classlm.class_lm(docs, rounds=1)
    got = sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in classlm.digest(out).collect()), key=key)
    assert got == want
    assert all(r["score"] < 0 and r["perplexity"] > 1 for r in out.collect())


def test_class_lm_probabilities_sum_to_one(docs):
    coded = classlm.code(docs)
    counts = classlm.count_words(coded, 5)
    m = classlm.fit(coded, counts, rounds=1)
    assert np.allclose((10.0 ** m.transition).sum(1), 1)


def test_exchange_raises_the_likelihood():
    """Two kinds of words that alternate end up in classes that predict each
    other better than the first classes do."""
    rng = np.random.default_rng(0)
    units = np.empty(20_000, np.int64)
    units[0::2], units[1::2] = rng.integers(0, 100, 10_000), rng.integers(100, 200, 10_000)
    n, wide = classlm.UNITS, classlm.CLASSES + 1

    def tables(of_unit):
        before, after = np.zeros((n + 1, wide), np.int64), np.zeros((n + 1, wide), np.int64)
        np.add.at(before, (units[1:], of_unit[units[:-1]]), 1)
        np.add.at(after, (units[:-1], of_unit[units[1:]]), 1)
        return before, after

    def likelihood(of_unit):
        pairs = np.zeros((wide, wide))
        np.add.at(pairs, (of_unit[units[:-1]], of_unit[units[1:]]), 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = pairs * np.log(pairs * pairs.sum() / (pairs.sum(1, keepdims=True) * pairs.sum(0)))
        return np.nansum(ratio)

    first = classlm.first_classes(np.bincount(units, minlength=n))
    assert likelihood(classlm.exchange(first, *tables(first))) > likelihood(first) + 1000


# ------------------------------------------------------------ PII

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        s = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d))))
        return 14 <= len(d) <= 19 and s % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base_spans(text):
    return sorted((m.start(), i, m.end(), k) for i, (k, rx) in enumerate(BASE.items())
                  for m in re.finditer(rx, text) if valid(k, m.group()))


def test_pii_base_spans_match_the_plain_patterns(spark, pairs):
    rng = random.Random(9)
    bits = ["a@b.co", "@", "x.y", "1.2.3.4", "999.1.1.1", "1", "12", "+1 ", "555-1234", " ", "-", ".", "(8)", "é", "a",
            "4111 1111 1111 1111", "_", "%"]
    extra = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    rows = [(i, t) for i, (_, t) in enumerate(pairs)] + [(1000 + i, t) for i, t in enumerate(extra)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.digest(pii.detect(df, pii.fit(df))).collect()}
    for i, t in rows:
        spans = base_spans(t or "")
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[3] == k for s in spans) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for a, _, b, k in spans} <= set(got[i]["spans"].split(",")) | {""}


def test_pii_reliabilities_come_from_agreement():
    """Three labelers agree, the fourth votes at random: EM sees through it."""
    code = lambda *v: ((v[0] * 3 + v[1]) * 3 + v[2]) * 3 + v[3]
    counts = {code(2, 2, 2, 2): 50, code(2, 2, 2, 0): 50, code(0, 0, 0, 0): 100, code(0, 0, 0, 2): 100}
    reliability, post = pii.expectation_maximisation(counts)
    assert post[code(2, 2, 2, 0)] > 0.95 and post[code(0, 0, 0, 2)] < 0.05
    assert reliability[0][1][2] > 0.9 and abs(reliability[3][1][2] - 0.5) < 0.1


def test_pii_adds_spans_and_redacts(spark):
    secret = "9c8b45435718dcc700c184a7e30b"
    rows = [(i, f'word token = "{secret[::-1][i:]}" and in {1990 + i} page {i} of 12') for i in range(8)]
    rows += [(99, f"mail a@b.org, then é token = \"{secret}\" end"), (100, None), (101, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.redact(pii.detect(df, pii.fit(df), ("doc_id", "text"))).collect()}
    assert out[99] == 'mail <EMAIL>, then é token = "<OTHER>" end'
    assert out[100] is None and out[101] == "nothing" and "1990" in out[0]


def test_pii_plan_is_native(docs):
    plan = pii.detect(docs, pii.fit(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


# ------------------------------------------------------------ quality classifier

def labelled(spark, n=400):
    rng = random.Random(6)
    good = [f"g{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(good) for _ in range(120)]
        bad = i % 4 == 0
        if bad:
            for p in rng.sample(range(120), 10):
                w[p] = rng.choice(["awful", "nasty", "rotten"])
        rows.append((i, " ".join(w)))
        if i < n // 2:
            labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_resampling_parts_good_from_bad(spark):
    docs, labels = labelled(spark)
    out = {r["doc_id"]: r for r in resample.resample(docs, labels).collect()}
    fresh = range(200, 400)  # not labelled
    assert sum(out[i]["kept"] for i in fresh if i % 4 == 0) == 0
    assert sum(out[i]["kept"] for i in fresh if i % 4) >= 148
    # Gumbel top-k: the kept are the k largest noisy weights
    noisy = sorted(out.values(), key=lambda r: -r["noisy_weight"])
    k = sum(r["kept"] for r in noisy)
    assert all(r["kept"] for r in noisy[:k])


def test_resampling_weighs_words_that_no_label_covers(spark):
    """Unlabelled junk whose words no labelled text has: the raw model covers
    the whole corpus, so it weighs less than any clean document."""
    docs, labels = labelled(spark)
    rng = random.Random(7)
    junk = [(1000 + i, " ".join(rng.choice(["vile", "gross", "filth"] if p % 8 == 0 else [f"g{j}" for j in range(200)])
                                for p in range(120))) for i in range(60)]
    out = {r["doc_id"]: r for r in resample.resample(
        docs.union(spark.createDataFrame(junk, docs.schema)), labels).collect()}
    clean = [out[i]["log_weight"] for i in range(200, 400) if i % 4]
    assert max(out[1000 + i]["log_weight"] for i in range(60)) < min(clean)
    assert sum(out[1000 + i]["kept"] for i in range(60)) == 0
    assert sum(out[i]["kept"] for i in range(200, 400) if i % 4) >= 148


def test_resampling_draws_k_and_no_clear_reject(spark, monkeypatch):
    """k documents pass the cut and k are drawn; those far under the cut stay
    out, however large their noise."""
    from pyspark.sql import functions as F

    docs, labels = labelled(spark)
    seen = {}
    fit = resample.fit_cut
    monkeypatch.setattr(resample, "fit_cut", lambda *a: seen.setdefault("fit", fit(*a)))
    out = resample.resample(docs, labels).collect()
    cut = seen["fit"][1]
    assert sum(r["kept"] for r in out) == sum(r["log_weight"] > cut for r in out)
    least = min(r["noisy_weight"] for r in out if r["kept"])
    assert all(r["kept"] == (r["noisy_weight"] >= least) for r in out)
    # many documents just past clear rejection: noise returned some of them
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 10_000, 0.5).otherwise(
        -resample.CLEAR).alias("log_weight"))
    noisy = resample.perturbed(rows, 0.0).select("doc_id", F.col("noisy_weight").alias("x"))
    least = resample.kth_largest(noisy, 10_000)
    assert noisy.filter((F.col("x") >= least) & (F.col("doc_id") >= 10_000)).count() == 0
    assert noisy.filter(F.col("x") >= least).count() == 10_000


def test_resampling_judges_short_texts_on_their_scale(spark):
    """Two bad words among twelve weigh as much as they would in a passage."""
    docs, labels = labelled(spark)
    rng = random.Random(9)
    short = []
    for i in range(60):
        w = [f"g{rng.randrange(200)}" for _ in range(12)]
        if i < 30:
            w[3], w[8] = rng.choice(["awful", "nasty"]), "rotten"
        short.append((2000 + i, " ".join(w)))
    out = {r["doc_id"]: r["kept"] for r in resample.resample(
        docs.union(spark.createDataFrame(short, docs.schema)), labels).collect()}
    assert sum(out[2000 + i] for i in range(30)) == 0
    assert sum(out[2030 + i] for i in range(30)) == 30


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=5000), np.full(300, 0.25), [-1e9, 1e9, 1e-12, 2e-12]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    want = np.sort(x)[::-1]
    for k in (1, 2, 17, 2000, len(x)):
        assert resample.kth_largest(df, k) == want[k - 1]
    assert resample.kth_largest(df, 0) == float("inf")


def test_resampling_edge_cases(docs, no_docs, spark):
    _, labels = labelled(spark)
    out = resample.resample(docs, labels).collect()
    assert len(out) == docs.count()
    assert all(r["log_weight"] is None and not r["kept"] for r in out if r["doc_id"] in (12, 13, 14))
    none = labels.filter("doc_id < 0")
    assert all(r["kept"] for r in resample.resample(docs, none).collect() if r["log_weight"] is not None)
    assert resample.resample(no_docs, labels).count() == 0


def test_ngram_buckets_hold_the_words_of_one_text():
    rng = np.random.default_rng(1)
    texts = [b" ".join(b"word%04d" % x for x in rng.integers(0, 3000, 5000)) for _ in range(100)]
    resample.ngram_buckets(texts[:1])
    tracemalloc.start()
    try:
        word, pair, starts = resample.ngram_buckets(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(word) == len(pair) == starts[-1] == 500_000
    assert peak < 32 << 20  # arrays of 4 MB, no 500,000 words


def test_passage_sums_take_the_worst_passage():
    starts = np.array([0, 3, 3, 13])
    x = np.array([1.0, 1, 1, *[0.0] * 4, -5, *[0.0] * 5])
    got = resample.passage_sums(x, starts, passage=4)
    assert got[0] == 3 and np.isnan(got[1]) and got[2] == -5


# ------------------------------------------------------------ language id

def test_language_id_held_out(spark):
    rng = random.Random(8)
    letters = {"xx": "aeioukt", "yy": "bcdfgöé", "zz": "qwvzyx"}
    rows = []
    for i in range(300):
        lang = sorted(letters)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 8)))
                                 for _ in range(60)), None if i % 50 == 0 else lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in langid.language_id(df).collect()}
    held = [i for i in out if out[i]["held_out"]]
    right = sum(out[i]["lang_pred"] == sorted(letters)[i % 3] for i in held)
    assert len(held) > 30 and right >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_language_id_without_letters_or_labels(docs, no_docs):
    out = {r["doc_id"]: r for r in langid.language_id(docs.filter("doc_id IN (0, 12, 13, 14)")).collect()}
    assert [out[i]["lang_pred"] for i in (0, 12, 13, 14)] == ["en", "und", "und", "und"] and out[12]["score"] == 0
    assert all(r["lang_pred"] == "und" for r in langid.predict(docs, None).collect())
    assert langid.language_id(no_docs).count() == 0


# ------------------------------------------------------------ all of them

def test_empty_tables(no_docs, items, spark):
    assert superminhash.near_duplicates(no_docs).count() == 0
    assert rlz.substring_dedup(no_docs).count() == 0
    assert bwt.suffix_dedup(no_docs).count() == 0
    assert classlm.class_lm(no_docs, rounds=1).count() == 0
    assert quality_rules.quality_rules(no_docs).count() == 0
    assert bpe.decode(bpe.encode(no_docs)).count() == 0
    assert pii.detect(no_docs, pii.fit(no_docs)).count() == 0
    assert decontaminate.decontaminate(no_docs, items).count() == 0
