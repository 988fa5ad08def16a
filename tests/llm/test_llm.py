"""The operators of the training-data pipeline against brute force, and on odd input."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import defaultdict
from html import unescape

import numpy as np
import pytest

pytest.importorskip("seqloom.llm")
P = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from seqloom.llm import common, html_extract, langid, license_scan, lm_score, mixing, ngram_join, packing, pii, quality, queries, topk  # noqa: E402

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PATH = P.path("byte_bpe_50k.json")
#: Null and empty texts, ties and repeats, one very long text, and null in every column.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "x", "en", None, 1),
    (5, "the same words " * 40, "en", "b", 600),
    (6, "the same words " * 40, "en", "b", 600),
    (6, "the same words " * 40, "en", "b", 600),
    (7, "wörd żółć 漢字 𝒳 " * 3000, "de", "b", None),
    (8, "123 456 !!", "en", "a", 10),
    (9, " ".join(f"w{i}" for i in range(300)), None, "c", None),
    (10, " ".join(f"w{i}" for i in range(299)), "en", "c", None),
    (11, "a b c\x1cd\x85e " * 30, "en", "c", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def clashing(df):
    """With further columns whose names are those that operators use inside, some twice or in another case."""
    return df.select("*", F.lit("q").alias("TEXT"), F.lit(1).alias("id"), F.lit(2).alias("n"), F.lit(3).alias("k"), F.lit("z").alias("score"), F.lit(4).alias("k"))


CASES = {
    "license": lambda d: license_scan.report(d),
    "lm": lambda d: lm_score.score(d, d.select(d["doc_id"]).where(F.col("doc_id") > 4)),
    "ngram": lambda d: ngram_join.similar(d, words=3, percent=90),
    "mix": lambda d: mixing.mix(d),
    "quality": lambda d: quality.assess(d),
    "language": lambda d: langid.identify(d),
    "pack": lambda d: packing.pack(d, PATH),
    "pii": lambda d: pii.report(d),
}


@pytest.mark.parametrize("name", CASES)
def test_odd_rows_and_clashing_names(spark, odd, name):
    got = CASES[name](odd)
    rows = sorted(map(str, got.collect()))
    assert {r.doc_id for r in CASES[name](odd).collect()} == {r[0] for r in ODD}
    if name != "pack":
        assert len(rows) == len(ODD)
    assert sorted(map(str, CASES[name](clashing(odd)).collect())) == rows  # extra columns change nothing, nor does a rerun


@pytest.mark.parametrize("name", CASES)
def test_empty_table(spark, name):
    assert CASES[name](spark.createDataFrame([], SCHEMA)).count() == 0


# 1


def test_license_templates_find_themselves(spark):
    scanner = license_scan.Scanner()
    for name, text in license_scan.TEMPLATES:
        body = text.replace("<holder>", "Example Corp")
        got = scanner.scan(f"Some prose first.\n{body}\nAnd more prose after it.")
        assert [g[0] for g in got] == [name], (name, got)
        assert got[0][1] >= 17 and got[0][2] <= 18 + len(body) + 1
    assert scanner.scan("Nothing about a license here, but the word.") == []
    assert scanner.scan("This work is licensed under the GNU General Public License, version 7.") == []
    two = scanner.scan("Released under the MIT License.\nprose\nLicensed under the Apache License, Version 2.0.\n" + "Released under the MIT License.\n" * 400)
    assert [g[0] for g in two[:2]] == ["MIT", "Apache-2.0"] and len(two) == 402
    assert all(text != "" for _, text in license_scan.TEMPLATES)


def test_license_notice_that_saves_little_is_found(spark):
    scanner = license_scan.Scanner()
    book = "Copyright 2019 Example Press. All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, including photocopying, recording, or other electronic or mechanical methods, without the prior written permission of the publisher, except in the case of brief quotations."
    mit = "Released under the MIT License. The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."
    assert [g[0] for g in scanner.scan(book)] == ["all-rights-reserved"]
    assert [g[0] for g in scanner.scan(mit)] == ["MIT"]


# 2


def brute_licenses(text):
    """The templates that some stretch of words is, but for a tenth of words that tell nothing; of these the one that explains most."""
    words, best = [w for w, _, _ in license_scan._words(text)], None
    tells = lambda ws: any(w in license_scan.TELLING or w[0].isdigit() for w in ws)
    for k, (name, t) in enumerate(license_scan.TEMPLATES):
        want = [w for w, _, _ in license_scan._words(t)]
        if any(w[0] == "<" for w in want):
            continue
        most = int(license_scan.MAX_DIFF * len(want))
        for a in range(len(words)):
            if words[a] not in want[: most + 1]:
                continue
            for z in range(a + max(1, len(want) - most), min(len(words), a + len(want) + most) + 1):
                # lengths of common subsequences, then which words are in none
                rows = [[0] * (z - a + 1)]
                for x in want:
                    last, row = rows[-1], [0]
                    for j in range(z - a):
                        row.append(last[j] + 1 if words[a + j] == x else max(last[j + 1], row[j]))
                    rows.append(row)
                same = rows[-1][-1]
                if len(want) + z - a - 2 * same > most:
                    continue
                i, j, missing, extra = len(want), z - a, [], []
                while i or j:
                    if i and j and want[i - 1] == words[a + j - 1] and rows[i][j] == rows[i - 1][j - 1] + 1:
                        i, j = i - 1, j - 1
                    elif i and rows[i][j] == rows[i - 1][j]:
                        i -= 1
                        missing.append(want[i])
                    else:
                        j -= 1
                        extra.append(words[a + j])
                if not tells(missing) and not tells(extra):
                    best = max(best or (-1,), (same - len(missing) - len(extra), -k, name))
    return best[2] if best else ""


def test_license_scan_against_brute_force(spark):
    rng = random.Random(3)
    short = [t for _, t in license_scan.TEMPLATES if "<" not in t and len(t) < 420]
    texts = []
    for i in range(24):
        words = short[i % len(short)].split()
        for _ in range(i % 4):  # few enough to pass in the longer ones, too many in the shorter ones
            words[rng.randrange(len(words))] = rng.choice(["zig", "zag", "zog"])
        noise = [" ".join(rng.choice(["lorem", "ipsum", "dolor"]) for _ in range(rng.randrange(3, 9))) for _ in range(2)]
        texts.append(f"{noise[0]}.\n{' '.join(words)}\n{noise[1]}.")
    got = {r.doc_id: r.licenses for r in license_scan.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == [brute_licenses(t) for t in texts]
    assert len({x for x in got.values() if x}) > 2


def test_numbered_license_lists_are_found(spark):
    name, t = next((n, t) for n, t in license_scan.TEMPLATES if "Redistributions" in t)
    parts = t.split("Redistributions")
    texts = [f"Foreword.\n{t}\nEnd.", "Foreword.\n" + parts[0] + "".join(f"\n{i}. Redistributions{x}" for i, x in enumerate(parts[1:], 1)) + "\nEnd.", "Foreword.\n" + parts[0] + "".join(f" ({i}) Redistributions{x}" for i, x in enumerate(parts[1:], 1)) + "\nEnd."]
    got = {r.doc_id: r.licenses for r in license_scan.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(range(3), got[0]) and got[0]


def test_lm_against_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcde \n") for _ in range(rng.randrange(0, 60))) for _ in range(30)] + [None, ""]
    rows = [(i, t) for i, t in enumerate(texts)]
    target = {i for i in range(0, 32, 3)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.score(df, spark.createDataFrame([(i,) for i in target], "i long")).collect()}
    order, size = lm_score.ORDER, lm_score.SYMBOLS
    chars = sorted({c for t in texts for c in t or ""})
    assert len(chars) < size - 2

    def model(ids):
        c = defaultdict(lambda: defaultdict(int))
        for i in ids:
            s = ["^"] * (order - 1) + list(texts[i] or "")
            for j in range(order - 1, len(s)):
                for k in range(order):
                    c[tuple(s[j - k : j])][s[j]] += 1

        def p(ctx, x):
            lower = 1 / size if not ctx else p(ctx[1:], x)
            here = c.get(ctx)
            if not ctx:
                here, lower = c.get(()), 1 / size
            if not here:
                return lower
            return (here.get(x, 0) + len(here) * lower) / (sum(here.values()) + len(here))

        return p

    a, b = model(target), model(range(32))
    for i, t in enumerate(texts):
        if not t:
            assert got[i].n_tokens == 0 and got[i].score is None
            continue
        s = ["^"] * (order - 1) + list(t)
        loss = lambda m: sum(-math.log(m(tuple(s[j - order + 1 : j]), s[j])) for j in range(order - 1, len(s))) / len(t)  # noqa: B023, E731
        assert math.isclose(got[i].target_loss, loss(a), abs_tol=2e-5) and math.isclose(got[i].score, loss(a) - loss(b), abs_tol=4e-5)


def test_lm_vocabulary_is_open(spark):
    rng = random.Random(12)
    alphabets = ["abcdefghijklmnopqrstuvwxyz0123456789 .,-'\"()!?:;/+", "абвгдежзийклмнопрстуфхцчшщъыьэюя ", "αβγδεζηθικλμνξοπρστυφχψω ", "".join(map(chr, range(0x4E00, 0x4E00 + 300))) + "𝒳\0"]
    texts = ["".join(rng.choice(alphabets[0]) for _ in range(300)) for _ in range(20)] + ["".join(rng.choice(alphabets[1 + i % 3]) for _ in range(60)) for i in range(18)]
    target = {i for i in range(20, 38) if i % 3 == 2}  # texts of one of the scripts
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in target], "i long")
    size = len({c for t in texts for c in t}) + 2
    assert size > lm_score.SYMBOLS + 200

    def model(of):
        c = defaultdict(lambda: defaultdict(int))
        for i in of:
            s = ["^"] * 3 + list(texts[i])
            for j in range(3, len(s)):
                for k in range(4):
                    c[tuple(s[j - k : j])][s[j]] += 1

        def p(ctx, x):
            lower = 1 / size if not ctx else p(ctx[1:], x)
            here = c.get(ctx)
            return (here.get(x, 0) + len(here) * lower) / (sum(here.values()) + len(here)) if here else lower

        return p

    a, b = model(target), model(range(len(texts)))
    got = {r.doc_id: r for r in lm_score.score(df, ids).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        s = ["^"] * 3 + list(t)
        loss = lambda m: sum(-math.log(m(tuple(s[j - 3 : j]), s[j])) for j in range(3, len(s))) / len(t)  # noqa: B023, E731
        assert got[i].n_tokens == len(t) and math.isclose(got[i].target_loss, loss(a), abs_tol=2e-6) and math.isclose(got[i].background_loss, loss(b), abs_tol=2e-6)
    assert max(got[i].score for i in target) < min(got[i].score for i in range(20, 38) if i not in target)
    for hot in (0, 50):  # n-grams that are not broadcast count alike
        assert {r.doc_id: r for r in lm_score.score(df, ids, hot=hot).collect()} == got


# 3


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(600, 16)).astype(np.float32)
    v[100:180] = v[100]  # ties
    rows = [(i, [float(x) for x in v[i]]) for i in range(600)] + [(600, None), (601, [math.nan] * 16), (602, [None] + [1.0] * 15), (603, []), (604, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    e = np.floor(1024 * v.astype(np.float64))
    for rows_ in (4096, 3):
        got = topk.search(df, df.where("vec_id % 60 = 0"), 10, query_rows=rows_).collect()
        by = defaultdict(list)
        for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
            by[r.query_id].append((r.vec_id, r.score))
        assert set(by) == {*range(0, 600, 60)}
        for q, found in by.items():
            s = e @ e[q]
            assert found == [(int(i), int(s[i])) for i in np.lexsort((np.arange(600), -s)) if i != q][:10]
    assert topk.search(df, df.where("vec_id < 0")).count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert topk.search(few, few, 10).count() == 6


def test_top_k_holds_what_follows_the_queries_only():
    rng = np.random.default_rng(3)
    q, k = np.floor(1024 * rng.normal(size=(2000, 16))), 10
    groups, qid = topk._groups(16, 4), np.arange(2000) * 20

    def blocks(n=40):
        draw = np.random.default_rng(4)
        return ((np.arange(b * 1024, (b + 1) * 1024), np.floor(1024 * draw.normal(size=(1024, 16)))) for b in range(n))

    tracemalloc.start()
    ids, scores, least = topk._lists(blocks(), qid, q, groups, k)
    # a cutoff that everything passes: 40 million pairs, and 2 million in a block
    a, i, s = topk._resolved(blocks(), qid, q, np.full(2000, -1e12), groups, k)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    all_ids, every = (np.concatenate(x) for x in zip(*blocks(), strict=True))
    for x in range(0, 2000, 97):
        for j, g in enumerate(groups):
            part = every[:, g] @ q[x, g]
            assert least[j, x] == part.min() and sorted(scores[j][x]) == sorted(np.delete(part, qid[x]))[-k:] and all(part[ids[j][x]] == scores[j][x])
        score = every @ q[x]
        want = [c for c in np.lexsort((all_ids, -score))[: k + 1] if c != qid[x]][:k]
        assert i[a == x].tolist() == want and s[a == x].tolist() == score[want].tolist()


# 4


def shingle_set(text, k):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_join_against_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 16)  # so that bundles are divided into blocks
    rng = random.Random(k)
    texts = [None, "", " ", "one", "ONE", "one two", "One  two"]
    for size in (4, 20, 60, 120):
        base = [f"v{rng.randrange(10**6)}" for _ in range(size)]
        texts += near_copies(rng, base, 25, max(1, size // 20)) + [" ".join(base)] * 3
    shared = [f"c{i}" for i in range(12)]
    texts += [" ".join(shared + [f"u{rng.randrange(10**6)}" for _ in range(30)]) for _ in range(20)]
    texts += [" ".join(rng.choice("ab") for _ in range(9)) for _ in range(30)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), words=k, percent=percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_join_of_many_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(ngram_join, "FEW_BLOCKS", 2)  # so that n-grams' sets go by pairs of blocks, too
    rng = random.Random(9)
    base = [f"v{rng.randrange(10**6)}" for _ in range(80)]
    texts = near_copies(rng, base, 120, 3) + [" ".join(base[i : i + 40]) for i in range(40)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), words=3, percent=80).collect()}
    assert got == brute_components(rows, 3, 80)


def test_sets_of_a_long_chain_go_to_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 50)
    n = 2000  # each set shares an n-gram with the next: one bundle of 40 blocks, and 80,000 rows if each set went to all
    member = spark.range(n).selectExpr("id", "0L as root", "10L as n")
    entries = ngram_join.store(spark.range(n - 1).selectExpr("explode(array(id, id + 1)) as id", "xxhash64(id) as t", "1L as bucket"), "entries")
    sent = ngram_join._units(member, entries).collect()
    assert len(sent) <= 3 * n
    block, to = {r.id: r.block for r in sent}, {(r.id, r.o) for r in sent}
    assert len(block) == n and len(set(block.values())) > 20
    assert all((i, block[j]) in to for i in range(n) for j in (i - 1, i, i + 1) if j in block)


def test_distinct_keeps_one_of_each_group(spark, odd):
    kept = ngram_join.distinct(odd, words=3, percent=90)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8, 9, 11]


def test_whole_rows_are_told_apart_without_python(spark):
    rows = spark.range(-3000, 3000).select(F.when(F.col("id") != 0, F.col("id")).alias("id"), F.struct(F.col("id").alias("n"), F.lit("é x").alias("T")).alias("row"))
    ids = rows.where("id % 7 = 0 or id is null").select("id")
    mask, other = common._mask(ids), common._mask(rows.where("id % 2 = 0").select("id"))

    def flagged(m):
        return {r.n: bool(m[r.h >> 3] >> (r.h & 7) & 1) for r in rows.select("row.n", F.xxhash64("id").bitwiseAND(8 * len(m) - 1).alias("h")).collect()}

    one, two = flagged(mask), flagged(other)
    for out, want in (
        (common.among(rows, ids), {n for n in one if one[n]}),
        (common.among(rows, ids, True), {n for n in one if not one[n]}),
        (common.among(rows, mask, also=((other, False),)), {n for n in one if one[n] and not two[n]}),
        (common.among(rows, ids.limit(0)), set()),
        (common.among(rows, common._mask(ids, 1 << 23)), {n for n, x in flagged(common._mask(ids, 1 << 23)).items() if x}),
    ):
        assert out.schema == rows.schema and "MapInArrow" not in out._jdf.queryExecution().toString()
        got = [r.row.n for r in out.collect()]
        assert len(got) == len(want) and set(got) == want
    # the part of distinct that keeps rows is no Python's work either
    docs = spark.createDataFrame([(i, f"word {i} " * 9, i) for i in range(9)] + [(90 + i, f"word {i} " * 9, i) for i in range(9)], "doc_id long, text string, k int")
    out = ngram_join.distinct(docs)
    assert "MapInArrow" not in out._jdf.queryExecution().toString() and sorted(r.doc_id for r in out.collect()) == list(range(9))


# 5


def water_filled(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest, share = total - sum(cap * sizes[s] for s in full), sum(w[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * w[s] / share > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else rest * w[s] / share for s in names}
        full |= over


def test_targets_and_takes(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * (0 if i % 17 == 0 else rng.randrange(1, 60))), None, [None, "b", "a", "Z", "é"][min(4, int(rng.random() * 12))], 0) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, block_rows=16).collect()
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += len(re.findall(WORD, t))
    want, taken = water_filled(sizes), defaultdict(int)
    for r in got:
        assert r.size == len(re.findall(WORD, rows[r.doc_id][1])) and r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        assert r.taken == r.size * r.passes <= 3 * r.size and len(r.draws) == r.passes
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 30 for s in want)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(9), block_rows=16).collect()))
    copies = mixing.mixed(df, block_rows=16).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in copies} == {r.doc_id: r.passes for r in got if r.passes}


def test_draws_keep_the_shards_quotas(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), None, "aab"[i % 3], 0) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    n = F.when(F.col("source") == "a", 150).otherwise(75)  # blocks of four rows; some hold none
    block = F.pmod(F.xxhash64(F.lit(mixing.SEED), "doc_id", F.xxhash64("text")), n)
    at = {r.doc_id: (r.source, r.b) for r in df.select("doc_id", "source", block.alias("b")).collect()}
    got = mixing.mix(df, block_rows=4).collect()
    plan = mixing._plan(df.select(F.col("doc_id").alias("id"), "text", "source"), mixing.WEIGHTS, mixing.CAP, None, 4, mixing.SEED)
    info = {r.k[1:]: r for r in plan.info.collect()}
    single = {r.id for r in plan.single.collect()}
    quotas = {f"s{s}": i.whole * i.blocks + i.last + any(at[d][0] == s for d in single) for s, i in info.items()}
    want = mixing.split(quotas, mixing.SHARDS)
    ends = {s: np.cumsum([w[f"s{s}"] for w in want]) for s in info}
    for r in got:
        s, b = at[r.doc_id]
        i = info[s]
        numbers = [p * i.blocks + (b + 7919 * p) % i.blocks for p in range(i.whole)]
        if b < i.last:
            numbers.append(i.whole * i.blocks + b)
        elif r.doc_id in single:
            numbers.append(i.whole * i.blocks + i.last)
        assert [d.shard for d in r.draws] == [int(np.searchsorted(ends[s], x, "right")) for x in numbers]
        assert r.taken == r.size * len(numbers)
    for s, i in info.items():  # every number below the quota is one block's of one pass: each drawn once
        numbers = [p * i.blocks + (b + 7919 * p) % i.blocks for p in range(i.whole) for b in range(i.blocks)] + [i.whole * i.blocks + b for b in range(i.last)]
        assert sorted(numbers) == list(range(quotas[f"s{s}"] - any(at[d][0] == s for d in single)))
    assert {d.shard for r in got for d in r.draws} <= set(range(mixing.SHARDS))


def test_hypergeometric_draws():
    rng = np.random.default_rng(1)
    for good, bad, take in ((5, 7, 4), (30, 2, 31), (1, 1, 1), (4, 0, 3), (0, 9, 5)):
        n = 20_000
        got = np.bincount([mixing.hypergeometric(rng, good, bad, take) for _ in range(n)], minlength=take + 1) / n
        for x in range(take + 1):
            p = math.comb(good, x) * math.comb(bad, take - x) / math.comb(good + bad, take) if x <= good and take - x <= bad else 0
            assert abs(got[x] - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9
    good, bad, take = 3 * 10**10, 7 * 10**10, 10**10  # beyond what numpy's own sampler takes
    got = np.array([mixing.hypergeometric(rng, good, bad, take) for _ in range(60)], float)
    sd = math.sqrt(take * 0.3 * 0.7 * 0.9)
    assert abs(got.mean() - take * 0.3) < 5 * sd / math.sqrt(60) and 0.6 * sd < got.std() < 1.5 * sd


def test_rows_that_share_an_id_are_taken_as_often_as_each_is(spark):
    rows = [(i // 2, f"w{i} " * (1 + i % 7), None, "ab"[i % 3 == 0], 0) for i in range(400)] + [(900, "x y", None, "a", 0)] * 9
    df = spark.createDataFrame(rows, SCHEMA)
    want = sum(r.taken for r in mixing.mix(df, block_rows=8).collect())
    got = [len(re.findall(WORD, r.text)) for r in mixing.mixed(df, block_rows=8).collect()]
    assert sum(got) == want


def test_mix_fills_beside_a_very_long_document(spark):
    rng = random.Random(9)
    sizes = [60_000] * 5 + [rng.randrange(20, 200) for _ in range(600)]
    rows = [(i, "w " * n, None, "a", 0) for i, n in enumerate(sizes)] + [(1000 + i, "w " * 100, None, "b", 0) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights=(1, 15), block_rows=16).collect()
    for s in "ab":
        mine = [r for r in got if r.source == s]
        gap = mine[0].target - sum(r.taken for r in mine)
        least = min(r.passes for r in mine)
        unused = [r.size for r in mine if r.passes == least]
        assert not any(abs(gap - n) < abs(gap) for n in unused), (s, gap)
        assert abs(gap) <= 100, (s, gap)


def test_splitting_tree():
    quotas = {"a": 5, "b": 0, "c": 1000, "d": 77}
    got = mixing.split(quotas, 7)
    assert all(sum(s[k] for s in got) == q for k, q in quotas.items())
    assert max(sum(s.values()) for s in got) - min(sum(s.values()) for s in got) <= 2
    assert got == mixing.split(quotas, 7) and got != mixing.split(quotas, 7, seed=1)


# 6


def test_quality_against_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "one two three one two three", "a b a b a b a"] + ["\n".join(" ".join(rng.choice(["xy", "q#", "é", "loooong", "A"]) for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    got = quality.assess(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        t = texts[r.doc_id] or ""
        w = re.findall(WORD, t)
        win = defaultdict(list)
        for i in range(len(w) - 2):
            win[tuple(w[i : i + 3])].append(i)
        rep = {i + j for at in win.values() if len(at) > 1 for i in at for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))
        assert r.base_failed == (len(w) < 50 or 100 * len(rep) > 50 * len(w)) and not (r.kept and r.base_failed)


def test_cascade_order_does_not_change_verdicts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a = {r.doc_id: r.kept for r in quality.assess(docs).collect()}
    b = {r.doc_id: r.kept for r in quality.assess(docs, rules=quality.RULES[::-1], sample_rows=5).collect()}
    assert a == b
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not any(a[i] for i, q in labels.items() if q == 0)
    order = quality.plan(docs)
    gain = [share / cost for _, cost, share in order]
    assert gain == sorted(gain, reverse=True)


# 7


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = html_extract.extract(pages).collect()
    assert len(got) == len(html)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        parts = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)[^>]*>", body))
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_markup_and_differencing(spark):
    page = lambda own: f"<body><div>Site name</div><p>{own} &amp; more</p><div>All pages have this</div></body>"
    rows = [
        (1, "http://h.example/a/1", page("first")),
        (2, "http://h.example/a/2", page("second")),
        (3, "http://h.example/b", page("third")),
        (4, "http://alone.example/", "<p>only <b>one</b>\n line<br>two</p>"),
        (5, None, "<p>no url</p>"),
        (6, "http://x.example/1", None),
        (7, "http://x.example/2", ""),
        (8, "http://c.example/same", "<p>copy</p>"),
        (8, "http://c.example/same", "<p>copy</p>"),
        (9, "http://c.example/same", "<p>copy</p>"),
        (10, "http://y.example/", "<header>top</header><nav>menu</nav><article><header><h1>T</h1></header><p>a<p>b<script>1<2</script><div class='reader-comments'><p>no</div><aside>no</aside><form>no</form></article><div class='cookie-notice'>no</div><footer>no"),
        (11, "http://z.example/", "<p>" * 3000 + "deep" + "<div" * 2000),
    ]
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert [g[:2] for g in got[:10]] == [(1, "first & more"), (2, "second & more"), (3, "third & more"), (4, "only one line\ntwo"), (5, "no url"), (6, ""), (7, ""), (8, "copy"), (8, "copy"), (9, "copy")]
    assert got[10][:2] == (10, "T\na\nb") and got[11][1].startswith("deep")
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_common_subsequence():
    rng = random.Random(7)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        got = html_extract.common(a, b)
        it = iter(b)
        assert len(got) == best[-1, -1] and got == sorted(set(got)) and all(a[i] in it for i in got)
    import time

    began = time.time()
    assert html_extract.common([1] * 10_000 + [2], [1] * 10_000 + [3]) == list(range(10_000))
    a, b = [3, *[1, 2] * 4000], [4, *[2, 1] * 4000]
    assert len(html_extract.common(a, b)) == 7999
    assert time.time() - began < 20


def test_markup_of_odd_pages():
    article, chrome, other = html_extract.ARTICLE, html_extract.CHROME_LINE, html_extract.OTHER
    for html, want in {
        '<p title="the hidden lake">Body</p>': [(other, "Body")],
        '<p data-x="see class=menu here">T</p>': [(other, "T")],
        "<p title=it's>A</p><p>b</p>": [(other, "A"), (other, "b")],
        '<p title="abc>x</p><p>y</p>': [(other, "x"), (other, "y")],
        '<p title=">">in</p>': [(other, "in")],
        '<div class="has-sidebar"><article>In</article></div>': [(article, "In")],
        '<article class="comment">c</article>': [(chrome, "c")],
        '<article><h1>t</h1><div class="related">r</div><p>z</p><article class="comment">cc</article></article>': [(article, "t"), (chrome, "r"), (article, "z"), (chrome, "cc")],
        '<article><div class="article-header"><h1>T</h1></div><p class="social-history">S</p></article>': [(article, "T"), (article, "S")],
        '<div class="comments"><article><p>reader</p></article></div>': [(chrome, "reader")],
        "<article>ok <math>x=1</math></article>": [(article, "ok x=1")],
        "x < y <3 <b>k</b>": [(other, "x < y <3 k")],
        "a<!-- b": [(other, "a")],
        "<ul class=comment-list><li class=comment>no</li></ul>": [(chrome, "no")],
    }.items():
        assert html_extract.lines(html) == want, html


def test_markup_in_linear_time():
    import time

    began = time.time()
    for piece in ("<a ", '<a "', '<p x="', "<a b='", "<!", "<!--", "</", "<p>", "&", "<script>", "<a b=c"):
        html_extract.lines(piece * (3_000_000 // len(piece)))
    assert time.time() - began < 120


def test_differencing_beside_and_without_articles(spark):
    body = lambda i: f"<article><p>Title {i}</p><p>A passage of many articles</p></article>"
    bare = lambda i: f"<p>Site</p><p>Title {i}</p><p>A passage of many articles</p><p>Imprint</p>"
    rows = [(i, f"http://h.example/a/{i}", body(i)) for i in range(3)] + [(10 + i, f"http://c.example/a/{i}", bare(i)) for i in range(3)] + [(20, "http://h.example/a/5", None), (20, "http://h.example/a/5", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Title {i}\nA passage of many articles" for i in range(3)} | {10 + i: f"Title {i}" for i in range(3)} | {20: ""}
    got = html_extract.extract(pages).collect()
    assert len(got) == len(rows) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)
    odd = pages.select("*", F.lit("q").alias("K"), F.lit("x").alias("lines"), F.lit(1).alias("id"))
    assert sorted(map(str, html_extract.extract(odd).collect())) == sorted(map(str, got))
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_differencing_decides_lines_beside_an_article(spark):
    page = lambda i: f"<p>Site</p><p>Lead {i}</p><article><p>Title {i}</p><p>A passage of many articles</p></article><p>Note {i}</p><p>Imprint</p>"
    rows = [(i, f"http://h.example/a/{i}", page(i)) for i in range(3)] + [(9, "http://alone.example/a/9", page(9))]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Lead {i}\nTitle {i}\nA passage of many articles\nNote {i}" for i in range(3)} | {9: "Title 9\nA passage of many articles"}


# 8


def test_language_accuracy_on_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_bundles_against_plain_sums():
    enc, rng = langid.Encoder(), random.Random(8)
    texts = ["", "ab", "a b", "Ça va", None] + ["".join(rng.choice("abé 1\n") for _ in range(40)) for _ in range(20)]
    got = enc.bundles(texts)
    for t, v in zip(texts, got, strict=True):
        a = [0]
        for ch in (t or "").lower():
            k = int(enc.number[ord(ch)])
            if k or a[-1]:
                a.append(k)
        if a[-1]:
            a.append(0)
        want = np.zeros(enc.dim)
        for i in range(1, len(a) - 1):
            if a[i]:
                want += enc.letter(a[i - 1]).astype(float) * np.roll(enc.letter(a[i]), 1) * np.roll(enc.letter(a[i + 1]), 2)
        assert np.array_equal(v, want)


# 9


def test_packing_round_trip(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "it's <|endoftext|> é漢\x00  'll  \n\n x" * 50), (-4, "y" * 30_000)], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    p = packing.pack(docs, PATH, keep_ids=True).toPandas()
    for i, g in p.groupby("doc_id"):
        g, ids = g.sort_values("piece"), [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        assert [x for ids_ in g.ids for x in ids_] == ids and list(g.piece) == list(range(len(g)))
        assert list(g.start) == [0, *np.cumsum(g.length)[:-1]] and (g.length.iloc[1:] == 1024).all()
        assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(g.ids, g.ids_crc32, strict=True))
    s = p.sort_values(["sequence_id", "offset"])
    end = s.offset + s.length
    assert (s.offset == end.shift(1).where(s.sequence_id == s.sequence_id.shift(1), 0)).all() and end.max() <= 1024
    assert p.sequence_id.nunique() <= -(-p.length.sum() // 1024) * 1.02 + 1
    again = packing.pack(docs.repartition(5), PATH).toPandas()
    cols = ["doc_id", "piece", "sequence_id", "offset"]
    assert again[cols].sort_values(cols).reset_index(drop=True).equals(p[cols].sort_values(cols).reset_index(drop=True))


def test_plan_of_bins():
    rng = random.Random(9)
    for _ in range(50):
        counts = {rng.randrange(1, 101): rng.randrange(1, 30) for _ in range(rng.randrange(1, 40))}
        plan = packing.plan(counts, 100)
        used = defaultdict(int)
        for many, lengths in plan:
            assert many > 0 and sum(lengths) <= 100 and sum(3 * n > 100 for n in lengths) <= 2
            for n in lengths:
                used[n] += many
        assert used == counts
        bins, total = sum(m for m, _ in plan), sum(n * c for n, c in counts.items())
        assert bins <= max(-(-total // 100) * 1.5 + 1, sum(c for n, c in counts.items() if n > 50) + sum(n * c for n, c in counts.items() if n <= 50) / 100 + 2)


# 10


def base_spans(t):
    rules = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, p in rules.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (kind == "card" and 16 <= len(d) <= 19 and luhn) or (kind == "phone" and 8 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_against_brute_force(spark, sf):
    rng = random.Random(10)
    made = ["".join(rng.choice("ab1.@+ -()_%é") for _ in range(80)) for _ in range(300)] + ["".join(rng.choice("0123456789. -+") for _ in range(200)) for _ in range(200)]
    made += [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 0001.002.3.255", "4111 1111-1111 1111 𝒳 +1 (234) 567-8900", "a.b." * 20000 + "@x.y" + ".z" * 20000, "1 " * 30000]
    docs = spark.createDataFrame([(-i, t) for i, t in enumerate(made, 1)], "doc_id long, text string").union(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.report(docs).collect():
        want = base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in pii.BASE], r
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r.spans.split(",")) | {""}


def test_validators_context_and_redaction(spark):
    text = "My iban DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00; ssn 123-45-6789, version 123-45-6789; mail a@b.co."
    r = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("findings", pii.redact(F.col("text"), F.col("findings")).alias("clean")).first()
    assert [(f.kind, f.match) for f in r.findings] == [("email", "a@b.co"), ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789")]
    assert r.clean == "My iban <IBAN>, not DE88 3704 0044 0532 0130 00; ssn <SSN>, version 123-45-6789; mail <EMAIL>."
    assert r.findings[1].score > pii.PRIOR["iban"]


def test_pii_context_on_both_sides_and_lists(spark):
    cases = {
        "SSN: 123-45-6789, 234-56-7890": ["ssn:5:16", "ssn:18:29"],
        "123-45-6789 (SSN)": ["ssn:0:11"],
        "123-45-6789 is a number": [],
        "IBAN DE89370400440532013000 BIC COBADEFFXXX": ["iban:5:27"],
        "GB82 WEST 1234 5698 7654 32 NOW": ["iban:0:27"],
        "order invoice GB82 WEST 1234 5698 7654 32 NOW": [],  # what surrounds it speaks against it
        "GB83 WEST 1234 5698 7654 32": [],  # its checksum fails
        "DNI 12345678Z, X1234567L and 12345678A": ["dni:4:13", "dni:15:24"],
        "version 12345678Z": [],
        "2 55 08 14 168 025 38 is her NIR": ["nir:0:21"],
        "2 55 08 14 168 025 39 is her NIR": [],
        "Steuer-ID 86 095 742 719": ["steuerid:10:24"],
        "86 095 742 719": [],
        "commit 04dbebab91ab85687d33eeaaf9ac699e1188f962": [],
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"': ["secret:9:49"],
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    for i, (text, want) in enumerate(cases.items()):
        assert [x for x in got[i].split(",") if x and x.split(":")[0] not in pii.BASE] == want, text


def test_pii_text_of_many_matches(spark):
    n = 6000
    words = [f"a{i}@b.co" if i % 2 else f"10.0.{i % 200}.{i // 300}" for i in range(n)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    r = pii.report(docs).first()
    want = base_spans(" ".join(words))
    assert (r.n_email, r.n_ip) == (n // 2, n // 2) and r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
    assert pii.redacted(docs).first().text == " ".join("<EMAIL>" if i % 2 else "<IP>" for i in range(n))


# all


def test_queries_with_sql(spark, sf):
    import os

    import duckdb

    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    for name, sql in queries.ORACLES.items():
        got, want = queries.QUERIES[name](spark, sf).toPandas(), c.sql(sql).df()
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols
        key = lambda d: sorted(map(tuple, d[cols].astype(object).where(d[cols].notna(), None).values.tolist()), key=str)  # noqa: B023, E731
        assert key(got) == key(want), name


def test_every_operator_has_a_query():
    assert {re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES} == {str(i) for i in range(1, 11)}


