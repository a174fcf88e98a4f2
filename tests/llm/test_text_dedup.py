import re
import string
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm.components import components
from tierline.llm.exact_dedup import exact_dedup, filtered
from tierline.llm.lines import dedup_lines, segment_keys, within
from tierline.llm.minhash import alike, bands_for, bitmap, near_duplicates
from tierline.llm.substring import COVER, PERIOD, remove_repeats
from tierline.llm.words import Words, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_words_are_the_runs_of_the_pattern(corpus):
    texts = [(x or "").encode() for x in corpus]
    words = Words(texts)
    flat = [words.data[a:b].tobytes().decode() for a, b in zip(words.begins, words.ends, strict=True)]
    assert flat == [w for x in corpus for w in WORD.findall(x or "")]
    assert words.counts.tolist() == [len(WORD.findall(x or "")) for x in corpus]
    by = defaultdict(set)
    for w, h in zip(flat, words.hashes.tolist(), strict=True):
        by[h].add(w)
    assert all(len(v) == 1 for v in by.values()) and len(by) == len(set(flat))


def test_runs_tell_sequences_apart():
    hashes = np.arange(50, dtype=np.uint64) % np.uint64(7)
    for n in (1, 2, 3, 5, 8, 20):
        got = runs(hashes, n).tolist()
        want = [tuple(hashes[i : i + n].tolist()) for i in range(50 - n + 1)]
        assert len(got) == len(want) and len(set(zip(got, want, strict=True))) == len(set(want)) == len(set(got))


def test_exact(make_docs, corpus, spark):
    docs = make_docs(corpus)
    groups = defaultdict(list)
    fold = lambda x: (x or "").translate(LOW)
    for i, x in enumerate(corpus):
        groups[fold(x)].append(i)
    for limit in (16 << 20, 300):  # in one range of digests, and in several
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs, broadcast_bytes=limit).collect()}
        assert got == {i: (max(groups[fold(x)]), len(groups[fold(x)]), i == max(groups[fold(x)])) for i, x in enumerate(corpus)}


def test_only_possible_repeats_are_grouped(spark):
    """Unique digests pass: of 20,000 hardly any looks repeated, and every repeated one does."""
    rows = spark.range(20_000).select("id", F.unhex(F.sha2(F.when(F.col("id") % 10 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), (F.col("id") - F.col("id") % 10 * F.col("id").isin(5, 15).cast("int")).cast("string"))), 256)).alias("digest"))
    for limit in (16 << 20, 50_000):
        probed, total = filtered(rows, 3, limit)
        told = probed.groupBy("digest").agg(F.count("*").alias("n"), F.max("maybe").alias("any"), F.min("maybe").alias("all")).collect()
        assert total == 20_000 == sum(r["n"] for r in told)
        assert all(r["all"] for r in told if r["n"] > 1) and sum(r["any"] for r in told if r["n"] == 1) < 60
    plan = probed.where("NOT maybe")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_exact_edge_cases(make_docs, spark):
    assert exact_dedup(make_docs([])).count() == 0
    rows = exact_dedup(make_docs(["a", "a", "A", None], ids=[None, None, 4, 4]).withColumn("keep_id", F.lit(1)).withColumn("digest", F.lit("x"))).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in rows) == [("4", "4", 1, True), ("4", "4", 3, True), ("None", "4", 3, False), ("None", "4", 3, False)]


def repeats(texts, window):
    seen, out = set(), []
    for x in texts:
        words = WORD.findall(x or "")
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            k = tuple(words[i : i + window])
            if k in seen:
                keep[i : i + window] = [False] * window
            seen.add(k)
        out.append((len(words), len(words) - sum(keep), " ".join(w for w, k in zip(words, keep, strict=True) if k)))
    return out


def test_cover_is_perfect():
    assert sorted((a - b) % PERIOD for a in COVER for b in COVER if a != b) == list(range(1, PERIOD))


@pytest.mark.parametrize("window", [14, 20])
def test_repeated_passages(make_docs, corpus, window):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeats(make_docs(corpus).repartition(5), window).collect()}
    assert [got[i] for i in range(len(corpus))] == repeats(corpus, window)


def test_repeated_passages_edge_cases(make_docs):
    text = " ".join(f"w{i}" for i in range(30))
    assert remove_repeats(make_docs([])).count() == 0
    rows = remove_repeats(make_docs([text, text, text, None], ids=[None, 3, 3, 3]).withColumn("marks", F.lit(1))).collect()
    # No key is the least key; the two equal rows of key 3 are one document, of which all words came before.
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in rows) == [("3", 0, 0), ("3", 30, 30), ("3", 30, 30), ("None", 30, 0)]
    with pytest.raises(ValueError):
        remove_repeats(make_docs([text]), window=PERIOD)


def shingle_sets(texts, size):
    out = []
    for x in texts:
        w = WORD.findall((x or "").translate(LOW))
        out.append(frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def linked(sets, percent):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(make_docs, corpus, size, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(make_docs(corpus), size, percent).collect()}
    sets = shingle_sets(corpus, size)
    roots = linked(sets, percent)
    assert got == {i: (len(sets[i]), roots[i], roots[i] == i) for i in range(len(corpus))}


def test_near_duplicates_edge_cases(make_docs):
    assert near_duplicates(make_docs([])).count() == 0
    rows = near_duplicates(make_docs(["a b c d e f", "a b c d e f", "", None], ids=[None, 5, 6, 7]).withColumn("component", F.lit(1))).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in rows) == [("5", 2, "5", True), ("6", 0, "6", True), ("7", 0, "7", True), ("None", 2, "None", True)]


def test_bitmaps_lose_no_link():
    rng = np.random.default_rng(1)
    sets = []
    for n in (50, 200, 800):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        for k in range(12):
            own = base.copy()
            own[: n * k // 40] = rng.integers(0, 2**63, n * k // 40).astype(np.uint64)
            sets.append(np.unique(own))
    sets.sort(key=len)
    sizes, maps = np.array([len(s) for s in sets]), [bitmap(s) for s in sets]
    got = set(alike(maps, maps, sizes, sizes, 80))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert (i, j) in got or 100 * both < 80 * (len(a) + len(b) - both)
    assert len(got) < len(sets) ** 2 / 2


def test_bands_miss_one_in_a_million():
    for percent in (80, 85, 95):
        assert (1 - (percent / 100) ** 5) ** bands_for(percent) <= 1e-6


def test_components_of_chains_stars_and_rings(spark):
    rng = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)] + [(300, 300)]
    links += [tuple(x) for x in rng.integers(400, 600, (150, 2)).tolist()] + links[:5]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent}
    assert got == {x: c for x, c in want.items() if x != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edit_distance_in_a_band():
    import random

    rng = random.Random(3)
    for _ in range(4000):
        a = rng.choices("abc", k=rng.randint(0, 14))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            i = rng.randint(0, len(b))
            if rng.random() < 0.4:
                b.insert(i, rng.choice("abc"))
            elif i < len(b):
                b[i : i + 1] = [] if rng.random() < 0.5 else [rng.choice("abc")]
        a, b, t = "".join(a), "".join(b), rng.randint(0, 4)
        assert within(a, b, t) == (plain_distance(a, b) <= t)


def test_lines_within_the_threshold_share_a_segment():
    import random

    rng = random.Random(4)
    for _ in range(500):
        a = "".join(rng.choices("abcdé😀", k=rng.randint(28, 60)))
        b = list(a)
        for _ in range(2):
            i = rng.randrange(len(b))
            b[i : i + 1] = rng.choice([[], ["q"], [b[i], "q"]])
        keys, owners = segment_keys([a, "".join(b)], 2)
        assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())


def plain_lines(texts, threshold=2, least=1, per=10):
    seen, out = [], []
    for x in texts:
        kept, gone = [], 0
        lines = (x or "").split("\n")
        for line in lines:
            near = lambda s: s == line or (abs(len(s) - len(line)) <= threshold and plain_distance(s, line) <= min(threshold, min(len(s), len(line)) // per))  # noqa: B023, E731
            if len(line) < least:
                kept.append(line)
            elif any(map(near, seen)):
                gone += 1
                seen.append(line)
            else:
                kept.append(line)
                seen.append(line)
        out.append((len(lines), gone, "\n".join(kept)))
    return out


def test_line_dedup(make_docs, corpus):
    texts = [x if x is None or len(x) < 700 else x[:700] for x in corpus]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_text"]) for r in dedup_lines(make_docs(texts).repartition(3)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_lines(texts)


def test_line_dedup_edge_cases(make_docs):
    line = "The quick brown fox jumps over the lazy dog"
    assert dedup_lines(make_docs([])).count() == 0
    docs = make_docs([line, line + "!", line, line, None, "\n\n"], ids=[2, 1, None, 7, 8, 9])
    got = sorted((str(r["doc_id"]), r["n_removed"], r["kept_text"], r["n_chars"]) for r in dedup_lines(docs, carry=("n_chars",)).collect())
    assert got == [("1", 1, "", 44), ("2", 1, "", 43), ("7", 1, "", 43), ("8", 0, "", 0), ("9", 0, "\n\n", 2), ("None", 0, line, 43)]


@pytest.mark.parametrize(("least", "per"), [(20, 10), (1, 10), (1, 1), (0, 3)])
def test_line_dedup_of_short_lines(make_docs, least, per):
    """Lines of 0 to 40 code points: no length is left out."""
    import random

    rng = random.Random(least)
    texts = ["All rights reserved.\nAll rights reserved\nSign up for our news"] * 3 + ["Sign up for our new.\n😀😀😀😀😀\n😀😀", "😀😀😀😀😀\nSign in for our news"]
    texts += ["\n".join("".join(rng.choices("abcdefgh", k=rng.randint(0, 9))) for _ in range(3)) for _ in range(12)]
    for n in range(1, 41):
        line = "".join(rng.choices("abcdefgh", k=n))
        texts.append("\n".join([line, line[1:] + "z", line[: n // 2] + "yy" + line[n // 2 :], line]))
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_text"]) for r in dedup_lines(make_docs(texts).repartition(3), least=least, per=per).collect()}
    want = plain_lines(texts, least=least, per=per)
    assert [got[i] for i in range(len(texts))] == want


def test_line_dedup_of_long_lines_and_clashing_names(make_docs):
    import random

    rng = random.Random(8)
    long = "".join(rng.choices("abcdef ", k=1_500_000))
    docs = make_docs([long, long[:700_000] + "x" + long[700_000:], "short\n" + long[:-1] + "\nshort"]).withColumns({c: F.lit(c) for c in ("marks", "doc", "twin", "tasks", "n_removed", "c0")})
    rows = sorted(dedup_lines(docs, carry=("marks", "doc", "twin", "n_removed", "c0")).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_lines"], r["n_removed"], len(r["kept_text"])) for r in rows] == [(1, 0, 1_500_000), (1, 1, 0), (3, 2, 5)]
    assert rows[0].asDict().keys() == {"doc_id", "n_lines", "n_removed", "kept_text", "marks", "doc", "twin", "c0"} and rows[2]["twin"] == "twin"


def test_short_lines_within_the_threshold_share_a_key():
    from itertools import product

    lines = ["".join(x) for n in range(5) for x in product("ab", repeat=n)] + ["abcdef", "bcde", "abcd", "aXbcYd"]
    keys, owners = segment_keys(lines, 2)
    of = [set(keys[owners == i].tolist()) for i in range(len(lines))]
    for i, a in enumerate(lines):
        assert all(of[i] & of[j] for j, b in enumerate(lines) if plain_distance(a, b) <= 2)


def test_rows_that_repeat_key_and_text_keep_the_first(make_docs):
    line, near = "The quick brown fox jumps over the lazy dog", "The quick brown fox jumps over the lazy cat"
    other = "Another line that nothing else in here comes near"
    words = " ".join(f"w{i}" for i in range(30))
    for ids in ([None, None], [5, 5]):
        for parts in (1, 2):
            rows = dedup_lines(make_docs([line, line], ids=ids).repartition(parts)).collect()
            assert [(r["n_removed"], r["kept_text"]) for r in rows] == [(0, line)] * 2
            text = f"{line}\n{other}\n{line}"
            rows = dedup_lines(make_docs([text, text, near.replace("cat", "dot")], ids=[*ids, 7]).repartition(parts)).collect()
            assert sorted((r["n_removed"], r["kept_text"]) for r in rows) == [(1, "")] + [(1, f"{line}\n{other}")] * 2
            rows = remove_repeats(make_docs([words, words], ids=ids).repartition(parts)).collect()
            assert [(r["n_removed"], r["kept_text"]) for r in rows] == [(0, words)] * 2
            rows = remove_repeats(make_docs([words + " " + words, words + " " + words, words], ids=[*ids, 7]).repartition(parts)).collect()
            assert sorted((r["n_removed"], r["kept_text"]) for r in rows) == [(30, ""), (30, words), (30, words)]
