"""The registered queries themselves, over a small table with odd rows, against plain versions of what they must return."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tierline.llm import gif, secrets
from tierline.llm.queries import QUERIES

pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRETS = ["password = hunter22 and token: abc", "AKIA" + "Q7" * 10 + " AKIA1", "sum " + "0af3" * 8 + " " + "ab" * 11, "api_key='zzzzzzzz' secret:tiny Passwd=long_enough", "éé token=abcdef.-_=", "TOKEN  :  'x/y+z=1'"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Documents: null and empty texts, repeated rows, equal texts, sources that are null, columns of an operator's own names, one text of megabytes."""
    rng = random.Random(11)
    say = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(n))
    texts = [say(rng.choice([0, 1, 3, 30, 200])) for _ in range(90)] + SECRETS + [None, None, "", "  \n ", "Ünï cödé 😀"]
    texts += [texts[3], texts[3].upper(), texts[7], say(40) + "\n" + say(40)] + [say(700_000)]
    rows = [(i, t, ["en", "de", None][i % 3], ["b", "a", None, "c", "B"][i % 5], len(t or ""), i, "x", 1, 2, 3) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("queries"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, row int, doc int, marks int"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(len(texts[i] or "") > 20), 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{folder}/empty/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/empty/embeddings.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/empty/labels.parquet")
    return folder, texts, [r[3] for r in rows]


def answers(spark, name, folder):
    return sorted((r.asDict() for r in QUERIES[name](spark, folder).collect()), key=lambda r: r["doc_id"])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_an_empty_table_gives_no_rows(spark, table, name):
    assert QUERIES[name](spark, f"{table[0]}/empty").count() == 0


def test_op1(spark, table):
    folder, texts, sources = table
    sizes = [len(WORD.findall(t or "")) for t in texts]
    of = defaultdict(int)
    for s, n in zip(sources, sizes, strict=True):
        of[s] += n
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, open_, left = {}, set(names), sum(sizes)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > 3 * of[s]}
        if not full:
            targets |= {s: unit * weights[s] for s in open_}
            break
        targets |= {s: 3.0 * of[s] for s in full}
        left -= sum(3 * of[s] for s in full)
        open_ -= full
    got = answers(spark, "op1_mix_sources", folder)
    assert [r["doc_id"] for r in got] == list(range(len(texts))) and [r["size"] for r in got] == sizes
    assert all(r["source_size"] == of[sources[r["doc_id"]]] and r["target"] == pytest.approx(targets[sources[r["doc_id"]]]) for r in got)
    assert all(r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"] for r in got)
    for s in names:
        own = [r for r in got if sources[r["doc_id"]] == s]
        rate = targets[s] / of[s] if of[s] else 1
        assert all(not r["size"] or r["taken"] // r["size"] in (math.floor(rate + 1e-9), math.ceil(rate - 1e-9)) for r in own)
        if max(r["size"] for r in own) < 1000:
            assert abs(sum(r["taken"] for r in own) - targets[s]) <= max(30, 0.02 * targets[s])
    assert got == answers(spark, "op1_mix_sources", folder)


def test_op3(spark, table):
    folder, texts, _ = table
    got = answers(spark, "op3_shards", folder)
    by = defaultdict(list)
    for r, t in zip(got, texts, strict=True):
        raw = (t or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        by[r["shard"]].append(r["slot"])
    assert set(by) == set(range(8)) and all(sorted(v) == list(range(len(v))) for v in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_op5(spark, table):
    folder, texts, _ = table
    for r, t in zip(answers(spark, "op5_gif", folder), texts, strict=True):
        raw = (t or "").encode()
        payload = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
        frames = -(-len(payload) // (192 * gif.HEIGHT))
        bins = [0] * 64
        for b in payload if len(payload) < 100_000 else b"":  # bits 7 and 6 of a byte, 4 and 3, 1 and 0 are the high bits of its colour
            bins[(b >> 6) << 4 | (b >> 3 & 3) << 2 | b & 3] += 1
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        head, shown, histogram = r["feature"].split(":")
        assert (int(head), int(shown)) == (frames, frames * gif.DELAY_MS)
        assert [int(x) for x in histogram.split(",")] == bins if sum(bins) else sum(map(int, histogram.split(","))) == len(payload)
        image = gif.store(payload)
        assert (r["media_bytes"], r["media_sha256"]) == (len(image), hashlib.sha256(image).hexdigest()) and b"".join(p for p, _ in gif.restore(image)) == payload


def test_op8(spark, table):
    folder, texts, _ = table
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = 0
    for r, t in zip(answers(spark, "op8_secrets", folder), texts, strict=True):
        base = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t or "") if len(m[2]) >= 6]
        base += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t or "") if len(m[0]) >= 20]
        base += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t or "") if len(m[0]) >= 24]
        told = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(base))
        count = lambda k: sum(x[2] == k for x in base)  # noqa: B023, E731
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (count("assign"), count("access"), count("hex"))
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        every = sorted([(a, secrets.KINDS.index(k), k, b) for a, k, b in secrets.confirmed_spans(t or "")] + base)
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, k, b in every)
        found += len(base)
    assert found >= 7


def test_op9(spark, table):
    import public_tokenizers
    from tokenizers import Tokenizer

    folder, texts, _ = table
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in answers(spark, "op9_packing", folder):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            own = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))) and len(own) == r["length"] > 0
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024


def test_op10(spark, table):
    """Posteriors from the evidence that the query tells, level by level, each document left out of its own."""
    from tierline.llm.queries import quality_model

    folder, texts, sources = table
    got = answers(spark, "op10_quality", folder)
    langs = [["en", "de", None][i % 3] for i in range(len(texts))]
    prior = quality_model(spark, folder).prior
    p = [1 / (1 + math.exp(-(r["evidence"] + math.log(prior / (1 - prior))))) for r in got]
    assert [r["doc_share"] for r in got] == pytest.approx(p)

    def strength(groups, parent):
        n, spread, noise, unit = 0, 0.0, 0.0, []
        for key, own in groups.items():
            if len(own) > 1:
                q = parent(key)
                spread += len(own) * (sum(own) / len(own) - q) ** 2
                noise += q * (1 - q)
                unit.append(q * (1 - q))
                n += len(own) - 1
        if not n:
            return 10_000.0
        between = max(0.0, (spread - noise) / n)
        return min(10_000.0, max(1.0, sum(unit) / len(unit) / between - 1)) if between > 0 else 10_000.0

    sites, paths = defaultdict(list), defaultdict(list)
    for i, x in enumerate(p):
        sites[sources[i]].append(x)
        paths[sources[i], langs[i]].append(x)
    overall = (sum(p) + 1) / (len(p) + 2)
    k_site = strength(sites, lambda _: overall)
    host = {s: (sum(v) + k_site * overall) / (len(v) + k_site) for s, v in sites.items()}
    k_path = strength(paths, lambda key: host[key[0]])
    for i, r in enumerate(got):
        others = (sum(p) - p[i] + 1) / (len(p) + 1)
        own, section = sites[sources[i]], paths[sources[i], langs[i]]
        h = (sum(own) - p[i] + k_site * others) / (len(own) - 1 + k_site)
        share = (sum(section) - p[i] + k_path * h) / (len(section) - 1 + k_path)
        quality = 1 / (1 + math.exp(-(r["evidence"] + math.log(share / (1 - share)))))
        assert (r["host_share"], r["path_share"], r["quality"]) == pytest.approx((h, share, quality)) and r["kept"] == (r["quality"] >= 0.5)


@pytest.mark.parametrize("name", ["op2_near_dedup", "op4_line_dedup", "op6_repeated_passages", "op7_exact_dedup"])
def test_queries_of_text_dedup(spark, table, name):
    from test_text_dedup import LOW, linked, plain_lines, repeats, shingle_sets

    folder, texts, _ = table
    got = answers(spark, name, folder)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if name == "op2_near_dedup":
        sets = shingle_sets(texts, 3)
        roots = linked(sets, 85)
        assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in got] == [(len(s), c, c == i) for i, (s, c) in enumerate(zip(sets, roots, strict=True))]
    elif name == "op4_line_dedup":
        assert [(r["n_lines"], r["n_removed"], r["kept_sha256"]) for r in got] == [(a, b, digest(c)) for a, b, c in plain_lines(texts)]
    elif name == "op6_repeated_passages":
        assert [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got] == [(a, b, digest(c)) for a, b, c in repeats(texts, 20)]
    else:
        fold = [(t or "").translate(LOW) for t in texts]
        last = {t: i for i, t in enumerate(fold)}
        assert [(r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got] == [(last[t], fold.count(t), last[t] == i, digest(t)) for i, t in enumerate(fold)]
