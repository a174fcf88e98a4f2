"""The stages of the pipeline on a small corpus, each held against a plain version on its own input."""

import random
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from test_place_and_media import quality_texts  # noqa: E402
from test_text_dedup import linked, plain_lines, shingle_sets  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(9)
    texts = [t for t, _ in quality_texts(150)]
    line = "All rights of this line belong to every page of this corpus."
    texts = [t + "\n" + line if i % 4 == 0 else t for i, t in enumerate(texts)]
    texts += [texts[1], texts[1].replace(texts[1].split()[5], "changed", 1), texts[2], "", None]
    rows = [(i, t, "en", f"src{rng.randint(0, 3)}", len(t or ""), "more") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()} if k < 4 else seen
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        ids = sorted(before)
        if k == 0:
            kept = {r["doc_id"] for r in rows}
            assert sum((i in kept) == (i % 3 != 0) for i in range(150)) >= 146
            assert all(tuple(r) == tuple(before[r["doc_id"]]) for r in rows)
        elif k == 1:
            want = {i: t for i, (_, gone, t) in zip(ids, plain_lines([before[i]["text"] for i in ids], least=20), strict=True) if not gone or t.strip()}
            assert {r["doc_id"]: r["text"] for r in rows} == want
            assert all(r["n_chars"] == len(r["text"]) for r in rows) and {r["kept"] for r in rows} == {"more"}
        elif k == 2:
            roots = linked(shingle_sets([before[i]["text"] for i in ids], 5), 80)
            root_of = {i: roots[n] for n, i in enumerate(ids)}
            assert sorted(root_of[r["doc_id"]] for r in rows) == sorted(set(roots))
        elif k == 3:
            assert max(Counter(r["doc_id"] for r in rows).values()) <= 3 and all(tuple(r) == tuple(before[r["doc_id"]]) for r in rows)
            seen = Counter(r["doc_id"] for r in rows)
        else:
            assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == seen


def test_run_gives_the_same(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and rows.count() > 50


def test_stages_stand_null_and_repeated_ids(spark, folder, tmp_path):
    """A third of all rows has one doc_id, another has none, and each column's name is one that an operator uses itself."""
    texts = [t for t, q in quality_texts(120) if q] * 2
    rows = [([None, 7, i][i % 3], t, "en", f"s{i % 2}" if i % 5 else None, len(t), "m", 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None, None, None, None, None, None), (7, "", "", "", 0, "", 0, 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, row int, marks int, size int, copies int").repartition(3)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == before.columns, name
        if k == 0:
            assert docs.count() >= 156
        elif k == 2:
            assert sorted(r["text"] for r in docs.where("text <> ''").collect()) == sorted(set(r["text"] for r in before.where("text <> ''").collect()))
        elif k == 3:
            was, now = Counter(map(tuple, before.collect())), Counter(map(tuple, docs.collect()))
            assert set(now) <= set(was) and all(n <= 3 * was[r] for r, n in now.items())
        elif k == 4:
            assert docs.where("start = 0").count() == before.count()


def test_stages_stand_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
