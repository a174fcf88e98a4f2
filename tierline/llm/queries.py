"""One query an operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.alignment import align_tokenizers
from tierline.llm.common import documents
from tierline.llm.exact_dedup import exact_dedup
from tierline.llm.gif import store_bytes
from tierline.llm.mixing import mix_sources
from tierline.llm.licenses import LICENSE_WORD, PHRASES, TEMPLATES, label_columns, scan_licenses
from tierline.llm.lines import dedup_lines
from tierline.llm.minhash import near_duplicates
from tierline.llm.negatives import hard_negatives
from tierline.llm.packing import pack_documents
from tierline.llm.quality import Model, classify, train
from tierline.llm.secrets import KINDS, scan_secrets
from tierline.llm.sharding import hypergeometric_shuffle
from tierline.llm.substring import remove_repeats


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; it must be at the same path on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir), weights=(5, 2, 1), most=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=3, percent=85)


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = hypergeometric_shuffle(rows, 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(documents(spark, sf_dir), threshold=2)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", F.encode("text", "UTF-8").alias("payload"))
    stored = store_bytes(rows, "doc_id", "payload")
    feature = F.concat_ws(":", F.col("frames").cast("string"), F.col("shown_ms").cast("string"), F.array_join("histogram", ",")).alias("feature")
    return stored.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature)


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(documents(spark, sf_dir), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path(), capacity=1024, end_id=0)


def quality_model(spark: SparkSession, sf_dir: str) -> Model:
    """Fitted on a bounded sample of the labelled documents."""
    return train(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), quality_model(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))[0]


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = label_columns()
    return scan_licenses(documents(spark, sf_dir)).select("doc_id", "n_words", *[c.alias(n) for n, c in told.items()], "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mix_sources, op2_near_dedup, op3_shards, op4_line_dedup, op5_gif, op6_repeated_passages, op7_exact_dedup, op8_secrets, op9_packing, op10_quality, op11_hard_negatives, op12_alignment, op13_licenses)}

#: A-Z in lower case and nothing else, as DuckDB has it.
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_quoted = lambda x: "'" + x.replace("'", "''") + "'"
_listed = lambda rows: ", ".join(f"({', '.join(map(_quoted, r))})" for r in rows)

_LICENSES = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLD}, '{LICENSE_WORD}') AS w FROM documents),
         t AS (SELECT row_number() OVER () AS t, label, regexp_extract_all({_FOLD}, '{LICENSE_WORD}') AS w FROM (VALUES {_listed(TEMPLATES)}) v(label, text)),
         p AS (SELECT label, string_split(phrase, ' ') AS w FROM (VALUES {_listed(PHRASES)}) v(phrase, label)),
         di AS (SELECT r, i, w[i + 1:i + 2] AS two, w[i + 1:i + 4] AS four FROM (SELECT r, w, unnest(range(len(w))) AS i FROM d)),
         b AS (SELECT r, i, label FROM di JOIN p ON two = w[1:2] AND four[1:len(w)] = w),
         bg AS (SELECT r, count(*) AS n, min(i) AS low, max(i) AS high, list(DISTINCT label) AS labels FROM b GROUP BY r),
         tg AS (SELECT t, label, i AS f, w[i + 1:i + 4] AS g, len(w) - 3 AS n FROM (SELECT *, unnest(range(len(w) - 3)) AS i FROM t)),
         h AS (SELECT r, i, t, label, f, n, i - f AS diagonal FROM di JOIN tg ON four = g),
         nw AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) > 5, false) AS new FROM h),
         sp AS (SELECT *, sum(new::int) OVER (PARTITION BY r, t ORDER BY diagonal) AS span FROM nw),
         sh AS (SELECT r, label, count(DISTINCT f) / any_value(n) AS share FROM sp GROUP BY r, t, label, span),
         sg AS (SELECT r, max(share) AS score, list(DISTINCT label) FILTER (share >= 0.6) AS labels FROM sh GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(bg.n, 0) AS n_base, low AS first_word, high AS last_word,
           coalesce(array_to_string(list_sort(bg.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bg.labels, []), coalesce(sg.labels, [])))), ','), '') AS labels,
           coalesce(score, 0.0)::double AS score
    FROM d LEFT JOIN bg ON d.r = bg.r LEFT JOIN sg ON d.r = sg.r"""

ORACLES: dict[str, str] = {
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_FOLD} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)""",
    "op6_repeated_passages": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS p FROM d WHERE len(w) >= 20),
             h AS (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(w[p:p + 19], ' ') ORDER BY doc_id, p) AS n FROM s),
             c AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS i FROM h WHERE n > 1),
             r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
               sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' '), '')) AS kept_sha256
        FROM d LEFT JOIN r ON d.doc_id = r.doc_id""",
    "op13_licenses": _LICENSES,
    "op11_hard_negatives": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::bigint + 1) % 10 ELSE label::bigint END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::double)) AS q
                   FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, a.label AS anchor_label, b.r, b.vec_id, b.label, list_dot_product(a.q, b.q)::bigint AS score
                   FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
             p AS (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, r) AS k FROM s WHERE label = anchor_label),
             n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                          row_number() OVER (PARTITION BY p.ar, k ORDER BY s.score DESC, s.vec_id, s.r) AS rank
                   FROM p JOIN s ON p.ar = s.ar AND s.label <> p.label AND 80 * p.score <= 100 * s.score AND s.score <= p.score WHERE k <= 5)
        SELECT anchor_id, positive_id, rank::int AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
