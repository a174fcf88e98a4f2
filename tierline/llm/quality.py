"""A quality classifier whose evidence is combined with what its site and section are like: hierarchical empirical Bayes.

A logistic model of style features gives each document its evidence. The documents of a site (source) and of a section in it
(path, here the language part) together give these a posterior share of good documents: each level's share shrinks toward its
parent's by a strength that is itself estimated from how much the siblings differ, so that a sparse section says what its
site says and a sparse site what all sites say. A document's odds are those of its evidence, with the global share in the
classifier's prior replaced by its section's, as the other documents tell it: its own evidence is left out of every level, so
that it does not count twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import durable, lookup, plain_names
from tierline.llm.words import Words, blocks

BLOCK = 1 << 19
#: Labels that the model is fitted on, at most: those with the least hash.
SAMPLE = 20_000

FEATURES = (
    "log_words", "word_bytes", "distinct", "repeated", "upper", "digits", "ends", "shouts", "bars", "other_marks", "high_bytes", "log_lines", "line_words",
    "log_top", "blank",
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CLASSES = [
    _table(bytes(range(65, 91))), _table(b"0123456789"), _table(b".,;:?"), _table(b"!"), _table(b"|"), _table(b"\"#$%&'()*+-/<=>@[\\]^_`{}~"), _table(bytes(range(128, 256))), _table(b"\n"),
]


def features(texts: list[bytes]) -> np.ndarray:
    """One row a text; all features of an empty text are 0."""
    words = Words(texts, lower=True)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.diff(words.edges)
    out = np.zeros((len(texts), len(FEATURES)))
    full = np.flatnonzero((sizes > 0) & (words.counts > 0))
    if not len(full):
        return out
    bytes_, counts = sizes[full].astype(float), words.counts[full].astype(float)
    marks = []
    for table in _CLASSES:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        marks.append((sums[words.edges[full + 1]] - sums[words.edges[full]]).astype(float))
    of = words.text_of_word()
    same = np.zeros(len(of), np.int64)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((words.hashes, of))
    hashes, owners = words.hashes[order], of[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])]
    distinct = np.bincount(owners[new], minlength=len(texts))[full]
    starts = np.flatnonzero(new)
    top = np.zeros(len(texts))
    np.maximum.at(top, owners[starts], np.diff(np.append(starts, len(owners))))
    word_bytes = np.bincount(of, words.ends - words.begins, len(texts))[full]
    lines = marks[7] + 1
    columns = [
        np.log1p(counts), word_bytes / counts, distinct / counts**0.8, np.bincount(of, same, len(texts))[full] / counts, *[m / bytes_ for m in marks[:7]],
        np.log1p(lines), np.log1p(counts / lines), np.log(top[full] / counts), (bytes_ - word_bytes) / bytes_,
    ]
    out[full] = np.stack(columns, axis=1)
    return out


@dataclass
class Model:
    """Standardised logistic regression; shares above or below `clip` log-odds count as that."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float  # share of good rows that it was fitted on

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(np.concatenate([z, z**2], axis=1) @ self.weights + self.bias, -30, 30)


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> Model:
    """By Newton's method with a ridge penalty, on features and their squares. Without both classes it knows the prior only."""
    prior = float((y.sum() + 1) / (len(y) + 2))
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    model = Model(mean, scale, np.zeros(2 * len(FEATURES)), float(np.log(prior / (1 - prior))), prior)
    if len(x) == 0 or y.min() == y.max():
        return model
    z = np.clip((x - mean) / scale, -8, 8)
    z = np.concatenate([z, z**2, np.ones((len(z), 1))], axis=1)
    w = np.r_[np.zeros(2 * len(FEATURES)), model.bias]
    ridge = np.r_[np.full(2 * len(FEATURES), penalty), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def feature_rows(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """The columns of carry and x, the features of the text (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "_text", BLOCK):
            x = features(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(carry))], lists], names=[*carry, "x"])

    rows = docs.select(*carry, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(run, f"{kinds}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model of label (0 or 1; other rows of labels are left out), fitted on the documents of sample labels at most.

    The labels of least hash are taken, the same in each run; so few are broadcast, and no text shuffles. Of documents that
    share a labelled key, the one of least hash counts, so no more than sample rows come to the driver. Without labels, the
    model knows an even prior only.
    """
    docs = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).distinct()
    some = known.orderBy(F.xxhash64("k", "y"), "k", "y").limit(sample)
    rows = docs.join(F.broadcast(some), "k").withColumn("h", F.xxhash64("k", "text"))
    one = feature_rows(rows, "text", ["k", "y", "h"]).groupBy("k", "y").agg(F.min(F.struct("h", "x")).alias("row"))
    got = one.select("y", "row.*").toPandas().sort_values(["h", "y"])
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def _strength(level: DataFrame, good: str, count: str, parent: str) -> float:
    """How many documents the parent's share counts as, by the method of moments over a level's groups (at most 10,000)."""
    p = F.col(good) / F.col(count)
    row = level.where(f"{count} > 1").agg(
        F.sum(F.col(count) * (p - F.col(parent)) * (p - F.col(parent))).alias("spread"), F.sum(F.col(parent) * (1 - F.col(parent))).alias("noise"), F.sum(F.col(count) - 1).alias("n"), F.avg(F.col(parent) * (1 - F.col(parent))).alias("unit")
    ).first()
    if not row["n"] or not row["unit"]:
        return 10_000.0
    between = max(0.0, (row["spread"] - row["noise"]) / row["n"])  # variance of the groups' true shares
    return float(min(10_000.0, max(1.0, row["unit"] / between - 1))) if between > 0 else 10_000.0


def site_sums(scored: DataFrame) -> DataFrame:
    """(site, path, good, docs, site_good, site_docs, all_good, all_docs, site_k, path_k) of scored (site, path, p).

    p is a document's own chance to be good; good and docs are sums over a section, a site and all; the strengths are those of
    a level's parent. Sums by section come first, of which the others are made: no group's rows meet in one task.
    """
    paths = durable(scored.groupBy("site", "path").agg(F.sum("p").alias("good"), F.count("*").alias("docs")))
    sites = paths.groupBy("site").agg(F.sum("good").alias("site_good"), F.sum("docs").alias("site_docs"))
    everything = sites.agg(F.sum("site_good").alias("g"), F.sum("site_docs").alias("n")).first()
    all_good, all_docs = float(everything["g"] or 0.0), int(everything["n"] or 0)
    sites = durable(sites.withColumn("global", F.lit((all_good + 1) / (all_docs + 2))))
    site_k = _strength(sites, "site_good", "site_docs", "global")
    sites = sites.withColumn("host_share", (F.col("site_good") + site_k * F.col("global")) / (F.col("site_docs") + site_k))
    joined = durable(lookup(paths, sites.withColumn("weight", F.col("site_docs")), ["site"], "weight", all_docs))
    path_k = _strength(joined, "good", "docs", "host_share")
    alike = {"all_good": all_good, "all_docs": all_docs, "site_k": site_k, "path_k": path_k}
    return joined.select("site", "path", "good", "docs", "site_good", "site_docs", *[F.lit(v).alias(k) for k, v in alike.items()])


def shares(p: Column) -> tuple[Column, Column]:
    """The share of good documents of a row's site and of its section, without p, the row's own part of the sums."""
    others = (F.col("all_good") - p + 1) / (F.col("all_docs") + 1)
    host = (F.col("site_good") - p + F.col("site_k") * others) / (F.col("site_docs") - 1 + F.col("site_k"))
    return host, (F.col("good") - p + F.col("path_k") * host) / (F.col("docs") - 1 + F.col("path_k"))


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify(docs: DataFrame, model: Model, text: str = "text", site: str = "source", path: str = "lang", carry: tuple[str, ...] = ("doc_id",), least: float = 0.5) -> DataFrame:
    """One row for each row of docs: the columns of carry, evidence, doc_share, host_share, path_share, quality, kept.

    evidence is the log-odds that the document is good by its text alone, less those of the classifier's prior; quality adds
    the log-odds of its section's share, without the document's own part of it; kept says that quality is at least `least`. A
    null site or path is a site or path of its own; a null text is an empty one. An empty table gives an empty result; repeated
    rows are rows like others. Columns of docs may have any names; of those in carry, one that is called like a column of the
    result's own gives way to it. Others are not read.
    """
    weights, bias = model.weights, model.bias - float(np.log(model.prior / (1 - model.prior)))
    told_by = Model(model.mean, model.scale, weights, bias, model.prior)
    own = ("evidence", "doc_share", "host_share", "path_share", "quality", "kept")
    carry = tuple(c for c in carry if c not in own)
    group = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    named, of = plain_names(docs, list(dict.fromkeys([text, site, path, *carry])))
    held, read = [of[c] for c in carry], of[text]
    rows = named.select(*dict.fromkeys([*held, read]), group(of[site]).alias("site"), group(of[path]).alias("path"))

    def evidence(df: DataFrame, drop: bool) -> DataFrame:
        names = [c for c in df.columns if not (drop and c == read)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in blocks(batches, read, BLOCK):
                yield batch.select(names).append_column("evidence", pa.array(told_by.logits(features(texts))))

        return df.mapInArrow(run, ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names) + ", evidence double")

    whole = text in carry  # then texts are read twice rather than written once more
    scored = evidence(rows.select("site", "path", read), True) if whole else durable(evidence(rows, True))
    prior = float(np.log(model.prior / (1 - model.prior)))
    chance = 1 / (1 + F.exp(-(F.col("evidence") + prior)))
    sums = site_sums(scored.select("site", "path", chance.alias("p")))
    total = sums.agg(F.sum("docs")).first()[0] or 0
    joined = lookup(rows if whole else scored, sums, ["site", "path"], "docs", total)
    joined = evidence(joined, False) if whole else joined
    host, share = shares(chance)
    told = joined.withColumns({"own": chance, "host": host, "share": share})
    quality = 1 / (1 + F.exp(-(F.col("evidence") + log_odds(F.col("share")))))
    return told.select(*[F.col(h).alias(c) for h, c in zip(held, carry, strict=True)], "evidence", F.col("own").alias("doc_share"), F.col("host").alias("host_share"), F.col("share").alias("path_share"), quality.alias("quality"), (quality >= least).alias("kept"))
