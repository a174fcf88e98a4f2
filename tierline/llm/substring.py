"""Removing repeated passages: windows of words, found by difference-cover anchors.

Anchors, short runs of words, are hashed at the positions of a document that lie in a difference cover modulo a period. Two
equal windows anywhere in the corpus contain, at the same offset, an anchor at which both positions are in the cover; so
only windows around repeated anchors can repeat, and only these are hashed in full and compared by first occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import NO_ID, partitions_for, plain_names
from tierline.llm.places import BY_DOCUMENT, PACKED, PLACE, gather, later, packed_batch, resolve, send, several
from tierline.llm.words import Words, blocks, runs

#: A perfect difference cover: each residue modulo 13 is a difference of two of these (fixed values).
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Bytes of text handled at once, and of text whose anchors, or all of whose windows, one bucket takes.
BLOCK, BUCKET, WINDOW_BUCKET = 2 << 20, 24 << 20, 12 << 20


def _places(batch: pa.RecordBatch, words: Words, which: np.ndarray, texts: np.ndarray, ats: np.ndarray) -> np.ndarray:
    out = np.empty(len(which), PLACE)
    out["doc"], out["twin"] = (batch.column(i).to_numpy()[texts[which]] for i in (0, 1))
    out["at"] = ats[which]
    return out


def _anchors(window: int, anchor: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_cover = np.isin(np.arange(PERIOD), COVER)
        for batch, texts in blocks(batches, "text", BLOCK):
            words = Words(texts)
            of, at = words.text_of_word(), words.place()
            size = words.counts[of]
            use = np.flatnonzero(in_cover[at % PERIOD] & (at + anchor <= size) & (size >= window))
            if len(use):
                keys = runs(words.hashes, anchor)[use]
                yield packed_batch(send(keys[:, None], _places(batch, words, use, of, at), buckets, True))

    return run


def _windows(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text", BLOCK):
            words = Words(texts)
            of, at = words.text_of_word(), words.place()
            near = np.zeros(len(of) + 1, np.int64)
            for i, marks in enumerate(batch.column(3).to_pylist()):
                anchors = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in marks]))
                np.add.at(near, words.first[i] + np.maximum(anchors - (PERIOD - 1), 0), 1)
                np.add.at(near, words.first[i] + anchors + 1, -1)
            use = np.flatnonzero((np.cumsum(near)[:-1] > 0) & (at + window <= words.counts[of]))
            if len(use):
                keys = np.stack([runs(words.hashes, window, salt)[use] for salt in (1, 1 << 40)], axis=1)
                yield packed_batch(send(keys, _places(batch, words, use, of, at), buckets, False))

    return run


def _rewrite(window: int, key: str):
    names = [key, "n_words", "n_removed", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text", BLOCK):
            rows = []
            for text, marks in zip(texts, batch.column(3).to_pylist(), strict=True):
                words = text.split()
                count, removed = len(words), 0
                if marks:
                    starts = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in marks]))
                    edge = np.zeros(count + 1, np.int64)
                    edge[starts] += 1
                    edge[starts + window] -= 1
                    keep = np.cumsum(edge)[:count] == 0
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                    removed = count - len(words)
                rows.append((count, removed, b" ".join(words).decode()))
            kinds = [pa.int64(), pa.int64(), pa.string()]
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]], names=names)

    return run, f"`{key}` long, n_words long, n_removed long, kept_text string"


def remove_repeats(docs: DataFrame, window: int = 20, text: str = "text", key: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """One row for each row of docs: key, n_words, n_removed and kept_text (kept words joined by one space).

    Removed are the words of every window of consecutive words whose sequence also starts earlier: in a row with a smaller
    key, or before it in the same row. A null key is the smallest; rows that share a key are ordered by position, then by a
    hash of the text; rows that repeat both key and text are one document and are treated alike. A null text has no words. A
    document of fewer words than the window loses none. An empty table gives an empty result; other columns are not read.
    window must be above PERIOD. Windows are compared by 96 bits of hash.
    """
    if window <= PERIOD:
        raise ValueError(f"a window of {window} words is not above the period, {PERIOD}")
    spark = docs.sparkSession
    anchor = window - PERIOD + 1
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
        buckets = partitions_for(spark, size, BUCKET)
    rows, of = plain_names(docs, [key, text])
    body = F.coalesce(F.col(of[text]), F.lit(""))
    rows = rows.select(F.coalesce(F.col(of[key]), F.lit(NO_ID)).cast("long").alias("doc"), F.xxhash64(body).alias("twin"), body.alias("text"))

    def marked(found: DataFrame, how: str) -> DataFrame:
        gathered = found.groupBy("doc", "twin").agg(F.collect_list("ats").alias("marks"))
        return rows.join(gathered, ["doc", "twin"], how).select("doc", "twin", "text", "marks")

    def resolved(sent: DataFrame, width: int, judge, buckets: int) -> DataFrame:
        found = sent.repartition(buckets, "bucket").mapInArrow(resolve(width, judge, buckets), PACKED)
        return found.repartition(buckets, "bucket").mapInArrow(gather, BY_DOCUMENT)

    anchors = resolved(rows.mapInArrow(_anchors(window, anchor, buckets), PACKED), 1, several, buckets)
    more = buckets * BUCKET // WINDOW_BUCKET
    repeats = resolved(marked(anchors, "inner").mapInArrow(_windows(window, more), PACKED), 2, later, more)
    run, schema = _rewrite(window, "doc")
    kept = marked(repeats, "left").mapInArrow(run, schema)
    return kept.select(F.nullif(F.col("doc"), F.lit(NO_ID)).alias(key), "n_words", "n_removed", "kept_text")
