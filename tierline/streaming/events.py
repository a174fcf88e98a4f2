"""Change-data-capture streams: validation, deduplication, enrichment, replay ledger, and the job that joins them."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Operations of an envelope and what they are called after validation (fixed values).
OPS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}
#: What a stream of records looks like, whatever it comes from.
RECORD = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


@dataclass(frozen=True)
class StreamSpec:
    """One topic: its keys, the typed columns of its payload, and how it is deduplicated."""

    topic: str
    keys: tuple[str, ...]
    columns: Mapping[str, str]
    dedup_keys: tuple[str, ...] = ()
    dedup_delay: str = ""
    lookup: str = ""
    lookup_keys: tuple[str, ...] = field(default_factory=tuple)

    def problems(self) -> list[str]:
        out = []
        if not self.keys:
            out.append(f"{self.topic}: no key columns")
        if bool(self.dedup_keys) != bool(self.dedup_delay):
            out.append(f"{self.topic}: deduplication needs both keys and a delay")
        if self.dedup_delay and not re.fullmatch(r"[1-9]\d* (second|minute|hour|day)s?", self.dedup_delay):
            out.append(f"{self.topic}: {self.dedup_delay!r} is no interval such as '10 minutes'")
        return out


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """A Kafka topic as records; the connector must be on the classpath."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("failOnDataLoss", "false")
    return (reader.option("maxOffsetsPerTrigger", per_trigger) if per_trigger else reader).load()


def file_stream(spark: SparkSession, path: str, schema: str = RECORD, fmt: str = "parquet", files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(path)


def drop_tombstones(records: DataFrame) -> DataFrame:
    return records.where(F.col("value").isNotNull())


def event_time(value: Column) -> Column:
    return F.timestamp_millis(F.get_json_object(value.cast("string"), "$.payload.__ts_ms").try_cast("bigint"))


def deduplicate(records: DataFrame, spec: StreamSpec) -> DataFrame:
    """Records without replays of the spec's keys within its delay; without such keys, all records.

    State is kept for the delay only: a replay that comes after its key has expired is not recognised.
    """
    bad = spec.problems()
    if bad:
        raise ValueError("; ".join(bad))
    if not spec.dedup_keys:
        return records
    names = [f"_k{i}" for i in range(len(spec.dedup_keys))]
    text = F.col("value").cast("string")
    keyed = drop_tombstones(records).withColumn("event_time", event_time(F.col("value"))).withColumns({n: F.get_json_object(text, f"$.payload.{k}") for n, k in zip(names, spec.dedup_keys, strict=True)})
    kept = keyed.withWatermark("event_time", spec.dedup_delay)
    return (kept.dropDuplicatesWithinWatermark(names) if records.isStreaming else kept.dropDuplicates(names)).drop(*names)


def validate(records: DataFrame, spec: StreamSpec) -> DataFrame:
    """Each record with its payload typed, __cdc_operation, __cdc_timestamp_ms, error_type and error_message (null: valid).

    The JSON is parsed once, to the columns of the spec as text; a key must be there as its type, as no merge could match
    another. One pass for good and bad: valid() and dead_letters() split the result.
    """
    fields = [*spec.columns, *[k for k in spec.keys if k not in spec.columns], "__op", "__ts_ms"]
    shape = "payload struct<" + ", ".join(f"`{c}`: string" for c in fields) + ">"
    rows = drop_tombstones(records).withColumn("_p", F.from_json(F.col("value").cast("string"), shape)["payload"])
    get = lambda k: F.col("_p")[k]
    op, ts = get("__op"), get("__ts_ms").try_cast("bigint")
    typed = {c: get(c).try_cast(t) for c, t in spec.columns.items()}
    no_key = F.lit(False)
    for k in spec.keys:
        no_key = no_key | typed.get(k, get(k)).isNull()
    # The names of the errors, in the order in which they count.
    kind = F.when(F.col("_p").isNull(), "PARSE_ERROR").when(~F.coalesce(op, F.lit("")).isin(*OPS), "INVALID_OPERATION").when(ts.isNull(), "INVALID_TIMESTAMP").when(no_key, "MISSING_PRIMARY_KEY")
    message = F.concat_ws(" ", kind, F.lit("op"), F.coalesce(op, F.lit("null")), F.lit("ts"), F.coalesce(get("__ts_ms"), F.lit("null")))
    names = F.create_map(*[F.lit(x) for kv in OPS.items() for x in kv])
    return rows.withColumns({**typed, "__cdc_operation": F.try_element_at(names, op), "__cdc_timestamp_ms": ts, "error_type": kind, "error_message": F.when(kind.isNotNull(), message)}).drop("_p")


def valid(checked: DataFrame, spec: StreamSpec) -> DataFrame:
    return checked.where("error_type IS NULL").select(
        *spec.columns, "__cdc_operation", "__cdc_timestamp_ms", F.col("topic").alias("__kafka_topic"), F.col("partition").alias("__kafka_partition"), F.col("offset").alias("__kafka_offset")
    )


def dead_letters(checked: DataFrame, entity: str) -> DataFrame:
    return checked.where("error_type IS NOT NULL").select(
        F.col("topic").alias("source_topic"), F.lit(entity).alias("entity"), F.col("value").cast("string").alias("raw_payload"), "error_type", "error_message", F.col("__cdc_timestamp_ms").alias("event_timestamp"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_timestamp"),
    )


def enrich(rows: DataFrame, dimension: DataFrame, keys: Mapping[str, str], prefix: str) -> DataFrame:
    """rows with the dimension's other columns, prefixed; keys maps rows' columns to the dimension's. No row is lost or added.

    The dimension must have one row a key; of several, the first by all its columns counts.
    """
    others = [c for c in dimension.columns if c not in keys.values()]
    one = dimension.groupBy(*keys.values()).agg(F.min(F.struct(*others)).alias("_d"))
    named = one.select(*[F.col(v).alias(f"_{k}") for k, v in keys.items()], *[F.col(f"_d.{c}").alias(f"{prefix}{c}") for c in others])
    on = None
    for k in keys:
        same = F.col(k) == F.col(f"_{k}")
        on = same if on is None else on & same
    return rows.join(named, on, "left").drop(*[f"_{k}" for k in keys])


# Contracts of events.


@dataclass(frozen=True)
class Field:
    """One field of a governed event: type, and what its values must be."""

    kind: str
    required: bool = True
    const: object = None
    enum: tuple = ()
    pattern: str = ""
    low: object = None
    high: object = None


def contract_violations(payload: Column, fields: Mapping[str, Field]) -> Column:
    """array<string> of what is wrong with a JSON payload, empty if nothing is; a field that the contract lacks is wrong too."""
    found = F.from_json(payload, "map<string,string>")
    out = [F.when(found.isNull(), "not an object")]
    for name, f in fields.items():
        text = F.try_element_at(found, F.lit(name))
        value = text.try_cast(f.kind)
        if f.required:
            out.append(F.when(found.isNotNull() & text.isNull(), f"{name}: missing"))
        out.append(F.when(text.isNotNull() & value.isNull(), f"{name}: not {f.kind}"))
        if f.const is not None:
            out.append(F.when(value != F.lit(f.const), f"{name}: not {f.const}"))
        if f.enum:
            out.append(F.when(~value.isin(*f.enum), f"{name}: not allowed"))
        if f.pattern:
            out.append(F.when(~text.rlike(f.pattern), f"{name}: no match"))
        if f.low is not None:
            out.append(F.when(value < F.lit(f.low), f"{name}: below {f.low}"))
        if f.high is not None:
            out.append(F.when(value > F.lit(f.high), f"{name}: above {f.high}"))
    extra = F.transform(F.array_sort(F.array_except(F.map_keys(found), F.array(*map(F.lit, fields)))), lambda k: F.concat(k, F.lit(": unknown")))
    return F.concat(F.filter(F.array(*out), lambda x: x.isNotNull()), F.coalesce(extra, F.array().cast("array<string>")))


def fingerprint(payload: Column) -> Column:
    return F.sha2(payload, 256)


def classify_replays(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """batch (topic, event_id, fingerprint, ...) with verdict: NEW, REPLAY (seen with this fingerprint) or CONFLICT (with another).

    Two fingerprints of one event in the batch itself are a conflict; of equal records in the batch, the least offset is NEW.
    """
    from pyspark.sql import Window

    keys = ["topic", "event_id"]
    kinds = batch.groupBy(*keys).agg(F.size(F.collect_set("fingerprint")).alias("_kinds"))
    seen = ledger.select(*keys, F.col("fingerprint").alias("_seen"))
    order = Window.partitionBy(*keys, "fingerprint").orderBy("offset")
    rows = batch.join(kinds, keys).join(seen, keys, "left").withColumn("_n", F.row_number().over(order))
    verdict = F.when(F.col("_kinds") > 1, "CONFLICT").when(F.col("_seen").isNull(), F.when(F.col("_n") == 1, "NEW").otherwise("REPLAY")).when(F.col("_seen") == F.col("fingerprint"), "REPLAY").otherwise("CONFLICT")
    return rows.withColumn("verdict", verdict).drop("_kinds", "_seen", "_n")


# Jobs.


def _numbers(spark: SparkSession, path: str) -> set[int]:
    """The batches that a folder of one partition a batch has."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(place) if files.exists(place) else []
    return {int(n.removeprefix("batch_id=")) for n in (f.getPath().getName() for f in found) if n.startswith("batch_id=")}


def run_cdc(records: DataFrame, spec: StreamSpec, out: str, checkpoint: str, dimension: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """A stream of records into out/log (by batch), out/dead_letters and, with a dimension, out/enriched; all data there is, then ends.

    A batch that is redone after a crash overwrites its own partition, so nothing appears twice. The dimension is read anew
    for each batch. A batch whose enrichment fails is in the log and not in out/enriched; it is enriched again from the log
    with each later batch, and before the stream starts, until it succeeds. Other errors end the stream.
    """
    spark = records.sparkSession

    def write(df: DataFrame, name: str, batch: int) -> None:
        df.withColumn("batch_id", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out}/{name}")

    def catch_up() -> None:
        """Enrich what the log has and out/enriched lacks."""
        if dimension is None:
            return
        for number in sorted(_numbers(spark, f"{out}/log") - _numbers(spark, f"{out}/enriched")):
            good = spark.read.parquet(f"{out}/log/batch_id={number}")
            try:
                joined = enrich(good, dimension(), dict(zip(spec.lookup_keys, spec.lookup_keys, strict=True)), f"{spec.lookup}_")
                write(joined, "enriched", number)
            except Exception as e:  # the log is whole without it, and holds the batch for the next turn
                print(f"{spec.topic}: batch {number} is not enriched yet: {e}")

    def each(batch: DataFrame, number: int) -> None:
        checked = validate(batch, spec).persist()
        try:
            write(valid(checked, spec), "log", number)
            write(dead_letters(checked, spec.topic), "dead_letters", number)
        finally:
            checked.unpersist()
        catch_up()

    catch_up()
    return deduplicate(records, spec).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def revenue_per_minute(payments: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Revenue of each merchant and minute; on a stream, a minute is told once the watermark has passed it."""
    good = F.col("status") == "SUCCESS"
    rows = payments.withWatermark("ts", delay) if payments.isStreaming else payments
    return rows.groupBy(F.window("ts", "1 minute").alias("w"), "merchant_id").agg(F.count_if(good).alias("successes"), F.sum(F.when(good, F.col("amount"))).alias("revenue")).select("merchant_id", F.col("w.start").alias("minute"), "successes", F.coalesce("revenue", F.lit(0).cast("decimal(28,2)")).cast("decimal(18,2)").alias("revenue"))
