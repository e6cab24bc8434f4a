"""Envelope handling shared by all event types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VITALS = "vitals.reading"
PRESCRIPTION = "prescription.issued"
SUPPORTED_VERSIONS = ("1.0",)

_S, _I, _D, _B, _T = (T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType())

VITALS_PAYLOAD = T.StructType([T.StructField(n, t) for n, t in [
    ("patient_id", _S), ("encounter_id", _S), ("hadm_id", _S), ("unit_id", _S), ("bed_id", _S),
    ("device_id", _S), ("charttime", _T), ("loinc_code", _S), ("parameter_name", _S),
    ("value_num", _D), ("value_uom", _S), ("warning", _I), ("is_artifact", _B)]])

PRESCRIPTION_PAYLOAD = T.StructType([T.StructField(n, t) for n, t in [
    ("subject_id", _S), ("hadm_id", _S), ("encounter_id", _S), ("pharmacy_id", _I), ("poe_id", _S),
    ("poe_seq", _I), ("order_provider_id", _S), ("drug", _S), ("drug_type", _S),
    ("formulary_drug_cd", _S), ("gsn", _S), ("ndc", _S), ("rxcui_scd", _S), ("prod_strength", _S),
    ("dose_val_rx", _S), ("dose_unit_rx", _S), ("form_val_disp", _S), ("form_unit_disp", _S),
    ("doses_per_24_hrs", _D), ("route", _S), ("frequency", _S), ("proc_type", _S), ("status", _S),
    ("fhir_status", _S), ("fhir_intent", _S), ("fhir_priority", _S), ("entertime", _T),
    ("verifiedtime", _T), ("starttime", _T), ("stoptime", _T), ("dispensation", _S),
    ("fill_quantity", _S), ("is_controlled", _B), ("dea_schedule", _S), ("unit_id", _S),
    ("event_subtype", _S)]])


def route(events: DataFrame, event_type: str) -> DataFrame:
    return events.filter(F.col("event_type") == event_type)


def parse_events(events: DataFrame, payload: T.StructType) -> DataFrame:
    """Payload fields next to the envelope.

    A payload that is not JSON, or of an unknown schema version, is kept and marked
    ``is_malformed``: dropping it here would hide the fault.
    """
    corrupt = T.StructType([*payload.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("payload", corrupt, {"columnNameOfCorruptRecord": "_corrupt"})
    envelope = [c for c in events.columns if c != "payload"]
    names = [f.name for f in payload.fields]
    out = events.withColumn("_p", parsed)
    malformed = (F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()
                 | ~F.coalesce(F.col("schema_version").isin(*SUPPORTED_VERSIONS), F.lit(False)))
    return out.select(*[F.col(c) for c in envelope if c not in names],
                      *[F.col(f"_p.{n}").alias(n) for n in names], malformed.alias("is_malformed"))


def with_event_watermark(events: DataFrame, delay: str = "75 minutes") -> DataFrame:
    """Event-time watermark (a no-op for a batch replay).  The default lies above the longest promised delay, one hour."""
    return events.withWatermark("event_time", delay) if events.isStreaming else events


def dedupe_events(events: DataFrame) -> DataFrame:
    """Drop repeats of an ``event_id``.

    In a stream the ids seen are forgotten once the watermark passes them, so state is bounded by
    the delay and not by the life of the stream.
    """
    if events.isStreaming:
        return events.dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id"])


def classify_late(events: DataFrame, threshold_seconds: int = 60) -> DataFrame:
    lag: Column = F.unix_timestamp("ingest_time") - F.unix_timestamp("event_time")
    return events.withColumn("arrival_lag_seconds", lag).withColumn(
        "is_late", F.col("arrival_lag_seconds") > threshold_seconds)


def enrich_static(stream: DataFrame, encounters: DataFrame, columns: list[str]) -> DataFrame:
    """Stream-static left join; an event without an encounter row is in flight, not an orphan."""
    static = encounters.select("encounter_id", *columns, F.lit(True).alias("_known"))
    return (stream.join(static, "encounter_id", "left")
            .withColumn("encounter_state", F.when(F.col("_known"), "closed").otherwise("in_flight"))
            .drop("_known"))
