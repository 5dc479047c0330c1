"""Stage jobs: each reference script as one call over paths.

These compose the operators; they add no logic of their own. Paths name
shared storage on a cluster. Every job returns the DataFrames it reports
(counts, metrics, importances) instead of printing them.

    python -m voltaic.jobs normalize --source A=raw/a --source B=raw/b --repaired B --output readings/
    python -m voltaic.jobs preprocess --input readings/ --output processed/
    python -m voltaic.jobs update --input readings/ --output processed/ --manifest processed_manifest/
    python -m voltaic.jobs ml-dataset --input readings/ --output ml_dataset/
    python -m voltaic.jobs train --input ml_dataset/ --model model/
    python -m voltaic.jobs tune --input ml_dataset/ --model model/
    python -m voltaic.jobs evaluate --input ml_dataset/ --model model/ --output metrics_csv/
    python -m voltaic.jobs train-time --input ml_dataset/ --model model/
    python -m voltaic.jobs train-80 --input ml_dataset/ --model model/
    python -m voltaic.jobs signal-report --input readings/
    python -m voltaic.jobs voltage-report --input readings/
    python -m voltaic.jobs feature-report --input processed/
    python -m voltaic.jobs publish --input readings/ --servers host:9092 --topic t
    python -m voltaic.jobs inspect-topic --servers host:9092 --topic t
    python -m voltaic.jobs stream --servers host:9092 --topic t --model model/ --output scores/ --checkpoint ck/
"""
from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic import config
from voltaic.operators import evaluate as ev
from voltaic.operators import model as md
from voltaic.operators import profile as pr
from voltaic.operators import split as sp
from voltaic.operators.features import LABEL_END, ml_dataset
from voltaic.operators.windows import window_wide
from voltaic.sources import files as fs
from voltaic.sources import incremental as inc
from voltaic.sources import raw as rw
from voltaic.sources.readings import scan_readings


def normalize(spark: SparkSession, sources: Mapping[str, str], output: str,
              repaired: Sequence[str] = (), mode: str = "strict") -> DataFrame:
    """Raw ns files -> one normalized reading dataset, one folder per source;
    returns rows and corrected rows per source with a total."""
    raw = rw.sources_from_files(spark, sources)
    norm = rw.normalize_sources(raw, repaired, mode=mode)
    fs.write_dataset(norm.drop("corrected"), output, partition_by=["source"])
    return pr.row_accounting(norm)


def preprocess(spark: SparkSession, input_path: str, output: str, window: str = config.WINDOW) -> DataFrame:
    """Readings -> the processed window table (seven signals, temperatures)."""
    wide = window_wide(scan_readings(spark, input_path), window)
    fs.write_dataset(wide, output)
    return fs.read_dataset(spark, output)


def build_ml_dataset(spark: SparkSession, input_path: str, output: str, **params) -> DataFrame:
    """Readings -> the ML table; returns the class distribution of what was written."""
    fs.write_dataset(ml_dataset(scan_readings(spark, input_path), **params), output)
    return pr.class_distribution(fs.read_dataset(spark, output))


def update_windows(spark: SparkSession, input_path: str, output: str, manifest: str, window: str = config.WINDOW) -> DataFrame:
    """New, changed or missing reading files -> the days of windows that they touch; returns what was found."""
    done = inc.update_windows(spark, input_path, output, manifest, window=window)
    return spark.createDataFrame([tuple(done.values())], ", ".join(f"{k} long" for k in done))


def _parts(spark: SparkSession, ml_path: str, features: Sequence[str], embargo_rows: int, purge: bool) -> dict[str, DataFrame]:
    """The chronological parts of the complete rows; ``purge`` needs an ML table with ``label_end``."""
    ends = [LABEL_END] if purge else []
    needed = ["vehicle_id", "time", config.LABEL, *features]
    rows = spark.read.parquet(ml_path).select(*needed, *ends).dropna(subset=needed)
    return sp.rank_parts(rows, embargo_rows=embargo_rows, label_end=LABEL_END if purge else None)


def train_valid_test(spark: SparkSession, ml_path: str, model_path: str,
                     features: Sequence[str] = config.FEATURES, embargo_rows: int = 0, purge: bool = False,
                     **rf_params) -> dict[str, DataFrame]:
    """Exact 60/20/20 rank split, class-weighted forest, validation and test metrics.
    ``embargo_rows`` rows after each cutoff are left out of every part; with ``purge``
    (an ML table built with ``label_end=True``) the rows whose label looks across one."""
    parts = _parts(spark, ml_path, features, embargo_rows, purge)
    model = md.train_rf(parts["train"], features, **rf_params)
    md.save_model(model, model_path)
    labelled = [p.withColumn("split", F.lit(name)) for name, p in parts.items()]
    data = labelled[0].unionByName(labelled[1]).unionByName(labelled[2])
    out = {"split_counts": pr.class_distribution(data, by=["split"]),
           "importance": md.feature_importance(spark, model)}
    for name in ("validation", "test"):
        scored = _stored_scores(model, parts[name])
        out[f"{name}_confusion"] = ev.confusion_matrix(scored)
        out[f"{name}_metrics"] = ev.multiclass_metrics(scored)
        out[f"{name}_risk"] = ev.risk_metrics(scored)
        out[f"{name}_auc"] = ev.auc(scored)
    return out


def _stored_scores(model, part: DataFrame) -> DataFrame:
    """Label, prediction and risk probability of a part: scored once, stored for all metrics."""
    return sp.materialize(md.score_rows(model, part, keep=(config.LABEL,)))


def _scored_split(spark, ml_path, model_path, split, features, embargo_rows, purge):
    parts = _parts(spark, ml_path, features, embargo_rows, purge)
    return md.score_rows(md.load_model(model_path), parts[split])


def tune_threshold(spark: SparkSession, ml_path: str, model_path: str,
                   grid: Sequence[float] = config.THRESHOLD_GRID_COARSE,
                   features: Sequence[str] = config.FEATURES, embargo_rows: int = 0, purge: bool = False) -> DataFrame:
    """Threshold sweep on the validation split (one job for the whole grid)."""
    scored = _scored_split(spark, ml_path, model_path, "validation", features, embargo_rows, purge)
    return ev.threshold_sweep(scored, grid)


def evaluate_threshold(spark: SparkSession, ml_path: str, model_path: str,
                       grid: Sequence[float] = config.THRESHOLD_GRID_REPORT,
                       features: Sequence[str] = config.FEATURES, csv_path: str | None = None,
                       embargo_rows: int = 0, purge: bool = False) -> DataFrame:
    """Threshold sweep on the test split; optionally written as the metrics CSV."""
    scored = _scored_split(spark, ml_path, model_path, "test", features, embargo_rows, purge)
    sweep = ev.threshold_sweep(scored, grid)
    if csv_path:
        fs.export_csv(sweep.select(*fs.THRESHOLD_METRICS_SCHEMA.fieldNames()), csv_path)
    return sweep


def train_time_split(spark: SparkSession, ml_path: str, model_path: str,
                     grid: Sequence[float] = config.THRESHOLD_GRID_LOW,
                     features: Sequence[str] = config.FEATURES_SOC_FIRST, exact: bool = False,
                     **rf_params) -> dict[str, DataFrame]:
    """60/20/20 split on time quantiles, median imputer, forest; the threshold
    with the best validation F1 (ties: lowest) is evaluated on the test split."""
    df = spark.read.parquet(ml_path).select("time", config.LABEL, *features)
    data = sp.materialize(sp.split_by_time(df, [0.6, 0.8], exact=exact))
    model = md.train_rf(data.filter(F.col("split") == "train"), features, impute=True, **rf_params)
    md.save_model(model, model_path)
    val = md.score_rows(model, data.filter(F.col("split") == "validation"), keep=(config.LABEL,))
    sweep = ev.threshold_sweep(val, grid)
    best = ev.best_threshold(sweep).first()
    test = md.score_rows(model, data.filter(F.col("split") == "test"), keep=(config.LABEL,))
    return {"split_counts": pr.class_distribution(data, by=["split"]), "validation_sweep": sweep,
            "test_at_best": ev.evaluate_at_threshold(test, best["threshold"]),
            "importance": md.feature_importance(spark, model)}


def train_evaluate_80(spark: SparkSession, ml_path: str, model_path: str,
                      grid: Sequence[float] = config.THRESHOLD_GRID_LOW,
                      features: Sequence[str] = config.FEATURES_SOC_FIRST, exact: bool = False,
                      **rf_params) -> dict[str, DataFrame]:
    """80/20 split on the time quantile, median imputer, forest; held-out
    confusion, risk metrics, AUC and a threshold analysis on the test rows."""
    df = spark.read.parquet(ml_path).select("time", config.LABEL, *features)
    data = sp.materialize(sp.split_by_time(df, [0.8], exact=exact))
    model = md.train_rf(data.filter(F.col("split") == "train"), features, impute=True, **rf_params)
    md.save_model(model, model_path)
    test = data.filter(F.col("split") == "test")
    predicted = scored = _stored_scores(model, test)
    return {"split_counts": pr.class_distribution(data, by=["split"]),
            "test_confusion": ev.confusion_matrix(predicted),
            "test_cells": ev.confusion_cells(predicted),
            "test_risk": ev.risk_metrics(predicted),
            "test_metrics": ev.multiclass_metrics(predicted),
            "test_auc": ev.auc(scored),
            "threshold_analysis": ev.threshold_sweep(scored, grid),
            "importance": md.feature_importance(spark, model)}


def signal_report(spark: SparkSession, readings_path: str,
                  codes: Sequence[int] = tuple(config.BATTERY_SIGNAL_NAMES)) -> dict[str, DataFrame]:
    """Battery signal check: counts and statistics per listed code, with names."""
    r = scan_readings(spark, readings_path)
    return {"stats": pr.signal_stats(r, codes), "names": pr.signal_names(spark, r)}


def voltage_report(spark: SparkSession, readings_path: str, code: int = 1200,
                   band: tuple[float, float] = config.VOLTAGE_BAND) -> dict[str, DataFrame]:
    """Voltage analysis of one signal: range, percentiles, extremes and band counts."""
    from voltaic.sources.readings import scan_profile, single_signal

    v = single_signal(scan_readings(spark, readings_path), code, "battery_voltage")
    return {"profile": scan_profile(v),
            "percentiles": pr.signal_percentiles(v, "battery_voltage"),
            "extremes": pr.out_of_band(v, "battery_voltage", band),
            "band": pr.band_audit(v, "battery_voltage", band)}


def feature_report(spark: SparkSession, processed_path: str) -> dict[str, DataFrame]:
    """Processed-table analysis: describe, NULL counts, SOC/voltage ranges, vehicles,
    schema, a preview, and rows with and without temperatures where the table has that flag."""
    from voltaic.operators import report as rp

    w = spark.read.parquet(processed_path)
    cols = [c for c in ("vehicle_speed", "ambient_air_temp", "hv_aux_power", "hv_soc", "hv_battery_voltage",
                        "battery_temp_avg", "battery_temp_delta") if c in w.columns]
    flag = "temperature_available"
    own = {"temperature": pr.class_distribution(w, flag)} if flag in w.columns else {}
    return own | {
            "describe": pr.describe_columns(w, cols), "nulls": pr.null_counts(w, long=True),
            "ranges": pr.range_stats(w), "vehicles": pr.vehicles(w), "schema": pr.schema_report(w),
            "preview": rp.preview(w, ["vehicle_id", "time"])}


def publish(spark: SparkSession, readings_path: str, servers: str, topic: str, limit: int | None = None) -> DataFrame:
    """Producer: all readings as JSON messages (or the first ``limit`` in time order)
    written to a Kafka topic in one batch job; returns what was sent."""
    from voltaic.streaming import messages as ms

    msgs = ms.publish_messages(scan_readings(spark, readings_path), limit=limit)
    ms.write_kafka(msgs, servers, topic)
    return msgs


def inspect_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Consumer check: the topic read once from the earliest offset and decoded."""
    from voltaic.streaming import messages as ms

    return ms.parse_messages(ms.kafka_source(spark, servers, topic, starting="earliest", stream=False))


def stream_scoring(spark: SparkSession, messages: DataFrame, model_path: str, output: str, checkpoint: str,
                   *, window: str = config.WINDOW, watermark: str = config.WATERMARK,
                   band: tuple[float, float] = config.VOLTAGE_BAND,
                   processing_time: str = "5 seconds", first_row: str = "current",
                   missing: str = "fill", state_ttl: str | None = None):
    """Messages -> closed windows -> per-vehicle features (state store) -> scores,
    appended to Parquet every ``processing_time``; returns the running query."""
    from voltaic.streaming import features as sf

    feats = sf.stream_features(sf.stream_windows(messages, window=window, watermark=watermark),
                               band=band, first_row=first_row, state_ttl=state_ttl, window=window)
    scored = sf.score_stream(feats, md.load_model(model_path), missing=missing)
    return sf.run_to_parquet(sf.to_ntz_times(scored), output, checkpoint, available_now=False,
                             processing_time=processing_time)


def _stream_stage(spark: SparkSession, a):
    from voltaic.streaming import messages as ms

    source = ms.kafka_source(spark, a.servers, a.topic, starting=a.starting, fail_on_data_loss=not a.allow_data_loss,
                             max_offsets_per_trigger=a.max_offsets)
    return stream_scoring(spark, source, a.model, a.output, a.checkpoint, window=a.window, processing_time=a.trigger,
                          first_row=a.first_row, missing=a.missing, state_ttl=a.state_ttl)


#: Stage name -> (options it needs, its job).
STAGES = {
    "normalize": (("source", "output"), lambda s, a: normalize(
        s, dict(x.split("=", 1) for x in a.source), a.output, a.repaired)),
    "preprocess": (("input", "output"), lambda s, a: pr.schema_report(preprocess(s, a.input, a.output))),
    "update": (("input", "output", "manifest"), lambda s, a: update_windows(s, a.input, a.output, a.manifest, a.window)),
    "ml-dataset": (("input", "output"), lambda s, a: build_ml_dataset(s, a.input, a.output, label_end=a.purge)),
    "train": (("input", "model"), lambda s, a: train_valid_test(
        s, a.input, a.model, embargo_rows=a.embargo_rows, purge=a.purge)),
    "tune": (("input", "model"), lambda s, a: tune_threshold(
        s, a.input, a.model, embargo_rows=a.embargo_rows, purge=a.purge)),
    "evaluate": (("input", "model"), lambda s, a: evaluate_threshold(
        s, a.input, a.model, csv_path=a.output, embargo_rows=a.embargo_rows, purge=a.purge)),
    "train-time": (("input", "model"), lambda s, a: train_time_split(s, a.input, a.model)),
    "train-80": (("input", "model"), lambda s, a: train_evaluate_80(s, a.input, a.model)),
    "signal-report": (("input",), lambda s, a: signal_report(s, a.input)),
    "voltage-report": (("input",), lambda s, a: voltage_report(s, a.input)),
    "feature-report": (("input",), lambda s, a: feature_report(s, a.input)),
    "publish": (("input", "servers", "topic"), lambda s, a: publish(s, a.input, a.servers, a.topic, a.limit)),
    "inspect-topic": (("servers", "topic"), lambda s, a: inspect_topic(s, a.servers, a.topic)),
    "stream": (("servers", "topic", "model", "output", "checkpoint"), _stream_stage),
}


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="voltaic.jobs")
    ap.add_argument("stage", choices=list(STAGES))
    for name in ("input", "output", "model", "servers", "topic", "checkpoint", "manifest"):
        ap.add_argument(f"--{name}")
    ap.add_argument("--source", action="append", metavar="NAME=PATH", help="a raw source (repeat)")
    ap.add_argument("--repaired", action="append", default=[], metavar="NAME", help="a source to repair (repeat)")
    ap.add_argument("--limit", type=int, help="publish only the first readings")
    ap.add_argument("--max-offsets", type=int, default=1_000_000, help="messages per micro-batch at most")
    ap.add_argument("--embargo-rows", type=int, default=0, help="rows left out after each split cutoff")
    ap.add_argument("--purge", action="store_true",
                    help="ml-dataset: keep the end of each label's frame; train, tune, evaluate: leave out labels across a cutoff")
    ap.add_argument("--starting", default="earliest", help="first offsets of a new stream: earliest or latest")
    ap.add_argument("--allow-data-loss", action="store_true", help="go on when the topic lost messages")
    ap.add_argument("--window", default=config.WINDOW, help="length of a window")
    ap.add_argument("--trigger", default="5 seconds", help="time between micro-batches")
    ap.add_argument("--first-row", choices=("current", "null"), default="current",
                    help="previous values of a vehicle's first window")
    ap.add_argument("--missing", choices=("fill", "drop"), default="fill", help="rows with missing features")
    ap.add_argument("--state-ttl", help="forget a vehicle that was silent for so long, e.g. '1 day'")
    args = ap.parse_args(argv)
    needs, job = STAGES[args.stage]
    absent = [n for n in needs if not getattr(args, n)]
    if absent:
        ap.error(f"{args.stage} needs " + ", ".join(f"--{n}" for n in absent))
    spark = SparkSession.builder.appName(f"voltaic-{args.stage}").getOrCreate()
    result = job(spark, args)
    if isinstance(result, DataFrame):
        result.show(truncate=False)
    elif isinstance(result, dict):
        for name, df in result.items():
            print(name)
            df.show(truncate=False)
    else:
        result.awaitTermination()


if __name__ == "__main__":
    main()
