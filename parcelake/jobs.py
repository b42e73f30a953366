"""Command line of the jobs, for spark-submit:

    spark-submit --py-files parcelake.zip run_job.py <job> --root s3a://lake [options]

Jobs: ingest-master, ingest-events, bronze, silver, gold, bi, panels, batch, checks, live.
The log is Kafka (--kafka host:port,...) or replay files (--replay path). BI tables and panels are
served over JDBC (--jdbc-url) or, without it, as tables under <root>/serving. Source options
(--log-option maxOffsetsPerTrigger=100000) and those of the database (--jdbc-option user=bi) may be
repeated; a value env:NAME is taken from the environment, so secrets stay off the command line.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from parcelake import domain
from parcelake.layout import Layout
from parcelake.plans import batch, gold, layers, quality, serve
from parcelake.schemas import ENTITIES
from parcelake.session import build_session
from parcelake.sources.log import KafkaLog, ReplayLog
from parcelake.sources.serving import JdbcTwoPhaseServing, ParquetServing, database_connection
from parcelake.streaming.audit import BatchAudit
from parcelake.streaming.ingest import await_any, start_ingest
from parcelake.streaming.live import start_live


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="parcelake", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True, help="root path of the lake")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--replay", help="path of replay files")
    parser.add_argument("--log-option", action="append", default=[], metavar="KEY=VALUE",
                        help="Kafka source option, e.g. kafka.security.protocol=SASL_SSL")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE",
                        help="database option, e.g. driver=..., password=env:DB_PASSWORD")
    parser.add_argument("--as-of", help="business date of the run (default: today, UTC)")
    parser.add_argument("--since", help="first ingest date that is new (default: all)")
    parser.add_argument("--network", help="checks: parquet of the served pairs")
    parser.add_argument("--once", action="store_true", help="streams: stop when caught up")
    return parser


def _options(pairs: Sequence[str]) -> dict[str, str]:
    """KEY=VALUE pairs; env:NAME is the value of an environment variable, which must be set."""
    out = {}
    for pair in pairs:
        key, given, value = pair.partition("=")
        if not key or not given:
            raise SystemExit(f"not KEY=VALUE: {pair}")
        if value.startswith("env:"):
            name = value.removeprefix("env:")
            if name not in os.environ:
                raise SystemExit(f"environment variable {name} is not set")
            value = os.environ[name]
        out[key] = value
    return out


class _Run:
    def __init__(self, spark: SparkSession, args: argparse.Namespace) -> None:
        now = datetime.now(timezone.utc)
        self.spark, self.args, self.layout = spark, args, Layout(args.root)
        self.run_ts = F.lit(now).cast("timestamp")
        self.as_of = F.lit(args.as_of or now.date().isoformat()).cast("date")
        self.trigger = {"availableNow": True} if args.once else None

    @property
    def log(self):
        if self.args.kafka:
            return KafkaLog(self.args.kafka, _options(self.args.log_option))
        if self.args.replay:
            return ReplayLog(self.args.replay)
        raise SystemExit("this job reads the message log: give --kafka or --replay")

    @contextmanager
    def audited(self):
        """Counts of the streams' batches are kept while this lasts."""
        audit = BatchAudit(self.spark, self.layout)
        self.spark.streams.addListener(audit)
        try:
            yield audit
        finally:
            self.spark.streams.removeListener(audit)

    @property
    def serving(self):
        if self.args.jdbc_url:
            url, options = self.args.jdbc_url, _options(self.args.jdbc_option)
            return JdbcTwoPhaseServing(
                url, options, lambda: database_connection(self.spark, url, options))
        return ParquetServing(self.spark, self.args.root.rstrip("/") + "/serving")


def _ingest_master(run: _Run) -> None:
    for topic in domain.MASTER_TOPICS:
        layers.ingest_new(run.spark, run.log, ENTITIES[topic], run.layout, run.run_ts)


def _ingest_events(run: _Run) -> None:
    with run.audited() as audit:
        queries = start_ingest(run.spark, run.log, run.layout, trigger=run.trigger)
        if run.args.once:
            for query in queries:
                query.awaitTermination()
                audit.finish(query)
        else:
            await_any(run.spark)


def _bronze(run: _Run) -> None:
    for entity in ENTITIES.values():
        layers.bronze(run.spark, entity, run.layout, run.run_ts, run.args.since)


def _silver(run: _Run) -> None:
    for entity in ENTITIES.values():
        layers.silver(run.spark, entity, run.layout, run.run_ts, run.args.since)


def _gold(run: _Run) -> None:
    gold.build_calendar(run.spark, run.layout)
    gold.build_dimensions(run.spark, run.layout, run.as_of)
    gold.build_fact(run.spark, run.layout, run.as_of, run.run_ts, run.args.since)


def _bi(run: _Run) -> None:
    serve.refresh_bi(run.spark, run.layout, run.serving, run.run_ts)


def _panels(run: _Run) -> None:
    serve.refresh_panels(run.spark, run.layout, run.serving, run.run_ts)


def _batch(run: _Run) -> None:
    batch.run_batch(run.spark, run.layout, run.serving, run.as_of, run.run_ts, run.args.since)


def _checks(run: _Run) -> None:
    if not run.args.network:
        raise SystemExit("checks needs --network")
    quality.run_checks(run.spark, run.layout, run.spark.read.parquet(run.args.network))


def _live(run: _Run) -> None:
    with run.audited() as audit:
        query = start_live(run.spark, run.log, run.layout, once=run.args.once,
                           since="earliest" if run.args.once else "latest", audit=audit)
        query.awaitTermination()
        audit.finish(query)


JOBS: dict[str, Callable[[_Run], None]] = {
    "ingest-master": _ingest_master, "ingest-events": _ingest_events, "bronze": _bronze,
    "silver": _silver, "gold": _gold, "bi": _bi, "panels": _panels, "batch": _batch, "checks": _checks,
    "live": _live,
}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    JOBS[args.job](_Run(spark or build_session(f"parcelake {args.job}"), args))


if __name__ == "__main__":
    main()
