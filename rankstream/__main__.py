"""``spark-submit`` entry point: run some or all jobs over a landing folder."""

from __future__ import annotations

import argparse

from rankstream.plans.jobs import JOBS, Workspace, run
from rankstream.session import build_session
from rankstream.sinks.store import TableStore


def main() -> None:
    parser = argparse.ArgumentParser(prog="rankstream", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder with the raw input")
    parser.add_argument("--warehouse", help="folder for tables; default under spark.checkpoint.dir")
    parser.add_argument(
        "--hive", action="store_true",
        help="keep the catalog in the cluster's metastore; needed unless one run does all jobs",
    )
    parser.add_argument("--brokers", help="Kafka brokers; without them logs come from the landing folder")
    parser.add_argument("--topic", default="server.logs")
    parser.add_argument("--record-format", choices=("json", "avro"), default="json")
    parser.add_argument("--publish-to", help="target for published gold tables")
    parser.add_argument("--publish-format", default="parquet")
    parser.add_argument("--run-id", default="latest", help="a repeated run id replaces its rows")
    parser.add_argument("--late", help="watermark delay: log metrics append closed windows only")
    parser.add_argument(
        "--incremental", action="store_true", help="keep gold tables by deltas, from the first run on"
    )
    parser.add_argument(
        "--stream-option", action="append", default=[], metavar="KEY=VALUE",
        help="reader option of the streams, such as maxBytesPerTrigger=500g",
    )
    parser.add_argument("jobs", nargs="*", metavar="job", help=f"any of: {', '.join(JOBS)}")
    args = parser.parse_args()

    spark = build_session("rankstream", hive=args.hive)
    workspace = Workspace(
        spark,
        TableStore(spark, args.warehouse),
        args.landing,
        brokers=args.brokers,
        topic=args.topic,
        record_format=args.record_format,
        publish_to=args.publish_to,
        publish_format=args.publish_format,
        run_id=args.run_id,
        late=args.late,
        incremental=args.incremental,
        stream_options=dict(option.split("=", 1) for option in args.stream_option),
    )
    run(workspace, args.jobs or None)


if __name__ == "__main__":
    main()
