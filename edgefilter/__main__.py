"""Command line: run registered queries and the stream jobs.

    python -m edgefilter list
    python -m edgefilter run NAME --sf-dir DIR [--out PATH] [--show N]
    python -m edgefilter train --sf-dir DIR --model-out PATH
    python -m edgefilter stream-sample --input DIR --out DIR --checkpoint DIR
    python -m edgefilter stream-filter (--input DIR | --kafka SERVERS) --state DIR
                                       --checkpoint DIR [--model PATH] [--once]
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone


def _session(args):
    from edgefilter.session import get_session
    return get_session(master=args.master, shuffle_partitions=args.shuffle_partitions)


def cmd_list(args) -> int:
    from edgefilter.plans.registry import oracle_sql, queries
    sql = oracle_sql()
    for name in sorted(queries()):
        print(f"{name}\t{'sql' if name in sql else 'rows'}")
    return 0


def cmd_run(args) -> int:
    from edgefilter.plans.registry import queries
    spark = _session(args)
    df = queries()[args.name](spark, args.sf_dir)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


def cmd_train(args) -> int:
    from edgefilter.operators import evaluate as EV
    from edgefilter.operators import model as M
    from edgefilter.plans.q_model import train_test
    spark = _session(args)
    train, test = train_test(spark, args.sf_dir)
    model = M.fit(train)
    M.save_model(model, args.model_out)
    EV.multiclass_metrics(model.transform(test)).show(truncate=False)
    return 0


def cmd_stream_sample(args) -> int:
    from edgefilter.streaming import jobs as J
    spark = _session(args)
    J.run_sample_job(spark, J.file_source(spark, args.input, None), args.out, args.checkpoint,
                     args.percent, args.records_per_file, args.timeout)
    return 0


def cmd_stream_filter(args) -> int:
    from pyspark.sql import functions as F

    from edgefilter.operators.scoring import rule_prediction
    from edgefilter.streaming import jobs as J
    spark = _session(args)
    if args.kafka:
        since = args.since and 1000 * int(datetime.fromisoformat(args.since).replace(tzinfo=timezone.utc).timestamp())
        lines = J.kafka_source(spark, args.kafka, args.topic, since)
    elif args.socket:
        host, port = args.socket.rsplit(":", 1)
        lines = J.socket_source(spark, host, int(port))
    else:
        lines = J.file_source(spark, args.input, args.files_per_trigger)
    if args.model:
        from edgefilter.operators.model import load_model
        scorer = load_model(args.model).transform
    else:
        def scorer(clean):
            return clean.withColumn("prediction", rule_prediction())
    state = J.BlacklistState(spark, args.state)
    process = J.filter_score_update(state, scorer)
    writer = (J.edit_stream(lines).writeStream.foreachBatch(process)
              .option("checkpointLocation", args.checkpoint))
    if args.once:
        J.finish(writer.trigger(availableNow=True).start(), args.timeout)
    else:
        writer.start().awaitTermination()
    state.reports().orderBy("epoch").show(truncate=False)
    print("blacklisted users:", state.keys().select(F.col("user")).distinct().count())
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="edgefilter")
    p.add_argument("--master", help="only if the submission gives none")
    p.add_argument("--shuffle-partitions", type=int)
    sub = p.add_subparsers(dest="cmd", required=True)

    sub.add_parser("list").set_defaults(fn=cmd_list)

    r = sub.add_parser("run")
    r.add_argument("name")
    r.add_argument("--sf-dir", required=True)
    r.add_argument("--out")
    r.add_argument("--show", type=int, default=20)
    r.set_defaults(fn=cmd_run)

    t = sub.add_parser("train")
    t.add_argument("--sf-dir", required=True)
    t.add_argument("--model-out", required=True)
    t.set_defaults(fn=cmd_train)

    s = sub.add_parser("stream-sample")
    s.add_argument("--input", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--percent", type=int, default=20)
    s.add_argument("--records-per-file", type=int, default=1_000_000)
    s.add_argument("--timeout", type=int, help="seconds; none by default")
    s.set_defaults(fn=cmd_stream_sample)

    f = sub.add_parser("stream-filter")
    src = f.add_mutually_exclusive_group(required=True)
    src.add_argument("--input")
    src.add_argument("--kafka")
    src.add_argument("--socket", metavar="HOST:PORT", help="line socket, for trials only")
    f.add_argument("--since", help="start of the Kafka topic, yyyy-MM-dd[ HH:mm:ss] UTC")
    f.add_argument("--topic", default="wikipedia-edits")
    f.add_argument("--files-per-trigger", type=int, default=1)
    f.add_argument("--state", required=True)
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--model")
    f.add_argument("--once", action="store_true", help="process what is there, then stop")
    f.add_argument("--timeout", type=int, help="seconds; none by default")
    f.set_defaults(fn=cmd_stream_filter)

    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
