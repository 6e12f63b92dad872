"""Command line for the jobs: ``python -m tallymill <job> ...``."""

import argparse
from datetime import datetime

from tallymill.operators import extract
from tallymill.plans import jobs
from tallymill.session import build_session
from tallymill.sources import kafka
from tallymill.streaming import run as streams

_ARGS = {
    "clean": ["source", "sink"],
    "review": ["source"],
    "train": ["runs", "model", "log"],
    "validate": ["runs", "model", "scores", "log"],
    "corpus": ["source", "sink"],
    "pairs": ["source", "sink"],
    "evaluate": ["source", "log"],
    "collect": ["pages", "rules", "sink"],
    "reconcile": ["source", "target", "sink"],
    "arrivals": ["source", "staging", "checkpoint", "sink"],
    "score": ["source", "model", "sink", "checkpoint"],
    "score-champion": ["source", "coefficients", "sink", "checkpoint"],
    "clicks": ["servers", "source_topic", "sink_topic", "checkpoint"],
}


def parse(argv=None):
    parser = argparse.ArgumentParser(prog="tallymill")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, places in _ARGS.items():
        command = commands.add_parser(name)
        for place in places:
            command.add_argument(place)
        command.add_argument("--run-ts", default=None, help="run time, ISO format")
    commands.choices["clean"].add_argument("--format", choices=["csv", "parquet"], default="csv")
    commands.choices["clean"].add_argument("--dedup", choices=["between", "last"], default="between")
    commands.choices["clean"].add_argument("--audit", action="store_true",
                                           help="also count the rows lost to each rule")
    commands.choices["clicks"].add_argument("--ca", default=None, help="CA certificate")
    commands.choices["clicks"].add_argument("--starting-offsets", default="earliest")
    commands.choices["clicks"].add_argument("--interval", default=streams.INTERVAL, help="trigger interval")
    commands.choices["clicks"].add_argument("--available-now", action="store_true",
                                            help="stop when the present messages are done")
    commands.choices["arrivals"].add_argument("--dedup", choices=["between", "last"], default="between")
    for name in ("score", "score-champion"):
        commands.choices[name].add_argument("--threshold", type=float, default=None)
    commands.choices["reconcile"].add_argument("--source-prefix", default="")
    commands.choices["evaluate"].add_argument("--texts", default=None, help="folder for the texts with their diversity")
    commands.choices["corpus"].add_argument("--header", action="store_true")
    commands.choices["validate"].add_argument("--require-improvement", action="store_true")
    commands.choices["validate"].add_argument("--coefficients", default=None,
                                              help="table of models, for streams that score with the model in use")
    return parser.parse_args(argv)


def main(argv=None):
    args = parse(argv)
    run_ts = datetime.fromisoformat(args.run_ts) if args.run_ts else datetime.now()
    run_id = f"{args.job}-{run_ts:%Y%m%d%H%M%S}"
    spark = build_session(f"tallymill-{args.job}")
    if args.job == "clean":
        print(jobs.clean_job(spark, args.source, args.sink, run_ts, args.format, args.dedup,
                             args.audit))
    elif args.job == "review":
        for name, report in jobs.review_job(spark.read.parquet(args.source)).items():
            print(name)
            report.show(truncate=False)
    elif args.job == "train":
        print(jobs.train_job(spark, args.runs, args.model, args.log, run_id, run_ts))
    elif args.job == "validate":
        print(jobs.validate_job(spark, args.runs, args.model, args.scores, args.log, run_id,
                                run_ts, args.require_improvement, args.coefficients))
    elif args.job == "corpus":
        jobs.corpus_job(spark, args.source, args.sink, header=args.header)
    elif args.job == "pairs":
        jobs.pairs_job(spark, args.source, args.sink)
    elif args.job == "clicks":
        # Credentials come from KAFKA_USERNAME and KAFKA_PASSWORD.
        source = kafka.source_options(args.servers, args.source_topic, args.starting_offsets, ca_location=args.ca)
        sink = kafka.sink_options(args.servers, args.sink_topic, ca_location=args.ca)
        messages = kafka.read_messages(spark, source)
        jobs.click_job(messages, args.checkpoint, sink, interval=args.interval,
                       available_now=args.available_now).awaitTermination()
    elif args.job == "collect":
        jobs.collect_job(spark.read.parquet(args.pages), extract.load_rules(args.rules), run_ts.date(), args.sink)
    elif args.job == "reconcile":
        print(jobs.reconcile_job(spark, args.source, args.target, args.sink, args.source_prefix))
    elif args.job == "arrivals":
        jobs.arrivals_job(spark, args.source, args.staging, args.checkpoint, args.sink, args.dedup)
    elif args.job == "score":
        jobs.score_job(spark, args.source, args.model, args.sink, args.checkpoint, args.threshold)
    elif args.job == "score-champion":
        jobs.score_champion_job(spark, args.source, args.coefficients, args.sink, args.checkpoint, args.threshold)
    else:
        jobs.evaluate_job(spark, spark.read.parquet(args.source), args.log, run_id, run_ts, args.texts).show()


if __name__ == "__main__":
    main()
