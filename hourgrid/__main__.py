"""Command line: python -m hourgrid <stage> --out FOLDER [--raw PATH]"""

from __future__ import annotations

import argparse

from hourgrid.operators.split import spec_with_cuts, spec_with_quiet_cuts
from hourgrid.plans.monthly import MonthlyStore
from hourgrid.plans.pipeline import Workspace
from hourgrid.session import get_spark
from hourgrid.sources.raw import read_raw
from hourgrid.spec import DemandSpec

STAGES = ("prepare", "features", "split", "tune", "train", "baseline", "predict", "evaluate", "report", "update")


def _spec(args: argparse.Namespace) -> DemandSpec:
    """The default spec with the cuts and rules that were given."""
    changes: dict[str, object] = {}
    if args.train_end:
        changes["train_end"] = args.train_end
    if args.validation_end:
        changes["validation_end"] = args.validation_end
    if args.exclude is not None:
        changes["exclude"] = tuple(dict(pair.split("=", 1) for pair in rule.split(",") if pair) for rule in args.exclude if rule)
    return DemandSpec().with_(**changes)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hourgrid")
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--out", required=True, help="folder of stored tables, shared by all executors")
    parser.add_argument("--raw", help="raw CSV file or folder (stages prepare, update)")
    parser.add_argument("--batch", help="name of the batch; a batch that is taken again replaces itself (stage update)")
    parser.add_argument("--name", default="summary", help="report name (stage report)")
    parser.add_argument("--trials", type=int, default=18, help="search budget (stage tune)")
    parser.add_argument("--startup", type=int, default=10, help="random trials before the model-based ones (stage tune)")
    parser.add_argument("--station", help="station name (reports of one station)")
    parser.add_argument("--start", help="first date (reports of one station)")
    parser.add_argument("--end", help="last date (reports of one station)")
    parser.add_argument("--train-end", help="first time after the training part")
    parser.add_argument("--validation-end", help="first time after the validation part")
    parser.add_argument("--proportional", action="store_true", help="cut points by shares of the time range (stage split)")
    parser.add_argument("--off-holidays", action="store_true", help="move the first of these cuts past unusual days")
    parser.add_argument("--exclude", action="append", metavar="COLUMN=VALUE,...", help="rows to drop; replaces the default")
    parser.add_argument("--latest-attributes", action="store_true", help="ids take the attributes of their latest step")
    args = parser.parse_args(argv)
    spark = get_spark()
    work = Workspace(spark, args.out, _spec(args))
    if args.stage == "prepare":
        if not args.raw:
            parser.error("--raw is needed for prepare")
        work.prepare(read_raw(spark, args.raw, spec=work.spec), args.latest_attributes)
        for name in ("profile", "unread", "ambiguous", "off_grid", "quality", "lineage"):
            work.table(name).show(truncate=False)
    elif args.stage == "update":
        if not (args.raw and args.batch):
            parser.error("--raw and --batch are needed for update")
        update = MonthlyStore(spark, work.path("monthly"), work.spec).update(read_raw(spark, args.raw, spec=work.spec), args.batch)
        print(f"months in the batch: {len(update.touched)}, built again: {', '.join(map(str, update.rebuilt)) or 'none'}")
    elif args.stage == "features":
        work.build_features()
        work.table("feature_counts").show(truncate=False)
    elif args.stage == "split":
        if args.off_holidays and (args.train_end or not args.proportional):
            parser.error("--off-holidays moves the cut of --proportional and takes no --train-end")
        if args.off_holidays:
            work.spec = spec_with_quiet_cuts(work.table("features"), spec=work.spec)
        elif args.proportional:
            work.spec = spec_with_cuts(work.table("features"), spec=work.spec, train_end=args.train_end)
        work.split()
        work.table("split_counts").show(truncate=False)
    elif args.stage == "tune":
        work.tune(n_trials=args.trials, startup=args.startup).show(truncate=False)
    elif args.stage == "train":
        work.train_default()
        work.train_final()
    elif args.stage == "baseline":
        work.baseline_metrics().show(truncate=False)
    elif args.stage == "predict":
        work.predict()
    elif args.stage == "evaluate":
        work.evaluate().show(truncate=False)
    else:
        work.report(args.name, args.station, args.start, args.end).show(50, truncate=False)


if __name__ == "__main__":
    main()
