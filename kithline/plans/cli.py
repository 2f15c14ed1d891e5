"""Command line: ``python -m kithline.plans.cli --mode train --train DIR``."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from ..operators import evaluate
from ..operators.blocking import STRATEGIES
from ..operators.models import MODELS
from ..packaging import ship
from ..schema import Settings
from . import linker


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kithline", description="Record linkage of a master source with two noisy ones.")
    p.add_argument("--mode", choices=["train", "validate", "predict", "all"], default="all")
    p.add_argument("--model", choices=sorted(MODELS), default=None)
    p.add_argument("--blocking", nargs="+", choices=sorted(STRATEGIES), default=None, metavar="STRATEGY", help=f"of {sorted(STRATEGIES)}")
    p.add_argument("--threshold", type=float, default=None, help="use this threshold instead of the tuned or stored one")
    p.add_argument("--train", default="data/train", help="folder of source1.tsv, source2.tsv, source3.tsv and ground_truth.tsv")
    p.add_argument("--test", default="data/test", help="folder of source1.tsv, source2.tsv and source3.tsv")
    p.add_argument("--out", default="output", help="folder of models and results")
    p.add_argument("--single-line", action="store_true", help="no cell holds a line break, so that all tasks read a large file")
    p.add_argument("--log", default=None, help="also log to this file")
    return p


def _paths(folder: str, out: str) -> linker.Paths:
    named = {f"s{i}": f"{folder}/source{i}.tsv" for i in (1, 2, 3)}
    return linker.Paths(**named, truth=f"{folder}/ground_truth.tsv", model=f"{out}/model", threshold=f"{out}/threshold.json", results=f"{out}/matching_results.tsv", candidates=f"{out}/candidate_pairs.tsv")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    handlers: list[logging.Handler] = [logging.StreamHandler()] + ([logging.FileHandler(args.log, encoding="utf-8")] if args.log else [])
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=handlers)
    chosen = {"model_type": args.model, "strategies": tuple(args.blocking) if args.blocking else None, "threshold": args.threshold, "multi_line": False if args.single_line else None}
    settings = Settings(**{k: v for k, v in chosen.items() if v is not None})
    spark = spark or SparkSession.builder.appName("kithline").getOrCreate()
    ship(spark)
    train, test = _paths(args.train, args.out), _paths(args.test, args.out)
    try:
        if args.mode == "train":
            print({k: v for k, v in linker.run_train(spark, train, settings).items() if k != "model"})
        elif args.mode == "validate":
            figures = linker.run_validate(spark, train, settings)
            evaluate.print_report(spark.createDataFrame([figures]))
        elif args.mode == "predict":
            linker.run_predict(spark, test, settings)
        else:
            linker.run_all(spark, train, test, settings)
    except (FileNotFoundError, ValueError) as e:
        logging.getLogger("kithline").error("%s", e)
        return 1
    except KeyboardInterrupt:
        return 130
    return 0


if __name__ == "__main__":
    sys.exit(main())
