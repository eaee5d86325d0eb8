"""python -m arearisk {prepare,combine,analyse,all} --root DATA --output OUT"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from arearisk.config import Catalogue
from arearisk.plans import jobs
from arearisk.scratch import release


def main() -> None:
    ap = argparse.ArgumentParser(prog="arearisk")
    ap.add_argument("step", choices=["prepare", "combine", "analyse", "all"])
    ap.add_argument("--root", default="./data")
    ap.add_argument("--output", default="./output")
    args = ap.parse_args()
    spark = SparkSession.builder.appName("arearisk").getOrCreate()
    cat = Catalogue(args.root, args.output)
    for step in ("prepare", "combine", "analyse") if args.step == "all" else (args.step,):
        getattr(jobs, step)(spark, cat)
        release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
