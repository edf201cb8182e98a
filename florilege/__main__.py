"""Command line: ``python -m florilege parse|normalize|report`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from florilege.plans import pipeline


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="florilege", description="Wiki dumps to quotes and a report of their quality.")
    steps = p.add_subparsers(dest="step", required=True)
    s = steps.add_parser("parse", help="dump to layer 1 and the redirect map")
    s.add_argument("--wiki-language", default="en")
    for name in ("input", "pages", "redirects"):
        s.add_argument(f"--{name}", required=True)
    s = steps.add_parser("normalize", help="layer 1 to quotes")
    s.add_argument("--wiki-language", default="en", help="taken from the pages; accepted as for parse")
    for name in ("pages", "out"):
        s.add_argument(f"--{name}", required=True)
    s = steps.add_parser("report", help="layer 1 and quotes to the report")
    for name in ("pages", "quotes", "out"):
        s.add_argument(f"--{name}", required=True)
    for s in steps.choices.values():
        s.add_argument("--form", choices=("parquet", "jsonl"), default="parquet", help="of layer 1: flat blocks, or nested documents as gzip JSON Lines")
    return p


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"florilege {a.step}").getOrCreate()
    if a.step == "parse":
        counted = pipeline.parse(spark, a.input, a.pages, a.redirects, a.wiki_language, a.form)
    elif a.step == "normalize":
        counted = pipeline.normalise(spark, a.pages, a.out, a.form)
    else:
        made = pipeline.make_report(spark, a.pages, a.quotes, a.out, a.form)
        counted = {"pages": made["pages"]["pages"], "quotes": made["quotes"]["overall"].get("quotes", 0)}
    print(", ".join(f"{k} {v}" for k, v in counted.items()), file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
