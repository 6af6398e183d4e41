"""N-gram files to parquet, once: python -m collodec.convert SOURCE TARGET"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .sources.ngrams import FORMATS, PARSE_MODES, convert_ngrams


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("collodec.convert", description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--format", choices=FORMATS, default="sequence")
    parser.add_argument("--parse-mode", choices=PARSE_MODES, default="FAILFAST")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("collodec-convert").getOrCreate()
    convert_ngrams(spark, args.source, args.target, args.format, args.parse_mode)


if __name__ == "__main__":
    main()
