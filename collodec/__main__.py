"""The whole batch as a job: python -m collodec eng --corpus ... --stop-words ... --output ...

Sequence files are converted once before: python -m collodec.convert SOURCE TARGET
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .functions.likelihood import MODES
from .functions.text import CLEAN_RULES
from .plans.pipeline import RUN_FORMATS, run
from .sinks.tables import RunPaths
from .sources.ngrams import PARSE_MODES, corpus
from .sources.tables import read_stop_words


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("collodec", description="Score collocations per decade.")
    parser.add_argument("language", choices=sorted(CLEAN_RULES))
    parser.add_argument("--corpus", help="folder of the n-gram collections")
    parser.add_argument("--unigrams", help="path of the 1-grams, if not below --corpus")
    parser.add_argument("--bigrams", help="path of the 2-grams, if not below --corpus")
    parser.add_argument("--format", choices=RUN_FORMATS, default="parquet")
    parser.add_argument("--parse-mode", choices=PARSE_MODES, default="FAILFAST")
    parser.add_argument("--stop-words", required=True, help="file with one word per line")
    parser.add_argument("--output", required=True, help="folder of all runs")
    parser.add_argument("--run-id", help="folder of this run; a new one if not given")
    parser.add_argument("--score-mode", choices=MODES, default="log")
    parser.add_argument("--score-format", choices=("text", "parquet"), default="text")
    parser.add_argument("--stage-format", choices=("text", "parquet"), default="parquet")
    parser.add_argument("--required", action="store_true", help="drop pairs without both counts")
    parser.add_argument("--resume", action="store_true", help="go on with the run of --run-id")
    parser.add_argument("--sorted", action="store_true", help="order the scores")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> RunPaths:
    args = _arguments(argv)
    source = corpus(args.language, args.corpus, args.unigrams, args.bigrams)
    paths = RunPaths(args.output, args.run_id) if args.run_id else RunPaths(args.output)
    spark = SparkSession.builder.appName(f"collodec-{args.language}").getOrCreate()
    run(
        spark,
        source,
        read_stop_words(spark, args.stop_words),
        paths,
        fmt=args.format,
        parse_mode=args.parse_mode,
        score_mode=args.score_mode,
        score_fmt=args.score_format,
        sorted=args.sorted,
        required=args.required,
        stage_fmt=args.stage_format,
        resume=args.resume,
    )
    return paths


if __name__ == "__main__":
    print(main().scores)
