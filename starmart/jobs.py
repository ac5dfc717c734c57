"""Command line: ``spark-submit starmart_job.py <job> <in> <out>`` or ``python -m starmart.jobs``.

``<in>`` and ``<out>`` are folders; the names below them can be given as options. The job ``all``
runs every job in order and then checks that each output exists and has rows.
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starmart.operators.pivot import MAX_CATEGORIES
from starmart.operators.quality import require_outputs
from starmart.plans import airports, arrivals, demographics, enriched, labels, weather
from starmart.sources.readers import read_code_map, read_code_maps, read_parquet

INPUTS = {
    "labels": "labels.txt",
    "airports": "airports.csv",
    "demographics": "demographics.csv",
    "weather": "weather.csv",
    "arrivals": "arrivals/*.parquet",
}

OUTPUTS = {
    "labels": "parquet",
    "airports": "csv",
    "demographics": "csv",
    "weather": "csv",
    "arrivals": "parquet",
    "enriched": "parquet",
}


def _join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def _dictionary(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.code_maps:
        sections = [section for section, *_ in arrivals.LOOKUPS]
        paths = {s: _join(args.code_maps, f"{s}.json") for s in sections}
        return read_code_maps(spark, paths, args.multi_line)
    path = _join(args.output, "labels")
    return read_code_map(spark, path) if args.labels_format == "json" else read_parquet(spark, path)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    source = {name: _join(args.input, getattr(args, f"{name}_file")) for name in INPUTS}
    out = {name: _join(args.output, name) for name in OUTPUTS}
    formats = {**OUTPUTS, "labels": args.labels_format}
    steps = {
        "labels": lambda: labels.run(
            spark, source["labels"], out["labels"], args.parity, args.labels_format
        ),
        "airports": lambda: airports.run(spark, source["airports"], out["airports"]),
        "demographics": lambda: demographics.run(
            spark,
            source["demographics"],
            out["demographics"],
            args.races,
            parity=args.parity,
            max_categories=args.max_categories,
        ),
        "weather": lambda: weather.run(
            spark,
            source["weather"],
            out["weather"],
            args.years,
            args.country,
            dedupe="latest" if args.parity else "none",
            header=not args.parity,
        ),
        "arrivals": lambda: arrivals.run(
            spark, source["arrivals"], _dictionary(spark, args), out["arrivals"], args.partition_by
        ),
        "enriched": lambda: enriched.run(
            spark,
            out["arrivals"],
            out["demographics"],
            out["weather"],
            out["airports"],
            out["enriched"],
            weather_header=not args.parity,
        ),
        "check": lambda: require_outputs(
            spark,
            {
                name: (formats[name], path, {"header": not (args.parity and name == "weather")})
                for name, path in out.items()
            },
            min_rows=1,
        ),
    }
    if args.job != "all":
        steps[args.job]()
        return
    for step in steps.values():
        step()


def parser() -> argparse.ArgumentParser:
    parse = argparse.ArgumentParser(prog="starmart")
    parse.add_argument("job", choices=[*OUTPUTS, "check", "all"])
    parse.add_argument("input")
    parse.add_argument("output")
    for name, default in INPUTS.items():
        parse.add_argument(f"--{name}-file", default=default)
    parse.add_argument("--labels-format", choices=["parquet", "json"], default=OUTPUTS["labels"])
    parse.add_argument("--code-maps", help="folder of JSON code maps, instead of the labels table")
    parse.add_argument("--multi-line", action="store_true", help="a code map is one object per file")
    parse.add_argument("--max-categories", type=int, default=MAX_CATEGORIES)
    parse.add_argument("--years", type=int, default=weather.YEARS)
    parse.add_argument("--country", default=weather.COUNTRY)
    parse.add_argument("--races", nargs="*", help="race columns; default: those in the data")
    parse.add_argument("--partition-by", nargs="*", default=[], help="columns of the arrivals folders")
    parse.add_argument("--parity", action="store_true", help="original rules, not repaired ones")
    return parse


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(SparkSession.builder.appName(f"starmart-{args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
