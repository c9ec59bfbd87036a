"""``spark-submit``-able entry: ``python -m cellframe <job> --help``."""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from cellframe.plans import jobs


JOBS = [
    jobs.create_table, jobs.write_sales, jobs.read_table, jobs.read_snapshot,
    jobs.bulk_load, jobs.delete_rows,
]
NUMBERS = {"start", "end", "at", "ts", "regions", "commit", "max_versions", "file_bytes"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cellframe")
    chosen = top.add_subparsers(dest="job", required=True)
    for job in JOBS:
        sub = chosen.add_parser(job.__name__.replace("_", "-"), help=job.__doc__)
        sub.set_defaults(run=job)
        for name, parameter in list(inspect.signature(job).parameters.items())[1:]:
            required = parameter.default is inspect.Parameter.empty
            flag = "--" + name.replace("_", "-")
            if isinstance(parameter.default, bool):
                sub.add_argument(
                    flag, action=argparse.BooleanOptionalAction,
                    default=parameter.default,
                )
            else:
                sub.add_argument(
                    flag, required=required, type=int if name in NUMBERS else str,
                    default=None if required else parameter.default,
                )
    return top


def main(argv: list[str] | None = None) -> None:
    options = vars(parser().parse_args(argv))
    run, _ = options.pop("run"), options.pop("job")
    left_out = run(SparkSession.builder.appName("cellframe").getOrCreate(), **options)
    if left_out:
        print(f"{left_out} rows or keys were blank and left out")


if __name__ == "__main__":
    main()
