"""Named stages over a set of tables, and the command line job."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Stage:
    """A transform of tables: it reads those in ``needs`` and returns those it makes or replaces."""

    name: str
    needs: tuple[str, ...]
    apply: Callable[..., Tables]
    wanted: bool = True


def run_stages(stages: list[Stage], tables: Tables) -> dict[str, DataFrame]:
    """All tables after the stages, in order; stages that are not wanted are passed over.  Nothing runs until a table is read."""
    out = dict(tables)
    for stage in stages:
        if not stage.wanted:
            continue
        missing = [n for n in stage.needs if n not in out]
        if missing:
            raise ValueError(f"stage {stage.name} needs {', '.join(missing)}")
        out |= stage.apply(*[out[n] for n in stage.needs])
    return out


def parse_stages(options) -> list[Stage]:
    """Detected boxes and recognised spans to blocks, JSON and Markdown."""
    from pagewright.plans import document

    return [
        Stage("cleaning", ("blocks",), lambda b: {"blocks": document.clean(b, options)}),
        Stage("parsing", ("blocks", "spans"), lambda b, s: {"parsed": document.parse(b, s, options)}),
        Stage("json", ("parsed",), lambda p: {"json": document.to_json(p)}),
        Stage("markdown", ("parsed",), lambda p: {"markdown": document.to_markdown(p)}),
    ]


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """``python -m pagewright.plans.stages --blocks … --spans … --out … [--config …] [-o name=value …] [--lang …]``.

    ``--blocks`` and ``--spans`` are Parquet; with ``--lang en uk`` they hold a folder a language
    and each is written to a folder of its own.  A language that fails is reported and the
    others go on; the result is the number of those that failed.
    """
    from pagewright.plans import document
    from pagewright.sources import writers

    parser = argparse.ArgumentParser(description="Parses detected boxes and recognised spans into documents.")
    for name in ("--blocks", "--spans", "--out"):
        parser.add_argument(name, required=True)
    parser.add_argument("--config", help="YAML file of options")
    parser.add_argument("-o", "--override", nargs="*", default=[], help="name=value")
    parser.add_argument("--lang", nargs="*", default=[])
    given = parser.parse_args(arguments)
    options = (document.Options.from_yaml(given.config) if given.config else document.Options()).override(*given.override)
    spark = spark or SparkSession.builder.getOrCreate()
    failed = 0
    for lang in given.lang or [""]:
        at = lambda root, lang=lang: f"{root}/{lang}" if lang else root
        try:
            made = run_stages(parse_stages(options), {"blocks": spark.read.parquet(at(given.blocks)), "spans": spark.read.parquet(at(given.spans))})
            writers.save_all({k: made[k] for k in ("json", "markdown")}, at(given.out))
        except Exception as e:
            failed += 1
            print(f"{lang or given.blocks}: {type(e).__name__}: {e}".splitlines()[0], file=sys.stderr)
    return failed


if __name__ == "__main__":
    sys.exit(main())
