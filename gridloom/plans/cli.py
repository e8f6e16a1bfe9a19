"""Command line: ``python -m gridloom.plans.cli COMMAND ...``; each prints one JSON object."""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.tables import pipes_from_html, within_budget
from gridloom.operators import combine
from gridloom.operators.evaluate import evaluate, summary
from gridloom.plans import runs
from gridloom.plans.presets import PRESETS, settings
from gridloom.sources import archives
from gridloom.sources.boxes import cached_tiles
from gridloom.sources.results import read_results, write_errors, write_results, write_scores


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for a in arguments:
            c.add_argument(a)
        return c

    command("inspect", "raw")
    command("extract", "pattern", "target")
    command("validate", "results", "template")
    c = command("overlay", "base", "overrides", "out")
    c.add_argument("--min-ratio", type=float, default=0.0)
    c.add_argument("--min-gain", type=int, default=0)
    c.add_argument("--max-duplicate", type=float, default=1.0)
    c = command("ensemble", "primary", "fallback", "out")
    c.add_argument("--max-chars", type=int, default=200)
    c.add_argument("--max-ratio", type=float, default=0.5)
    c.add_argument("--need-table", action="store_true")
    c = command("compact", "results", "out")
    c.add_argument("--budget", type=int, default=190_000)
    c = command("evaluate", "results", "labels")
    c.add_argument("--scores")
    for name, arguments in (("predict", ("raw", "template", "out")), ("baseline-submit", ("raw", "template", "out")), ("experiment-train", ("raw", "out"))):
        c = command(name, *arguments)
        c.add_argument("--recogniser", required=True, help="module:name of what makes a recogniser")
        c.add_argument("--cache")
        c.add_argument("--errors")
        c.add_argument("--boxes", help="Parquet of the pages' text boxes")
        c.add_argument("--preset", default="v1", choices=sorted(PRESETS))
        c.add_argument("--on-error", default="placeholder", choices=("placeholder", "empty", "raise"))
    c = command("remerge", "base", "tiles", "out")
    c.add_argument("--max-duplicate", type=float, default=0.30)
    c = command("rebuild-matrices", "base", "boxes", "raw", "out")
    c.add_argument("--preset", default="v4", choices=sorted(PRESETS))
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[dict, int]:
    """The report of a command and its exit code."""
    if args.command == "inspect":
        return archives.inspect(spark, args.raw), 0
    if args.command == "extract":
        return {"written": len(archives.extract(args.pattern, args.target))}, 0
    if args.command == "validate":
        row = combine.validation_report(read_results(spark, args.results, "error"), read_results(spark, args.template)).first().asDict()
        bad = any(row[k] for k in ("n_unnamed", "n_broken", "n_repeated", "n_missing", "n_unknown"))
        return row, int(bad)
    if args.command == "overlay":
        base, over = read_results(spark, args.base, "error"), read_overrides(spark, args.overrides)
        unknown, repeated = combine.unknown_overrides(base, over).count(), over.groupBy("file_name").count().where("count > 1").count()
        if unknown or repeated:
            return {"unknown": unknown, "repeated": repeated}, 1
        rows = combine.guarded_overlay(base, over, min_ratio=args.min_ratio, min_gain=args.min_gain, max_duplicate=args.max_duplicate)
        write_results(rows, args.out, single=True)
        return {"rows": rows.count(), "accepted": rows.where("accepted").count()}, 0
    if args.command == "ensemble":
        a, b = read_results(spark, args.primary, "error"), read_results(spark, args.fallback, "error").drop("ord")
        sides = combine.reconcile(a, b).where("status <> 'matched'").count()
        if sides:
            return {"unmatched": sides}, 1
        rows = combine.collapsed_fallback(a, b, max_chars=args.max_chars, max_ratio=args.max_ratio, need_table=args.need_table)
        write_results(rows, args.out, single=True)
        return {"rows": rows.count(), "fell_back": rows.where("fell_back").count()}, 0
    if args.command == "compact":
        rows = read_results(spark, args.results, "error")
        piped = F.coalesce(pipes_from_html("text"), F.col("text"))
        small = F.when(F.octet_length(piped) <= args.budget, piped).otherwise(within_budget(args.budget)(piped))
        out = rows.withColumn("text", small)
        failed = out.where("text is null").count()
        if not failed:
            write_results(out, args.out, single=True)
        return {"rows": out.count(), "over_budget": failed}, int(failed > 0)
    if args.command in ("predict", "baseline-submit", "experiment-train"):
        return run_pages(spark, args)
    if args.command == "remerge":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(args.tiles)
        rows = runs.remerged(read_results(spark, args.base, "error"), cached_tiles(files), args.max_duplicate)
        write_results(rows, args.out, single=True)
        return {"rows": rows.count(), "changed": rows.where("changed").count()}, 0
    if args.command == "rebuild-matrices":
        base = read_results(spark, args.base, "error").withColumn("issue", F.lit(None).cast("string"))
        sizes = runs.sized_pages(archives.page_images(spark, args.raw))
        rows = runs.rebuilt_matrices(base, spark.read.parquet(args.boxes), sizes, settings(args.preset))
        write_results(rows, args.out, single=True)
        return {"rows": rows.count(), "changed": rows.join(base.select("file_name", F.col("text").alias("_t")), "file_name").where("text <> _t").count()}, 0
    truths = archives.directory_markdown(spark, args.labels).select("file_name", "text")
    scores = evaluate(read_results(spark, args.results), truths)
    if args.scores:
        write_scores(scores, args.scores, single=True)
    return summary(scores).first().asDict(), 0


def read_overrides(spark: SparkSession, paths: str) -> DataFrame:
    """Override sets of several files, named with commas between."""
    return reduce(DataFrame.unionByName, [read_results(spark, p, "error").drop("ord") for p in paths.split(",")])


def run_pages(spark: SparkSession, args: argparse.Namespace) -> tuple[dict, int]:
    pages = runs.sized_pages(archives.page_images(spark, args.raw))
    reader, s = runs.recogniser_of(args.recogniser), settings(args.preset, on_error=args.on_error)
    if args.command == "experiment-train":
        labels = archives.directory_markdown(spark, args.raw).select("file_name", "text")
        scores = runs.train_experiment(pages, labels, reader, s, {"dev": 0.2, "validation": 0.2, "test": 0.6}, args.cache)
        write_scores(scores.select("file_name", "split", *[c for c in scores.columns if c not in ("file_name", "split")]), args.out, single=True)
        return {r["split"] or "all": r["mean_overall"] for r in runs.scores_by_split(scores).collect()}, 0
    template = read_results(spark, args.template).select("ord", "file_name")
    boxes = spark.read.parquet(args.boxes) if args.boxes else None
    run = runs.predict(pages, template, reader, s, args.cache) if args.command == "predict" else runs.baseline(pages, template, reader, s, args.cache, boxes)
    write_results(run.results.join(template, "file_name"), args.out, single=True)
    if args.errors:
        write_errors(run.errors, args.errors, single=True)
    return {"rows": run.results.count(), "errors": run.errors.count()}, 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    report, code = run(SparkSession.builder.appName("gridloom").getOrCreate(), args)
    print(json.dumps(report, ensure_ascii=False))
    return code


if __name__ == "__main__":
    sys.exit(main())
