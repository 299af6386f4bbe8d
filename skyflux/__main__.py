"""python -m skyflux process|convert|availability ...: the pipelines from a shell, also as one of several array tasks."""

from __future__ import annotations

import argparse
import os
import uuid

from .plans import pipeline
from .session import get_session
from .sources.sinks import bare, remove, write_parts


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="skyflux", description=__doc__)
    parser.add_argument("command", choices=["process", "convert", "availability"])
    parser.add_argument("files", nargs="*", help="raw or lvl0 files; none: what is found under --root")
    parser.add_argument("--root")
    parser.add_argument("--glob", default="*")
    parser.add_argument("--output", required=True)
    parser.add_argument("--mode", default="both", choices=["lvl2", "lvl3", "both"])
    parser.add_argument("--infer-missing", action="store_true")
    parser.add_argument("--versions", nargs="*")
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--tasks", type=int, default=1, help="contiguous parts that the files are dealt to")
    parser.add_argument("--task", type=int, default=int(os.environ.get("SLURM_ARRAY_TASK_ID", 0)))
    parser.add_argument("--stations", help="availability: the station table")
    parser.add_argument("--second", default="receiver2", help="availability: what paths of the second generation contain")
    parser.add_argument("--codes", nargs="*", default=[], help="availability: abcd=CODE for the fourth generation's files")
    parser.add_argument("--months", type=int, default=3)
    a = parser.parse_args(argv)
    spark = get_session()
    if a.command == "availability":
        from .plans.availability import report

        print(*report(spark, a.root, a.stations, a.output, a.second, dict(c.split("=") for c in a.codes), a.months, glob=a.glob, overwrite=a.overwrite), sep="\n")
        return 0
    levels = ("lvl0",) if a.command == "convert" else tuple(n for n in pipeline.LEVELS if a.mode in (n, "both"))
    files = pipeline.resolve_inputs(spark, a.files or None, a.root, a.glob, a.infer_missing, a.output, set(a.versions) if a.versions else None, levels=levels)
    files = pipeline.chunk(files, a.tasks, a.task)
    if not a.overwrite:
        there = pipeline.done(spark, a.output, levels)
        files = [f for f in files if bare(os.path.abspath(f) if "://" not in f else f) not in there]
    if not files:
        print("nothing to do")
        return 0
    if a.command == "process":
        work = f"{a.output}/_work-{uuid.uuid4().hex}"
        out = pipeline.process(spark, files, a.mode, work)
        made, errors = pipeline.write_products(out, a.output, a.overwrite), out.errors
    else:
        work = None
        lvl0, errors = pipeline.convert(spark, files)
        write_parts(lvl0, f"{a.output}/lvl0", a.overwrite, sort=("row_id",))
        made = [f"{a.output}/lvl0"]
    failed = errors.toPandas()
    if work:
        remove(spark, work)
    for row in failed.itertuples():
        print(f"{row.file_id}: {row.error}")
    print(*made, sep="\n")
    return int(len(failed) > 0)


if __name__ == "__main__":
    raise SystemExit(main())
