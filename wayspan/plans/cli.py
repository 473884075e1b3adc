"""Command line: ``spark-submit -m wayspan.plans.cli speed|rides|depots|publish|sync ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from .. import session
from ..operators import depots
from ..params import Params
from ..sources import schedule, snapshots, stores
from ..tables import scope
from . import ingest, publish


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wayspan")
    p.add_argument("--raw", default="raw", help="folder of snapshots by day")
    p.add_argument("--static", default="static", help="folder of schedule archives by date")
    p.add_argument("--out", default="data", help="folder of derived tables")
    p.add_argument("--workers", type=int, help="threads of a run on this machine; on a cluster its own settings hold")
    sub = p.add_subparsers(dest="job", required=True)
    for job in ("speed", "rides"):
        s = sub.add_parser(job)
        s.add_argument("days", nargs="*")
        s.add_argument("--all", action="store_true")
        s.add_argument("--force", action="store_true")
        if job == "rides":
            s.add_argument("--paths-only", action="store_true")
    s = sub.add_parser("depots")
    s.add_argument("--list", action="store_true")
    s.add_argument("--merge", action="store_true")
    s.add_argument("--force", action="store_true")
    sub.add_parser("publish").add_argument("--web", default="web")
    s = sub.add_parser("sync")
    s.add_argument("way", choices=("pull", "push"))
    s.add_argument("remote")
    return p


def _schedule(spark, args, day: str, p: Params) -> tuple[schedule.Schedule, str]:
    """The day's schedule, built once for each archive and kept as tables."""
    date = stores.static_date_for(day, stores.dates(spark, args.static))
    if date is None:
        raise FileNotFoundError(f"{args.static}: no schedule archives")
    kept = f"{args.out}/schedule"
    if date not in stores.dates(spark, f"{kept}/stop_dist"):
        files = [n for n in stores.names(spark, f"{args.static}/{date}") if n.endswith(".zip")]
        if not files:
            raise FileNotFoundError(f"{args.static}/{date}: no schedule archive")
        schedule.build(schedule.read_archive(spark, f"{args.static}/{date}/{files[0]}"), p).write(kept, date)
    return schedule.Schedule.read(spark, kept, date), date


def read_sites(spark, path: str):
    """Depot sites, none if the file is absent."""
    fs, p = stores._fs(spark, path)
    if not fs.exists(p):
        return []
    found = spark.read.json(path, multiLine=True)
    if "array<struct" not in dict(found.dtypes).get("sites", ""):
        return []
    return [r.asDict() for r in found.select(F.explode("sites").alias("s")).select("s.*").collect()]


def main(argv: list[str] | None = None) -> None:
    args, p = parser().parse_args(argv), Params.from_env()
    spark = session.build(master=f"local[{args.workers}]" if args.workers else None)
    if args.job in ("speed", "rides"):
        kinds = ("agg", "hist") if args.job == "speed" else ("seg", "seghist")
        days = ingest.missing(spark, args.out, stores.dates(spark, args.raw) if args.all else args.days, kinds, args.force)
        zones = zones_of(spark, read_sites(spark, f"{args.out}/depots.json")) if args.job == "speed" else ()
        for day in [] if getattr(args, "paths_only", False) else days:
            s, _ = _schedule(spark, args, day, p)
            rows = snapshots.readable(snapshots.read_snapshots(spark, f"{args.raw}/{day}"))
            ingest.ingest_speed(rows, s, args.out, zones, p) if args.job == "speed" else ingest.ingest_rides(rows, s, args.out, p)
        if args.job == "rides":
            newest = max(stores.dates(spark, args.static))
            s, date = _schedule(spark, args, newest, p)
            ingest.paths_document(s, date).coalesce(1).write.mode("overwrite").text(f"{args.out}/paths")
    elif args.job == "depots":
        write_depots(spark, args, p)
    elif args.job == "publish":
        t = publish.load(spark, args.out)
        newest = max(stores.dates(spark, args.static), default=None)
        paths = _schedule(spark, args, newest, p)[0].paths if newest and t.seg is not None else None
        with scope():
            publish.write_all(publish.publish(t, paths, zones_of(spark, read_sites(spark, f"{args.out}/depots.json")), p), args.web, spark)
    else:
        a, b = (args.remote, args.out) if args.way == "pull" else (args.out, args.remote)
        print(len(stores.mirror(spark, a, b)))


def zones_of(spark, sites: list[dict]) -> list[tuple[float, float, float]]:
    """Planar circles of a few sites."""
    from ..functions.expr import project_xy

    if not sites:
        return []
    x, y = project_xy(F.col("lon"), F.col("lat"))
    df = spark.createDataFrame([(float(s["lat"]), float(s["lon"]), float(s["radius_m"])) for s in sites], "lat double, lon double, r double")
    return [tuple(r) for r in df.select(x, y, "r").collect()]


def write_depots(spark, args, p: Params) -> None:
    path = f"{args.out}/depots.json"
    old = read_sites(spark, path)
    if old and not (args.list or args.merge or args.force):
        raise FileExistsError(f"{path} exists: --merge or --force")
    t = publish.load(spark, args.out)
    stops = _schedule(spark, args, max(stores.dates(spark, args.static)), p)[0].pattern_stop
    columns = ["x", "y", "lat", "lon", "radius_m", "cells", "samples", "kmh"]
    found = depots.discover(t.agg, stops, p).select(*columns)
    if args.merge and old:
        known = [(x, y, float(s["lat"]), float(s["lon"]), r, int(s.get("cells") or 0), int(s.get("samples") or 0), float(s.get("kmh") or 0)) for (x, y, r), s in zip(zones_of(spark, old), old, strict=True)]
        found = depots.merge_sites(spark.createDataFrame(known, found.schema), found)
    rows = [{k: r[k] for k in columns[2:]} for r in found.orderBy(F.desc("samples"), "x", "y").collect()]  # tens of sites
    print(f"{len(rows)} sites, {sum(r['samples'] for r in rows)} samples")
    if args.list:
        for r in rows[:20]:
            print(r)
        if len(rows) > 20:
            print(f"... {len(rows) - 20} more")
        return
    criteria = {"max_kmh": p.depot_max_kmh, "min_samples": p.depot_min_samples, "min_hours": p.depot_min_hours}
    spark.createDataFrame([(json.dumps({"criteria": criteria, "sites": rows}),)], "value string").coalesce(1).write.mode("overwrite").text(path)


if __name__ == "__main__":
    main()
