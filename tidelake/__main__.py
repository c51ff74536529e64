"""Command line: ``python -m tidelake <command> --root <lake>``."""

from __future__ import annotations

import argparse

from tidelake.plans import adhoc, jobs
from tidelake.session import get_session
from tidelake.sources import catalog, writers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidelake")
    top.add_argument("--root", default="lake", help="directory or bucket that holds bronze, silver and gold")
    top.add_argument("--master", default=None, help="Spark master; left to spark-submit by default")
    commands = top.add_subparsers(dest="command", required=True)
    query = commands.add_parser("query", help="run SQL over the registered tables; print all rows and their number")
    query.add_argument("sql")
    query.add_argument("--output", default=None, help="write the rows there as CSV instead of printing them")
    commands.add_parser("merge", help="merge bronze bars and points into silver")
    commands.add_parser("load", help="load raw payload files of all sources into silver; counts what was rejected")
    gold = commands.add_parser("gold", help="build the gold exports from silver")
    gold.add_argument("--indicator", default="SP.POP.TOTL", help="indicator of the growth report")
    commands.add_parser("warehouse", help="load the star schema from silver and publish its views")
    commands.add_parser("catalog", help="export databases, tables and columns as JSON")
    commands.add_parser("tables", help="list the registered tables and their columns")
    return top


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = get_session(master=options.master)
    root = options.root
    if options.command == "tables":
        for name, entry in catalog.TABLES.items():
            print(f"{name}  {entry.format}  {root}/{entry.path}  ({entry.schema})")
    elif options.command == "merge":
        state = f"{root}/silver/merge_state"
        for name, merge, bronze, silver in (
                ("market/ohlcv", jobs.merge_market, "bronze.bars", "silver.market_ohlcv"),
                ("macro/observations", jobs.merge_macro, "bronze.points", "silver.macro_observations")):
            ran = merge(spark, f"{root}/{catalog.TABLES[bronze].path}", f"{root}/{catalog.TABLES[silver].path}", state)
            print(f"{name}: {'merged' if ran else 'unchanged'}")
    elif options.command == "load":
        for source in jobs.FEEDS:
            bronze = f"{root}/bronze/{source}"
            try:
                rejected = jobs.load_feed(spark, source, bronze, root)
            except FileNotFoundError:
                print(f"{source}: no raw files")
                continue
            print(f"{source}: loaded, {rejected.count()} payloads rejected")
    elif options.command == "gold":
        for row in jobs.build_gold(spark, jobs.standard_outputs(jobs.gold_inputs(spark, root), options.indicator), f"{root}/gold").collect():
            print(f"{row['output']}: {row['status']}" + (f" ({row['reason']})" if row["reason"] else ""))
    elif options.command == "warehouse":
        star = jobs.load_warehouse(spark, root)
        jobs.store_star(star, f"{root}/star")
        adhoc.publish_views(spark, jobs.stored_star(spark, f"{root}/star", jobs.schemas_of(star)), f"{root}/views")
        print("star schema loaded, views published")
    elif options.command == "catalog":
        layers: dict[str, dict] = {}
        for name in catalog.register_existing(spark, root):
            layers.setdefault(name.partition(".")[0], {})[name.partition(".")[2]] = catalog.read_table(spark, root, name)
        print(f"{jobs.export_catalog(spark, layers, root, f'{root}/catalog').count()} tables")
    else:
        catalog.register_existing(spark, root)
        rows = adhoc.query(spark, options.sql)
        if options.output:
            writers.write_csv(rows, options.output)
        else:
            print("\t".join(rows.columns))
            number = 0
            for number, row in enumerate(rows.toLocalIterator(prefetchPartitions=True), 1):
                print("\t".join("" if v is None else str(v) for v in row))
            print(f"({number} rows)")


if __name__ == "__main__":
    main()
