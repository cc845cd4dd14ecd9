"""Command line: ``python -m lexstrata catalog|convert|index``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import catalog as C
from .plans import convert as X
from .sources import readers, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexstrata")
    jobs = top.add_subparsers(dest="job", required=True)
    one = jobs.add_parser("catalog", help="stored HTML index pages to a catalog")
    one.add_argument("--html", required=True)
    one.add_argument("--out")
    one.add_argument("--list", action="store_true", help="print entries only")
    one.add_argument("--limit", type=int, default=0)
    two = jobs.add_parser("convert", help="extracted pages (Parquet) to Markdown")
    two.add_argument("--pages", required=True)
    two.add_argument("--catalog", required=True)
    two.add_argument("--out", required=True)
    two.add_argument("--existing", help="folder of finished files to skip")
    two.add_argument("--limit", type=int, default=0)
    two.add_argument("--strict", action="store_true")
    three = jobs.add_parser("index", help="coverage index of a catalog")
    three.add_argument("--catalog", required=True)
    three.add_argument("--markdown", required=True)
    three.add_argument("--out", required=True)
    three.add_argument("--today", required=True, help="dd/mm/yyyy")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.job == "catalog":
        entries = X.catalog_from_html(readers.read_html(spark, args.html))
        if args.list or not args.out:
            shown = C.listing(entries).orderBy("pos")
            for row in (shown.limit(args.limit) if args.limit else shown).toLocalIterator():
                print(row["line"])
        else:
            sinks.write_catalog(entries, args.out, single_array=True)
    elif args.job == "convert":
        existing = readers.existing_outputs(spark, args.existing) if args.existing else None
        out = X.convert(spark.read.parquet(args.pages), readers.read_catalog(spark, args.catalog), existing, args.limit, args.strict)
        sinks.write_documents(out.where("status = 'converted'"), args.out)
        print(C.status_counts(out).first().asDict())
    else:
        entries, have = readers.read_catalog(spark, args.catalog, strict=True), readers.existing_outputs(spark, args.markdown)
        state = C.coverage_summary(entries, have).first()
        index = C.coverage_index(X.entry_slug(entries), have)
        sinks.write_index(sinks.index_lines(index, args.today, state["done"], state["total"]), args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
