"""Trending words of a document collection, as a job.

    python -m trainlake.plans.trends --file-name sample --source <path> --target <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from trainlake.operators.trend import trending
from trainlake.session import get_session, spread_scan
from trainlake.sources.documents import collection_name, read_documents, text_field
from trainlake.sources.tables import write_table


def run_trends(
    spark: SparkSession,
    file_name: str,
    source: str,
    target: str,
    source_format: str = "json",
    target_format: str = "parquet",
    **read_options: str,
) -> str:
    """Write all words by falling count to <target>/trends-<collection>, replacing it."""
    name = collection_name(file_name)
    field = text_field(name)
    documents = spread_scan(read_documents(spark, source, source_format, **read_options))
    path = f"{target.rstrip('/')}/trends-{name}"
    write_table(trending(documents, field), path, target_format)
    return path


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Count the trending words of a document collection.")
    parser.add_argument("--file-name", default="sample", help="name of the collection")
    parser.add_argument("--source", required=True, help="path of the documents")
    parser.add_argument("--target", required=True, help="folder for the result table")
    parser.add_argument("--source-format", default="json")
    parser.add_argument("--target-format", default="parquet")
    args = parser.parse_args(argv)
    spark = get_session("trends")
    run_trends(spark, args.file_name, args.source, args.target, args.source_format, args.target_format)


if __name__ == "__main__":
    main()
