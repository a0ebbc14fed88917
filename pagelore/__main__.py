"""Run one job: ``python -m pagelore JOB ...``, or submit this file with the package zipped."""

import argparse
import inspect

from pagelore.plans import jobs
from pagelore.session import build_session

JOBS = {
    "feeds": jobs.transform_feeds,
    "urls-csv": jobs.urls_to_parquet,
    "urls": jobs.transform_urls,
    "anchors": jobs.transform_anchors,
    "compact": jobs.compact_parquet,
    "raw-pages": jobs.raw_pages_to_parquet,
    "quads": jobs.quads_to_parquet,
    "wiki-links": jobs.wiki_links_to_parquet,
    "wiki-paragraphs": jobs.extract_wiki_paragraphs,
    "tweet-links": jobs.extract_tweet_links,
    "knowledge-base": jobs.build_knowledge_base_by_name,
}


def build_parser() -> argparse.ArgumentParser:
    """One subcommand per job: required parameters by position, the others as options."""
    parser = argparse.ArgumentParser(prog="pagelore", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=(inspect.getdoc(job) or "").split("\n")[0])
        for parameter in list(inspect.signature(job).parameters.values())[1:]:
            if parameter.default is parameter.empty:
                command.add_argument(parameter.name)
            elif parameter.default is False:
                command.add_argument(_option(parameter.name), action="store_true")
            else:
                kind = int if parameter.name in ("files", "min_partitions", "buckets") else str
                command.add_argument(
                    _option(parameter.name), type=kind, default=parameter.default
                )
    return parser


def _option(name: str) -> str:
    return "--" + name.replace("_", "-")


def main(arguments: list[str] | None = None) -> None:
    chosen = vars(build_parser().parse_args(arguments))
    name = chosen.pop("job")
    report = JOBS[name](build_session(f"pagelore-{name}"), **chosen)
    if report:
        print(*(f"{what}: {n}" for what, n in report.items()), sep="\n")


if __name__ == "__main__":
    main()
