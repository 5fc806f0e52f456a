"""python -m millrace COMMAND: drafts from a source tree, their enrichment, and chat rows."""

from __future__ import annotations

import argparse


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description=__doc__)
    kinds = top.add_subparsers(dest="command", required=True)
    for name, text in (("line-drafts", "drafts of the line rules"), ("anchor-drafts", "drafts of the anchor rules")):
        p = kinds.add_parser(name, help=text)
        p.add_argument("--tree", required=True, help="root of the source tree")
        p.add_argument("--out", required=True, help="folder of JSON lines")
        if name == "anchor-drafts":
            p.add_argument("--max-items", type=int, default=200)
    p = kinds.add_parser("enrich", help="ask a model for questions, answers and traces; ids in the output are left out")
    p.add_argument("--items", required=True)
    p.add_argument("--out", required=True, help="folder of JSON lines, appended to")
    p.add_argument("--errors", required=True, help="folder of the error log, appended to")
    p.add_argument("--scenario", type=int, choices=(1, 2), default=2)
    p.add_argument("--url", required=True, help="address of a chat-completions service")
    p.add_argument("--model", required=True)
    p.add_argument("--key-file", help="file that holds the service's key")
    p.add_argument("--timeout", type=float, default=60)
    p.add_argument("--workers", type=int, default=5, help="requests at a time")
    p = kinds.add_parser("chat-rows", help="system, user and target texts of enriched items")
    p.add_argument("--items", required=True, nargs="+")
    p.add_argument("--out", required=True)
    return top


def run(spark, args: argparse.Namespace) -> int:
    """Runs a command; gives the number of rows that it wrote."""
    from millrace.operators import enrich as E
    from millrace.operators import rules as R
    from millrace.operators.sft import sft_rows
    from millrace.sources import jsonl
    from millrace.sources.pyfiles import source_tree
    from millrace.storage import materialize

    if args.command == "line-drafts":
        jsonl.write_items(R.as_items(R.run_line_rules(source_tree(spark, args.tree))), args.out)
        return spark.read.text(args.out).count()
    if args.command == "anchor-drafts":
        jsonl.write_items(R.anchor_items(R.run_anchor_rules(source_tree(spark, args.tree, "documents"), max_items=args.max_items)), args.out)
        return spark.read.text(args.out).count()
    if args.command == "enrich":
        key = open(args.key_file).read().strip() if args.key_file else None
        todo = E.remaining(jsonl.read_items(spark, args.items), jsonl.done_ids(spark, args.out)).repartition(args.workers)
        done = materialize(E.enrich(todo, E.chat_model(args.url, args.model, key, args.timeout), scenario2=args.scenario == 2), "enriched")
        jsonl.write_items(done, args.out, append=True)
        E.append_errors(done, args.errors)
        return done.count()
    rows = sft_rows(jsonl.read_items(spark, *args.items))
    rows.write.mode("overwrite").json(args.out)
    return spark.read.text(args.out).count()


def main() -> None:
    from millrace.session import local_session

    args = parser().parse_args()
    print(run(local_session(), args), "rows")


if __name__ == "__main__":
    main()
