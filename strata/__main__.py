"""Command line: ``python -m strata refresh IN OUT --as-of YYYY-MM-DD`` runs the full
refresh (H14); ``python -m strata question q1_top_authorities OUT ANSWER`` writes the answer of one of
the analytic questions over the gold tables.  On a cluster submit it with spark-submit,
which supplies the master and ``spark.checkpoint.dir``."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from strata.plans import questions, refresh
from strata.session import get_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="raw -> bronze -> silver -> gold")
    r.add_argument("in_dir")
    r.add_argument("out_dir")
    r.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    r.add_argument("--strict", action="store_true", help="fail on bad casts (ANSI)")
    r.add_argument("--duplicates", choices=["error", "last"], default="error")
    q = sub.add_parser("question", help="one analytic question over the gold tables")
    q.add_argument("name", choices=sorted(questions.ALL))
    q.add_argument("out_dir")
    q.add_argument("answer", help="folder that gets the whole answer (CSV with a header)")
    args = ap.parse_args(argv)
    spark = get_session()
    if args.cmd == "refresh":
        res = refresh.refresh(spark, args.in_dir, args.out_dir, args.as_of, args.strict,
                              args.duplicates)
        print(json.dumps({"merge": res["merge"], "gold": sorted(res["gold"])}))
    else:
        gold = refresh.gold_tables(spark, args.out_dir)
        questions.ALL[args.name](gold).write.mode("overwrite").option("header", True).csv(args.answer)


if __name__ == "__main__":
    main()
