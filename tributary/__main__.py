"""Command line: run one day of the platform.

    spark-submit --py-files tributary.zip -m tributary run-day --date 2025-11-20 \\
        --lake s3a://lake --customers s3a://in/customers --call-logs s3a://in/call_logs \\
        --social-media s3a://in/social_media --spreadsheet s3a://in/sheets \\
        --jdbc-url jdbc:postgresql://db/complaints --jdbc-user etl --jdbc-password-env DB_PASSWORD

(or ``python -m tributary run-day ...``).  Credentials are read from the
environment and passed to Spark only as reader options (decision Z8).
Prints the day's result as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tributary")
    sub = p.add_subparsers(dest="command", required=True)
    d = sub.add_parser("run-day", help="land, load and model one execution date")
    d.add_argument("--date", required=True, help="execution date YYYY-MM-DD")
    d.add_argument("--lake", required=True, help="lake root (raw layer, audit)")
    d.add_argument("--customers")
    d.add_argument("--call-logs")
    d.add_argument("--social-media")
    d.add_argument("--spreadsheet", help="folder of exported tabs (agents.csv)")
    d.add_argument("--jdbc-url")
    d.add_argument("--jdbc-driver")
    d.add_argument("--jdbc-user")
    d.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    d.add_argument("--jdbc-schema")
    d.add_argument("--jdbc-key", help="numeric column for parallel range reads")
    d.add_argument("--jdbc-balanced", action="store_true", help="read in quantile bands of the key")
    d.add_argument("--warehouse-root", help="table location root (default: the catalog's warehouse dir)")
    d.add_argument("--namespace", default="", help="prefix of the raw/silver/gold database names")
    d.add_argument("--on-fail", choices=("warn", "raise"), default="warn")
    d.add_argument("--as-of", help="extraction instant (UTC); default now")
    d.add_argument("--buckets", type=int, help="bucket the fact and dimensions by key into this many buckets")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    from tributary.plans.daily import Sources, run_day
    from tributary.session import build_session
    from tributary.sinks.warehouse import Warehouse
    from tributary.sources.jdbc import JdbcSource

    spark = build_session(app_name=f"tributary-{args.date}")
    web_forms = None
    if args.jdbc_url:
        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password_env:
            props["password"] = os.environ[args.jdbc_password_env]
        web_forms = JdbcSource(url=args.jdbc_url, driver=args.jdbc_driver, properties=props)
    src = Sources(customers_dir=args.customers, call_logs_dir=args.call_logs, social_media_dir=args.social_media,
                  spreadsheet_dir=args.spreadsheet, web_forms=web_forms, web_forms_schema=args.jdbc_schema,
                  web_forms_key=args.jdbc_key, web_forms_balanced=args.jdbc_balanced)
    wh = Warehouse(spark, args.warehouse_root, namespace=args.namespace)
    out = run_day(spark, src, args.lake, wh, args.date, as_of=args.as_of, on_fail=args.on_fail,
                  buckets=args.buckets)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
