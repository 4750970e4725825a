"""``spark-submit -m prevascope {all,load,build,check} [LANDING_DIRECTORY] [--layout lines] [--report PATH]``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import functions as F

from prevascope.operators.quality import assert_quality
from prevascope.plans.layers import build_models, check_raw, load_directory, run_all
from prevascope.session import build_session, scratch_scope
from prevascope.sources.landing import AUTO, DOCUMENT, LINES
from prevascope.sources.reports import nest_report, save_report


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="prevascope", description="Load landing files, build models, check them.")
    parser.add_argument("step", choices=["all", "load", "build", "check"])
    parser.add_argument("directory", nargs="?", help="landing files, for all and load")
    parser.add_argument("--layout", choices=[AUTO, DOCUMENT, LINES], default=AUTO)
    parser.add_argument("--report", help="folder for the quality report, for all and check")
    options = parser.parse_args(arguments)
    if options.step in ("all", "load") and not options.directory:
        parser.error(f"{options.step} needs the directory")
    spark = build_session()
    if options.step == "all":
        run_all(spark, options.directory, layout=options.layout, report_path=options.report)
    elif options.step == "load":
        with scratch_scope(spark):
            load_directory(spark, options.directory, layout=options.layout)
    elif options.step == "build":
        with scratch_scope(spark):
            build_models(spark)
    else:
        as_of = datetime.now(timezone.utc)
        checks = check_raw(spark, as_of=F.lit(as_of))
        if options.report:
            save_report(nest_report(checks, as_of.isoformat()), options.report)
        assert_quality(checks)


if __name__ == "__main__":
    main()
