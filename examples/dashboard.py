"""Run the whole dashboard flow over a folder of channel exports.

    python examples/dashboard.py EXPORT_DIR [OUT_DIR]

EXPORT_DIR holds one CSV export (or a folder of them) per channel, named
after the channel (``*facebook*``, ``*google*``, ``*tiktok*``).  Every table
of the dashboard is written as parquet under OUT_DIR (default: a folder under
the session's checkpoint directory); only the small KPI row is printed.
"""

from __future__ import annotations

import glob
import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adfuse.plans import dashboard  # noqa: E402
from adfuse.sources import CHANNELS, read_feed, scratch_path  # noqa: E402


def main() -> None:
    export_dir = sys.argv[1]
    spark = (
        SparkSession.builder.appName("adfuse-dashboard")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    out_dir = sys.argv[2] if len(sys.argv) > 2 else scratch_path(spark, "dashboard")
    feeds = {}
    for name, spec in CHANNELS.items():
        paths = sorted(glob.glob(os.path.join(export_dir, f"*{name}*")))
        if paths:
            feeds[name] = read_feed(spark, spec, paths, "csv")
    loaded = dashboard.load(feeds, {n: CHANNELS[n] for n in feeds}, materialize_to=f"{out_dir}/base")
    view = dashboard.select(loaded)
    for table in ("series", "platforms", "campaigns", "kpis", "tiles", "spend_share", "impression_share",
                  "platform_kpis", "conversions_stacked", "ctr", "best_worst", "leaders", "below_target",
                  "funnel_stages", "engagement", "search_table", "fact_table"):
        df = getattr(view, table)
        if df is not None:
            df.write.mode("overwrite").parquet(f"{out_dir}/{table}")
    view.tiles.show(truncate=False)
    print(f"tables written under {out_dir}")
    spark.stop()


if __name__ == "__main__":
    main()
