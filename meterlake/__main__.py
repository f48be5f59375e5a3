"""Run the lakehouse from a landing folder, then print evidence and sample answers.

    python -m meterlake LANDING ROOT [--ingest-date 2025-08-31] [--exact-profile]
"""

from __future__ import annotations

import argparse
import datetime as dt

from meterlake.operators.quality import reason_breakdown, reject_samples
from meterlake.operators.ranking import busiest
from meterlake.plans.lakehouse import Lakehouse
from meterlake.plans.questions import TICKET_DAYS, busiest_org
from meterlake.plans.reports import partition_report, zone_size
from meterlake.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="meterlake", description=__doc__)
    parser.add_argument("landing")
    parser.add_argument("root")
    parser.add_argument("--master")
    parser.add_argument("--ingest-date", type=dt.date.fromisoformat)
    parser.add_argument("--buckets", type=int, default=64)
    parser.add_argument("--shuffle-partitions", type=int)
    parser.add_argument("--exact-profile", action="store_true")
    parser.add_argument("--stream", action="store_true", help="one streamed round only")
    args = parser.parse_args()

    spark = build_session("meterlake", args.master, args.shuffle_partitions)
    lake = Lakehouse(spark, args.landing, args.root, args.buckets, args.exact_profile)
    if args.stream:
        days = lake.stream_round()
        print(f"days refreshed: {len(days)}")
        lake.live.row_count("org_daily_usage_by_service").show()
        spark.stop()
        return
    lake.run(args.ingest_date)

    def show(title: str, df, rows: int = 20) -> None:
        print(f"\n{title}")
        df.show(rows, truncate=False)

    show("rows per zone", lake.manifest(), 40)
    rejects = lake.rejected_events()
    show("rejected rows by reason", reason_breakdown(rejects))
    show("rejected rows, examples", reject_samples(rejects))
    for zone in (lake.events, lake.silver, lake.gold("org_daily_usage_by_service")):
        report = partition_report(spark, lake.stored_at(zone), "event_date")
        show(f"size of {zone}", zone_size(report))

    newest, store = lake.newest_day(), lake.serving
    month_ago = newest - dt.timedelta(days=TICKET_DAYS - 1)
    usage = lake.read(lake.gold("org_daily_usage_by_service"))
    org = busiest(usage, "org_id", "event_count").first()[0]
    show("daily cost and requests", store.daily_range(org, month_ago, newest))
    show("services by 14-day cost", store.top_services(org, 5))
    show("revenue in USD", store.revenue(org))
    show("generative tokens", store.genai(org, month_ago))
    show("worst cost anomalies", store.worst_anomalies(org, 10))
    tickets = lake.read(lake.gold("tickets_by_org_date"))
    top = busiest_org(tickets, as_of=newest).first()
    if top is not None:
        show("tickets of the busiest organisation", store.tickets(top[0], month_ago))
    spark.stop()


if __name__ == "__main__":
    main()
