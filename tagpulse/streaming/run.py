"""Run the three streaming queries until one ends: ``python -m tagpulse.streaming.run --root ...``"""

from __future__ import annotations

import argparse

from tagpulse.session import build_session
from tagpulse.sources.messages import BOOTSTRAP_SERVERS, QUESTIONS_TOPIC, TRENDS_TOPIC, file_messages, kafka_messages
from tagpulse.streaming import jobs


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of tables and checkpoints, shared by all executors")
    parser.add_argument("--servers", default=BOOTSTRAP_SERVERS)
    parser.add_argument("--questions", default=QUESTIONS_TOPIC, help="topic, or with --files a folder")
    parser.add_argument("--trends", default=TRENDS_TOPIC, help="topic, or with --files a folder")
    parser.add_argument("--files", action="store_true", help="read text files, one message per line")
    parser.add_argument("--minutes", type=float, default=5, help="between triggers; 0: take what is there and end")
    parser.add_argument("--max-per-trigger", type=int)
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--dedup", action="store_true", help="count a question once however often it is sent")
    given = parser.parse_args(arguments)

    spark = build_session(kafka=not given.files)

    def messages(place: str):
        if given.files:
            return file_messages(spark, place, max_per_trigger=given.max_per_trigger)
        limits = {"max_per_trigger": given.max_per_trigger, "min_partitions": given.min_partitions}
        return kafka_messages(spark, place, given.servers, **limits)

    trigger = {"processingTime": f"{given.minutes} minutes"} if given.minutes else {"availableNow": True}
    _, running = jobs.start_all(
        spark, messages(given.questions), messages(given.trends), given.root, trigger, dedup=given.dedup
    )
    if given.minutes:
        jobs.await_any(spark, running)
    else:
        for query in running:
            query.awaitTermination()


if __name__ == "__main__":
    main()
