"""Bench: the 25 questions on $BENCH_SF_DIR with local[$BENCH_CPUS].

1. Map the driver's tables to the seven catalogue tables and land them once
   (timed, reported as ``land_sec``) as Parquet folders under the session's
   checkpoint dir. All timings below are on these tables.
2. Per question: one warm-up, then the median of 5 runs of a ``noop`` write
   (the full result is computed, nothing is collected to the driver).
3. Like for like (``like_for_like``): the questions whose reference form is a window or pivot
   that we wrote differently (Q7, Q10, Q14, Q16-Q19, Q23, Q25), ours and the
   literal form as Spark SQL.
4. What the opt-in sharing of ``plans.job.run_all`` costs and gains
   (``shared_rated``, ``shared_credits``): the seconds to write the table, and the
   sums over the questions that use it with and without it.
5. Per question, the initial plan's exchange / join / broadcast / window counts
   (``plans``).

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.plans import oracle as O  # noqa: E402
from marquee.plans.inspect import operator_counts, physical_plan  # noqa: E402
from marquee.plans.job import shared  # noqa: E402
from marquee.plans.registry import QUESTION_KEYS, REGISTRY, present  # noqa: E402
from marquee.session import local_session, scratch_path  # noqa: E402
from marquee.sources import land_catalog, load_parquet, load_testdata  # noqa: E402

USE_RATED = (
    "top_titles_by_votes",
    "titles_above_rating",
    "top_titles_per_year",
    "rating_vs_genre_year_mean",
    "top_writer_genre_sets",
    "top_genre_set_per_decade",
    "youngest_actors",
    "titles_per_year",
    "genre_rating_by_region",
)
USE_CREDITS = ("worst_rated_actors", "most_improved_people", "actors_by_genre_count", "people_by_rating_spread", "longest_careers")

# Q10's window as the reference has it: first and last rating over each person's
# titles by startYear, up to the current one.
Q10_LITERAL = """
WITH w AS (
  SELECT p.nconst, last(r.averageRating) OVER byYear - first(r.averageRating) OVER byYear AS gain
  FROM title_principals p JOIN title_basics t ON p.tconst = t.tconst JOIN title_ratings r ON p.tconst = r.tconst
  WINDOW byYear AS (PARTITION BY p.nconst ORDER BY t.startYear)
), m AS (SELECT nconst, max(gain) AS max_improvement FROM w GROUP BY nconst)
SELECT primaryName, max_improvement FROM m JOIN name_basics USING (nconst) ORDER BY max_improvement DESC"""


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    keys = os.environ.get("BENCH_KEYS")
    keys = keys.split(",") if keys else QUESTION_KEYS

    parts = 2 * cpus

    spark = local_session(
        master=f"local[{cpus}]",
        shuffle_partitions=parts,
        app="marquee-bench",
        extra={
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="marquee-wh-"),
            **json.loads(os.environ.get("BENCH_EXTRA_CONF", "{}")),
        },
    )

    spark.range(1).count()  # start the executors before any timing

    t0 = time.perf_counter()
    mapped = load_testdata(spark, sf_dir)
    cat = load_parquet(spark, land_catalog(mapped, scratch_path(spark, "bench-catalog"), files=parts))
    land_sec = time.perf_counter() - t0

    def timed(build) -> float:
        _noop(build())  # warm-up
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            _noop(build())
            samples.append(time.perf_counter() - t)
        return round(statistics.median(samples), 4)

    timings: dict[str, float] = {}
    plans: dict[str, dict[str, int]] = {}
    for key in keys:
        build = REGISTRY[key].build
        counts = operator_counts(physical_plan(build(cat)))
        plans[key] = {
            "exchanges": counts.get("Exchange", 0),
            "joins": sum(v for k, v in counts.items() if k.endswith("Join")),
            "broadcast_joins": counts.get("BroadcastHashJoin", 0),
            "windows": counts.get("Window", 0),
        }
        timings[key] = timed(lambda: build(cat))

    # The reference's literal forms of the questions we rewrote (the oracle's
    # SQL, which keeps them), run on Spark SQL over the same landed tables, next
    # to ours over those tables: the measured gain -- or cost -- of each rewrite.
    like: dict[str, dict[str, float]] = {}
    gains: dict[str, dict[str, float]] = {}
    if os.environ.get("BENCH_LITERAL", "1") == "1":
        for name, df in cat.items():
            df.createOrReplaceTempView(O.TABLE_OF[name])
        params = {s.key: s.params for s in REGISTRY.values()}
        forms = {
            "rating_vs_genre_year_mean": O.q7(),
            "most_improved_people": Q10_LITERAL,
            "series_by_episode_count": O.q14(10),
            "people_by_rating_spread": O.q16(10),
            "titles_by_alias_count": O.q17(10),
            "longest_careers": O.q18(),
            "people_by_genre_credits": O.q19(params["people_by_genre_credits"]["genre"], 10),
            "youngest_actors": O.q23(params["youngest_actors"]["year"], 20),
            "genre_rating_by_region": O.q25(
                params["genre_rating_by_region"]["genre"],
                params["genre_rating_by_region"]["year_from"],
                params["genre_rating_by_region"]["year_to"],
                params["genre_rating_by_region"]["regions"],
            ),
        }
        for key, sql in forms.items():
            if key not in timings:
                continue
            # the two DuckDB function names these statements use, in Spark SQL
            sql = sql.replace("list_contains(", "array_contains(").replace("array_to_string(", "array_join(")
            like[key] = {
                "ours": timed(lambda: present(REGISTRY[key].build(cat))),
                "literal": timed(lambda: spark.sql(sql)),
            }
        for name, keyset, credits in (("shared_rated", USE_RATED, False), ("shared_credits", USE_CREDITS, True)):
            t0 = time.perf_counter()
            with shared(cat, rated=not credits, credits=credits) as full:
                gains[name] = {"write": round(time.perf_counter() - t0, 4)}
                mine = [key for key in keyset if key in timings]
                gains[name]["with"] = round(sum(timed(lambda: REGISTRY[key].build(full)) for key in mine), 4)
                gains[name]["without"] = round(sum(timings[key] for key in mine), 4)

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_question_sec",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "land_sec": round(land_sec, 4),
                "total_with_landing": round(sum(timings.values()) + land_sec, 4),
                "like_for_like": like,
                **gains,
                "plans": plans,
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
