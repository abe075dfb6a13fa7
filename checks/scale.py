"""Run both jobs on a multiple of the test tables: python -m checks.scale VIEWS SEARCHES [SF_DIR]

VIEWS and SEARCHES say how often the logs are repeated, each time for other customers; a third of
all rows then goes to one contract and one user. Prints one JSON line.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import bench
from checks import fixtures
from couchlog import plans


def repeated(log: DataFrame, times: int, customer: str) -> DataFrame:
    copies = log.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
    own = F.when(F.col(customer).isin("", "0"), F.col(customer)).otherwise(
        F.concat(customer, F.lit("/"), F.col("copy").cast("string"))
    )
    return copies.withColumn(customer, F.when(F.col("copy") % 3 == 0, F.lit("hot")).otherwise(own)).drop("copy")


def main(views: int, searches: int, sf_dir: str) -> None:
    spark = bench.session(tempfile.mkdtemp(prefix="couchlog-scale-"))
    folder = fixtures.raw_folder(spark, "scale")
    report = {}
    if views:
        log = repeated(fixtures.view_log(spark, sf_dir), views, "Contract").repartition(64)
        root = fixtures.write_view_days(log, f"{folder}/views")
        start = time.perf_counter()
        profile = plans.content_job(spark, root, f"{folder}/content")
        report["content_job"] = {"sec": round(time.perf_counter() - start, 1), "profiles": profile.count()}
        hot = profile.filter("Contract = 'hot'").head()
        report["content_job"]["hot"] = None if hot is None else hot.asDict()
    if searches:
        log = repeated(fixtures.search_log(spark, sf_dir), searches, "user_id").repartition(64)
        root = fixtures.write_search_days(log, f"{folder}/searches")
        span = (fixtures.SEARCH_START, fixtures.SEARCH_END)
        start = time.perf_counter()
        profile = plans.search_job(spark, root, *span, f"{folder}/search")
        report["search_job"] = {"sec": round(time.perf_counter() - start, 1), "profiles": profile.count()}
        hot = profile.filter("user_id = 'hot'").head()
        report["search_job"]["hot"] = None if hot is None else hot.asDict()
    print(json.dumps(report, ensure_ascii=False))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]), int(sys.argv[2]), sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1")
