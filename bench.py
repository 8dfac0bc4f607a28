"""Time the headline queries on the tables in $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from copse.params import BoostParams  # noqa: E402
from copse.plans import catalog, views  # noqa: E402
from copse.plans.boost import fit  # noqa: E402
from copse.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "grad_hess", "node_hist", "split_candidates", "split_root", "split_level", "split_histogram", "split_quantile",
    "predict_proba", "confusion", "train_test_split", "value_rank", "impute", "standardize", "target_encode",
    "knn", "oversample", "prep_clean", "end_to_end",
)


def run(df) -> None:
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "copse-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(views.li_xy(spark, FOLDER))  # start-up is not part of any figure
    times: dict[str, float] = {}
    quality: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        run(catalog.QUERIES[name](spark, FOLDER))
        times[name] = round(time.perf_counter() - began, 3)
    for method, more in (("exact", {}), ("quantile", {"eps": 0.02}), ("histogram", {"num_bins": 32})):
        params = BoostParams(
            trees=3, depth=4, learning_rate=0.1, gamma=0.0, subsample_cols=1.0, method=method, **more
        )
        began = time.perf_counter()
        model = fit(views.li_xy(spark, FOLDER), views.LI_FEATURES, "label", params)
        times[f"fit_{method}"] = round(time.perf_counter() - began, 3)
        quality[f"loss_{method}"] = round(model.losses[-1], 6)
        quality[f"sec_per_tree_{method}"] = round(sum(model.elapsed_ms) / 1000 / params.trees, 3)
    began = time.perf_counter()
    run(model.predict_proba(views.li_xy(spark, FOLDER)))
    times["score_3_trees"] = round(time.perf_counter() - began, 3)
    began = time.perf_counter()
    run(catalog.QUERIES["usual_configuration"](spark, FOLDER))  # ten trees of depth eight; apart from the total, which goes on from earlier ones
    usual = round(time.perf_counter() - began, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total headline query time", "value": total, "unit": "sec",
                "queries": times, "quality": quality, "usual_configuration_sec": usual, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
