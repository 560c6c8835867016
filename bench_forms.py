"""Time plain forms of some steps next to the forms used here; one JSON line.

The plain form is what the same result takes without the rewrite: four stacked
regex replacements and an IN list, a projection for each column, two metric
jobs, one scoring job for each model.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from trainlake.catalog.common import spread_table
from trainlake.catalog.metrics import signal
from trainlake.functions.stopwords import stopwords
from trainlake.functions.words import clean_steps
from trainlake.operators import models
from trainlake.operators.evaluate import metrics_of, score_models
from trainlake.operators.features import Roles
from trainlake.operators.models import fit_features
from trainlake.operators.trend import trending
from trainlake.session import get_session


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def plain_trend(docs):
    words = docs.select(F.explode(F.split(clean_steps(F.col("text")), " ")).alias("word"))
    counts = words.groupBy("word").count().orderBy(F.desc("count"), "word")
    return counts.filter(~F.col("word").isin(list(stopwords())) & (F.length("word") > 3))


def best_of(times: int, job) -> float:
    seconds = []
    for _ in range(times):
        started = time.monotonic()
        job()
        seconds.append(time.monotonic() - started)
    return round(min(seconds), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}
    spark = get_session("forms", f"local[{cpus}]", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    docs = spread_table(spark, sf, "documents", "text")

    rows = signal(spark, sf)
    features = fit_features(rows, Roles(("l_returnflag",), ("l_quantity", "l_discount")), one_hot=False)
    data = features.model.transform(rows).select("features", "y").persist()
    fits = [models.tree("y", maxDepth=d).fit(data) for d in (1, 2, 3, 4)]
    scored = fits[0].transform(data)

    def plain_metrics() -> None:
        for name in ("rmse", "r2", "mae"):
            RegressionEvaluator(labelCol="y", metricName=name).evaluate(scored)

    forms = {
        "trend": (lambda: run(plain_trend(docs)), lambda: run(trending(docs))),
        "metrics": (plain_metrics, lambda: metrics_of(scored, "y", {"p": "prediction"})),
        "score_four_models": (
            lambda: [score_models([m], data, "y") for m in fits],
            lambda: score_models(fits, data, "y"),
        ),
    }
    seconds = {name: {"plain": best_of(3, a), "ours": best_of(3, b)} for name, (a, b) in forms.items()}
    print(json.dumps({"unit": "sec, best of 3", "forms": seconds, "sf": os.path.basename(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
