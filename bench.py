"""Benchmark: the reference's workload on ``$BENCH_SF_DIR`` (default sf0.1).

Phases timed, all cold (states and results are forgotten before each):
* ``lemmatize``, ``clean_text``, ``tokenize``: data queries, executed in full (noop sink);
* ``prepare_fit``: label index + class weights + cleaning + lemmas + fitting the
  four feature sets (vocabularies, IDF, chi-square selection) on training rows;
* ``cache_G1``..``cache_G4``: writing and caching each set's training and held-out frames;
* ``df1``..``df12``: wall seconds of each classifier ``fit`` on a cached
  training frame -- the same quantity as the reference's ``trainingTime``
* ``nb_predict_cold``, ``chi2_statistic``: queries with the fits they need;
* ``cv_small``: cross-validation of 2 settings on 3 folds.

Prints one JSON line.  ``value`` is the sum of the twelve fit times (the
reference's is 55.64 s on 16,000 short texts); ``fit_and_cache_total`` adds the
cache fills, part of which the reference's clock has inside its fits.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexiflow.operators.models import make_classifier, materialize, release  # noqa: E402
from lexiflow.plans import catalog as C  # noqa: E402
from lexiflow.plans import tuning as T  # noqa: E402
from lexiflow.plans.experiments import run_experiments  # noqa: E402
from lexiflow.plans.splits import TRAIN, is_split  # noqa: E402
from lexiflow.session import local_session  # noqa: E402

#: Tasks of a solver's iteration: the caller's choice for some thousand training rows on one machine.
TRAIN_PARTITIONS = int(os.environ.get("BENCH_TRAIN_PARTITIONS", "2"))
COLD = ["clean_text", "tokenize", "lemmatize"]
AFTER = ["vocabulary", "tfidf", "weighted_metrics"]


def _sf_number(sf_dir: str):
    name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="lexiflow-bench")
    times: dict[str, float] = {}

    errors = {}

    def timed(name, work):
        t0 = time.perf_counter()
        try:
            return work()
        except Exception as e:  # noqa: BLE001 - report, keep the headline numbers
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        finally:
            times[name] = time.perf_counter() - t0

    def run(name):
        C.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    C.READ_PARTITIONS = spark.sparkContext.defaultParallelism  # the test tables are single row groups
    for name in COLD:
        timed(name, lambda name=name: run(name))

    def prepare():
        st = C.state(spark, sf_dir)
        return st, dict(zip(("G1", "G2", "G3", "G4"), st.models("G1", "G2", "G3", "G4")))

    st, models = timed("prepare_fit", prepare)
    log: list = []
    rows = timed("experiment_total", lambda: run_experiments(
        spark, st.frame, models, st.n_classes, ("svm", "lr", "nb"), orientation="swapped", parallelism=4,
        log=log, train_partitions=TRAIN_PARTITIONS).collect())
    n_runs = 0
    for entry in log:
        if "fit_seconds" in entry:
            n_runs += 1
            times[f"df{n_runs}"] = entry["fit_seconds"]
        else:
            times[f"cache_{entry['feature_set']}"] = entry["cache_seconds"]
    for name in AFTER:
        timed(name, lambda name=name: run(name))

    def small_cv():
        (g3,) = st.models("G3")
        train = materialize(T.assign_folds(g3.transform(st.frame).filter(is_split(TRAIN)).select(
            "doc_id", "label", "weight", "featuresIDF"), 3, "doc_id", "fold"))
        est = make_classifier("lr", "featuresIDF")
        T.cross_validate(est, T.param_grid(est, (10,), (0.1, 0.01)), train, "fold", parallelism=2)
        release(train)

    timed("cv_small", small_cv)
    for name, query in (("nb_predict_cold", "nb_predict"), ("chi2_statistic_cold", "chi2_statistic")):
        C.release_states()
        timed(name, lambda query=query: run(query))

    fit_total = sum(times[f"df{i}"] for i in range(1, n_runs + 1))
    out = {
        "metric": "experiment_fit_seconds_total",
        "value": round(fit_total, 3),
        "unit": "sec",
        "fit_and_cache_total": round(fit_total + sum(v for k, v in times.items() if k.startswith("cache_")), 3),
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": _sf_number(sf_dir),
        "results": [r.asDict() for r in rows],
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
