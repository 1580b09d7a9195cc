"""Command line: ``python -m lexiflow prepare|select|tune|score ...`` (spark-submit friendly)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def main(argv=None):
    ap = argparse.ArgumentParser(prog="lexiflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare", help="labelled text files -> feature tables + models")
    p.add_argument("--train", required=True)
    p.add_argument("--test", required=True)
    p.add_argument("--val", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--sep", default=";")
    p.add_argument("--malformed", default="fail", choices=["keep", "drop", "fail"])
    p.add_argument("--lemmas", default=None, help="Parquet table (form, lemma)")
    p.add_argument("--weights", default="share", choices=["share", "inverse"])
    p.add_argument("--mode", default="errorifexists")
    s = sub.add_parser("select", help="feature tables -> result table CSV")
    s.add_argument("--features", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--classifiers", default="svm,lr,nb")
    s.add_argument("--feature-sets", default="G1,G2,G3,G4")
    s.add_argument("--orientation", default="right", choices=["right", "swapped"])
    s.add_argument("--train-partitions", type=int, default=None, help="tasks of a solver's iteration at most")
    t = sub.add_parser("tune", help="cross-validated grid search of the one-vs-rest SVM")
    t.add_argument("--features", required=True)
    t.add_argument("--feature-set", default="G3")
    t.add_argument("--folds", type=int, default=3)
    t.add_argument("--model", default=None, help="where to save the best model")
    c = sub.add_parser("score", help="text files -> predicted labels, with the saved models")
    c.add_argument("--prepared", required=True, help="the folder that prepare wrote")
    c.add_argument("--model", required=True, help="the model that tune saved")
    c.add_argument("--texts", required=True)
    c.add_argument("--out", required=True)
    for q in (s, t, c):
        q.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    args = ap.parse_args(argv)

    from .plans import jobs
    spark = SparkSession.builder.appName(f"lexiflow-{args.cmd}").getOrCreate()
    if args.cmd == "prepare":
        out = jobs.prepare_job(spark, args.train, args.test, args.val, args.out, args.sep, args.malformed,
                               args.lemmas, args.weights, mode=args.mode)
    elif args.cmd == "select":
        res = jobs.select_job(spark, args.features, args.out, tuple(args.classifiers.split(",")),
                              tuple(args.feature_sets.split(",")), args.orientation, mode=args.mode, train_partitions=args.train_partitions)
        out = [r.asDict() for r in res.collect()]
    elif args.cmd == "tune":
        out = jobs.tune_job(spark, args.features, args.feature_set, args.folds, model_path=args.model, mode=args.mode)
    else:
        scored = jobs.score_job(spark, args.prepared, args.model, args.texts, args.out, args.mode)
        out = {r["label"]: r["count"] for r in scored.groupBy("label").count().collect()}
    print(json.dumps(out, indent=1, default=str))


if __name__ == "__main__":
    main()
