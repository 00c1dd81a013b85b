"""Command line for the recurring jobs.

  python -m pintime refresh <data_dir> <root> [--end YYYY-MM-DD]
      rebuild both feature tables under <root>/tables and publish the newest
      values incrementally to the snapshot store under <root>/online (FS-11);
      run it from any scheduler, e.g. daily.
  python -m pintime train <data_dir> <root> [--trees N] [--objective counts]
      fit the count model on the cleaned training set and save the next
      version under <root>/models (ML-3, ML-5, ML-8).
  python -m pintime score <root> <requests_json> <out_dir>
      batch-score request documents with the latest model against the
      current snapshots; writes ``id, state, prediction`` as parquet (ML-7).

<root> must be a shared path on a cluster (the same kind of location as
``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pintime import config
from pintime.session import get_spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="pintime")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("data_dir")
    r.add_argument("root")
    r.add_argument("--end", default=None)
    t = sub.add_parser("train")
    t.add_argument("data_dir")
    t.add_argument("root")
    t.add_argument("--trees", type=int, default=config.GBT_TREES)
    t.add_argument("--objective", choices=["squared", "poisson", "counts"],
                   default="squared", help="boosted trees for squared error or for counts "
                                           "(Poisson), or a Poisson regression")
    s = sub.add_parser("score")
    s.add_argument("root")
    s.add_argument("requests")
    s.add_argument("out")
    args = p.parse_args(argv)
    spark = get_spark()

    if args.cmd == "refresh":
        from pintime.plans.refresh import refresh
        end = datetime.fromisoformat(args.end) if args.end else None
        store, _ = refresh(spark, args.data_dir, args.root, end_ts=end)
        for view in ("weekly_vaccinations", "vaccine_search_trends"):
            cur = store.current(view)
            print(view, "version", cur.version if cur else None)
    elif args.cmd == "train":
        from pintime.plans.catalog import clean_training_set
        from pintime.plans.model import ModelRegistry, fit, gbt_pipeline, poisson_pipeline
        data = clean_training_set(spark, args.data_dir).select(
            "state", config.EVENT_TS, *config.X_COLS, config.Y_COL).checkpoint()
        if args.objective == "counts":
            from datetime import timedelta

            from pintime.operators.split import temporal_split
            from pintime.plans.boosting import fit_counts
            model = fit_counts(*temporal_split(data, timedelta(weeks=1), config.EVENT_TS),
                               trees=args.trees).model
        else:
            model = fit(data, poisson_pipeline() if args.objective == "poisson"
                        else gbt_pipeline(trees=args.trees))
        version = ModelRegistry(spark, f"{args.root}/models").save("predict-counts", model)
        print("saved model version", version)
    elif args.cmd == "score":
        from pintime.plans.model import ModelRegistry, score
        from pintime.plans.online import SnapshotStore, get_online_features
        from pintime.plans.repo import count_view, services, trend_view
        from pintime.sources.requests import read_request_keys
        root = args.root.rstrip("/")
        serving, _ = services(trend_view(path=f"{root}/tables/trends"),
                              count_view(path=f"{root}/tables/counts"))
        store = SnapshotStore(spark, f"{root}/online")
        feats = get_online_features(store, serving, read_request_keys(spark, args.requests))
        model = ModelRegistry(spark, f"{root}/models").load("predict-counts")
        score(model, feats, keys=("id", "state")).write.mode("overwrite").parquet(args.out)
        print("scored to", args.out)
    spark.stop()


if __name__ == "__main__":
    main()
