"""The comparison of all models: one split for all of them."""
import numpy as np

from sparkfeat.operators import models as M
from sparkfeat.plans import queries as Q


def test_models_share_one_split(spark, tmp_path, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=4) + i % 3).tolist(), i % 3) for i in range(240)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    splits, split = [], Q._train_test
    monkeypatch.setattr(Q, "_train_test", lambda *a: splits.append(split(*a)) or splits[-1])
    monkeypatch.setattr(M, "MODELS", ["naive_bayes", "tree", "forest"])
    got = {x["model"]: x for x in Q.q_model_comparison(spark, str(tmp_path)).collect()}
    assert len(splits) == 1 and set(got) == {"knn_5", "naive_bayes", "tree", "forest"}
    assert sum(x["is_best"] for x in got.values()) == 1 and all(x["accuracy"] > 0.5 and x["size_kb"] > 0 for x in got.values())
    alone = Q._zoo_row(spark, str(tmp_path), "naive_bayes").first()
    assert all(abs(alone[c] - got["naive_bayes"][c]) < 1e-9 for c in ("accuracy", "precision", "recall", "f1"))
