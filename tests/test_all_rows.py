"""Every query that fits a model asks for all training rows."""

import pytest

from conftest import SF0001
from newsflow.plans import model as M
from newsflow.plans import sharded


class _Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["dedup_score", "grid_search", "lexicon_train", "model_accuracy", "model_roundtrip",
                                  "predict_text", "retrain", "score_batch", "score_json", "stream_score", "train_lr", "train_sharded"])
def test_queries_fit_all_rows(spark, monkeypatch, name):
    import __spark_entry__ as E
    from newsflow.queries import model as Q

    def bounded(df, cfg):
        raise _Asked(cfg.max_fit_rows)

    monkeypatch.setattr(Q, "_MODELS", {})
    monkeypatch.setattr(M, "bounded", bounded)
    monkeypatch.setattr(sharded, "bounded", bounded, raising=False)
    with pytest.raises(_Asked) as asked:
        E.queries()[name](spark, SF0001)
    assert asked.value.args == (None,)
