"""Registered queries run the operators' own settings."""

import inspect
from types import SimpleNamespace

import pytest

from corpus_engine.catalog import learning
from corpus_engine.operators import models


def test_boosted_scores_trains_all_rounds(monkeypatch):
    class Trained(Exception):
        pass

    def train(*args, **settings):
        bound = inspect.signature(models_train).bind(*args, **settings)
        bound.apply_defaults()
        raise Trained(bound.arguments["max_iter"])

    models_train = models.train_boosted
    monkeypatch.setattr(learning, "classifier", lambda spark, sf: SimpleNamespace(train=None, test=None, model=None))
    monkeypatch.setattr(learning.md, "train_boosted", train)
    with pytest.raises(Trained, match="^100$"):
        learning.boosted_scores(None, "sf")
