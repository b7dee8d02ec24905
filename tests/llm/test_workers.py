"""What Python workers hold while they wait, and that no step starts a second set of them."""

from __future__ import annotations

import pickle
import time

import pandas as pd
import public_tokenizers
import pytest
from pyspark import SparkContext

from fleetlens.llm import common, language
from fleetlens.llm.packing import pack


@pytest.fixture
def alone(monkeypatch):
    """The test's own store of what is kept, given up soon."""
    monkeypatch.setattr(common, "_kept", {})
    monkeypatch.setattr(common, "IDLE", 0.3)
    return common._kept


def waited(store):
    end = time.time() + 10
    while store and time.time() < end:
        time.sleep(0.05)
    return store


def test_idle_workers_keep_nothing(alone):
    run = common.trimmed(lambda batches: ((b, common.kept("k", object)) for b in batches))
    assert [b for b, _ in run(iter([1, 2]))] == [1, 2]
    assert "k" in alone  # the next task finds it
    assert not waited(alone)


def test_a_task_in_between_keeps_it(alone):
    made = []

    def run(batches):
        for batch in batches:
            common.kept("k", lambda: made.append(1) or object())
            time.sleep(0.2)
            yield batch

    for _ in range(4):
        assert list(common.trimmed(run)(iter([1, 2]))) == [1, 2]
    assert len(made) == 1
    assert not waited(alone)


def test_a_failed_task_leaves_nothing(alone):
    def run(batches):
        common.kept("k", object)
        raise ValueError
        yield

    with pytest.raises(ValueError):
        list(common.trimmed(run)(iter([])))
    assert not waited(alone)


def test_one_model_a_worker(spark, alone, monkeypatch):
    model = language.Model(["de", "en"], {0: {"der": [-1.0, -7.0], "the": [-7.0, -1.0]}})
    loads, calls = pickle.loads, []
    monkeypatch.setattr(language.pickle, "loads", lambda x: calls.append(1) or loads(x))
    predict = language.predictor(model)
    for _ in range(3):
        found = pd.concat(predict.func(iter([pd.Series(["der Hund", "the dog", None, "12"])])))
        assert found["lang_pred"].tolist() == ["de", "en", "und", "und"]
    assert len(calls) == 1


def test_packing_hands_no_rows_to_python(frame, odd_rows, monkeypatch):
    def never(*_args, **_named):
        raise AssertionError("rows of the driver go through Python workers of their own")

    docs = frame(odd_rows)
    monkeypatch.setattr(SparkContext, "parallelize", never)
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2).collect()
    assert {r["doc_id"] for r in pieces} == {row[0] for row in odd_rows}
    assert not pack(docs.limit(0), public_tokenizers.path("word_bpe_49k.json"), 2).collect()
