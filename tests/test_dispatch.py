"""Dispatchers and guards: named methods run, unknown names are errors (not silent no-ops)."""

import pytest

from framewright.operators import encode as E
from framewright.operators import evaluate as EV
from framewright.operators import impute as I
from framewright.operators import scale as S
from framewright.operators import select as SEL
from framewright.plans.compose import resolve_errors


@pytest.fixture
def frame(spark):
    rows = [(1, "a", 1.0, 0), (2, "b", None, 1), (3, "a", 3.0, 1), (3, "a", 3.0, 1), (4, None, -5.0, 0)]
    return spark.createDataFrame(rows, "k int, c string, x double, y int")


def test_resolve_errors_order_and_unknown(frame):
    out = resolve_errors(frame, {"duplicate_rows": True, "missing_values": "drop", "inconsistent_values": True})
    assert sorted((r.k, r.x) for r in out.collect()) == [(1, 1.0), (3, 3.0)]
    with pytest.raises(ValueError):
        resolve_errors(frame, {"typo": True})


def test_named_dispatchers(frame):
    assert E.encoding_selected(frame, "frequency", col="c").count() == 5
    with pytest.raises(ValueError):
        E.encoding_selected(frame, "nope")
    assert I.impute_missing_values(frame, "median").where("x IS NULL").count() == 0
    with pytest.raises(ValueError):
        I.impute_missing_values(frame, "nope")
    assert S.scale_generic(frame, "robust", ["x"]).count() == 5
    with pytest.raises(ValueError):
        S.scale_generic(frame, "nope")
    with pytest.raises(ValueError):
        SEL.filter_irrelevant_columns(frame, ["nope"])


def test_guards(frame):
    with pytest.raises(ValueError):
        EV.evaluate_clusters(frame, ["x"], "y", kind="agglomerative")
    with pytest.raises(ValueError):
        EV.confusion_matrix(frame, "k", "y", max_labels=2)
    with pytest.raises(ValueError):
        E.onehot_full(frame.withColumn("c", frame["k"].cast("string")), max_categories=2)
