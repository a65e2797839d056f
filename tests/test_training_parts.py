"""An iteration adds up as many gradients as there are cores."""

from corpus_engine.operators import models as md


def test_gradients_of_an_iteration_are_as_many_as_cores():
    assert md.training_parts(10_000_000, 2_000, 12) == 12
    assert md.training_parts(7_000, 100, 12) == 2
    assert md.training_parts(0, 4, 12) == 1
